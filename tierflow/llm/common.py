"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.session import work_dir
from tierflow.sinks.paths import delete_dir

WORD = r"[^\x20\x09-\x0D]+"  # a word: code points other than ASCII white space
GAP = r"[\x20\x09-\x0D]+"


def by_value(module_name: str) -> None:
    """Ship a module's functions inside the tasks, so that executors need not
    be able to import this package from their own working directory."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_WRITTEN: list[str] = []


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: write the rows as a Parquet table in the shared folder that
    the session names in ``spark.checkpoint.dir`` and read it again (a lost
    executor loses nothing, and the table's size is known to the planner).  The
    tables of a process are removed when it ends, or by ``release``."""
    spark = df.sparkSession
    path = work_dir(spark, "cut")
    df.write.parquet(path)
    if not _WRITTEN:
        atexit.register(release)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def release() -> None:
    """Remove the tables written by ``cut``; results that still read them must
    have been computed."""
    while _WRITTEN:
        path = _WRITTEN.pop()
        try:
            delete_dir(path)
        except Exception as e:  # noqa: BLE001 - the session may have ended first
            sys.stderr.write(f"left {path}: {type(e).__name__}\n")


def words(text: Column) -> Column:
    """The words of a text in order; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def ascii_lower(text: Column) -> Column:
    """A-Z only, whatever the locale or alphabet of the rest."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null ids count as the empty text)."""
    return F.crc32(F.encode(F.coalesce(id_col.cast("string"), F.lit("")), "UTF-8")) % folds


def buckets_for(df: DataFrame, text_col: str, bytes_each: int = 12_000_000, least: int = 8) -> int:
    """How many hash buckets keep one bucket at the size of ``bytes_each`` of
    input text, from the exact size of all texts (one scan of one column)."""
    total = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(least, -(-int(total) // bytes_each))
