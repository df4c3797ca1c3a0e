"""Tables on Parquet.

* Append tables (bronze, silver): one directory per micro-batch,
  ``<table>/batch_id=<n>/``.  A batch directory is written with overwrite, so
  a retried batch (at-least-once ``foreachBatch``) replaces itself instead of
  duplicating rows; readers see the partition column ``batch_id``.
* Full-refresh tables (gold, monitoring): every refresh writes a NEW
  directory ``<table>/version=<n>/``; the current version is the highest one
  whose write committed (recorded in the table's metadata), so readers of the previous
  version are never disturbed, a failed refresh is simply skipped, and the
  change feed can diff two versions.
* Compacted copies of append tables: ``<table>/_compacted/<n>/`` holds the rows
  of a range of closed batches in files of the target size.  The table's
  metadata points at these segments; batch readers take them instead of the batch
  folders they cover, while streams, to which names with ``_`` are hidden, go on
  with the batch folders, so no row is delivered again.
Comment and properties are kept in ``<table>/_table.json``.
"""

from __future__ import annotations

import json
import math
import threading
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.config import MAX_FILE_AGE
from tierflow.sinks import paths

BUCKET = "_bucket"  # partition column of a version that is laid out for change feeds
TURN = "__turn"
CODEC = "zstd"  # about 0.7 of snappy's bytes
MAX_RANGES = 200  # ranges of batches that one compaction reads apart, at most
TARGET_FILE_BYTES = 128 * 1024 * 1024
# Streams of one driver run as threads and may append to one table: a table's
# metadata is read, changed and written under this lock.
_META = threading.RLock()


class TableStore:
    def __init__(self, spark: SparkSession, root: str, database: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.database = database

    # -- naming / metadata -------------------------------------------------
    def path(self, name: str) -> str:
        db = f"{self.database}/" if self.database else ""
        return f"{self.root}/{db}{name}"

    def meta(self, name: str) -> dict:
        with _META:
            text = paths.read_text(f"{self.path(name)}/_table.json")
        return json.loads(text) if text else {}

    def set_meta(self, name: str, **kv) -> None:
        with _META:
            old = self.meta(name)
            m = {**old, **{k: v for k, v in kv.items() if v is not None}}
            if m != old:
                paths.write_text(f"{self.path(name)}/_table.json", json.dumps(m, sort_keys=True))

    def exists(self, name: str) -> bool:
        return paths.exists(self.path(name))

    # -- append tables ---------------------------------------------------------
    def append_batch(self, name: str, df: DataFrame, batch_id: int, optimize_write: bool = False,
                     partition: tuple[str, str] | None = None, size_bytes: int | None = None) -> None:
        """Write one micro-batch as ``[<key>=<value>/]batch_id=<n>/`` (overwrite,
        so a replayed batch replaces itself).  ``partition`` lets several
        streams (one per source) append to one table without colliding.
        ``optimize_write``: see ``write_files``; ``size_bytes`` is what is read for the batch."""
        if optimize_write:
            df = write_files(df, size_bytes)
        prefix = f"{partition[0]}={partition[1]}/" if partition else ""
        self._uncover(name, partition[1] if partition else "", int(batch_id))
        df.write.mode("overwrite").parquet(f"{self.path(name)}/{prefix}batch_id={int(batch_id)}", compression=CODEC)
        with _META:
            old = self.stored_schema(name)
            schema = df.schema
            if old is not None:  # additive: keep every column ever written, in first-seen order
                known = set(old.fieldNames())
                schema = T.StructType(list(old.fields) + [f for f in df.schema.fields if f.name not in known])
            self.set_meta(name, kind="append", schema=schema.json(), partition=partition[0] if partition else None)

    def batches_by_partition(self, name: str) -> dict[str, list[int]]:
        """Batch numbers by partition value; an unpartitioned table has the value ""."""
        number = lambda dirs: sorted(int(d.split("=", 1)[1]) for d in dirs if d.startswith("batch_id="))
        top = paths.list_dirs(self.path(name))
        if own := number(top):
            return {"": own}
        out = {}
        for d in top:  # partitioned append table: <key>=<value>/batch_id=<n>
            if "=" in d and not d.startswith(("version=", "_", ".")):
                out[d.split("=", 1)[1]] = number(paths.list_dirs(f"{self.path(name)}/{d}"))
        return {k: v for k, v in out.items() if v}

    def batches(self, name: str) -> list[int]:
        return sorted({b for bs in self.batches_by_partition(name).values() for b in bs})

    def stored_schema(self, name: str) -> T.StructType | None:
        s = self.meta(name).get("schema")
        return T.StructType.fromJson(json.loads(s)) if s else None

    def read_append(self, name: str, with_batch_id: bool = True) -> DataFrame:
        schema = self.stored_schema(name)
        if not self.batches(name):
            if schema is None:
                raise FileNotFoundError(f"table {name} has no data and no schema")
            df = self.spark.createDataFrame([], schema).withColumn("batch_id", F.lit(None).cast("int"))
        elif schema is not None:
            # the recorded schema: no footer scan, older files read NULL for newer columns
            part = self.meta(name).get("partition")
            extra = ([T.StructField(part, T.StringType(), True)] if part else []) + \
                [T.StructField("batch_id", T.IntegerType(), True)]
            full = T.StructType(list(schema.fields) + extra)
            df = self.spark.read.schema(full).parquet(self.path(name))
            segments = self.meta(name).get("compacted") or []
            if segments:
                copies = self.spark.read.schema(full).parquet(
                    *[f"{self.path(name)}/_compacted/{seg['dir']}" for seg in segments])
                df = copies.unionByName(df.filter(~self._covered(part, segments[-1]["through"])))
            if part and not with_batch_id:
                df = df.drop(part)
        else:
            df = self.spark.read.option("mergeSchema", "true").parquet(self.path(name))
        return df if with_batch_id else df.drop("batch_id")

    # -- compacted copies of append tables ---------------------------------------
    @staticmethod
    def _covered(part: str | None, through: dict) -> Column:
        """Of a batch folder's rows: are they up to ``through``?  Only partition columns
        are used, so covered folders are not read at all."""
        hit = F.lit(False)
        for value, last in through.items():
            one = F.col("batch_id") <= int(last)
            hit = hit | (one & (F.col(f"`{part}`") == value) if part else one)
        return hit

    def _uncover(self, name: str, value: str, batch_id: int) -> None:
        """Before a batch is written again: no copy that covers it counts any longer."""
        with _META:
            m = self.meta(name)
            segments = m.get("compacted") or []
            good = [seg for seg in segments if seg["through"].get(value, -1) < batch_id]
            if len(good) < len(segments):
                self.set_meta(name, compacted=good)

    def compact_append(self, name: str, target_bytes: int = TARGET_FILE_BYTES, least_batches: int = 2) -> bool:
        """Copy the closed batches that no segment covers yet into a new segment with
        files of about ``target_bytes`` and point batch readers at it.  A batch is closed
        once its stream has written a later one (the last may still be replayed).  Costs
        one pass over the new batches, without a shuffle or sort: a file holds the rows of
        a short range of batches, so a reader of some batches skips the others' files.
        False if they are fewer than ``least_batches``."""
        m = self.meta(name)
        part, segments = m.get("partition"), m.get("compacted") or []
        done = segments[-1]["through"] if segments else {}
        closed = {v: [b for b in bs[:-1] if b > done.get(v, -1)] for v, bs in self.batches_by_partition(name).items()}
        closed = {v: bs for v, bs in closed.items() if bs}
        if sum(map(len, closed.values())) < max(1, least_batches):
            return False
        through = {**done, **{v: bs[-1] for v, bs in closed.items()}}
        prefix = lambda v: f"{self.path(name)}/{part}={v}" if part else self.path(name)
        folders = [f"{prefix(v)}/batch_id={b}" for v, bs in closed.items() for b in bs]
        extra = ([T.StructField(part, T.StringType(), True)] if part else []) + [T.StructField("batch_id", T.IntegerType(), True)]
        full = T.StructType(list(self.stored_schema(name).fields) + extra)
        read = self.spark.read.schema(full).option("basePath", self.path(name))
        ranges = batch_ranges([(f, paths.total_size(f)) for f in folders], target_bytes)
        rows = reduce(DataFrame.unionAll, [read.parquet(*some).coalesce(files_for(size, target_bytes)) for some, size in ranges])
        with _META:  # a number that no segment ever had, valid or not
            number = max([-1, *[int(d) for d in paths.list_dirs(f"{self.path(name)}/_compacted") if d.isdigit()]]) + 1
        rows.write.mode("errorifexists").parquet(f"{self.path(name)}/_compacted/{number}", compression=CODEC)
        with _META:
            if (self.meta(name).get("compacted") or []) != segments:
                return False  # a covered batch was written again meanwhile: this copy does not count
            self.set_meta(name, compacted=[*segments, {"dir": str(number), "through": through}])
        return True

    def stream_append(self, name: str, max_files_per_trigger: int | None = None) -> DataFrame:
        schema = self.stored_schema(name)
        if schema is None:
            raise FileNotFoundError(f"table {name} has no schema yet")
        full = T.StructType(list(schema.fields) + [T.StructField("batch_id", T.IntegerType(), True)])
        r = self.spark.readStream.schema(full).option("maxFileAge", MAX_FILE_AGE)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
        return r.parquet(self.path(name))

    # -- full-refresh (versioned) tables ---------------------------------------
    def versions(self, name: str) -> list[int]:
        return sorted(int(d.split("=", 1)[1]) for d in paths.list_dirs(self.path(name)) if d.startswith("version="))

    def latest_version(self, name: str) -> int | None:
        """The version recorded after its write committed; for tables without
        that record, the highest one with Spark's marker file."""
        current = self.meta(name).get("current")
        if current is not None:
            return int(current)
        for v in reversed(self.versions(name)):
            if paths.exists(f"{self.path(name)}/version={v}/_SUCCESS"):
                return v
        return None

    def write_snapshot(self, name: str, df: DataFrame, comment: str | None = None,
                       properties: dict | None = None, optimize_write: bool = False,
                       buckets: tuple[Sequence[str], int] | None = None, size_bytes: int | None = None) -> int:
        """Write a new version and make it current; returns the version number.
        ``optimize_write``: see ``write_files``; ``size_bytes`` is what is read for the version.

        ``buckets`` (columns, number): rows are laid out by a hash of these columns, and
        a fingerprint of each bucket is kept beside them, so that a change feed reads
        only the buckets that differ.  Choose columns that rows which change together
        share, such as their file."""
        existing = self.versions(name)
        version = (existing[-1] + 1) if existing else 1
        folder, schema = f"{self.path(name)}/version={version}", df.schema
        if buckets:
            columns, n = list(buckets[0]), int(buckets[1])
            laid = df.withColumn(BUCKET, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in columns]), F.lit(n)).cast("int"))
            laid.hint("rebalance", BUCKET).write.partitionBy(BUCKET).mode("errorifexists").parquet(folder, compression=CODEC)
            self._write_fingerprint(folder, schema, columns, n)
        else:
            if optimize_write:
                df = write_files(df, size_bytes)
            df.write.mode("errorifexists").parquet(folder, compression=CODEC)
        self.set_meta(name, kind="snapshot", schema=schema.json(), comment=comment, current=version,
                      properties=dict(properties) if properties else None)
        return version

    def expire_versions(self, name: str, keep: int) -> list[int]:
        """Delete all but the newest ``keep`` committed versions (and failed writes
        below the current one); returns the versions that went.  Readers of an
        older version must have finished."""
        current = self.latest_version(name)
        old = [v for v in self.versions(name) if current is not None and v < current][: None if keep <= 1 else -(keep - 1)]
        for v in old:
            paths.delete_dir(f"{self.path(name)}/version={v}")
        return old

    def read_version(self, name: str, version: int | None = None) -> DataFrame:
        v = version if version is not None else self.latest_version(name)
        if v is None:
            raise FileNotFoundError(f"table {name} has no committed version")
        folder = f"{self.path(name)}/version={v}"
        mark = self.fingerprint(name, v)
        return self._bucketed(folder, mark).drop(BUCKET) if mark else self.spark.read.parquet(folder)

    def _bucketed(self, folder: str, mark: dict) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(mark["schema"]))
        return self.spark.read.schema(T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(folder)

    def _write_fingerprint(self, folder: str, schema: T.StructType, columns: list[str], n: int) -> None:
        """Rows and sum of row hashes of every bucket: ``n`` rows at most reach the driver."""
        mark = {"schema": schema.json(), "columns": columns, "n": n}
        row = F.xxhash64(*[F.col(f"`{c}`") for c in schema.fieldNames()]).cast("decimal(38,0)")
        got = self._bucketed(folder, mark).groupBy(BUCKET).agg(F.count(F.lit(1)).alias("rows"), F.sum(row).alias("sum"))
        mark["buckets"] = {str(r[BUCKET]): [r["rows"], str(r["sum"])] for r in got.collect()}
        paths.write_text(f"{folder}/_fingerprint.json", json.dumps(mark))

    def fingerprint(self, name: str, version: int) -> dict | None:
        text = paths.read_text(f"{self.path(name)}/version={version}/_fingerprint.json")
        return json.loads(text) if text else None

    def read_buckets(self, name: str, version: int, buckets: Sequence[int]) -> DataFrame:
        """The rows of some buckets of a version; other folders are not read."""
        df = self._bucketed(f"{self.path(name)}/version={version}", self.fingerprint(name, version))
        return df.filter(F.col(BUCKET).isin(*buckets) if buckets else F.lit(False)).drop(BUCKET)

    def read(self, name: str) -> DataFrame:
        kind = self.meta(name).get("kind")
        return self.read_version(name) if kind == "snapshot" else self.read_append(name, with_batch_id=False)

    def size_bytes(self, name: str, version: int | None = None) -> int:
        if self.meta(name).get("kind") == "snapshot":
            v = version if version is not None else self.latest_version(name)
            return paths.total_size(f"{self.path(name)}/version={v}")
        return paths.total_size(self.path(name))

    def register(self, name: str, view: str | None = None) -> str:
        """Expose the current data as a temporary view named after the table."""
        v = view or name
        self.read(name).createOrReplaceTempView(v)
        return v

    def describe(self, name: str) -> dict:
        m = self.meta(name)
        return {"name": name, "comment": m.get("comment"), "properties": m.get("properties", {}),
                "kind": m.get("kind")}


def batch_ranges(folders: Sequence[tuple[str, int]], target_bytes: int) -> list[tuple[list[str], int]]:
    """``folders`` (path, bytes) in order -> consecutive ones of up to two files'
    ``target_bytes`` together (more, where that would make over ``MAX_RANGES`` ranges),
    with their bytes.  Of several ranges some is larger than one file: a union of
    ranges that all were read into one partition would be one partition."""
    least = max(2 * target_bytes, sum(size for _, size in folders) // MAX_RANGES + 1)
    out: list[tuple[list[str], int]] = []
    for folder, size in folders:
        if out and out[-1][1] + size <= least:
            out[-1] = ([*out[-1][0], folder], out[-1][1] + size)
        else:
            out.append(([folder], size))
    return out


def files_for(size_bytes: int, target_bytes: int = TARGET_FILE_BYTES) -> int:
    return max(1, math.ceil(size_bytes / max(1, target_bytes)))


def write_files(df: DataFrame, size_bytes: int | None = None) -> DataFrame:
    """Partitions to write as files, without a shuffle.  A scan packs small files and
    splits large ones already; where a union of scans has more partitions than the
    session has cores and ``size_bytes`` has target files, neighbours are put together.
    Without a size they stay as they are."""
    if size_bytes is None:
        return df
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, files_for(size_bytes)))


def deal(df: DataFrame, parts: int) -> DataFrame:
    """Rows dealt in turns to ``parts`` partitions.  Unlike a round-robin ``repartition``
    no task sorts its rows first (a task of any size holds a few), and rows
    that were neighbours stay near each other."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    turn = F.pmod(F.monotonically_increasing_id(), F.lit(parts)).cast("int")
    return df.select(*cols, turn.alias(TURN)).repartitionById(parts, F.col(TURN)).select(*cols)


def compact(df: DataFrame, size_bytes: int, target_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
    """Redistribute rows into ~``size/target`` evenly sized partitions.  The row
    multiset is unchanged; dealing in turns needs no key, so skew cannot build up."""
    return deal(df, files_for(size_bytes, target_bytes))


def compact_table(store: TableStore, name: str, target_bytes: int = TARGET_FILE_BYTES) -> int:
    """Rewrite the current version of a full-refresh table as a new version
    with files of about ``target_bytes``; returns the new version."""
    size = store.size_bytes(name)
    m = store.meta(name)
    return store.write_snapshot(name, compact(store.read_version(name), size, target_bytes),
                                comment=m.get("comment"), properties=m.get("properties"))


AUTO_COMPACT_BATCHES = 16  # closed batches outside any copy from which ``auto_compact`` makes one


def auto_compact(store: TableStore, name: str, least_batches: int = AUTO_COMPACT_BATCHES) -> bool:
    """Compact an append table whose properties ask for it, once enough batches wait."""
    m = store.meta(name)
    wanted = str((m.get("properties") or {}).get("delta.autoOptimize.autoCompact", "false")).lower() == "true"
    return wanted and m.get("kind") == "append" and store.compact_append(name, least_batches=least_batches)
