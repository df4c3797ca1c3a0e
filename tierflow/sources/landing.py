"""Landing-zone CSV scans.

Every value is read as text (no inference).  Files may disagree on their
header (extra, missing or reordered columns), so a micro-batch of files is
grouped by header; each group is read with its own all-text schema and then
projected BY NAME onto the table schema.  Columns the table does not know go
into the rescued-data column as JSON (rescue mode) or widen the table schema
(additive mode).  A record that does not have the header's number of fields is
kept as raw text by the scan and split by position: fields beyond the header are
rescued as ``_c<position>``, and the columns that a short record lacks are named
under ``_missing``.  Header discovery reads only the first bytes of each file,
in Spark tasks.
"""

from __future__ import annotations

import bz2
import csv
import io
import json
import sys
import zlib
from collections import OrderedDict
from collections.abc import Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.config import MAX_FILE_AGE
from tierflow.functions.schema import RESCUED, string_schema
from tierflow.operators.transforms import union_tier
from tierflow.sinks import paths

LISTING_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])


# tasks read file heads with this module's functions: ship them along, so that
# the workers need not find the package in their own working directory
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(paths)

HEADER_LIMIT = 1 << 24  # bytes in which a file's header must end


def parse_header(head: bytes) -> list[str]:
    """First CSV record of a file (quotes, embedded commas handled); blank lines
    before it are skipped, as Spark's reader does."""
    text = head.decode("utf-8-sig", errors="replace")
    for row in csv.reader(io.StringIO(text.lstrip("\r\n\t "))):
        return [c.strip() for c in row]
    return []


def _plain(uri: str, head: bytes) -> bytes:
    """The beginning of a file's text, unpacked by its suffix as Spark does."""
    name = uri.lower()
    if name.endswith(".gz"):
        return zlib.decompressobj(wbits=31).decompress(head)
    if name.endswith(".bz2"):
        return bz2.BZ2Decompressor().decompress(head)
    return head


def _file_header(uri: str, limit: int = HEADER_LIMIT) -> list[str]:
    """Header of a file; empty if it has no text but white space.  A header that
    does not end within ``limit`` bytes is an error, never cut off."""
    n = 1 << 16
    while True:
        raw = paths.read_head(uri, n)
        head = _plain(uri, raw).removeprefix(b"\xef\xbb\xbf").lstrip(b"\r\n\t ")
        if b"\n" in head:
            return parse_header(head[: head.index(b"\n") + 1])
        if len(raw) < n:
            return parse_header(head)
        if n >= limit:
            raise ValueError(f"{uri}: the header does not end within {limit} bytes")
        n *= 4


def read_headers(spark: SparkSession, files: Sequence[str]) -> dict[str, list[str]]:
    """Header of each file, read by Spark tasks (a few KiB per file).

    ``files`` is one micro-batch, bounded by the per-trigger file cap."""
    if not files:
        return {}

    def heads(batches):
        for pdf in batches:
            yield pd.DataFrame({"path": pdf["path"],
                                "header": [json.dumps(_file_header(p)) for p in pdf["path"]]})

    df = spark.createDataFrame([(p,) for p in files], "path string")
    df = df.repartition(max(1, min(len(files), spark.sparkContext.defaultParallelism)))
    rows = df.mapInPandas(heads, "path string, header string").collect()
    return {r.path: json.loads(r.header) for r in rows}


def _dedupe(names: list[str]) -> list[str]:
    seen: dict[str, int] = {}
    out = []
    for i, n in enumerate(names):
        n = n or f"_c{i}"
        if n in seen:
            seen[n] += 1
            n = f"{n}_{seen[n]}"
        else:
            seen[n] = 0
        out.append(n)
    return out


# One field and its comma: quoted (with escaped or doubled quotes) or plain.
_FIELD = r'("[^"\\]*+(?:(?:\\.|"")[^"\\]*+)*+"|[^,]*),'


def _free(name: str, taken: Sequence[str]) -> str:
    """``name``, with underscores before it until no name in ``taken`` begins with it."""
    while any(t.startswith(name) for t in taken):
        name = "_" + name
    return name


def _record_rescue(record: Column, header: Sequence[str]) -> Column:
    """Map of what a record of another length than the header has or lacks: its
    surplus fields by position, and the names of its missing ones."""
    n = len(header)
    fields = F.regexp_extract_all(F.concat(record, F.lit(",")), F.lit(_FIELD), 1)
    surplus = F.slice(fields, n + 1, F.greatest(F.size(fields) - n, F.lit(0)))

    def text(f):
        inner = F.replace(F.replace(F.substr(f, F.lit(2), F.length(f) - 2), F.lit('\\"'), F.lit('"')), F.lit('""'), F.lit('"'))
        return F.when(f.startswith('"') & f.endswith('"') & (F.length(f) > 1), inner).otherwise(f)

    key = _free("_c", header)
    named = F.transform(surplus, lambda f, i: F.struct(F.concat(F.lit(key), (i + n).cast("string")).alias("k"),
                                                       text(f).alias("v")))
    lacking = F.array_join(F.slice(F.array(*[F.lit(h) for h in header]), F.size(fields) + 1,
                                   F.greatest(n - F.size(fields), F.lit(0))), ",")
    missing = F.when(F.size(fields) < n, F.create_map(F.lit(_free("_missing", header)), lacking))
    return F.map_concat(F.map_from_entries(F.filter(named, lambda e: e["v"] != "")),
                        F.coalesce(missing, F.create_map().cast("map<string,string>")))


def project_by_name(df: DataFrame, header: Sequence[str], columns: Sequence[str],
                    rescued_col: str = RESCUED, record_col: str | None = None) -> DataFrame:
    """Select the table's columns by name; keep unknown ones as rescued JSON, and
    with ``record_col`` (the raw text of a record of another length, else NULL)
    also the fields that have no column."""
    known = set(columns)
    extras = [h for h in header if h not in known and h != rescued_col]
    sel = [F.col(f"`{c}`") if c in header else F.lit(None).cast("string").alias(c) for c in columns]
    by_name = F.map_filter(F.create_map(*[x for h in extras for x in (F.lit(h), F.col(f"`{h}`"))]).cast("map<string,string>"),
                           lambda k, v: v.isNotNull())
    as_json = lambda m: F.when(F.size(m) > 0, F.to_json(m))
    rescued = as_json(by_name) if extras else F.lit(None).cast("string")
    if record_col:
        record = F.col(f"`{record_col}`")
        rescued = F.when(record.isNull(), rescued).otherwise(
            as_json(F.map_concat(by_name, _record_rescue(record, header))))
    return df.select(*sel, rescued.alias(rescued_col), F.col("source_file"))


def read_files(spark: SparkSession, files: Sequence[str], columns: Sequence[str],
               headers: dict[str, list[str]], rescued_col: str = RESCUED) -> DataFrame | None:
    """Bronze rows of the given files: table columns as text, rescued JSON,
    and the path of the file each row came from."""
    groups: "OrderedDict[tuple, list[str]]" = OrderedDict()
    for f in files:
        h = headers.get(f) or []
        if h:
            groups.setdefault(tuple(_dedupe(list(h))), []).append(f)
    parts = []
    for header, group in groups.items():
        record = _free("_record", header)
        raw = (spark.read.schema(string_schema([*header, record])).option("header", True).option("inferSchema", False)
               .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", record).csv(list(group)))
        raw = raw.withColumn("source_file", F.col("_metadata.file_path"))
        parts.append(project_by_name(raw, header, columns, rescued_col, record))
    return union_tier(parts) if parts else None


def read_landing(spark: SparkSession, glob: str, columns: Sequence[str] | None = None,
                 rescued_col: str = RESCUED) -> DataFrame:
    """Batch scan of many landing folders by glob, as the stream reads them: text
    values by header name, rescue JSON, ``source_file``.  Without ``columns`` the
    header of the first file (by path) names them.  The driver holds the names of
    the files, as for any scan."""
    listed = spark.read.format("binaryFile").schema(LISTING_SCHEMA).load(glob).select("path").collect()
    files = sorted(r.path for r in listed)
    headers = read_headers(spark, files)
    if columns is None:
        columns = next((_dedupe(headers[f]) for f in files if headers.get(f)), None)
    df = read_files(spark, files, columns, headers, rescued_col) if columns else None
    if df is None:
        return spark.createDataFrame([], string_schema([*(columns or []), rescued_col, "source_file"]))
    return df


def stream_landing(spark: SparkSession, glob: str, schema: T.StructType | Sequence[str],
                   max_files_per_trigger: int | None = None, max_file_age: str = MAX_FILE_AGE) -> DataFrame:
    """Plain streaming CSV scan; a file stream needs its schema up front."""
    if not isinstance(schema, T.StructType):
        schema = string_schema(schema)
    r = spark.readStream.schema(schema).option("header", True).option("maxFileAge", max_file_age)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.csv(glob).withColumn("source_file", F.col("_metadata.file_path"))


def landing_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Files and bytes per source folder (``<root>/<source>/...``).  Only file
    metadata is read (the content column is never selected)."""
    root_uri = root.rstrip("/")
    files = (spark.read.format("binaryFile").schema(LISTING_SCHEMA).option("recursiveFileLookup", True)
             .option("pathGlobFilter", glob).load(root_uri).select("path", "length", "modificationTime"))
    rel = F.regexp_extract(F.col("path"), r"^.*?" + _re_escape(root_uri.split(":", 1)[-1].lstrip("/")) + r"/([^/]+)/", 1)
    return files.groupBy(rel.alias("source")).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"),
                                                  F.max("modificationTime").alias("last_modified"))


def _re_escape(s: str) -> str:
    import re
    return re.escape(s)
