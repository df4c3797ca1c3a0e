"""Change feed between two versions of a table.

Tables have no key and may hold duplicate rows, so the feed is a multiset
difference: a row whose count rose by n yields n ``insert`` rows, one whose
count fell by n yields n ``delete`` rows.

Plan: both versions are unioned with a +1/-1 tag and aggregated by the whole
row in ONE shuffle (partial aggregation first, so a group of copies holding a
large share of the table collapses to one row per task).  Groups whose count
changed are expanded back into rows in chunks of at most ``chunk_rows``, and
the chunks are spread over tasks, so a hot group never lands whole in one task.
Where a count by hash buckets (``most_copies``, one scan, a few numbers shuffled) shows
that no row has so many copies, groups are expanded where they are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_ROWS = 1_000_000
COPY_BUCKETS = 1 << 16


def _align(old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    cols = list(new.columns) + [c for c in old.columns if c not in new.columns]
    def fill(df, other):
        types = dict(other.dtypes)
        return df.select(*[F.col(f"`{c}`") if c in df.columns else F.lit(None).cast(types[c]).alias(c) for c in cols])
    return fill(old, new), fill(new, old), cols


def net_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Each distinct row whose count differs, with ``_net``: copies gained or lost."""
    old, new, cols = _align(old, new)
    qcols = [F.col(f"`{c}`") for c in cols]
    both = old.select(*qcols, F.lit(-1).alias("_d")).unionByName(new.select(*qcols, F.lit(1).alias("_d")))
    return both.groupBy(*qcols).agg(F.sum("_d").alias("_net")).filter(F.col("_net") != 0)


def most_copies(*versions: DataFrame) -> int:
    """No row of a version has more copies than this: rows of its fullest hash bucket.
    Different rows of one bucket can only make it larger."""
    def fullest(df):
        bucket = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(COPY_BUCKETS))
        return df.groupBy(bucket.alias("b")).count().agg(F.max("count")).first()[0] or 0
    return max(map(fullest, versions))


def change_feed(old: DataFrame, new: DataFrame, to_version: int, chunk_rows: int = CHUNK_ROWS,
                most: int | None = None) -> DataFrame:
    """``most``: copies that a row has in either version at most, where that is known
    (``most_copies``)."""
    net = net_changes(old, new)
    qcols = [F.col(f"`{c}`") for c in net.columns if c != "_net"]
    n = F.abs(F.col("_net"))
    if most is not None and most <= chunk_rows:
        sized = net.withColumn("_size", n)
    else:
        chunks = net.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.floor((n - 1) / chunk_rows).cast("bigint"))))
        chunks = chunks.repartition(F.col("_chunk"), *qcols)
        sized = chunks.withColumn("_size", F.least(F.lit(chunk_rows).cast("bigint"), n - F.col("_chunk") * chunk_rows))
    rows = sized.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_size"))))
    kind = F.when(F.col("_net") > 0, F.lit("insert")).otherwise(F.lit("delete"))
    return rows.select(*qcols, kind.alias("_change_type"), F.lit(int(to_version)).alias("_commit_version"))


def changed_buckets(store, name: str, from_version: int, to_version: int) -> list[int] | None:
    """Buckets whose fingerprints (rows, sum of 64-bit row hashes) differ between two
    versions; None where the versions are not laid out alike.  Buckets that differ
    but agree in both have a probability of about 2**-64."""
    old, new = store.fingerprint(name, from_version), store.fingerprint(name, to_version)
    if not old or not new or any(old[k] != new[k] for k in ("schema", "columns", "n")):
        return None
    a, b = old["buckets"], new["buckets"]
    return sorted(int(k) for k in a.keys() | b.keys() if a.get(k) != b.get(k))


def bucketed_change_feed(store, name: str, from_version: int, to_version: int) -> DataFrame:
    """The change feed of two versions of a table, comparing row by row only the
    buckets that differ; versions that are not laid out alike are compared whole."""
    buckets = changed_buckets(store, name, from_version, to_version)
    if buckets is None:
        return change_feed(store.read_version(name, from_version), store.read_version(name, to_version), to_version)
    marks = [store.fingerprint(name, v)["buckets"] for v in (from_version, to_version)]
    most = max((m[str(b)][0] for m in marks for b in buckets if str(b) in m), default=0)  # a row's copies share its bucket
    old, new = (store.read_buckets(name, v, buckets) for v in (from_version, to_version))
    return change_feed(old, new, to_version, most=most if most <= CHUNK_ROWS else most_copies(old, new))


def append_changes(table: DataFrame, from_batch: int, to_batch: int, batch_col: str = "batch_id") -> DataFrame:
    """Append-only tables: the rows of batches (from_batch, to_batch] are
    inserts.  The batch filter prunes partitions, so only those batches are read."""
    sel = table.filter((F.col(batch_col) > from_batch) & (F.col(batch_col) <= to_batch))
    return sel.select(*[F.col(f"`{c}`") for c in table.columns if c != batch_col],
                      F.lit("insert").alias("_change_type"), F.col(batch_col).cast("bigint").alias("_commit_version"))
