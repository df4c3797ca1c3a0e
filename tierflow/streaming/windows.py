"""Event-time tumbling windows over a stream, with a watermark for late data (W5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tierflow.sinks.tables import TableStore


def windowed_counts(stream: DataFrame, ts: str, duration: str = "1 hour", by: Sequence[str] = (),
                    value: str | None = None, watermark: str = "2 hours",
                    value_type: str = "decimal(18,2)") -> DataFrame:
    """Rows and exact sum per (window, keys).  The watermark must exceed the
    lateness of the data (initial and incremental files overlap in time)."""
    aggs = [F.count(F.lit(1)).alias("events")]
    if value:
        aggs.append(F.sum(F.col(value).cast(value_type)).alias(f"sum_{value}"))
    ntz = dict(stream.dtypes).get(ts) == "timestamp_ntz"
    if ntz:
        # Watermarks need TIMESTAMP.  Map the wall-clock time to the instant
        # whose UTC reading is that wall clock, so windows align with
        # wall-clock hours in any session time zone; map the bounds back.
        stream = stream.withColumn(ts, F.to_utc_timestamp(F.col(ts).cast("timestamp"), F.current_timezone()))
    g = stream.withWatermark(ts, watermark).groupBy(F.window(ts, duration).alias("w"), *by).agg(*aggs)

    def bound(c):
        return F.from_utc_timestamp(c, F.current_timezone()).cast("timestamp_ntz") if ntz else c

    return g.select(bound(F.col("w.start")).alias("window_start"), bound(F.col("w.end")).alias("window_end"), *by,
                    *[c for c in g.columns if c not in ("w", *by)])


def run_windows(agg: DataFrame, store: TableStore, table: str, checkpoint: str,
                mode: str = "complete") -> StreamingQuery:
    """Drain the stream once (availableNow).

    * ``complete``: each micro-batch writes the whole (small, aggregated)
      window table as a new version of ``table``.
    * ``append``: only windows closed by the watermark are emitted; each
      batch is appended as its own ``batch_id`` directory.  State stays
      bounded by the watermark.
    * ``update``: every window that a batch touched is emitted with its new
      value and appended; ``latest_windows`` reads the last value of each.  A
      window is there as soon as its first row is, and state is bounded too."""
    if mode not in ("complete", "append", "update"):
        raise ValueError("mode must be complete, append or update")

    def write(df, batch_id):
        if mode == "complete":
            store.write_snapshot(table, df)
        else:
            store.append_batch(table, df, batch_id)

    return (agg.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
            .foreachBatch(write).trigger(availableNow=True).start())


def latest_windows(store: TableStore, table: str, by: Sequence[str] = ()) -> DataFrame:
    """Of a table written in update mode: each window with its last value.  One
    aggregate by window, partial first; a compacted table reads few files."""
    df = store.read_append(table)
    keys = ["window_start", "window_end", *by]
    values = [c for c in df.columns if c not in (*keys, "batch_id")]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("v"))
    return last.select(*keys, "v.*")
