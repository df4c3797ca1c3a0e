"""Plain append-mode stream sinks (no rules, no per-batch logic)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def append_stream(df: DataFrame, path: str, checkpoint: str, table: str | None = None,
                  available_now: bool = True) -> StreamingQuery:
    """Append a streaming DataFrame to Parquet files, exactly once.

    Spark's file sink records committed files in ``_spark_metadata`` and the
    checkpoint records offsets, so a restart neither loses nor repeats rows.
    With ``table`` the sink is registered in the session catalog as well."""
    w = (df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
         .option("path", path))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.toTable(table) if table else w.start()
