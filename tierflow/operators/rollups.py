"""Aggregations: per-file, per-change-batch, business metrics, rescued-schema
history, distinct counts and event-time windows.  All are hash aggregates with
map-side partial aggregation, so a key holding a large share of the rows costs
one partial row per task before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.functions.exprs import as_of_column


def file_rollup(df: DataFrame, by: Sequence[str] = ("exchange", "source_file"), ts: str = "timestamp",
                quantity: str = "quantity", as_of=None, ingested: str | None = None) -> DataFrame:
    """Rows, first/last event time and quantity per landing file; with
    ``ingested`` (a time column) also when its last row was ingested."""
    out = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(ts).alias("first_event_ts"),
        F.max(ts).alias("last_event_ts"),
        F.sum(quantity).alias("total_quantity"),
        *([F.max(ingested).alias("ingested_at")] if ingested else []),
    )
    return out.withColumn("rollup_timestamp", as_of_column(as_of))


def change_rollup(changes: DataFrame, to_version: int | None = None, by: Sequence[str] = ("exchange",)) -> DataFrame:
    """Rows per group, change type and change batch: of a change feed, or (with
    ``to_version``) of net changes, whose copies are summed without expanding them."""
    if to_version is None:
        return changes.groupBy(*by, "_change_type", "_commit_version").agg(F.count(F.lit(1)).alias("rows"))
    kind = F.when(F.col("_net") > 0, "insert").otherwise("delete")
    return changes.groupBy(*by, kind.alias("_change_type"), F.lit(int(to_version)).alias("_commit_version")).agg(
        F.sum(F.abs("_net")).alias("rows"))


def trade_metrics(gold: DataFrame, by: Sequence[str] = ("exchange", "symbol")) -> DataFrame:
    """Trade count, volume, traded value and volume-weighted average price."""
    out = gold.groupBy(*by).agg(
        F.count(F.lit(1)).alias("trade_count"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("trade_value").alias("total_value"),
    )
    return with_vwap(out)


def with_vwap(out: DataFrame) -> DataFrame:
    vwap = F.round(F.col("total_value").cast("double") / F.nullif(F.col("total_quantity"), F.lit(0)).cast("double"), 4)
    return out.withColumn("vwap", vwap)


def schema_changes(bronze: DataFrame, by: Sequence[str] = (), rescued: str = "_rescued_data",
                   file_col: str = "source_file") -> DataFrame:
    """Columns seen only in rescued data: rows carrying them and the first file."""
    order = ["batch_id"] if "batch_id" in bronze.columns else []
    keys = bronze.filter(F.col(rescued).isNotNull()).select(
        *by, file_col, *order, F.explode(F.json_object_keys(F.col(rescued))).alias("column_name"))
    # the first file: earliest batch, then name
    first = (F.min_by(F.col(file_col), F.struct(F.col(order[0]), F.col(file_col))) if order
             else F.min(F.col(file_col)))
    return keys.groupBy(*by, "column_name").agg(F.count(F.lit(1)).alias("rows"), first.alias("first_file"))


def distinct_symbols(df: DataFrame, by: Sequence[str] = ("exchange",), col: str = "symbol",
                     approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Distinct values per group; ``approx`` uses a HyperLogLog++ sketch
    (fixed-size state per group, no per-value shuffle)."""
    agg = F.approx_count_distinct(col, rsd) if approx else F.count_distinct(F.col(col))
    return df.groupBy(*by).agg(agg.alias(f"distinct_{col}s" if not col.endswith("s") else f"distinct_{col}"))


def time_windows(df: DataFrame, ts: str = "ts", duration: str = "1 hour", by: Sequence[str] = (),
                 value: str | None = None, value_type: str = "decimal(18,2)") -> DataFrame:
    """Tumbling event-time windows: rows and (exact decimal) sum per window."""
    aggs = [F.count(F.lit(1)).alias("events")]
    if value:
        aggs.append(F.sum(F.col(value).cast(value_type)).alias(f"sum_{value}"))
    out = df.groupBy(F.window(ts, duration).alias("w"), *by).agg(*aggs)
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by,
                      *[a for a in out.columns if a not in ("w", *by)])
