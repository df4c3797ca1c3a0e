"""Rollups kept incrementally, as mergeable partial aggregates.

One stream for each (tier, source) turns every new micro-batch into partial rows
(counts, sums, extremes, HyperLogLog sketches by key) and appends them as
``_partials/<rollup>/source=<name>/batch_id=<n>``; a replayed batch replaces its
own.  Reading a rollup merges the partial rows, whose number is that of keys
times batches, and never looks at the tier again.  So an update costs O(new
rows), and a distinct count needs no rescan: the sketches of all batches are
united.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tierflow.config import SourceConfig
from tierflow.functions.exprs import rule_columns
from tierflow.functions.schema import TRADE_TYPES_DECLARED, conform
from tierflow.operators.quality import completeness_of, compliance_of
from tierflow.operators.rollups import with_vwap
from tierflow.sinks.tables import TableStore

SKETCH_BITS = 12  # of HyperLogLog registers: a relative standard error of 1.6 %
MERGE = {"sum": F.sum, "min": F.min, "max": F.max, "sketch": F.hll_union_agg}


@dataclass(frozen=True)
class Rollup:
    """``parts``: name -> (aggregate over a batch, how two of them merge); ``finish``
    turns the merged rows into the result."""

    name: str
    tier: str  # raw_table, clean_table or transform_table
    keys: Sequence[str]
    parts: Callable[[], Mapping[str, tuple[Column, str]]]
    finish: Callable[[DataFrame], DataFrame] = field(default=lambda df: df)

    @property
    def table(self) -> str:
        return f"_partials/{self.name}"


def partial_rows(batch: DataFrame, rollup: Rollup) -> DataFrame:
    return batch.groupBy(*rollup.keys).agg(*[a.alias(n) for n, (a, _) in rollup.parts().items()])


def merged(partials: DataFrame, rollup: Rollup) -> DataFrame:
    return rollup.finish(partials.groupBy(*rollup.keys).agg(
        *[MERGE[how](n).alias(n) for n, (_, how) in rollup.parts().items()]))


def read_rollup(store: TableStore, rollup: Rollup) -> DataFrame:
    return merged(store.read(rollup.table), rollup)


def start_rollups(spark: SparkSession, cfg: SourceConfig, store: TableStore, tier: str, rollups: Sequence[Rollup],
                  available_now: bool = True) -> StreamingQuery | None:
    """One stream over a tier of a source for all rollups of that tier."""
    table = getattr(cfg, tier)
    if store.stored_schema(table) is None or store.meta(table).get("kind") == "snapshot":
        return None
    types = dict(cfg.declared_types or TRADE_TYPES_DECLARED)

    def write(df, batch_id: int):
        rows = df.drop("batch_id")
        if tier == "raw_table":
            rows = conform(rows, types, cfg.rescued_data_column)
        for r in rollups:
            store.append_batch(r.table, partial_rows(rows, r).coalesce(1), batch_id, partition=("source", cfg.name))

    w = (store.stream_append(table, cfg.tier_max_files_per_trigger).writeStream.queryName(f"rollups_{tier}_{cfg.name}")
         .option("checkpointLocation", f"{cfg.checkpoint_path.rstrip('/')}/rollups_{tier}").foreachBatch(write))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def _count() -> Column:
    return F.count(F.lit(1))


def file_rollup(by: Sequence[str] = ("exchange", "file_path")) -> Rollup:
    """Per landing file: rows, event times, quantity and when its last row was processed."""
    return Rollup("file_rollup", "clean_table", by, lambda: {
        "rows": (_count(), "sum"), "first_event_ts": (F.min("timestamp"), "min"), "last_event_ts": (F.max("timestamp"), "max"),
        "total_quantity": (F.sum("quantity"), "sum"), "ingested_at": (F.max("processing_timestamp"), "max")})


def trade_metrics(by: Sequence[str] = ("exchange", "symbol")) -> Rollup:
    """Trade count, volume, traded value and volume-weighted average price."""
    return Rollup("trade_metrics", "clean_table", by, lambda: {
        "trade_count": (_count(), "sum"), "total_quantity": (F.sum("quantity"), "sum"),
        "total_value": (F.sum((F.col("price") * F.col("quantity")).cast("decimal(38,4)")), "sum")}, with_vwap)


def rule_compliance(rules: Mapping[str, object], by: Sequence[str] = ("exchange",)) -> Rollup:
    """Pass rate of every rule over the landed rows."""
    return Rollup("rule_compliance", "raw_table", by, lambda: {
        "rows": (_count(), "sum"), **{f"_p{i}": (F.count_if(ok), "sum") for i, (_, ok) in enumerate(rule_columns(rules))}},
        lambda df: compliance_of(df, list(rules), by))


def completeness(columns: Sequence[str], by: Sequence[str] = ("exchange",)) -> Rollup:
    """Null rate of every column over the landed rows."""
    return Rollup("completeness", "raw_table", by, lambda: {
        "rows": (_count(), "sum"), **{f"_n{i}": (F.count(F.col(f"`{c}`")), "sum") for i, c in enumerate(columns)}},
        lambda df: completeness_of(df, list(columns), by))


def distinct_values(column: str = "symbol", by: Sequence[str] = ("exchange",)) -> Rollup:
    """Distinct values of a column, estimated from one sketch for each key and batch."""
    return Rollup(f"distinct_{column}", "clean_table", by, lambda: {
        "rows": (_count(), "sum"), "sketch": (F.hll_sketch_agg(column, SKETCH_BITS), "sketch")},
        lambda df: df.select(*by, "rows", F.hll_sketch_estimate("sketch").alias("estimate")))
