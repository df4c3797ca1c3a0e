"""One pipeline update: drain every source's streams, then refresh the batch
tables, in dependency order (bronze -> silver -> gold -> monitoring).

Adding a source means adding a ``SourceConfig``; no code changes per source.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tierflow.config import SourceConfig
from tierflow.operators import monitoring
from tierflow.operators.transforms import apply_sql_template, is_row_wise
from tierflow.sinks.tables import TableStore, auto_compact
from tierflow.streaming import ingest, monitor
from tierflow.streaming.metrics import PerformanceLog, progress_frame, progress_rows
from tierflow.streaming.partials import Rollup, start_rollups

MONITORING_PROPERTIES = {"delta.enableChangeDataFeed": "true", "delta.autoOptimize.optimizeWrite": "true"}
MONITORING_COMMENTS = {
    "trade_changes_summary": "every bronze row of every source, stamped when summarised",
    "file_ingestion_metrics": "every bronze row of every source, with how it was ingested",
    "quality_changes_monitoring": "every silver row of every source, stamped when checked",
}
KEEP_VERSIONS = 8  # of a full-refresh table, the current one included


STATUS_TABLE = "_update_status"


@dataclass
class UpdateResult:
    progress: list = field(default_factory=list)
    gold_versions: dict = field(default_factory=dict)
    monitoring_versions: dict = field(default_factory=dict)
    last_batches: dict = field(default_factory=dict)  # of each silver table, after the update
    status: dict = field(default_factory=dict)  # table -> "updated", "failed" or "skipped"
    errors: dict = field(default_factory=dict)  # table -> what failed

    def progress_frame(self, spark: SparkSession) -> DataFrame:
        return progress_frame(spark, self.progress)


class UpdateFailed(RuntimeError):
    """Raised at the end of an update in which a table failed; the tables that do not
    depend on it are up to date.  ``result`` has the status of every table."""

    def __init__(self, result: UpdateResult):
        super().__init__("\n".join(f"{t}: {e}" for t, e in result.errors.items()))
        self.result = result


def select_sources(configs: Sequence[SourceConfig], only: str | Sequence[str] | None = None) -> list[SourceConfig]:
    """``only``: None/'all' for every source, or source/exchange names."""
    if only is None or only == "all":
        return list(configs)
    wanted = {only.lower()} if isinstance(only, str) else {o.lower() for o in only}
    return [c for c in configs if c.name.lower() in wanted or c.name.lower().split("_")[0] in wanted]


def _each(res: UpdateResult, work: Mapping[str, Callable], log: PerformanceLog) -> set[str]:
    """Start a stream (or run a step) for each table and wait for all of them; a table
    that fails is noted and does not stop the others.  Returns the tables that hold."""
    started = {}
    for table, start in work.items():
        try:
            started[table] = log.watch(q) if isinstance(q := start(), StreamingQuery) else q
        except Exception as e:  # noqa: BLE001 - raised at the end of the update
            res.errors[table] = e
    for table, query in started.items():
        if not isinstance(query, StreamingQuery):
            continue
        try:
            log.wait(query)
        except Exception as e:  # noqa: BLE001 - raised at the end of the update
            res.errors[table] = e
        res.progress += progress_rows(query)
    for table in work:
        res.status[table] = "failed" if table in res.errors else "updated"
    return {t for t in work if t not in res.errors}


def gold_is_incremental(spark: SparkSession, cfg: SourceConfig, store: TableStore) -> bool:
    if cfg.gold_mode == "full":
        return False
    row_wise = is_row_wise(spark, store.read(cfg.clean_table), cfg.business_logic, cfg.clean_table)
    if cfg.gold_mode == "incremental" and not row_wise:
        raise ValueError(f"{cfg.transform_table}: template is not row-wise; use gold_mode='full'")
    return row_wise


def refresh_gold(spark: SparkSession, cfg: SourceConfig, store: TableStore) -> int:
    silver = store.read(cfg.clean_table)
    gold = apply_sql_template(spark, silver, cfg.business_logic, cfg.clean_table)
    return store.write_snapshot(cfg.transform_table, gold,
                                comment=f"{cfg.name}: silver rows through the SQL template",
                                properties=dict(cfg.table_properties), optimize_write=cfg.optimize_write,
                                buckets=(["source_file"], cfg.change_buckets) if cfg.change_buckets else None,
                                size_bytes=store.size_bytes(cfg.clean_table))


def refresh_monitoring(store: TableStore, configs: Sequence[SourceConfig], as_of=None) -> dict:
    raw = [c.raw_table for c in configs if store.stored_schema(c.raw_table)]
    clean = [c.clean_table for c in configs if store.stored_schema(c.clean_table)]
    bronze, silver = [store.read(t) for t in raw], [store.read(t) for t in clean]
    raw_bytes, clean_bytes = (sum(map(store.size_bytes, tables)) for tables in (raw, clean))
    out = {}
    if bronze:
        out["trade_changes_summary"] = store.write_snapshot(
            "trade_changes_summary", monitoring.changes_summary(bronze, as_of),
            comment=MONITORING_COMMENTS["trade_changes_summary"], properties=MONITORING_PROPERTIES, optimize_write=True,
            size_bytes=raw_bytes)
        out["file_ingestion_metrics"] = store.write_snapshot(
            "file_ingestion_metrics", monitoring.file_metrics(bronze, as_of),
            comment=MONITORING_COMMENTS["file_ingestion_metrics"], properties=MONITORING_PROPERTIES, optimize_write=True,
            size_bytes=raw_bytes)
    if silver:
        out["quality_changes_monitoring"] = store.write_snapshot(
            "quality_changes_monitoring", monitoring.quality_monitoring(silver, as_of),
            comment=MONITORING_COMMENTS["quality_changes_monitoring"], properties=MONITORING_PROPERTIES,
            optimize_write=True, size_bytes=clean_bytes)
    return out


def record_status(store: TableStore, res: UpdateResult) -> None:
    """Monitoring: one row for each table and update, so a gap in a table is marked."""
    have = store.batches(STATUS_TABLE)
    rows = [(t, st, str(res.errors[t])[:2000] if t in res.errors else None) for t, st in sorted(res.status.items())]
    df = store.spark.createDataFrame(rows, "table_name string, status string, error string")
    store.append_batch(STATUS_TABLE, df.withColumn("updated_at", F.current_timestamp()).coalesce(1),
                       have[-1] + 1 if have else 0)


def run_update(spark: SparkSession, configs: Sequence[SourceConfig], store: TableStore, as_of=None,
               only: str | Sequence[str] | None = None, monitoring_tables: bool = True,
               monitoring_mode: str = "full", keep_versions: int = KEEP_VERSIONS,
               rollups: Sequence[Rollup] = ()) -> UpdateResult:
    """Run one update.  Streams of different sources run concurrently; a
    tier starts only after the tier below it is fully drained, so silver never
    reads a half-committed bronze batch.

    A table that fails (a rule that does not hold, a folder that is missing) stops
    only the tables below it: those of other sources, and the monitoring tables over
    them, are updated.  The status of every table is appended to ``_update_status``
    and ``UpdateFailed`` is raised at the end.

    ``monitoring_mode``: "full" recomputes the monitoring tables from all
    rows (the reference's definition); "incremental" appends only the rows of
    new tier batches, each stamped when processed.  ``rollups`` are kept
    incrementally (``streaming.partials``).  Every micro-batch is logged in
    ``_performance_metrics``; append tables whose properties ask for it are compacted.

    Full-refresh tables keep their newest ``keep_versions`` versions."""
    if monitoring_mode not in ("full", "incremental"):
        raise ValueError("monitoring_mode must be 'full' or 'incremental'")
    chosen = select_sources(configs, only)
    res = UpdateResult()
    with PerformanceLog(spark, store) as log:
        for cfg in chosen:
            store.set_meta(cfg.raw_table, comment=f"{cfg.name}: landing rows as text, by file",
                           properties=dict(cfg.table_properties))
        good = _each(res, {c.raw_table: partial(ingest.start_bronze, spark, c, store) for c in chosen}, log)
        while more := [c for c in chosen if c.raw_table in good and ingest.more_files(c)]:
            good -= {c.raw_table for c in more}
            good |= _each(res, {c.raw_table: partial(ingest.start_bronze, spark, c, store) for c in more}, log)
        good = _each(res, {c.clean_table: partial(ingest.start_silver, spark, c, store, as_of)
                           for c in chosen if c.raw_table in good}, log)
        res.last_batches = {c.clean_table: b[-1] for c in chosen if (b := store.batches(c.clean_table))}
        gold = {}
        for cfg in chosen:
            if cfg.clean_table in good and store.exists(cfg.clean_table):
                store.set_meta(cfg.clean_table, comment=f"{cfg.name}: typed rows that pass every rule",
                               properties=dict(cfg.table_properties))
                gold[cfg.transform_table] = partial(_update_gold, spark, cfg, store, res)
        _each(res, gold, log)
        for cfg in chosen:  # what lies above a table that failed
            for table in (cfg.clean_table, cfg.transform_table):
                if table not in res.status and any(t in res.errors for t in (cfg.raw_table, cfg.clean_table)):
                    res.status[table] = "skipped"
        _each(res, {f"rollups_{t}_{c.name}": partial(start_rollups, spark, c, store, t, [r for r in rollups if r.tier == t])
                    for c in chosen for t in sorted({r.tier for r in rollups})}, log)
        if monitoring_tables and monitoring_mode == "full":
            _each(res, {"monitoring": lambda: res.monitoring_versions.update(refresh_monitoring(store, configs, as_of))}, log)
        elif monitoring_tables:
            for table, comment in MONITORING_COMMENTS.items():  # before the streams that share the tables
                store.set_meta(table, comment=comment, properties=dict(MONITORING_PROPERTIES))
            _each(res, {f"{t}_{c.name}": partial(monitor.start_monitor, spark, c, store, t, as_of)
                        for c in chosen for t in monitor.MONITORS}, log)
    for cfg in chosen:
        for table in (cfg.raw_table, cfg.clean_table, cfg.transform_table):
            auto_compact(store, table)
    for table in [*res.gold_versions, *res.monitoring_versions]:
        store.expire_versions(table, keep_versions)
    record_status(store, res)
    if res.errors:
        raise UpdateFailed(res) from next(iter(res.errors.values()))
    return res


def _update_gold(spark: SparkSession, cfg: SourceConfig, store: TableStore, res: UpdateResult):
    """The stream of an incremental table, or a full refresh."""
    if gold_is_incremental(spark, cfg, store):
        return ingest.start_gold(spark, cfg, store)
    res.gold_versions[cfg.transform_table] = refresh_gold(spark, cfg, store)
    return None
