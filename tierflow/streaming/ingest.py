"""Incremental tiers: landing -> bronze and bronze -> silver.

Bronze: a file-listing stream (``binaryFile`` with only path/length/mtime
selected, so file contents are never loaded by the listing) gives incremental
discovery, ``maxFilesPerTrigger`` admission control, a checkpoint per source
and ``cleanSource`` archive/delete.  Each micro-batch's files are read in one
Spark job per distinct header and appended as ``batch_id=<n>``.

Silver: a Parquet stream over bronze; each micro-batch is typed, filtered,
stamped and checked (fail-on-violation) in the same pass that writes it.

``foreachBatch`` is at-least-once; writing each batch to its own directory
with overwrite makes a replayed batch replace itself (exactly-once table).
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tierflow.config import SourceConfig
from tierflow.functions.exprs import as_of_column, passes, rule_columns
from tierflow.functions.schema import TRADE_TYPES_DECLARED, conform
from tierflow.operators.quality import expect_all_or_fail
from tierflow.operators.transforms import apply_sql_template
from tierflow.sinks import paths
from tierflow.sinks.tables import TableStore
from tierflow.sources import listing
from tierflow.sources.landing import LISTING_SCHEMA, read_files, read_headers


PACKED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate")


def schema_log(cfg: SourceConfig) -> str:
    return f"{cfg.checkpoint_path.rstrip('/')}/_schemas"


def schema_versions(cfg: SourceConfig) -> list[int]:
    names = [n for n in paths.list_names(schema_log(cfg)) if re.fullmatch(r"v\d{8}\.json", n)]
    return sorted(int(n[1:9]) for n in names)


def schema_of_version(cfg: SourceConfig, version: int) -> list[str]:
    return json.loads(paths.read_text(f"{schema_log(cfg)}/v{version:08d}.json"))["columns"]


def current_schema(cfg: SourceConfig) -> tuple[int, list[str]] | None:
    """(version, columns) of the newest entry of the schema log."""
    have = schema_versions(cfg)
    return (have[-1], schema_of_version(cfg, have[-1])) if have else None


def widen_schema(cfg: SourceConfig, columns: Sequence[str]) -> tuple[int, list[str]]:
    """Make sure that the source's schema has all ``columns``.  The log is append-only:
    a wider schema is a new entry that is created only if no other writer has taken
    its number; then it is widened once more, so no column is ever lost."""
    while True:
        at = current_schema(cfg)
        have = at[1] if at else []
        grown = [*have, *dict.fromkeys(c for c in columns if c not in have)]
        if at and grown == have:
            return at
        version = at[0] + 1 if at else 0
        if paths.create_new(f"{schema_log(cfg)}/v{version:08d}.json", json.dumps({"columns": grown})):
            return version, grown


def load_or_discover_schema(cfg: SourceConfig, first_header: list[str] | None) -> tuple[int, list[str]] | None:
    """(version, columns) remembered between runs.  First run: the declared columns
    if configured, else the first file's header."""
    at = current_schema(cfg)
    if at:
        return at
    cols = list(cfg.declared_types.keys()) if cfg.declared_types else (list(first_header) if first_header else None)
    return widen_schema(cfg, cols) if cols else None


def batch_schema(cfg: SourceConfig, batch_id: int) -> tuple[int, list[str]] | None:
    """(version, columns) that a bronze batch was read with."""
    text = paths.read_text(f"{schema_log(cfg)}/batches/{batch_id}.json")
    if text is None:
        return None
    version = json.loads(text)["version"]
    return version, schema_of_version(cfg, version)


def names_log(cfg: SourceConfig) -> str:
    return f"{cfg.checkpoint_path.rstrip('/')}/_names"


def more_files(cfg: SourceConfig) -> bool:
    """Whether a source that is listed by names has files for another run."""
    return cfg.listing == "names" and listing.pending(cfg.source_path, names_log(cfg), cfg.file_pattern)


def listing_stream(spark: SparkSession, cfg: SourceConfig):
    if cfg.listing == "names":
        return listing.names_stream(spark, cfg.source_path, names_log(cfg), cfg.file_pattern,
                                    cfg.max_files_per_trigger, cfg.full_listing_every)
    r = (spark.readStream.format("binaryFile").schema(LISTING_SCHEMA)
         .option("recursiveFileLookup", True).option("pathGlobFilter", cfg.file_pattern)
         .option("maxFileAge", cfg.max_file_age)
         .option("maxFilesPerTrigger", int(cfg.max_files_per_trigger)))
    if cfg.clean_source != "off":
        r = r.option("cleanSource", cfg.clean_source)
        if cfg.clean_source == "archive":
            r = r.option("sourceArchiveDir", cfg.archive_path)
    return r.load(cfg.source_path).select("path", "length", "modificationTime")


def bronze_batch_writer(spark: SparkSession, cfg: SourceConfig, store: TableStore):
    def write(files_df, batch_id: int):
        # one micro-batch of file names, bounded by max_files_per_trigger
        listed = files_df.select("path", "length", "modificationTime").collect()
        files = [r.path for r in sorted(listed, key=lambda r: (r.modificationTime, r.path))]
        if not files:
            return
        headers = read_headers(spark, files)
        first = next((headers[f] for f in files if headers.get(f)), None)
        at = load_or_discover_schema(cfg, first)
        if at is None:
            return
        if cfg.schema_evolution_mode == "additive":
            at = widen_schema(cfg, [h for f in files for h in headers.get(f) or [] if h != cfg.rescued_data_column])
        version, columns = at
        paths.write_text(f"{schema_log(cfg)}/batches/{batch_id}.json", json.dumps({"version": version}))
        df = read_files(spark, files, columns, headers, cfg.rescued_data_column)
        if df is not None:
            packed = any(f.lower().endswith(PACKED) for f in files)  # read by one task each, however large
            store.append_batch(cfg.raw_table, df.hint("rebalance") if packed and cfg.optimize_write else df, batch_id,
                               optimize_write=cfg.optimize_write and not packed, size_bytes=sum(r.length for r in listed))
    return write


def start_bronze(spark: SparkSession, cfg: SourceConfig, store: TableStore, available_now: bool = True) -> StreamingQuery:
    w = (listing_stream(spark, cfg).writeStream.queryName(f"bronze_{cfg.name}")
         .option("checkpointLocation", f"{cfg.checkpoint_path.rstrip('/')}/bronze")
         .foreachBatch(bronze_batch_writer(spark, cfg, store)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def silver_batch_writer(spark: SparkSession, cfg: SourceConfig, store: TableStore, as_of=None):
    types = dict(cfg.declared_types or TRADE_TYPES_DECLARED)
    checks = rule_columns(cfg.quality_rules)

    def write(df, batch_id: int):
        typed = conform(df.drop("batch_id"), types, cfg.rescued_data_column)
        primary = passes(cfg.primary_filter)
        obs = Observation(f"quality_{cfg.name}_{batch_id}")
        observed = typed.observe(obs, F.count(F.lit(1)).alias("rows_in"),
                                 F.count_if(primary).alias("rows_selected"),
                                 *[F.count_if(primary & ~ok).alias(f"violations_{n}") for n, ok in checks])
        out = observed.filter(cfg.primary_filter).withColumn("processing_timestamp", as_of_column(as_of))
        out = expect_all_or_fail(out, cfg.quality_rules, label=cfg.clean_table)
        try:
            store.append_batch(cfg.clean_table, out, batch_id, optimize_write=cfg.optimize_write)
        except Exception:
            # the batch is not written; what it violates is: counted in one pass over it
            counts = typed.agg(F.count(F.lit(1)).alias("rows_in"), F.count_if(primary).alias("rows_selected"),
                               *[F.count_if(primary & ~ok).alias(f"violations_{n}") for n, ok in checks]).first().asDict()
            if any(v for k, v in counts.items() if k.startswith("violations_")):
                record_batch_quality(spark, store, cfg, batch_id, counts)
            raise
        m = obs.get
        if m.get("rows_in", 0):
            record_batch_quality(spark, store, cfg, batch_id, m)
    return write


def record_batch_quality(spark, store: TableStore, cfg: SourceConfig, batch_id: int, metrics: dict) -> None:
    """Streaming quality metrics: one row per source and micro-batch (W6)."""
    rules = [k[len("violations_"):] for k in metrics if k.startswith("violations_")]
    rows = [(cfg.name, int(batch_id), int(metrics["rows_in"]), int(metrics["rows_selected"]), r,
             int(metrics[f"violations_{r}"])) for r in rules]
    df = spark.createDataFrame(rows, "source string, batch_id_ long, rows_in long, rows_selected long, "
                                     "rule string, violations long").withColumn("recorded_at", F.current_timestamp())
    store.append_batch(f"_quality_metrics/{cfg.name}", df.withColumnRenamed("batch_id_", "silver_batch"), batch_id)


def start_silver(spark: SparkSession, cfg: SourceConfig, store: TableStore, as_of=None,
                 available_now: bool = True) -> StreamingQuery | None:
    if store.stored_schema(cfg.raw_table) is None:
        return None  # nothing landed yet
    src = store.stream_append(cfg.raw_table, cfg.tier_max_files_per_trigger)
    w = (src.writeStream.queryName(f"silver_{cfg.name}")
         .option("checkpointLocation", f"{cfg.checkpoint_path.rstrip('/')}/silver")
         .foreachBatch(silver_batch_writer(spark, cfg, store, as_of)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def start_gold(spark: SparkSession, cfg: SourceConfig, store: TableStore,
               available_now: bool = True) -> StreamingQuery:
    """Incremental gold for row-wise templates: each new silver batch is run
    through the template and appended, so an update costs O(new rows)."""
    kind = store.meta(cfg.transform_table).get("kind")
    if kind == "snapshot":
        raise ValueError(f"{cfg.transform_table} was built by full refresh; rebuild it to switch to incremental")
    view = f"{cfg.clean_table}__batch"

    def write(df, batch_id: int):
        gold = apply_sql_template(df.sparkSession, df.drop("batch_id"), cfg.business_logic, view)
        store.append_batch(cfg.transform_table, gold, batch_id, optimize_write=cfg.optimize_write)

    store.set_meta(cfg.transform_table, comment=f"{cfg.name}: silver rows through the SQL template",
                   properties=dict(cfg.table_properties))
    src = store.stream_append(cfg.clean_table, cfg.tier_max_files_per_trigger)
    w = (src.writeStream.queryName(f"gold_{cfg.name}")
         .option("checkpointLocation", f"{cfg.checkpoint_path.rstrip('/')}/gold").foreachBatch(write))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
