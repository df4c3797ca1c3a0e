"""Plans over tables and landing files with a history: rescue of malformed
records, compaction under running streams, incremental rollups, performance
metrics, late rows in windows, failure isolation, schema evolution, the catalog.

Like the plans of ``streaming_queries`` they run on trades derived from all of
``lineitem`` (or on all of ``events``), in folders of their own or in those of the
incremental pipeline run.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.config import SourceConfig, default_sources
from tierflow.functions.exprs import in_market_hours, price_bucket
from tierflow.operators import changefeed, quality
from tierflow.operators.transforms import union_tier
from tierflow.plans.oracle import time_windows, trade_metrics, with_trades
from tierflow.plans.pipeline import STATUS_TABLE, UpdateFailed, run_update
from tierflow.plans.queries import ADAPTER_TYPES, DEC, EXCHANGES, RULES
from tierflow.plans.streaming_queries import (_SILVER_SQL, DROP_CUTOFF, ROLLUPS, SILVER_OUT, STREAM_ORACLES,
                                              TRADE_COLUMNS_CHECKED, TRADE_LIST, landing_frame, pipeline_run)
from tierflow.session import work_dir
from tierflow.sinks import catalog
from tierflow.sinks.streams import append_stream
from tierflow.sinks.tables import TableStore
from tierflow.sources.adapter import AS_OF_SPARK, AS_OF_SQL, read_table, trades
from tierflow.sources.generator import write_landing
from tierflow.sources.landing import read_landing, stream_landing
from tierflow.streaming import ingest, partials
from tierflow.streaming.metrics import PerformanceLog, performance
from tierflow.streaming.windows import latest_windows, run_windows, windowed_counts

LANDED = TRADE_LIST + ["ingestion_timestamp", "file_path"]
RAGGED_FILES = 4  # parts
RAGGED_ROWS = 1_000_000  # lines of a file, about
MICRO_BATCHES = 120
SLICES = 5
FEED_BUCKETS = 64


# -- records that do not have the header's number of fields ----------------------
def _ragged_landing(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Trades as CSV lines: every fifth order has two surplus fields (one quoted, with
    a comma), every seventh other one lacks the last two.  A part has so many files that
    each has about ``RAGGED_ROWS`` lines, dealt by a hash of the line after one header;
    lines without an order stay in one file, which has none."""
    order = F.split("trade_id", "_")[1].cast("long")
    lines = trades(spark, sf_dir, clean=True)
    pieces = max(1, -(-lines.count() // (RAGGED_FILES * RAGGED_ROWS)))
    t = lines.select(
        *TRADE_LIST, F.col("timestamp").alias("ingestion_timestamp"), F.col("source_file").alias("file_path"))
    whole = F.concat_ws(",", *[F.col(c).cast("string") for c in LANDED])
    short = F.concat_ws(",", *[F.col(c).cast("string") for c in LANDED[:-2]])
    line = (F.when(order % 5 == 0, F.concat(whole, F.lit(",X"), "symbol", F.lit(",\"a,b\"")))
            .when(order % 7 == 0, short).otherwise(whole))
    part = (order % RAGGED_FILES).cast("int")
    piece = F.when(part.isNull(), 0).otherwise(F.pmod(F.xxhash64(line), F.lit(pieces))).cast("int")
    rows = t.select(part.alias("part"), piece.alias("piece"), F.lit(1).alias("at"), line.alias("value"))
    heads = spark.range(RAGGED_FILES * pieces).select(
        (F.col("id") % RAGGED_FILES).cast("int").alias("part"), F.floor(F.col("id") / RAGGED_FILES).cast("int").alias("piece"),
        F.lit(0).alias("at"), F.lit(",".join(LANDED)).alias("value"))
    file = F.coalesce("part", F.lit(0)) * pieces + F.col("piece")
    (heads.unionByName(rows).repartitionById(RAGGED_FILES * pieces, file).sortWithinPartitions("part", "piece", "at")
     .select("part", "piece", "value").write.partitionBy("part", "piece").text(folder))


def q_landing_rescue(spark, sf_dir):
    folder = f"{work_dir(spark, 'ragged')}/landing"
    _ragged_landing(spark, sf_dir, folder)
    rows = read_landing(spark, f"{folder}/part=*/piece=*/*.txt")
    return rows.select(*LANDED, "_rescued_data", F.regexp_extract("source_file", r"part=(\d+)/", 1).alias("part"))


# -- append tables ------------------------------------------------------------------
def _files_read(store: TableStore, table: str) -> int:
    return store.read(table).select(F.input_file_name()).distinct().count()


def q_stream_compact_append(spark, sf_dir):
    """Bronze and silver tables get compacted copies, then a third update runs without
    new files: no row may come again, and readers take fewer files."""
    store, configs, _, _ = pipeline_run(spark, sf_dir, incremental=True)
    for c in configs:
        for table in (c.raw_table, c.clean_table):
            before = _files_read(store, table)
            if store.compact_append(table) and _files_read(store, table) >= before:
                raise RuntimeError(f"{table}: compaction left {before} files or more")
    run_update(spark, configs, store, as_of=AS_OF_SPARK, monitoring_mode="incremental", rollups=ROLLUPS)
    bronze = union_tier([store.read(c.raw_table) for c in configs])
    silver = union_tier([store.read(c.clean_table) for c in configs])
    return (bronze.select(F.lit("bronze").alias("tier"), *[F.col(c) for c in LANDED])
            .unionByName(silver.select(F.lit("silver").alias("tier"), *[F.col(c).cast("string") for c in LANDED])))


def q_stream_change_feed_buckets(spark, sf_dir):
    """The gold change feed of the second update from bucketed versions: the buckets of
    the files that landed before are not read."""
    store, configs, results, _ = pipeline_run(spark, sf_dir)
    side, feeds = TableStore(spark, f"{work_dir(spark, 'buckets')}/tables"), []
    for c in configs:
        versions = [side.write_snapshot(c.transform_table, store.read_version(c.transform_table, r.gold_versions[c.transform_table]),
                                        buckets=(["source_file"], FEED_BUCKETS)) for r in results]
        changed = changefeed.changed_buckets(side, c.transform_table, *versions)
        if not changed or len(changed) > FEED_BUCKETS // 2:
            raise RuntimeError(f"{c.transform_table}: {changed} should be some of the buckets")
        feeds.append(changefeed.bucketed_change_feed(side, c.transform_table, *versions))
    return union_tier(feeds).select(*SILVER_OUT, F.col("trade_value").cast(DEC).alias("trade_value"), "_change_type",
                                    "_commit_version")


def _rollup(name):
    rollup = next(r for r in ROLLUPS if r.name == name)

    def run(spark, sf_dir):
        store, _, _, _ = pipeline_run(spark, sf_dir, incremental=True)
        return partials.read_rollup(store, rollup)
    return run


def q_incremental_file_rollup(spark, sf_dir):
    return _rollup("file_rollup")(spark, sf_dir)


def q_incremental_trade_metrics(spark, sf_dir):
    return _rollup("trade_metrics")(spark, sf_dir).withColumn("total_value", F.col("total_value").cast(DEC))


def q_incremental_distinct(spark, sf_dir):
    """Distinct trade symbols: exact from the partial rows by symbol, and whether the
    union of the batches' sketches is within 5 % of it."""
    sketch = _rollup("distinct_symbol")(spark, sf_dir)
    exact = _rollup("trade_metrics")(spark, sf_dir).groupBy("exchange").agg(F.count("symbol").alias("distinct_symbols"))
    near = F.abs(F.col("estimate") - F.col("distinct_symbols")) <= 0.05 * F.col("distinct_symbols")
    return sketch.join(exact, "exchange").select("exchange", "rows", "distinct_symbols", near.alias("sketch_within_5_percent"))


# -- metrics ----------------------------------------------------------------------------
def q_stream_performance(spark, sf_dir):
    """More micro-batches than Spark keeps progress records for, each logged."""
    root = work_dir(spark, "performance")
    trades(spark, sf_dir).select("trade_id").repartition(MICRO_BATCHES).write.parquet(f"{root}/in")
    store = TableStore(spark, f"{root}/tables")
    stream = spark.readStream.schema("trade_id string").option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    with PerformanceLog(spark, store) as log:
        q = log.watch(stream.writeStream.queryName("trades_by_file").format("noop")
                      .option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start())
        log.wait(q)
    return performance(store).select("query", "batches", "rows")


# -- windows with late rows ---------------------------------------------------------------
def _late_windows(spark, sf_dir, mode):
    """Events arrive in ``SLICES`` drops by time, every twentieth one drop too late; one
    run of the stream after each.  The watermark waits for two drops."""
    root = work_dir(spark, f"windows-{mode}")
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    first, last = ev.agg(F.min("ts"), F.max("ts")).first()
    step = (last - first) / SLICES + dt.timedelta(seconds=1)
    seconds = F.lit(step.total_seconds())
    age = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lit(first).cast("timestamp_ntz").cast("timestamp"))
    drop = F.floor(age / (seconds * 1_000_000)).cast("int")
    late = F.when(F.col("event_id") % 20 == 0, 1).otherwise(0)
    dealt = ev.withColumn("slice", F.least(drop + late, F.lit(SLICES - 1)))
    store, wait = TableStore(spark, f"{root}/tables"), f"{int(2 * step.total_seconds()) + 1} seconds"
    for k in range(SLICES + (mode == "append")):
        if k < SLICES:
            rows = dealt.filter(F.col("slice") == k).drop("slice")
        else:  # nothing follows that would close the last windows: an empty mark far ahead does
            far = last + 3 * step + dt.timedelta(hours=2)
            rows = spark.createDataFrame([(None, far, None, None)], ev.schema)
        rows.write.parquet(f"{root}/in/drop={k}")
        stream = spark.readStream.schema(ev.schema).parquet(f"{root}/in/drop=*")
        agg = windowed_counts(stream, "ts", "1 hour", by=["event_type"], value="value", watermark=wait)
        run_windows(agg, store, "event_windows", f"{root}/state", mode=mode).awaitTermination()
    out = latest_windows(store, "event_windows", ["event_type"]) if mode == "update" else store.read("event_windows")
    return out.withColumn("sum_value", F.col("sum_value").cast("decimal(38,2)"))


def q_stream_time_windows_update(spark, sf_dir):
    return _late_windows(spark, sf_dir, "update")


def q_stream_time_windows_append(spark, sf_dir):
    return _late_windows(spark, sf_dir, "append")


# -- failure isolation ---------------------------------------------------------------------
def q_stream_failure_isolation(spark, sf_dir):
    """NASDAQ lands trades that break the rule; the other exchanges must advance, and
    the status table and the quality metrics show what happened."""
    root = work_dir(spark, "isolation")
    configs = default_sources(f"{root}/landing", f"{root}/state", declared_types=ADAPTER_TYPES, gold_mode="auto")
    store = TableStore(spark, f"{root}/tables")
    for ex in EXCHANGES:
        t = trades(spark, sf_dir, clean=ex != "NASDAQ").filter(F.col("exchange") == ex).select(
            *TRADE_LIST, F.col("timestamp").alias("ingestion_timestamp"), F.col("source_file").alias("file_path"))
        write_landing(t, f"{root}/landing", ex, "trades", "00000000_000000")
    try:
        run_update(spark, configs, store, as_of=AS_OF_SPARK)
        raise RuntimeError("the update should have failed")
    except UpdateFailed as e:
        if set(e.result.errors) != {"silver_nasdaq_trades"}:
            raise
    status = store.read(STATUS_TABLE).select(F.col("table_name"), "status")
    counts = union_tier([store.read(c.transform_table).groupBy().agg(F.count("*").alias("gold_rows"))
                         .withColumn("exchange", F.lit(ex)) for c, ex in zip(configs, EXCHANGES, strict=True)
                         if ex != "NASDAQ"])
    metrics = union_tier([store.read_append(f"_quality_metrics/{c.name}") for c in configs])
    bad = metrics.groupBy("source").agg(F.sum("rows_in").alias("rows_in"), F.sum("violations").alias("violations"))
    out = spark.createDataFrame([(ex,) for ex in EXCHANGES], "exchange string")
    low = F.lower("exchange")
    for tier in ("silver", "gold"):
        one = status.withColumnsRenamed({"status": f"{tier}_status", "table_name": tier})
        out = out.join(one, F.col(tier) == F.concat(F.lit(f"{tier}_"), low, F.lit("_trades"))).drop(tier)
    return (out.join(counts, "exchange", "left").join(bad, F.col("source") == F.concat(low, F.lit("_trades")))
            .select("exchange", "silver_status", "gold_status", F.coalesce("gold_rows", F.lit(0)).alias("gold_rows"),
                    "rows_in", "violations"))


# -- schemas ------------------------------------------------------------------------------------
def q_stream_additive_schema(spark, sf_dir):
    """NASDAQ trades without, then with a venue column, in additive mode: the table
    widens, and each batch names the schema that it was read with."""
    root = work_dir(spark, "additive")
    cfg = default_sources(f"{root}/landing", f"{root}/state", exchanges=("NASDAQ",), schema_evolution_mode="additive")[0]
    store = TableStore(spark, f"{root}/tables")
    for drop in ("initial", "incremental"):
        df = landing_frame(spark, sf_dir, "NASDAQ", drop)
        write_landing(df.drop("venue") if drop == "initial" else df, f"{root}/landing", "NASDAQ", drop, "0")
        ingest.start_bronze(spark, cfg, store).awaitTermination()
    rows = store.read_append(cfg.raw_table)
    at = F.create_map(*[F.lit(x) for b in store.batches(cfg.raw_table) for x in (b, ingest.batch_schema(cfg, b)[0])])
    return rows.groupBy("venue", at[F.col("batch_id")].alias("schema_version")).agg(F.count("*").alias("rows"))


def q_stream_plain_append(spark, sf_dir):
    """Landing files through the plain CSV stream into an append-mode file sink."""
    root = work_dir(spark, "plain")
    t = trades(spark, sf_dir, clean=True).filter("exchange = 'LSE'").select(*TRADE_LIST)
    write_landing(t, f"{root}/landing", "LSE", "trades", "0")
    stream = stream_landing(spark, f"{root}/landing/lse/bronze/*", TRADE_LIST, max_files_per_trigger=2)
    append_stream(stream.drop("source_file"), f"{root}/table", f"{root}/state").awaitTermination()
    return spark.read.parquet(f"{root}/table")


def q_stream_listing_by_names(spark, sf_dir):
    """Bronze of files listed from the last name; the second drop's names sort before
    those of the first, so only a full listing finds them."""
    root = work_dir(spark, "names")
    cfg = default_sources(f"{root}/landing", f"{root}/state", exchanges=("LSE",), clean_source="off",
                          listing="names", full_listing_every=1, max_files_per_trigger=2)[0]
    store = TableStore(spark, f"{root}/tables")
    for drop, prefix in (("initial", "trades"), ("incremental", "late")):
        write_landing(landing_frame(spark, sf_dir, "LSE", drop), f"{root}/landing", "LSE", prefix, "0")
        have = -1
        while have != len(store.batches(cfg.raw_table)):
            have = len(store.batches(cfg.raw_table))
            ingest.start_bronze(spark, cfg, store).awaitTermination()
    return store.read_append(cfg.raw_table).select(*TRADE_LIST)


# -- catalog ------------------------------------------------------------------------------------------
def _published(spark, sf_dir) -> tuple[str, list[SourceConfig], TableStore]:
    store, configs, _, _ = pipeline_run(spark, sf_dir, incremental=True)
    database = f"trades_{abs(hash((sf_dir, spark.sparkContext.applicationId))) % 10 ** 8}"
    for c in configs:
        for table in (c.raw_table, c.clean_table, c.transform_table):
            catalog.publish(store, table, database)
    return database, configs, store


def q_catalog_gold(spark, sf_dir):
    """The gold tables by name in a database, partitions in step with the batches."""
    database, configs, _ = _published(spark, sf_dir)
    return spark.sql(" UNION ALL ".join(
        f"SELECT {', '.join(SILVER_OUT)}, CAST(trade_value AS {DEC}) AS trade_value FROM {database}.{c.transform_table}"
        for c in configs))


def q_catalog_properties(spark, sf_dir):
    database, configs, _ = _published(spark, sf_dir)
    out = []
    for c in configs:
        one = spark.sql(f"SHOW TBLPROPERTIES {database}.{c.raw_table}").filter(F.col("key").startswith("delta."))
        out.append(one.select(F.lit(c.raw_table).alias("table_name"), "key", "value",
                              F.lit(spark.table(f"{database}.{c.raw_table}").count()).alias("rows")))
    return union_tier(out)


# -- rules as functions ----------------------------------------------------------------------------
def q_callable_rules(spark, sf_dir):
    rules = {"cheap": lambda: price_bucket() == "LOW", "session": in_market_hours, "positive": "price > 0"}
    return quality.rule_compliance(trades(spark, sf_dir), rules)


TABLE_QUERIES = {
    "landing_rescue": q_landing_rescue,
    "stream_compact_append": q_stream_compact_append,
    "stream_change_feed_buckets": q_stream_change_feed_buckets,
    "incremental_file_rollup": q_incremental_file_rollup,
    "incremental_trade_metrics": q_incremental_trade_metrics,
    "incremental_compliance": _rollup("rule_compliance"),
    "incremental_completeness": _rollup("completeness"),
    "incremental_distinct": q_incremental_distinct,
    "stream_performance": q_stream_performance,
    "stream_time_windows_update": q_stream_time_windows_update,
    "stream_time_windows_append": q_stream_time_windows_append,
    "stream_failure_isolation": q_stream_failure_isolation,
    "stream_additive_schema": q_stream_additive_schema,
    "stream_plain_append": q_stream_plain_append,
    "stream_listing_by_names": q_stream_listing_by_names,
    "catalog_gold": q_catalog_gold,
    "catalog_properties": q_catalog_properties,
    "callable_rules": q_callable_rules,
}

_ORDER_KEY = "CAST(string_split(trade_id, '_')[2] AS BIGINT)"
_TEXT = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in TRADE_LIST)
_RESCUE = (f"CASE WHEN {_ORDER_KEY} % 5 = 0 THEN '{{\"_c10\":\"X' || symbol || '\",\"_c11\":\"a,b\"}}' "
           f"WHEN {_ORDER_KEY} % 7 = 0 THEN '{{\"_missing\":\"ingestion_timestamp,file_path\"}}' END")
_SHORT = f"{_ORDER_KEY} % 5 <> 0 AND {_ORDER_KEY} % 7 = 0"
_COMPLETENESS = " UNION ALL ".join(
    f"SELECT exchange, '{c}' AS column_name, count(*) AS rows, count(*) - count({'source_file' if c == 'file_path' else c}) "
    f"AS nulls, CAST(count(*) - count({'source_file' if c == 'file_path' else c}) AS DOUBLE) / count(*) AS null_rate "
    "FROM trades GROUP BY exchange" for c in TRADE_COLUMNS_CHECKED)


def _rules_sql(rules: dict) -> str:
    return " UNION ALL ".join(
        f"SELECT exchange, '{n}' AS rule, count(*) AS rows, count(*) FILTER (WHERE coalesce(({r}), false)) AS passed, "
        f"count(*) - count(*) FILTER (WHERE coalesce(({r}), false)) AS failed, "
        f"CAST(count(*) FILTER (WHERE coalesce(({r}), false)) AS DOUBLE) / count(*) AS pass_rate "
        "FROM trades GROUP BY exchange" for n, r in rules.items())


_PROPERTIES = ", ".join(f"('delta.{k}', 'true')" for k in (
    "enableChangeDataFeed", "autoOptimize.optimizeWrite", "autoOptimize.autoCompact"))

TABLE_ORACLES = {
    "landing_rescue": with_trades(
        f"SELECT {_TEXT}, CASE WHEN {_SHORT} THEN NULL ELSE CAST(timestamp AS VARCHAR) END AS ingestion_timestamp, "
        f"CASE WHEN {_SHORT} THEN NULL ELSE source_file END AS file_path, {_RESCUE} AS _rescued_data, "
        f"CAST({_ORDER_KEY} % {RAGGED_FILES} AS VARCHAR) AS part FROM trades", clean=True),
    "stream_compact_append": with_trades(
        " UNION ALL ".join(f"SELECT '{tier}' AS tier, {_TEXT}, CAST(timestamp AS VARCHAR) AS ingestion_timestamp, "
                           f"source_file AS file_path FROM trades{where}" for tier, where in
                           (("bronze", ""), ("silver", " WHERE price > 0 AND quantity > 0"))), clean=True),
    "stream_change_feed_buckets": STREAM_ORACLES["stream_change_feed"],
    "incremental_file_rollup": with_trades(
        "SELECT exchange, source_file AS file_path, count(*) AS rows, min(timestamp) AS first_event_ts, "
        "max(timestamp) AS last_event_ts, CAST(sum(quantity) AS BIGINT) AS total_quantity, "
        f"{AS_OF_SQL} AS ingested_at FROM ({_SILVER_SQL.replace('source_file AS file_path', 'source_file')}) s "
        "GROUP BY exchange, source_file", clean=True),
    "incremental_trade_metrics": trade_metrics(),
    "incremental_compliance": with_trades(_rules_sql(RULES), clean=True),
    "incremental_completeness": with_trades(_COMPLETENESS, clean=True),
    "incremental_distinct": with_trades(
        "SELECT exchange, count(*) AS rows, count(DISTINCT symbol) AS distinct_symbols, true AS sketch_within_5_percent "
        "FROM trades WHERE price > 0 AND quantity > 0 GROUP BY exchange", clean=True),
    "stream_performance": f"SELECT 'trades_by_file' AS query, {MICRO_BATCHES} AS batches, count(*) AS rows FROM lineitem",
    "stream_time_windows_update": time_windows(),
    "stream_time_windows_append": time_windows(),
    "stream_failure_isolation": with_trades(
        "SELECT exchange, CASE WHEN exchange = 'NASDAQ' THEN 'failed' ELSE 'updated' END AS silver_status, "
        "CASE WHEN exchange = 'NASDAQ' THEN 'skipped' ELSE 'updated' END AS gold_status, "
        "count(*) FILTER (WHERE exchange <> 'NASDAQ') AS gold_rows, count(*) AS rows_in, "
        "count(*) FILTER (WHERE exchange = 'NASDAQ' AND NOT coalesce(price > 0 AND quantity > 0, false)) AS violations "
        "FROM trades GROUP BY exchange"),
    "stream_additive_schema": with_trades(
        f"SELECT CASE WHEN timestamp >= TIMESTAMP '{DROP_CUTOFF}' THEN market_center END AS venue, "
        f"CASE WHEN timestamp >= TIMESTAMP '{DROP_CUTOFF}' THEN 1 ELSE 0 END AS schema_version, count(*) AS rows "
        "FROM trades WHERE exchange = 'NASDAQ' GROUP BY 1, 2", clean=True),
    "stream_plain_append": with_trades(f"SELECT {_TEXT} FROM trades WHERE exchange = 'LSE'", clean=True),
    "stream_listing_by_names": with_trades(f"SELECT {_TEXT} FROM trades WHERE exchange = 'LSE'", clean=True),
    "catalog_gold": with_trades(
        f"SELECT *, CAST(price * quantity AS DECIMAL(38,4)) AS trade_value FROM ({_SILVER_SQL}) s", clean=True),
    "catalog_properties": with_trades(
        "SELECT 'bronze_' || lower(exchange) || '_trades' AS table_name, p.key, p.value, rows "
        "FROM (SELECT exchange, count(*) AS rows FROM trades GROUP BY exchange), "
        f"(VALUES {_PROPERTIES}) AS p(key, value)", clean=True),
    "callable_rules": with_trades(_rules_sql({
        "cheap": "coalesce(price, 0) <= 50", "session": "hour(timestamp) >= 9 AND hour(timestamp) < 16",
        "positive": "price > 0"})),
}
