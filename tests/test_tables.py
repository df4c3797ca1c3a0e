"""Compacted copies, schema log, rescue of records, rollups, metrics, catalog."""

import threading

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_streaming import AS_OF, HEADER, cfg_for, write
from tierflow.functions.schema import conform
from tierflow.operators import changefeed
from tierflow.operators import rollups as R
from tierflow.plans.pipeline import STATUS_TABLE, UpdateFailed, run_update
from tierflow.sinks import catalog, paths
from tierflow.sinks.tables import TableStore, auto_compact
from tierflow.sources.landing import read_landing
from tierflow.streaming import ingest, partials
from tierflow.streaming.metrics import PerformanceLog, performance
from tierflow.streaming.windows import latest_windows, run_windows, windowed_counts


def files_read(store, name):
    return store.read(name).select(F.input_file_name()).distinct().count()


def fill(store, name, batches, partition=None):
    for b in batches:
        store.append_batch(name, store.spark.range(b * 10, b * 10 + 10).repartition(3), b, partition=partition)


def test_compacted_copies(spark, tmp):
    store = TableStore(spark, tmp)
    fill(store, "t", range(6))
    want = rows(store.read_append("t"))
    assert files_read(store, "t") == 18
    seen = []
    stream = lambda: store.stream_append("t").writeStream.foreachBatch(lambda df, _: seen.append(df.count())).option(
        "checkpointLocation", f"{tmp}/state").trigger(availableNow=True).start().awaitTermination()
    stream()
    assert sum(seen) == 60
    assert store.compact_append("t") and rows(store.read_append("t")) == want
    assert files_read(store, "t") == 1 + 3  # closed batches in one file; the last one may be replayed
    stream()
    assert sum(seen) == 60  # nothing is delivered again
    fill(store, "t", [6, 7])
    stream()
    assert sum(seen) == 80
    assert store.compact_append("t") and store.meta("t")["compacted"][1]["through"] == {"": 6}  # only the new batches
    assert store.read("t").count() == 80 and files_read(store, "t") == 1 + 1 + 3
    assert not store.compact_append("t")
    # covered folders are not read: only partition columns decide
    live = store.read_append("t").filter("batch_id = 7").select(F.input_file_name().alias("f")).distinct().collect()
    assert len(live) == 3 and all("batch_id=7" in r.f for r in live)
    # a covered batch that is written again is read from its folder, as are all after it
    store.append_batch("t", spark.range(500, 501), 5)
    assert [seg["through"] for seg in store.meta("t")["compacted"]] == [{"": 4}] and store.read("t").count() == 71
    assert store.compact_append("t") and store.read("t").count() == 71
    store.append_batch("t", spark.range(500, 502), 0)
    assert store.meta("t")["compacted"] == [] and store.read("t").count() == 63


def test_compaction_of_partitioned_and_small_tables(spark, tmp):
    store = TableStore(spark, tmp)
    fill(store, "p", range(3), ("source", "a"))
    fill(store, "p", [4], ("source", "b"))
    want = rows(store.read_append("p").select("id", "batch_id", "source"))
    assert store.compact_append("p") and store.meta("p")["compacted"][0]["through"] == {"a": 1}
    assert rows(store.read_append("p").select("id", "batch_id", "source")) == want
    fill(store, "one", [0])
    assert not store.compact_append("one")
    fill(store, "auto", range(4))
    assert not auto_compact(store, "auto", 2)
    store.set_meta("auto", properties={"delta.autoOptimize.autoCompact": "true"})
    assert not auto_compact(store, "auto") and auto_compact(store, "auto", 2) and store.read("auto").count() == 40


def test_schema_log_keeps_every_writers_columns(spark, tmp):
    cfg = cfg_for(tmp)
    ingest.widen_schema(cfg, ["a"])
    threads = [threading.Thread(target=ingest.widen_schema, args=(cfg, [f"c{i}", f"d{i}"])) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    version, columns = ingest.current_schema(cfg)
    assert set(columns) == {"a", *[f"{x}{i}" for i in range(8) for x in "cd"]} and version <= 8
    assert ingest.schema_of_version(cfg, 0) == ["a"] and ingest.widen_schema(cfg, ["a"])[0] == version
    assert not paths.create_new(f"{ingest.schema_log(cfg)}/v00000000.json", "x")


def test_records_of_another_length_are_rescued(spark, tmp):
    land = f"{tmp}/landing"
    write(f"{land}/a/f1.csv", 'x,y\n1,2\n3,4,5,"six, ""6"""\n7\n8,9,\n"a,b",\n')
    write(f"{land}/b/f2.csv", "y,_c2,z\n1,2,3\n1,2,3,4\n")
    got = {(r.x, r.y): r._rescued_data for r in read_landing(spark, f"{land}/*/*.csv", ["x", "y"]).collect()}
    assert got == {("1", "2"): None, ("3", "4"): '{"_c2":"5","_c3":"six, \\"6\\""}', ("7", None): '{"_missing":"y"}',
                   ("8", "9"): None, ("a,b", None): None, (None, "1"): got[None, "1"]}
    later = {r._rescued_data for r in read_landing(spark, f"{land}/b/*.csv", ["y"]).collect()}
    assert later == {'{"_c2":"2","z":"3"}', '{"_c2":"2","z":"3","__c3":"4"}'}  # named apart from the header's _c2
    assert {r.f for r in read_landing(spark, f"{land}/*/*.csv", ["x"]).select(
        F.element_at(F.split("source_file", "/"), -1).alias("f")).collect()} == {"f1.csv", "f2.csv"}


def test_rounded_values_are_rescued(spark):
    df = spark.createDataFrame([("12.34567",), ("12.3400",), ("12.34000",), ("abc",), (None,), ("1e2",)], "price string")
    got = [tuple(r) for r in conform(df, {"price": "decimal(10,4)"}).selectExpr("cast(price AS string)", "_rescued_data").collect()]
    assert got == [("12.3457", '{"price":"12.34567"}'), ("12.3400", None), ("12.3400", None), (None, '{"price":"abc"}'),
                   (None, None), ("100.0000", None)]


def trade(i, price="12.5", exchange="NYSE"):
    return f"T{i},S{i % 3},{exchange},{price},{i + 1},2024-01-01 10:00:0{i % 10},BUY,MAIN"


def two_sources(tmp):
    second = dict(name="lse_trades", raw_table="bronze_lse_trades", clean_table="silver_lse_trades",
                  transform_table="gold_lse_trades", source_path=f"{tmp}/landing/lse/bronze/",
                  checkpoint_path=f"{tmp}/state/lse", primary_filter="exchange = 'LSE'", gold_mode="auto")
    return [cfg_for(tmp, gold_mode="auto"), cfg_for(tmp, **second)]


def test_one_source_fails_the_others_advance(spark, tmp):
    store, configs = TableStore(spark, f"{tmp}/tables"), two_sources(tmp)
    write(f"{tmp}/landing/nyse/bronze/f1.csv", "\n".join([HEADER, trade(1), trade(2, "-1")]) + "\n")
    write(f"{tmp}/landing/lse/bronze/f1.csv", "\n".join([HEADER, trade(1, exchange="LSE")]) + "\n")
    with pytest.raises(UpdateFailed, match="EXPECTATION_FAILED") as e:
        run_update(spark, configs, store, as_of=AS_OF)
    status = e.value.result.status
    assert status["silver_nyse_trades"] == "failed" and status["gold_nyse_trades"] == "skipped"
    assert status["bronze_nyse_trades"] == status["gold_lse_trades"] == status["monitoring"] == "updated"
    assert store.read("gold_lse_trades").count() == 1 and not store.exists("gold_nyse_trades")
    marks = {r.table_name: (r.status, r.error) for r in store.read(STATUS_TABLE).collect()}
    assert marks["gold_nyse_trades"] == ("skipped", None) and "EXPECTATION_FAILED" in marks["silver_nyse_trades"][1]
    # a folder that is missing fails its own source only
    paths.delete_dir(f"{tmp}/landing/nyse")
    store2, configs2 = TableStore(spark, f"{tmp}/tables2"), two_sources(tmp)
    configs2 = [c.__class__(**{**c.__dict__, "checkpoint_path": c.checkpoint_path + "2", "clean_source": "off"}) for c in configs2]
    with pytest.raises(UpdateFailed) as e:
        run_update(spark, configs2, store2, as_of=AS_OF)
    assert set(e.value.result.errors) == {"bronze_nyse_trades"} and store2.read("gold_lse_trades").count() == 1


def test_rollups_merge_and_replay(spark, tmp):
    store, cfg = TableStore(spark, f"{tmp}/tables"), cfg_for(tmp, gold_mode="auto")
    kinds = (partials.trade_metrics(), partials.distinct_values(), partials.file_rollup(("exchange",)))
    for k in range(2):
        write(f"{tmp}/landing/nyse/bronze/f{k}.csv", "\n".join([HEADER, *[trade(i) for i in range(k, 5 + k)]]) + "\n")
        run_update(spark, [cfg], store, as_of=AS_OF, rollups=kinds, monitoring_tables=False)
    gold = store.read(cfg.transform_table)
    assert rows(partials.read_rollup(store, kinds[0])) == rows(R.trade_metrics(gold).selectExpr(
        "exchange", "symbol", "trade_count", "total_quantity", "cast(total_value as decimal(38,4)) total_value", "vwap"))
    assert rows(partials.read_rollup(store, kinds[1])) == [("NYSE", 10, 3)]
    assert partials.read_rollup(store, kinds[2]).first()["rows"] == 10
    # a replayed batch replaces its own partial rows
    silver = store.read_append(cfg.clean_table)
    for r in kinds:
        batch = partials.partial_rows(silver.filter("batch_id = 1").drop("batch_id"), r)
        store.append_batch(r.table, batch, 1, partition=("source", cfg.name))
    assert partials.read_rollup(store, kinds[2]).first()["rows"] == 10
    assert store.batches(kinds[0].table) == [0, 1]


def test_performance_log_outlives_recent_progress(spark, tmp):
    spark.range(40).repartition(12).write.parquet(f"{tmp}/in")
    store = TableStore(spark, f"{tmp}/tables")
    old = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates", "100")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        with PerformanceLog(spark, store) as log:
            stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{tmp}/in")
            q = log.watch(stream.writeStream.format("noop").queryName("q").option(
                "checkpointLocation", f"{tmp}/state").trigger(availableNow=True).start())
            log.wait(q)
            assert len(q.recentProgress) <= 3
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", old)
    assert [tuple(r)[:3] for r in performance(store).collect()] == [("q", 12, 40)]
    with PerformanceLog(spark, store):
        pass  # nothing watched, nothing written
    assert performance(store).first()["rows"] == 40


def test_update_mode_windows_keep_the_last_value(spark, tmp):
    store = TableStore(spark, f"{tmp}/tables")
    drops = [[("2024-01-01 00:10:00", 1.0), ("2024-01-01 02:30:00", 2.0)], [("2024-01-01 00:50:00", 4.0)],  # late, in time
             [("2024-01-01 09:00:00", 1.0)], [("2024-01-01 00:20:00", 8.0)]]  # the last comes after its window has closed
    for k, drop in enumerate(drops):
        spark.createDataFrame(drop, "t string, value double").selectExpr("cast(t AS timestamp) ts", "value").write.parquet(f"{tmp}/in/d={k}")
        stream = spark.readStream.schema("ts timestamp, value double").parquet(f"{tmp}/in/d=*")
        run_windows(windowed_counts(stream, "ts", value="value", watermark="3 hours"), store, "w", f"{tmp}/state",
                    mode="update").awaitTermination()
    got = rows(latest_windows(store, "w").selectExpr("hour(window_start)", "events", "cast(sum_value AS string)"))
    assert got == [(0, 2, "5.00"), (2, 1, "2.00"), (9, 1, "1.00")]
    with pytest.raises(ValueError):
        run_windows(None, store, "w", tmp, mode="upsert")


def test_catalog_follows_versions_batches_and_columns(spark, tmp):
    store, db = TableStore(spark, tmp), "catalog_test"
    store.write_snapshot("s", spark.range(3), comment="it's one", properties={"a.b": "x"})
    name = catalog.publish(store, "s", db)
    assert spark.table(name).count() == 3
    store.write_snapshot("s", spark.range(5))
    catalog.publish(store, "s", db)
    assert spark.sql(f"SELECT count(*) FROM {name}").first()[0] == 5
    store.write_snapshot("s", spark.range(2).withColumn("more", F.lit("m")))
    catalog.publish(store, "s", db)
    assert rows(spark.table(name)) == [(0, "m"), (1, "m")]
    assert {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}["a.b"] == "x"
    assert [r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect() if r.col_name == "Comment"] == ["it's one"]
    fill(store, "p", [0, 1], ("source", "a"))
    table = catalog.publish(store, "p", db)
    store.append_batch("p", spark.range(1).withColumn("extra", F.lit(7)), 2, partition=("source", "b"))
    catalog.publish(store, "p", db)
    assert spark.table(table).count() == 21 and spark.sql(f"SHOW PARTITIONS {table}").count() == 3
    assert spark.table(table).filter("extra = 7 AND source = 'b'").count() == 1


def feed(df):
    return sorted((r.k, r.v, r._change_type) for r in df.collect())


def test_bucketed_change_feed_reads_changed_buckets_only(spark, tmp):
    store = TableStore(spark, tmp)
    base = spark.range(400).select((F.col("id") % 20).alias("k"), (F.col("id") % 3).cast("string").alias("v"))
    new = base.filter("k <> 7").unionByName(base.filter("k = 7").limit(5)).unionByName(spark.sql("SELECT 3L k, '9' v"))
    v1 = store.write_snapshot("t", base, buckets=(["k"], 16))
    v2 = store.write_snapshot("t", new, buckets=(["k"], 16))
    assert rows(store.read("t")) == rows(new) and store.read("t").columns == ["k", "v"]
    changed = changefeed.changed_buckets(store, "t", v1, v2)
    assert 1 <= len(changed) <= 2
    got = changefeed.bucketed_change_feed(store, "t", v1, v2)
    assert feed(got) == feed(changefeed.change_feed(base, new, v2)) and got.count() == 16
    import contextlib
    import io
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        got.explain("formatted")
    filters = [line for line in out.getvalue().splitlines() if line.startswith("PartitionFilters")]
    assert len(filters) == 2 and all("_bucket" in f for f in filters)
    assert changefeed.bucketed_change_feed(store, "t", v2, v2).count() == 0
    # another layout, another column or no layout: every bucket is compared
    v3 = store.write_snapshot("t", new.withColumn("w", F.lit(1)), buckets=(["k"], 8))
    assert changefeed.changed_buckets(store, "t", v2, v3) is None
    assert changefeed.bucketed_change_feed(store, "t", v2, v3).count() == 2 * new.count()
    v4 = store.write_snapshot("t", new)
    assert changefeed.bucketed_change_feed(store, "t", v2, v4).count() == 0
