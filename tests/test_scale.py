"""Steps that must not grow with a task's share of the rows: writes without a shuffle,
compaction without a sort, parts in several files, changes expanded in place."""

from pyspark.sql import functions as F

from tests.conftest import rows
from tierflow.operators import changefeed
from tierflow.operators.changefeed import change_feed
from tierflow.plans import table_queries
from tierflow.sinks import paths
from tierflow.sinks.tables import MAX_RANGES, TableStore, batch_ranges, deal, files_for


def test_optimized_writes_take_no_shuffle(spark, tmp):
    store = TableStore(spark, tmp)
    cores = spark.sparkContext.defaultParallelism
    store.write_snapshot("t", spark.range(0, 4000, 1, 4 * cores), optimize_write=True, size_bytes=1)
    store.append_batch("a", spark.range(0, 4000, 1, 4 * cores), 0, optimize_write=True, size_bytes=1)
    for df in (store.read_version("t"), store.read("a")):
        files = df.groupBy(F.input_file_name()).agg(F.min("id").alias("a"), F.max("id").alias("b"), F.count("*").alias("n")).collect()
        assert 0 < len(files) <= cores and sum(r.n for r in files) == 4000
        assert all(r.b - r.a + 1 == r.n for r in files)  # neighbours stayed together


def test_rows_are_dealt_evenly_without_a_sort(spark, tmp):
    src = spark.range(0, 1000, 1, 7).withColumn("k", F.lit("same"))
    df = deal(src, 4)
    assert "Sort" not in df._jdf.queryExecution().executedPlan().toString()
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) - min(sizes) <= 7 and rows(df) == rows(src)


def test_compacted_files_hold_ranges_of_batches(spark, tmp):
    store = TableStore(spark, tmp)
    for b in range(9):
        store.append_batch("t", spark.range(b * 1000, b * 1000 + 1000, 1, 2), b)
    one = paths.total_size(f"{tmp}/t/batch_id=0")
    want = rows(store.read_append("t"))
    assert store.compact_append("t", target_bytes=one + one // 4) and rows(store.read_append("t")) == want
    assert files_for(2 * one, one + one // 4) == 2
    files = store.read_append("t").filter("batch_id < 8").groupBy(F.input_file_name().alias("f")).agg(
        F.min("batch_id").alias("a"), F.max("batch_id").alias("b")).collect()
    assert len(files) == 8 and all(r.b // 2 == r.a // 2 for r in files)  # two files for each two batches


def test_ranges_of_batches_are_bounded():
    folders = [(str(k), 10) for k in range(5000)]
    got = batch_ranges(folders, 10)
    assert len(got) <= 2 * MAX_RANGES and [f for some, _ in got for f in some] == [f for f, _ in folders]
    assert batch_ranges([("a", 50), ("b", 5), ("c", 5), ("d", 5)], 5) == [(["a"], 50), (["b", "c"], 10), (["d"], 5)]


def test_ragged_parts_are_dealt_to_files(spark, tmp, monkeypatch):
    sf = f"{tmp}/sf"
    spark.range(0, 3000, 1, 3).selectExpr(
        "id div 3 AS l_orderkey", "id % 3 AS l_linenumber", "id % 50 AS l_partkey", "id % 11 AS l_suppkey",
        "cast(id + 1 AS decimal(15,2)) AS l_extendedprice", "cast(1 + id % 9 AS decimal(15,2)) AS l_quantity",
        "timestamp_ntz'1995-01-01 00:00:00' + make_dt_interval(cast(id % 900 AS int)) AS l_shipdate",
    ).write.parquet(f"{sf}/lineitem.parquet")
    want = rows(table_queries.q_landing_rescue(spark, sf))
    monkeypatch.setattr(table_queries, "RAGGED_ROWS", 300)
    df = table_queries.q_landing_rescue(spark, sf)
    assert rows(df) == want
    sizes = [r["count"] for r in df.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 3 * table_queries.RAGGED_FILES and max(sizes) < 2 * 300


def test_changes_are_expanded_where_they_are(spark):
    old, new = spark.range(0, 50), spark.range(40, 100).union(spark.range(90, 100))
    most = changefeed.most_copies(old, new)
    assert 2 <= most <= 70 and changefeed.most_copies(spark.range(0)) == 0
    assert changefeed.most_copies(spark.range(0, 500).selectExpr("id div 400 AS x", "cast(null AS int) AS y")) == 400
    for chunk in (most, most - 1, 1):
        feed = change_feed(old, new, 2, chunk_rows=chunk, most=most)
        got = feed.groupBy("_change_type").count().collect()
        assert {r["_change_type"]: r["count"] for r in got} == {"insert": 60, "delete": 40}
        # changed groups are dealt again only where one may be larger than a chunk
        assert ("RepartitionByExpression" in feed._jdf.queryExecution().optimizedPlan().toString()) == (chunk < most)


def test_bucketed_changes_with_copies_beyond_a_chunk(spark, tmp, monkeypatch):
    store = TableStore(spark, tmp)
    old = spark.range(0, 40).selectExpr("id", "concat('f', id % 4) AS f")
    new = old.union(spark.range(0, 30).selectExpr("7L AS id", "'f3' AS f"))
    v1, v2 = (store.write_snapshot("t", df, buckets=(["f"], 8)) for df in (old, new))
    feed = change_feed
    monkeypatch.setattr(changefeed, "change_feed", lambda *a, **kw: feed(*a, **kw, chunk_rows=10))
    got = changefeed.bucketed_change_feed(store, "t", v1, v2)
    assert rows(got) == [(7, "f3", "insert", 2)] * 30
