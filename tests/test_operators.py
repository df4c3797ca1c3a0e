from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tierflow.functions.exprs import exact_mean
from tierflow.functions.schema import conform
from tierflow.operators import changefeed, monitoring, quality, rollups
from tierflow.operators.transforms import apply_sql_template, stamp, tag, union_tier

TYPES = {"price": "decimal(10,4)", "quantity": "bigint", "exchange": "string"}


def test_conform_casts_before_rules_and_rescues_bad_text(spark):
    df = spark.createDataFrame(
        [("NYSE", "12.3400", "5", None), ("NYSE", "0.30", "100.0", None), ("NYSE", "abc", "1", '{"venue":"X"}'),
         ("NYSE", None, None, None)],
        "exchange string, price string, quantity string, _rescued_data string")
    out = conform(df, TYPES)
    assert out.columns == df.columns
    got = {(r.price, r.quantity, r._rescued_data) for r in out.collect()}
    assert (Decimal("12.3400"), 5, None) in got
    # '0.30' stays a valid sub-1.00 price; '100.0' is not a bigint -> rescued
    assert (Decimal("0.3000"), None, '{"quantity":"100.0"}') in got
    # merges with keys rescued at ingest
    assert (None, 1, '{"venue":"X","price":"abc"}') in got
    assert (None, None, None) in got
    # the sub-1.00 price passes the rule once typed
    assert out.filter(F.expr("price > 0")).count() == 2


def test_expect_all_or_fail_raises_and_null_is_violation(spark):
    df = spark.createDataFrame([(1.0, 1), (None, 2)], "price double, quantity long")
    with pytest.raises(Exception, match="EXPECTATION_FAILED"):
        quality.expect_all_or_fail(df, {"valid_trade": "price > 0 AND quantity > 0"}).collect()
    ok = spark.createDataFrame([(1.0, 1), (2.0, 3)], "price double, quantity long")
    assert quality.expect_all_or_fail(ok, {"valid_trade": "price > 0 AND quantity > 0"}).count() == 2


def test_rules_see_rows_after_primary_filter(spark):
    df = spark.createDataFrame([("NYSE", 1.0), ("LSE", -1.0)], "exchange string, price double")
    out = quality.expect_all_or_fail(df.filter("exchange = 'NYSE'"), {"p": "price > 0"})
    assert out.count() == 1  # the wrong-exchange row is dropped, never validated


def test_check_expectations_counts(spark):
    df = spark.createDataFrame([(1.0,), (-1.0,), (None,)], "price double")
    assert quality.violation_counts(df, {"p": "price > 0"}) == {"p": 2}
    with pytest.raises(quality.ExpectationError):
        quality.check_expectations(df, {"p": "price > 0"})


def test_quality_score_empty_is_null(spark):
    df = spark.createDataFrame([], "price double")
    r = quality.quality_score(df, "price > 0").first()
    assert r.total_rows == 0 and r.valid_rows == 0 and r.quality_score is None
    df = spark.createDataFrame([(1.0,), (-1.0,), (None,), (2.0,)], "price double")
    r = quality.quality_score(df, "price > 0").first()
    assert (r.total_rows, r.valid_rows, r.quality_score) == (4, 2, 0.5)


def test_callable_rule(spark):
    df = spark.createDataFrame([("A", 1.0), ("A", -2.0)], "exchange string, price double")
    c = quality.rule_compliance(df, {"positive": lambda: F.col("price") > 0}).first()
    assert (c.rows, c.passed, c.failed, c.pass_rate) == (2, 1, 1, 0.5)


def test_completeness_and_alerts(spark):
    df = spark.createDataFrame([("A", 1.0, None), ("A", None, "x"), ("B", 2.0, "y")], "exchange string, p double, s string")
    comp = {(r.exchange, r.column_name): (r.rows, r.nulls) for r in quality.completeness(df).collect()}
    assert comp == {("A", "p"): (2, 1), ("A", "s"): (2, 1), ("B", "p"): (1, 0), ("B", "s"): (1, 0)}
    al = quality.alerts(quality.rule_compliance(df, {"r": "p > 0"}), 0.9).collect()
    assert [(a.exchange, a.rule) for a in al] == [("A", "r")]


def test_exact_mean_rounds_half_up_without_floats(spark):
    df = spark.createDataFrame([(Decimal("55567.7157"), 1), (Decimal("55567.7158"), 1)], "v decimal(10,4), k int")
    r = df.groupBy("k").agg(F.sum("v").alias("s"), F.count("v").alias("n")).select(
        exact_mean(F.col("s"), F.col("n")).alias("m")).first()
    assert r.m == Decimal("55567.7158")  # .71575 -> half toward +inf
    neg = spark.createDataFrame([(Decimal("-0.0001"), 1), (Decimal("-0.0002"), 1)], "v decimal(10,4), k int")
    r = neg.groupBy("k").agg(F.sum("v").alias("s"), F.count("v").alias("n")).select(
        exact_mean(F.col("s"), F.col("n")).alias("m")).first()
    assert r.m == Decimal("-0.0001")  # -0.00015 -> toward +inf


def test_drift_lag(spark):
    import datetime as dt
    df = spark.createDataFrame([("A", dt.datetime(2024, 1, 5), Decimal("10")), ("A", dt.datetime(2024, 2, 5), Decimal("14")),
                                ("A", dt.datetime(2024, 2, 6), None)], "exchange string, timestamp timestamp, price decimal(10,4)")
    got = rows(quality.drift(df), "bucket", "rows", "null_rate", "mean_value", "prev_mean_value", "mean_change")
    assert got[0][1:] == (1, 0.0, Decimal("10.0000"), None, None)
    assert got[1][1:] == (2, 0.5, Decimal("14.0000"), Decimal("10.0000"), Decimal("4.0000"))


def test_union_tier_by_name_with_drift(spark):
    a = spark.createDataFrame([(1, "x")], "id int, s string")
    b = spark.createDataFrame([("y", 2, "extra")], "s string, id int, venue string")
    out = union_tier([a, b])
    assert out.columns == ["id", "s", "venue"]
    assert rows(out) == [(1, "x", None), (2, "y", "extra")]


def test_stamp_tag_template(spark):
    df = spark.createDataFrame([(Decimal("2.5000"), 4)], "price decimal(10,4), quantity bigint")
    g = apply_sql_template(spark, df, "SELECT *, price * quantity AS trade_value FROM __TABLE__", "silver_t")
    assert dict(g.dtypes)["trade_value"] == "decimal(31,4)"
    assert g.first().trade_value == Decimal("10.0000")
    t = tag(stamp(df, "ts", "TIMESTAMP '2024-01-01 00:00:00'"), a="x", b=True)
    assert t.columns == ["price", "quantity", "ts", "a", "b"]


def test_file_metrics_replaces_ingestion_timestamp_in_place(spark):
    b = spark.createDataFrame([("t1", "2020-01-01", "f")], "trade_id string, ingestion_timestamp string, source_file string")
    fm = monitoring.file_metrics([b, b], "TIMESTAMP '2024-01-01 00:00:00'")
    assert fm.columns == ["trade_id", "ingestion_timestamp", "source_file", "ingestion_method", "cdc_enabled",
                          "streaming_enabled"]
    assert fm.count() == 2
    cs = monitoring.changes_summary([b], None)
    assert cs.columns[-3:] == ["change_timestamp", "change_source", "ingestion_method"]
    qm = monitoring.quality_monitoring([b], None)
    assert qm.first().change_detected is True and qm.first().quality_layer == "silver"


def _apply(old, feed):
    """Apply a change feed to a multiset (Python reference)."""
    from collections import Counter
    c = Counter(old)
    for *row, kind, _v in feed:
        row = tuple(row)
        c[row] += 1 if kind == "insert" else -1
        assert c[row] >= 0
    return sorted(c.elements())


def test_change_feed_multiset_with_duplicates_and_chunks(spark):
    old_rows = [("a", 1)] * 5 + [("b", 2)] * 2 + [("c", None)]
    new_rows = [("a", 1)] * 2 + [("b", 2)] * 4 + [("d", 4)] * 7 + [("c", None)]
    old = spark.createDataFrame(old_rows, "k string, v int")
    new = spark.createDataFrame(new_rows, "k string, v int")
    feed = changefeed.change_feed(old, new, to_version=2, chunk_rows=3)
    got = [tuple(r) for r in feed.collect()]
    assert sum(1 for g in got if g[2] == "delete") == 3
    assert sum(1 for g in got if g[2] == "insert") == 2 + 7
    assert _apply(old_rows, got) == sorted(new_rows, key=lambda r: (r[0], r[1] is None, r[1]))


def test_append_changes_prunes_batches(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 2)], "x int, batch_id int")
    got = rows(changefeed.append_changes(df, 0, 2))
    assert got == [(2, "insert", 1), (3, "insert", 2)]


def test_rollups(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1, 10)
    df = spark.createDataFrame([("NYSE", "S1", "f1", t, 10, Decimal("100.0000")),
                                ("NYSE", "S1", "f1", t + dt.timedelta(hours=2), 30, Decimal("330.0000")),
                                ("LSE", "S2", "f2", t, 5, Decimal("5.0000"))],
                               "exchange string, symbol string, source_file string, timestamp timestamp, "
                               "quantity bigint, trade_value decimal(31,4)")
    fr = {r.source_file: (r.rows, r.total_quantity) for r in rollups.file_rollup(df).collect()}
    assert fr == {"f1": (2, 40), "f2": (1, 5)}
    tm = {r.symbol: (r.trade_count, r.total_quantity, r.vwap) for r in rollups.trade_metrics(df).collect()}
    assert tm["S1"] == (2, 40, 10.75)
    ds = {r.exchange: r.distinct_symbols for r in rollups.distinct_symbols(df).collect()}
    assert ds == {"NYSE": 1, "LSE": 1}
    ds2 = {r.exchange: r.distinct_symbols for r in rollups.distinct_symbols(df, approx=True).collect()}
    assert ds2 == ds
    tw = rollups.time_windows(df, "timestamp", "1 hour", by=["exchange"])
    assert tw.count() == 3


def test_schema_changes(spark):
    b = spark.createDataFrame([('{"venue":"A"}', "f1", 0), ('{"venue":"B","x":"1"}', "f2", 1), (None, "f3", 0)],
                              "_rescued_data string, source_file string, batch_id int")
    got = {r.column_name: (r.rows, r.first_file) for r in rollups.schema_changes(b).collect()}
    assert got == {"venue": (2, "f1"), "x": (1, "f2")}
