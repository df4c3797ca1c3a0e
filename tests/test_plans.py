"""Guard the physical properties the design relies on."""

import contextlib
import io
import os

import pytest

import __spark_entry__ as E
from tests.conftest import SF0001

pytestmark = pytest.mark.skipif(not os.path.isdir(SF0001), reason="driver test data not present")


def plan(df) -> str:
    """The static physical plan (AQE off, so codegen stages are shown)."""
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        return buf.getvalue()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_silver_is_one_codegen_stage_without_key_shuffle(spark):
    p = plan(E.queries()["silver_nyse"](spark, SF0001))
    assert "* Filter" in p  # the fail-on-violation check stays inside whole-stage codegen
    assert "hashpartitioning" not in p and "rangepartitioning" not in p
    assert "PythonUDF" not in p and "BatchEvalPython" not in p


def test_rule_compliance_prunes_columns_and_aggregates_partially(spark):
    p = plan(E.queries()["rule_compliance"](spark, SF0001))
    read = [line for line in p.splitlines() if line.startswith("ReadSchema")]
    assert read and all("l_tax" not in r and "l_returnflag" not in r for r in read)
    assert p.count("HashAggregate (") == 2  # partial (map side) + final


def test_change_feed_single_aggregate_shuffle(spark):
    p = plan(E.queries()["change_feed"](spark, SF0001))
    assert "ReplicateRows" not in p  # no exceptAll: hot duplicate groups are expanded in chunks
    assert p.count("HashAggregate (") == 2  # one partial + final pair: one shuffle by row


def test_no_broadcast_anywhere(spark):
    for name in ["gold_nyse", "quality_monitoring", "drift", "trade_metrics", "file_rollup"]:
        p = plan(E.queries()[name](spark, SF0001))
        assert "Broadcast" not in p, name
