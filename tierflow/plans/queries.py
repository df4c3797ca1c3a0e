"""Query plans registered in ``__spark_entry__``.

Every plan reads the driver's tables in full (``lineitem`` through the trade
adapter, ``events`` directly).  Timestamps that are ``current_timestamp()``
in production are pinned to one literal here so a SQL engine can reproduce
the rows.  Decimal products are cast to decimal(38,4) on output because
engines pick different (equally exact) precisions for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.config import (MARKET_HOURS_RULE, PRICE_BUCKET_SQL, PRICE_RANGE_RULE, TRADE_VALUE_SQL,
                             VALID_TRADE_RULE)
from tierflow.functions.schema import TRADE_TYPES_DECLARED, conform
from tierflow.operators import changefeed, monitoring, quality, rollups
from tierflow.operators.transforms import apply_sql_template, stamp
from tierflow.sources.adapter import AS_OF_SPARK, bronze_trades, read_table, trades

EXCHANGES = ("NYSE", "NASDAQ", "LSE")
# The driver's Parquet stores timestamps without zone; keep them that way.
ADAPTER_TYPES = {**TRADE_TYPES_DECLARED, "timestamp": "timestamp_ntz", "ingestion_timestamp": "timestamp_ntz"}
RULES = {"valid_trade": VALID_TRADE_RULE, "price_range": PRICE_RANGE_RULE, "market_hours": MARKET_HOURS_RULE}
ALERT_THRESHOLD = 0.99
DEC = "decimal(38,4)"


def silver(spark: SparkSession, sf_dir: str, *exchanges: str) -> DataFrame:
    """bronze (text) -> typed -> primary filter -> stamp -> fail-on-violation.  The
    adapter holds all exchanges in one table, so several of them are one scan."""
    among = "exchange IN ({})".format(", ".join(f"'{ex}'" for ex in exchanges))
    b = bronze_trades(spark, sf_dir, clean=True).filter(among)
    df = stamp(conform(b, ADAPTER_TYPES).filter(among), "processing_timestamp", AS_OF_SPARK)
    return quality.expect_all_or_fail(df, {"valid_trade": VALID_TRADE_RULE}, label=f"silver_{'_'.join(exchanges).lower()}")


def gold(spark: SparkSession, sf_dir: str, *exchanges: str, template: str = TRADE_VALUE_SQL) -> DataFrame:
    s = silver(spark, sf_dir, *exchanges)
    g = apply_sql_template(spark, s, template, f"silver_{'_'.join(exchanges).lower()}_trades")
    return g.withColumn("trade_value", F.col("trade_value").cast(DEC))


def _bronze(spark, sf_dir):
    return bronze_trades(spark, sf_dir).filter(F.col("exchange").isin(*EXCHANGES))


def q_silver(exchange):
    return lambda spark, sf_dir: silver(spark, sf_dir, exchange)


def q_gold(exchange):
    return lambda spark, sf_dir: gold(spark, sf_dir, exchange)


def q_gold_price_bucket(spark, sf_dir):
    return gold(spark, sf_dir, *EXCHANGES, template=PRICE_BUCKET_SQL)


def q_changes_summary(spark, sf_dir):
    return monitoring.changes_summary([_bronze(spark, sf_dir)], AS_OF_SPARK)


def q_quality_monitoring(spark, sf_dir):
    return monitoring.quality_monitoring([silver(spark, sf_dir, *EXCHANGES)], AS_OF_SPARK)


def q_file_metrics(spark, sf_dir):
    return monitoring.file_metrics([_bronze(spark, sf_dir)], AS_OF_SPARK)


def q_quality_score(spark, sf_dir):
    return quality.quality_score(trades(spark, sf_dir), "price > 0")


def q_rule_compliance(spark, sf_dir):
    return quality.rule_compliance(trades(spark, sf_dir), RULES)


def q_completeness(spark, sf_dir):
    return quality.completeness(trades(spark, sf_dir))


def q_alerts(spark, sf_dir):
    return quality.alerts(quality.rule_compliance(trades(spark, sf_dir), RULES), ALERT_THRESHOLD)


def q_drift(spark, sf_dir):
    return quality.drift(trades(spark, sf_dir))


def q_market_hours(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return ev.filter(F.expr("hour(ts) >= 9 AND hour(ts) < 16")).select("event_id", "ts", "user_id", "event_type", "value")


def q_price_range(spark, sf_dir):
    return trades(spark, sf_dir).filter(F.expr(PRICE_RANGE_RULE))


def q_distinct_symbols(spark, sf_dir):
    return rollups.distinct_symbols(trades(spark, sf_dir))


def q_file_rollup(spark, sf_dir):
    return rollups.file_rollup(trades(spark, sf_dir), as_of=AS_OF_SPARK)


def change_feed_trades(spark, sf_dir):
    """Version 1 = trades as landed (dirty), version 2 = trades after the
    price corrections; the feed holds the corrected rows as delete+insert."""
    return changefeed.change_feed(trades(spark, sf_dir), trades(spark, sf_dir, clean=True), to_version=2)


def q_change_rollup(spark, sf_dir):
    return rollups.change_rollup(changefeed.net_changes(trades(spark, sf_dir), trades(spark, sf_dir, clean=True)), 2)


def q_trade_metrics(spark, sf_dir):
    g = gold(spark, sf_dir, *EXCHANGES)
    return rollups.trade_metrics(g).withColumn("total_value", F.col("total_value").cast(DEC))


def q_time_windows(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    out = rollups.time_windows(ev, "ts", "1 hour", by=["event_type"], value="value")
    return out.withColumn("sum_value", F.col("sum_value").cast("decimal(38,2)"))


BATCH_QUERIES = {
    "silver_nyse": q_silver("NYSE"),
    "silver_nasdaq": q_silver("NASDAQ"),
    "silver_lse": q_silver("LSE"),
    "gold_nyse": q_gold("NYSE"),
    "gold_nasdaq": q_gold("NASDAQ"),
    "gold_lse": q_gold("LSE"),
    "gold_price_bucket": q_gold_price_bucket,
    "changes_summary": q_changes_summary,
    "quality_monitoring": q_quality_monitoring,
    "file_metrics": q_file_metrics,
    "quality_score": q_quality_score,
    "rule_compliance": q_rule_compliance,
    "completeness": q_completeness,
    "alerts": q_alerts,
    "drift": q_drift,
    "market_hours": q_market_hours,
    "price_range": q_price_range,
    "distinct_symbols": q_distinct_symbols,
    "file_rollup": q_file_rollup,
    "change_feed": change_feed_trades,
    "change_rollup": q_change_rollup,
    "trade_metrics": q_trade_metrics,
    "time_windows": q_time_windows,
}
