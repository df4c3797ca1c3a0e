"""ANSI SQL (DuckDB dialect) equivalents of the registered plans, over the
driver's tables.  Used only to check results; never executed by the library."""

from __future__ import annotations

from tierflow.config import MARKET_HOURS_RULE, PRICE_RANGE_RULE, VALID_TRADE_RULE
from tierflow.sources.adapter import AS_OF_SQL, bronze_sql, trades_sql

EXCHANGES = ("NYSE", "NASDAQ", "LSE")
TRADE_COLS = "trade_id, symbol, exchange, price, quantity, timestamp, trade_type, market_center"
RULES = {"valid_trade": VALID_TRADE_RULE, "price_range": PRICE_RANGE_RULE, "market_hours": MARKET_HOURS_RULE}


def with_trades(body: str, clean: bool = False, extra: str = "") -> str:
    return f"WITH trades AS ({trades_sql(clean)}){extra}\n{body}"


def _silver_body(exchange: str, table: str = "trades") -> str:
    return (f"SELECT {TRADE_COLS}, timestamp AS ingestion_timestamp, CAST(NULL AS VARCHAR) AS _rescued_data, "
            f"source_file, {AS_OF_SQL} AS processing_timestamp FROM {table} "
            f"WHERE exchange = '{exchange}' AND price > 0 AND quantity > 0")


def silver(exchange: str) -> str:
    return with_trades(_silver_body(exchange), clean=True)


def gold(exchange: str) -> str:
    body = ("SELECT *, CAST(price * quantity AS DECIMAL(38,4)) AS trade_value "
            f"FROM ({_silver_body(exchange)}) s")
    return with_trades(body, clean=True)


def gold_price_bucket() -> str:
    body = " UNION ALL ".join(
        "(SELECT *, CAST(price * quantity AS DECIMAL(38,4)) AS trade_value, CASE WHEN price > 100 THEN 'HIGH' "
        f"WHEN price > 50 THEN 'MEDIUM' ELSE 'LOW' END AS price_volatility FROM ({_silver_body(ex)}) s)" for ex in EXCHANGES)
    return with_trades(body, clean=True)


def _bronze_union() -> str:
    return ", bronze AS (" + " UNION ALL ".join(f"({bronze_sql(ex)})" for ex in EXCHANGES) + ")"


def changes_summary() -> str:
    return with_trades(f"SELECT *, {AS_OF_SQL} AS change_timestamp, 'autoloader_autocdc' AS change_source, "
                       "'streaming' AS ingestion_method FROM bronze", extra=_bronze_union())


def file_metrics() -> str:
    return with_trades(f"SELECT {TRADE_COLS}, {AS_OF_SQL} AS ingestion_timestamp, _rescued_data, source_file, "
                       "'autoloader' AS ingestion_method, true AS cdc_enabled, true AS streaming_enabled FROM bronze",
                       extra=_bronze_union())


def quality_monitoring() -> str:
    silver_union = " UNION ALL ".join(f"({_silver_body(ex)})" for ex in EXCHANGES)
    return with_trades(f"SELECT *, {AS_OF_SQL} AS quality_check_timestamp, 'silver' AS quality_layer, "
                       f"true AS change_detected, 'streaming' AS processing_method FROM ({silver_union}) s", clean=True)


def quality_score() -> str:
    return with_trades("SELECT count(*) AS total_rows, count(*) FILTER (WHERE price > 0) AS valid_rows, "
                       "CAST(count(*) FILTER (WHERE price > 0) AS DOUBLE) / NULLIF(count(*), 0) AS quality_score "
                       "FROM trades")


def _compliance_sql() -> str:
    parts = []
    for name, rule in RULES.items():
        ok = f"coalesce(({rule}), false)"
        parts.append(f"SELECT exchange, '{name}' AS rule, count(*) AS rows, count(*) FILTER (WHERE {ok}) AS passed, "
                     f"count(*) - count(*) FILTER (WHERE {ok}) AS failed, "
                     f"CAST(count(*) FILTER (WHERE {ok}) AS DOUBLE) / NULLIF(count(*), 0) AS pass_rate "
                     f"FROM trades GROUP BY exchange")
    return " UNION ALL ".join(parts)


def rule_compliance() -> str:
    return with_trades(_compliance_sql())


def alerts(threshold: float = 0.99) -> str:
    return with_trades(f"SELECT exchange, rule, rows, failed, pass_rate, CAST({threshold} AS DOUBLE) AS threshold "
                       f"FROM ({_compliance_sql()}) c WHERE pass_rate < {threshold}")


def completeness() -> str:
    cols = ["trade_id", "symbol", "price", "quantity", "timestamp", "trade_type", "market_center", "source_file"]
    parts = [f"SELECT exchange, '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS nulls, "
             f"CAST(count(*) - count({c}) AS DOUBLE) / NULLIF(count(*), 0) AS null_rate FROM trades GROUP BY exchange"
             for c in cols]
    return with_trades(" UNION ALL ".join(parts))


def drift() -> str:
    return with_trades(
        "SELECT exchange, bucket, rows, null_rate, mean_value, stddev_value, "
        "lag(mean_value) OVER (PARTITION BY exchange ORDER BY bucket) AS prev_mean_value, "
        "CAST(mean_value - lag(mean_value) OVER (PARTITION BY exchange ORDER BY bucket) AS DECIMAL(20,4)) AS mean_change "
        "FROM (SELECT exchange, bucket, rows, CAST(rows - nn AS DOUBLE) / NULLIF(rows, 0) AS null_rate, "
        "CASE WHEN nn > 0 THEN CAST(CAST((num - (((num % den) + den) % den)) // den AS DECIMAL(38,0)) / 10000 AS DECIMAL(20,4)) END AS mean_value, "
        "CAST(round(sd, 4) AS DECIMAL(20,4)) AS stddev_value "
        "FROM (SELECT exchange, date_trunc('month', timestamp) AS bucket, count(*) AS rows, count(price) AS nn, "
        "CAST(sum(price) * 10000 AS HUGEINT) * 2 + count(price) AS num, 2 * CAST(count(price) AS HUGEINT) AS den, "
        "stddev_samp(CAST(price AS DOUBLE)) AS sd "
        "FROM trades GROUP BY exchange, date_trunc('month', timestamp)) a) p")


def market_hours() -> str:
    return "SELECT event_id, ts, user_id, event_type, value FROM events WHERE hour(ts) >= 9 AND hour(ts) < 16"


def price_range() -> str:
    return with_trades(f"SELECT * FROM trades WHERE {PRICE_RANGE_RULE}")


def distinct_symbols() -> str:
    return with_trades("SELECT exchange, count(DISTINCT symbol) AS distinct_symbols FROM trades GROUP BY exchange")


def file_rollup() -> str:
    return with_trades("SELECT exchange, source_file, count(*) AS rows, min(timestamp) AS first_event_ts, "
                       "max(timestamp) AS last_event_ts, CAST(sum(quantity) AS BIGINT) AS total_quantity, "
                       f"{AS_OF_SQL} AS rollup_timestamp FROM trades GROUP BY exchange, source_file")


def _change_feed_body() -> str:
    return ("SELECT *, 'insert' AS _change_type, 2 AS _commit_version FROM "
            "(SELECT * FROM clean_trades EXCEPT ALL SELECT * FROM trades) i "
            "UNION ALL SELECT *, 'delete' AS _change_type, 2 AS _commit_version FROM "
            "(SELECT * FROM trades EXCEPT ALL SELECT * FROM clean_trades) d")


def change_feed() -> str:
    return with_trades(_change_feed_body(), extra=f", clean_trades AS ({trades_sql(True)})")


def change_rollup() -> str:
    return with_trades(f"SELECT exchange, _change_type, _commit_version, count(*) AS rows FROM ({_change_feed_body()}) c "
                       "GROUP BY exchange, _change_type, _commit_version", extra=f", clean_trades AS ({trades_sql(True)})")


def trade_metrics() -> str:
    return with_trades(
        "SELECT exchange, symbol, count(*) AS trade_count, CAST(sum(quantity) AS BIGINT) AS total_quantity, "
        "CAST(sum(CAST(price * quantity AS DECIMAL(38,4))) AS DECIMAL(38,4)) AS total_value, "
        "round(CAST(sum(CAST(price * quantity AS DECIMAL(38,4))) AS DOUBLE) / CAST(NULLIF(sum(quantity), 0) AS DOUBLE), 4) AS vwap "
        "FROM trades WHERE price > 0 AND quantity > 0 GROUP BY exchange, symbol", clean=True)


def time_windows() -> str:
    return ("SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, "
            "event_type, count(*) AS events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS sum_value "
            "FROM events GROUP BY date_trunc('hour', ts), event_type")


BATCH_ORACLES = {
    "silver_nyse": silver("NYSE"),
    "silver_nasdaq": silver("NASDAQ"),
    "silver_lse": silver("LSE"),
    "gold_nyse": gold("NYSE"),
    "gold_nasdaq": gold("NASDAQ"),
    "gold_lse": gold("LSE"),
    "gold_price_bucket": gold_price_bucket(),
    "changes_summary": changes_summary(),
    "quality_monitoring": quality_monitoring(),
    "file_metrics": file_metrics(),
    "quality_score": quality_score(),
    "rule_compliance": rule_compliance(),
    "completeness": completeness(),
    "alerts": alerts(),
    "drift": drift(),
    "market_hours": market_hours(),
    "price_range": price_range(),
    "distinct_symbols": distinct_symbols(),
    "file_rollup": file_rollup(),
    "change_feed": change_feed(),
    "change_rollup": change_rollup(),
    "trade_metrics": trade_metrics(),
    "time_windows": time_windows(),
}
