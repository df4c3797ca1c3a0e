"""Trades shaped from the driver's ``lineitem`` table.

The same definition exists as DataFrame code (used by the Spark queries) and
as ANSI SQL (used by the DuckDB oracle); FIXTURES.md records that both agree.
About 1 in 97 orders get a negative price and 1 in 89 a NULL price so the
quality operators have something to find; ``clean=True`` drops those two
branches for fail-on-violation tiers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TRADE_COLUMNS = ["trade_id", "symbol", "exchange", "price", "quantity", "timestamp",
                 "trade_type", "market_center", "source_file"]

LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate"]
EXCHANGE_OF_LINE = "CASE l_linenumber % 3 WHEN 0 THEN 'NYSE' WHEN 1 THEN 'NASDAQ' ELSE 'LSE' END"

# Pinned processing time used wherever a query must be comparable with SQL.
AS_OF_TEXT = "2024-01-01 00:00:00"
AS_OF_SPARK = f"TIMESTAMP_NTZ '{AS_OF_TEXT}'"
AS_OF_SQL = f"TIMESTAMP '{AS_OF_TEXT}'"


def _price_expr(clean: bool, string_type: str) -> str:
    base = "cast(l_extendedprice AS decimal(10,4))"
    if clean:
        return base
    return ("CASE WHEN l_orderkey % 97 = 0 THEN cast(-l_extendedprice AS decimal(10,4)) "
            f"WHEN l_orderkey % 89 = 0 THEN NULL ELSE {base} END")


def _trade_exprs(clean: bool, s: str = "string") -> list[str]:
    """The adapter's column expressions; ``s`` is the text type name of the
    SQL dialect (Spark ``string``, ANSI ``varchar``)."""
    return [
        f"concat('TRD_', cast(l_orderkey AS {s}), '_', cast(l_linenumber AS {s})) AS trade_id",
        f"concat('SYM_', cast(l_partkey % 10 AS {s})) AS symbol",
        f"{EXCHANGE_OF_LINE} AS exchange",
        f"{_price_expr(clean, s)} AS price",
        "cast(l_quantity AS bigint) AS quantity",
        "l_shipdate AS timestamp",
        "CASE l_suppkey % 4 WHEN 0 THEN 'BUY' WHEN 1 THEN 'SELL' WHEN 2 THEN 'SHORT' ELSE 'COVER' END AS trade_type",
        "CASE l_partkey % 6 WHEN 0 THEN 'MAIN' WHEN 1 THEN 'ARCA' WHEN 2 THEN 'EDGX' "
        "WHEN 3 THEN 'EDGA' WHEN 4 THEN 'BATS' ELSE 'IEX' END AS market_center",
        f"concat('part_', cast(l_orderkey % 8 AS {s}), '.csv') AS source_file",
    ]


def spread(df: DataFrame) -> DataFrame:
    """Give a scan at least one task per core.  A Parquet file with a single
    row group is read by one task however many splits it gets; a round-robin
    spread lets the (CPU-bound) projections downstream run on every core.  A
    large input already has more splits than cores and is left as it is."""
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        parts = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD view (e.g. a Spark Connect session): leave as is
        return df
    return df.repartition(cores) if parts < cores else df


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def trades(spark: SparkSession, sf_dir: str, clean: bool = False) -> DataFrame:
    """Typed trades: one row per lineitem row."""
    return as_trades(read_table(spark, sf_dir, "lineitem"), clean)


def as_trades(lines: DataFrame, clean: bool = False) -> DataFrame:
    return lines.selectExpr(*_trade_exprs(clean))


def bronze_trades(spark: SparkSession, sf_dir: str, exchange: str | None = None, clean: bool = False) -> DataFrame:
    """The landing (bronze) form: every value as text, plus the rescue column.

    One landing directory per exchange, as the generator lays files out."""
    t = trades(spark, sf_dir, clean)
    if exchange is not None:
        t = t.filter(f"exchange = '{exchange}'")
    return t.selectExpr(*[f"cast(`{c}` AS string) AS `{c}`" for c in TRADE_COLUMNS if c != "source_file"],
                        "cast(timestamp AS string) AS ingestion_timestamp",
                        "cast(NULL AS string) AS _rescued_data", "source_file")


def trades_sql(clean: bool = False) -> str:
    return "SELECT " + ",\n  ".join(_trade_exprs(clean, "varchar")) + "\nFROM lineitem"


def bronze_sql(exchange: str, clean: bool = False, trades_cte: str = "trades") -> str:
    cols = ", ".join(f"cast({c} AS varchar) AS {c}" for c in TRADE_COLUMNS if c != "source_file")
    return (f"SELECT {cols}, cast(timestamp AS varchar) AS ingestion_timestamp, "
            f"cast(NULL AS varchar) AS _rescued_data, source_file FROM {trades_cte} WHERE exchange = '{exchange}'")
