import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tierflow.config import MARKET_CENTERS, TRADE_EXCHANGES, TRADE_TYPES
from tierflow.sources.generator import generate_landing, generate_trades

START = dt.datetime(2024, 1, 1, 9)
END = dt.datetime(2024, 1, 1, 10)


def _rows(df):
    return sorted(tuple(r) for r in df.drop("ingestion_timestamp").collect())


def test_seeded_and_partition_independent(spark):
    a = generate_trades(spark, "NYSE", 500, START, END, seed=7, partitions=1)
    b = generate_trades(spark, "NYSE", 500, START, END, seed=7, partitions=7)
    assert _rows(a) == _rows(b)
    c = generate_trades(spark, "NYSE", 500, START, END, seed=8, partitions=7)
    assert _rows(a) != _rows(c)


def test_value_ranges(spark):
    df = generate_trades(spark, "LSE", 2000, START, END, seed=1)
    assert df.columns == ["id", "trade_id", "symbol", "exchange", "price", "quantity", "timestamp", "trade_type",
                          "market_center", "ingestion_timestamp", "file_path"]
    assert dict(df.dtypes)["price"] == "decimal(10,4)"
    r = df.agg(F.min("price"), F.max("price"), F.min("quantity"), F.max("quantity"), F.min("timestamp"),
               F.max("timestamp"), F.count_distinct("id")).first()
    assert Decimal("10") <= r[0] and r[1] <= Decimal("1010")
    assert 100 <= r[2] and r[3] <= 10099
    assert START <= r[4] and r[5] < END
    assert r[6] == 2000
    assert {x.symbol for x in df.select("symbol").distinct().collect()} <= set(TRADE_EXCHANGES["LSE"])
    assert {x.trade_type for x in df.select("trade_type").distinct().collect()} == set(TRADE_TYPES)
    assert {x.market_center for x in df.select("market_center").distinct().collect()} == set(MARKET_CENTERS)
    assert df.filter(F.col("price") * 100 != F.floor(F.col("price") * 100)).count() == 0
    assert df.filter(~F.col("file_path").startswith("/mnt/data/lse/trades_")).count() == 0


def test_generate_landing_then_ingest(spark, tmp):
    from tierflow.config import default_sources
    from tierflow.plans.pipeline import run_update
    from tierflow.sinks.tables import TableStore
    res = generate_landing(spark, f"{tmp}/landing", rows_per_exchange=300, data_type="both", seed=3,
                           now=dt.datetime(2024, 1, 1, 12))
    got = sorted((r.exchange, r.kind, r.rows, r.error) for r in res.collect())
    assert got == sorted([(e, k, 300 if k == "initial" else 500, None)
                          for e in TRADE_EXCHANGES for k in ("initial", "incremental")])
    bad = generate_landing(spark, f"{tmp}/landing2", exchange_filter="TSE", data_type="initial")
    assert bad.first().error is not None  # isolated failure, reported
    store = TableStore(spark, f"{tmp}/tables")
    run_update(spark, default_sources(f"{tmp}/landing", f"{tmp}/state"), store, as_of="TIMESTAMP '2024-01-01 00:00:00'")
    counts = {r.exchange: r.n for r in store.read("quality_changes_monitoring").groupBy("exchange")
              .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {"NYSE": 800, "NASDAQ": 800, "LSE": 800}
    g = store.read("gold_nyse_trades")
    assert dict(g.dtypes)["trade_value"] == "decimal(31,4)"
    assert dict(g.dtypes)["timestamp"] == "timestamp"
    assert g.filter(F.col("trade_value") != F.col("price") * F.col("quantity")).count() == 0


def test_price_ranges_option(spark):
    ranges = {"AAPL": (150.0, 200.0), "V": (0.5, 1.5)}
    df = generate_trades(spark, "NYSE", 3000, START, END, seed=2, price_ranges=ranges)
    for r in df.groupBy("symbol").agg(F.min("price").alias("lo"), F.max("price").alias("hi")).collect():
        lo, hi = ranges.get(r.symbol, (10.0, 1010.0))
        assert Decimal(str(lo)) <= r.lo and r.hi <= Decimal(str(hi)), r
    plain = generate_trades(spark, "NYSE", 3000, START, END, seed=2)
    assert _rows(plain.select("id", "symbol")) == _rows(df.select("id", "symbol"))
