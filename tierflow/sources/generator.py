"""Synthetic trade source and the landing-file generation job.

Rows come from ``spark.range`` (distributed; nothing passes through the
driver).  Random values are derived from a hash of (seed, row id, column), so
a run is reproducible and independent of the partition count, and a task
recomputed after an executor loss regenerates exactly the same rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.config import MARKET_CENTERS, TRADE_EXCHANGES, TRADE_TYPES
from tierflow.functions.exprs import pick, unit_hash

# Fixed generation sizes of the reference job.
DEFAULT_ROWS = 1000
INCREMENTAL_ROWS = 500
PARTITIONS = 4
ROWS_PER_PARTITION = 2_000_000


def generate_trades(spark: SparkSession, exchange: str, rows: int = DEFAULT_ROWS,
                    start: dt.datetime | None = None, end: dt.datetime | None = None,
                    seed: int = 0, partitions: int | None = None,
                    symbols: list[str] | None = None,
                    price_ranges: Mapping[str, tuple[float, float]] | None = None) -> DataFrame:
    """Trades for one exchange over [start, end).

    Prices are uniform in 10..1010 (rounded to cents); ``price_ranges`` gives
    symbols another range (the others keep the uniform one).  Partitions default to the reference's 4, growing
    with ``rows`` so no task generates more than ~2M rows; values do not
    depend on the partitioning."""
    if partitions is None:
        partitions = max(PARTITIONS, -(-rows // ROWS_PER_PARTITION))
    end = end or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    start = start or end - dt.timedelta(hours=1)
    span = max(1, int((end - start).total_seconds()))
    syms = symbols or TRADE_EXCHANGES[exchange]

    def u(name):
        return unit_hash(seed, F.col("id"), F.lit(exchange), salt=name)

    ts = F.lit(start).cast("timestamp") + F.make_dt_interval(secs=F.floor(u("timestamp") * span).cast("int"))
    uniform = F.round(u("price") * 1000 + 10, 2)
    price = uniform
    if price_ranges:
        ranged = [(sym, price_ranges[sym]) for sym in syms if sym in price_ranges]
        if ranged:
            sym_col = pick(syms, u("symbol"))
            price = None
            for sym, (lo, hi) in ranged:
                branch = F.round(u("price") * (hi - lo) + lo, 2)
                price = F.when(sym_col == sym, branch) if price is None else price.when(sym_col == sym, branch)
            price = price.otherwise(uniform)
    df = spark.range(0, rows, 1, partitions)
    return df.select(
        "id",
        F.concat(F.lit("TRD_"), F.col("id").cast("string"), F.lit("_"),
                 (u("trade_id") * 1_000_000).cast("int").cast("string")).alias("trade_id"),
        pick(syms, u("symbol")).alias("symbol"),
        F.lit(exchange).alias("exchange"),
        price.cast("decimal(10,4)").alias("price"),
        (u("quantity") * 10000 + 100).cast("bigint").alias("quantity"),
        ts.alias("timestamp"),
        pick(TRADE_TYPES, u("trade_type")).alias("trade_type"),
        pick(MARKET_CENTERS, u("market_center")).alias("market_center"),
        F.current_timestamp().alias("ingestion_timestamp"),
    ).withColumn("file_path", F.concat(F.lit("/mnt/data/"), F.lower("exchange"), F.lit("/trades_"),
                                       F.date_format("timestamp", "yyyyMMdd_HHmm"), F.lit(".parquet")))


def write_landing(df: DataFrame, landing_root: str, exchange: str, kind: str = "trades",
                  stamp: str | None = None, single_file: bool = False) -> str:
    """Distributed CSV export with a header into ``<root>/<exchange>/bronze/``.

    Spark writes a folder of part files named ``<kind>_<exchange>_<stamp>``;
    the ingest stream lists files recursively.  ``single_file`` funnels the
    rows through one task and is meant for small hand-offs only."""
    stamp = stamp or dt.datetime.now().strftime("%Y%m%d_%H%M%S")
    low = exchange.lower()
    out = f"{landing_root.rstrip('/')}/{low}/bronze/{kind}_{low}_{stamp}"
    text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    if single_file:
        text = text.coalesce(1)
    text.write.mode("errorifexists").option("header", True).csv(out)
    return out


def generate_landing(spark: SparkSession, landing_root: str, rows_per_exchange: int = DEFAULT_ROWS,
                     exchange_filter: str = "all", data_type: str = "both", seed: int = 0,
                     now: dt.datetime | None = None) -> DataFrame:
    """The generation job: per exchange an ``initial`` and/or ``incremental``
    batch; one exchange failing does not stop the others.  Returns one row per
    attempted batch: (exchange, kind, path, rows, error)."""
    if data_type not in ("initial", "incremental", "both"):
        raise ValueError("data_type must be initial, incremental or both")
    exchanges = list(TRADE_EXCHANGES) if exchange_filter == "all" else [exchange_filter]
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    start = now - dt.timedelta(hours=1)
    seed = seed * 1000 + int(now.replace(tzinfo=dt.timezone.utc).timestamp())  # another run, other trades
    results = []
    for i, ex in enumerate(exchanges):
        kinds = [k for k in ("initial", "incremental") if data_type in (k, "both")]
        for j, kind in enumerate(kinds):
            rows = rows_per_exchange if kind == "initial" else INCREMENTAL_ROWS
            prefix = "trades" if kind == "initial" else "incremental"
            try:
                df = generate_trades(spark, ex, rows, start, now, seed=seed * 1000 + i * 10 + j)
                path = write_landing(df, landing_root, ex, prefix, now.strftime("%Y%m%d_%H%M%S"))
                results.append((ex, kind, path, rows, None))
            except Exception as e:  # noqa: BLE001 - per-exchange isolation is the contract
                results.append((ex, kind, None, 0, f"{type(e).__name__}: {e}"))
    return spark.createDataFrame(results, "exchange string, kind string, path string, rows long, error string")
