"""tierflow: a configuration-driven, multi-tier (bronze -> silver -> gold) trade
ingestion and data-quality engine written natively on Spark DataFrames,
Spark SQL and Structured Streaming."""

from tierflow.config import SourceConfig, default_sources, TRADE_EXCHANGES
from tierflow.session import build_session, work_dir

__all__ = ["SourceConfig", "default_sources", "TRADE_EXCHANGES", "build_session", "work_dir"]
