"""The three cross-source monitoring tables (row level, full recompute)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tierflow.operators.transforms import stamp, tag, union_tier

# Fixed values that must equal the reference's.
CHANGE_SOURCE = "autoloader_autocdc"
INGESTION_METHOD_STREAMING = "streaming"
QUALITY_LAYER = "silver"
PROCESSING_METHOD = "streaming"
INGESTION_METHOD_FILES = "autoloader"


def changes_summary(bronze_tables: Sequence[DataFrame], as_of=None) -> DataFrame:
    """trade_changes_summary: all bronze rows + change metadata."""
    df = stamp(union_tier(bronze_tables), "change_timestamp", as_of)
    return tag(df, change_source=CHANGE_SOURCE, ingestion_method=INGESTION_METHOD_STREAMING)


def quality_monitoring(silver_tables: Sequence[DataFrame], as_of=None) -> DataFrame:
    """quality_changes_monitoring: all silver rows + quality metadata."""
    df = stamp(union_tier(silver_tables), "quality_check_timestamp", as_of)
    return tag(df, quality_layer=QUALITY_LAYER, change_detected=True, processing_method=PROCESSING_METHOD)


def file_metrics(bronze_tables: Sequence[DataFrame], as_of=None) -> DataFrame:
    """file_ingestion_metrics: all bronze rows; ``ingestion_timestamp`` is
    replaced in place by the processing time (so 3 columns are added, not 4)."""
    df = stamp(union_tier(bronze_tables), "ingestion_timestamp", as_of)
    return tag(df, ingestion_method=INGESTION_METHOD_FILES, cdc_enabled=True, streaming_enabled=True)
