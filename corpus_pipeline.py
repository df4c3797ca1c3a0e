"""Corpus pipeline: toxic documents out, one document of each group of near
copies, benchmark leaks out, sources mixed to target weights, shards assigned.

Every stage is a function ``(spark, docs, sf_dir) -> DataFrame`` over all rows
that its predecessor kept.  All but the last return the columns of documents;
the last adds ``slot`` and ``shard``.  A document that the mix takes twice is two
equal rows, and both go to one shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm import decontamination, mixing, ngram_join, sharding, toxicity
from tierflow.llm.common import fold, read
from tierflow.session import work_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Compression-distance classification, trained on the labelled rows of
    ``docs`` outside the held-out fold."""
    labels = read(spark, sf_dir, "labels").select("doc_id", "toxic").filter(fold(F.col("doc_id"), 4) != 2)
    scored = toxicity.score(docs, toxicity.fit(docs, labels), out="__score", gain="__gain")
    return scored.filter(F.col("__score") < toxicity.THRESHOLD).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: one document of each component stays."""
    return ngram_join.deduplicate(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Template decontamination against the benchmark items."""
    return decontamination.clean_documents(docs, read(spark, sf_dir, "benchmark").select("item_id", "text"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Capped water-filling: each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def place_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard of each document by the permutation-filled lookup table."""
    return sharding.assign_shards(spark, docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("sharding", place_shards),
]
ORACLE_SQL = None  # the compression and template stages have no SQL; see tests/llm/test_pipeline.py


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written in the shared folder
    and read again, so a lost executor repeats no earlier stage."""
    docs, out = read(spark, sf_dir, "documents"), work_dir(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{out}/{k}-{name}")
        docs = spark.read.parquet(f"{out}/{k}-{name}")
    return docs
