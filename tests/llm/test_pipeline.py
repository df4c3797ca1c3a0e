import os

import pytest

import __spark_entry__
import corpus_pipeline as cp
from tierflow.llm import decontamination, mixing, ngram_join, sharding, toxicity
from tierflow.llm.common import fold, read
from tests.llm.test_ngram_join import brute

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_registered():
    names = __spark_entry__.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert names["pipeline"] is cp.run and [n for n, _ in cp.STAGES] == [
        "toxicity", "ngram_join", "decontamination", "mixing", "sharding"]


def test_stages_match_their_operators(spark):
    """Every stage on what its predecessor kept, against the operator's own
    verdicts or, for near copies, all pairs."""
    from pyspark.sql import functions as F
    docs = read(spark, SF, "documents").cache()
    columns = docs.columns
    out = cp.drop_toxic(spark, docs, SF).cache()
    model = toxicity.fit(docs, read(spark, SF, "labels").select("doc_id", "toxic").filter(fold(F.col("doc_id"), 4) != 2))
    bad = {r.doc_id for r in toxicity.score(docs, model).collect() if r.score >= toxicity.THRESHOLD}
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()} - bad and out.columns == columns
    docs, out = out, cp.drop_near_copies(spark, out, SF).cache()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(r.doc_id for r in out.collect()) == sorted({c for _, _, c in brute(rows)}) and out.columns == columns
    docs, out = out, cp.drop_benchmark_leaks(spark, out, SF).cache()
    hit = {r.doc_id for r in decontamination.contaminated(docs, read(spark, SF, "benchmark")).collect()}
    assert hit and {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()} - hit
    docs, out = out, cp.mix_sources(spark, out, SF).cache()
    want = sorted(r.doc_id for r in mixing.mix(docs).collect() for _ in range(r.copies))
    assert sorted(r.doc_id for r in out.collect()) == want and out.columns == columns
    placed = cp.place_shards(spark, out, SF)
    assert placed.columns == [*columns, "slot", "shard"] and placed.count() == len(want)
    assert {r["shard"] for r in placed.collect()} <= set(sharding.SHARDS)


def test_stages_on_odd_and_empty_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in cp.STAGES:
            out = stage(spark, docs, SF)
            new = ["slot", "shard"] if name == "sharding" else []
            assert out.columns == [c for c in docs.columns if c not in new] + new
            docs = spark.createDataFrame(out.collect(), out.schema)


def test_near_copy_operator_is_the_stage(spark):
    docs = read(spark, SF, "documents")
    assert ngram_join.deduplicate(docs).count() == cp.drop_near_copies(spark, docs, SF).count()
