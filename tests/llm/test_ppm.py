import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierflow.llm import ppm
from tests.llm.conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]


def canonical(text):
    return b"".join(w.encode() + b" " for w in tokens(text)) + b"\n"


def counts_of(texts, order):
    """context -> Counter of the next byte, for every length of context."""
    out = defaultdict(Counter)
    for t in texts:
        s = b"\n" * order + canonical(t)
        for i in range(order, len(s)):
            for k in range(order + 1):
                out[s[i - k:i]][s[i]] += 1
    return out


def byte_log10(seen, context, symbol):
    """Escape from the longest known context, excluding what it knew."""
    total, excluded = 0.0, set()
    for k in range(len(context), -1, -1):
        c = seen.get(context[len(context) - k:])
        if c is None:
            continue
        rest = {x: n for x, n in c.items() if x not in excluded}
        t, d = sum(rest.values()), len(rest)
        if symbol in rest:
            return total + math.log10(rest[symbol] / (t + d))
        if d:
            total += math.log10(d / (t + d))
        excluded |= set(c)
    return total - math.log10(256 - len(excluded))


def trie_of(texts, order):
    keys = Counter()
    for t in texts:
        s = b"\n" * order + canonical(t)
        for i in range(order, len(s)):
            keys[int.from_bytes(s[i - order:i + 1], "big")] += 1
    return ppm.Trie(np.array(list(keys), dtype=np.uint64), np.array(list(keys.values()), dtype=np.int64), order)


@pytest.mark.parametrize("order", [1, 3, 5])
def test_trie_matches_brute_force_and_sums_to_one(order):
    rng = random.Random(order)
    train = [prose(rng, rng.randrange(40)) for _ in range(30)]
    trie, seen = trie_of(train, order), counts_of(train, order)
    for text in [train[3], prose(rng, 30), "ünseen Ωords", ""]:
        s = b"\n" * order + canonical(text)
        keys = np.array([int.from_bytes(s[i - order:i + 1], "big") for i in range(order, len(s))], dtype=np.uint64)
        want = [byte_log10(seen, s[i - order:i], s[i]) for i in range(order, len(s))]
        assert np.allclose(trie.log10(keys), want)
    for context in (b"\n" * order, b"ka lo mi"[:order], b"\xff" * order):
        keys = np.array([int.from_bytes(context + bytes([x]), "big") for x in range(256)], dtype=np.uint64)
        assert (10 ** trie.log10(keys)).sum() == pytest.approx(1)


def check(spark, docs, order=ppm.ORDER, hot_leaves=ppm.HOT_LEAVES):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    train = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 != 0
    out = ppm.score_documents(docs, train, order=order, hot_leaves=hot_leaves).collect()
    learn = [t for d, t in rows if zlib.crc32(("" if d is None else str(d)).encode()) % 3]
    c = Counter(w for t in learn for w in [*tokens(t), "\n"])
    n, v = sum(c.values()), len(c)
    seen = counts_of(learn, order)
    want = {}
    for _, t in rows:
        w, s = [*tokens(t), "\n"], b"\n" * order + canonical(t)
        want[t] = (len(w), sum(c[x] > 0 for x in w), sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w),
                   sum(byte_log10(seen, s[i - order:i], s[i]) for i in range(order, len(s))))
    assert len(out) == len(rows)
    text_of = defaultdict(list)
    for d, t in rows:
        text_of[d].append(t)
    for r in out:
        assert r.train_tokens == n and r.trained == bool(zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 3)
        assert any(r.n_tokens == want[t][0] and r.n_known == want[t][1]
                   and (r.base_score, r.score) == pytest.approx(want[t][2:], rel=1e-9) for t in text_of[r.doc_id])
    return out


def test_scores_match_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, rng.randrange(60)) + rng.choice(["", " unknown", " Ünique" + str(i)])) for i in range(150)]
    rows += [(200 + i, rows[i][1]) for i in range(20)]  # copies, in other batches too
    check(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(6))


def test_odd_rows(spark, odd_docs, no_docs):
    check(spark, odd_docs.filter("length(text) < 1000 or text is null"), 2)
    long = ppm.score_documents(odd_docs, F.lit(True)).filter("doc_id = 100").collect()
    assert len(long) == 2 and long[0].score == long[1].score and long[0].n_tokens == 40_001
    assert ppm.score_documents(no_docs, F.lit(True)).count() == 0
    untrained = ppm.score_documents(odd_docs.filter("doc_id = 4"), F.lit(False)).first()
    assert untrained.score == pytest.approx(-11 * math.log10(256)) and untrained.n_known == 0


def test_scores_are_exact_where_few_leaves_are_broadcast(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, prose(rng, rng.randrange(80)) + f" näme{i % 7} Ω{i}") for i in range(120)]
    docs = spark.createDataFrame(rows + [(500 + i, rows[i][1]) for i in range(10)], "doc_id long, text string").repartition(5)
    monkeypatch.setattr(ppm, "GROUP_BYTES", 100)  # salts too
    check(spark, docs, 5, 40)
    check(spark, docs, 2, 0)


def test_no_context_is_left_out(spark):
    docs = spark.createDataFrame([(i, f"wörd{i} common words") for i in range(50)], "doc_id long, text string")
    src = docs.select("text", F.lit(True).alias("train"))
    model = ppm.fit(src, 8, 100_000, 3, hot_leaves=30)
    assert 0 < len(model.leaves) <= 30
    cold = sum(r.entries for r in model.values.filter("kind = 1").collect())
    seen = counts_of([t for _, t in docs.collect()], 3)
    assert cold + len(model.leaves) == sum(len(c) for k, c in seen.items() if len(k) == 3)
