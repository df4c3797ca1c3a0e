import random
import re
from collections import Counter, defaultdict

import pytest

from tierflow.llm import mixing, sharding, url_filter
from tests.llm.conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fill(sizes, weights, budget, most):
    """The loop that the operator solves in one pass."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, clamped = budget * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in clamped]
        left = total - sum(clamped.values())
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return {**clamped, **share}
        clamped.update({s: most * sizes[s] for s in over})


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_taken_words(spark, seed):
    rng, rows = random.Random(seed), []
    for i in range(900):
        source = rng.choice(["hot"] * 6 + ["b", "c", "Ä", "z", None])
        rows.append((i, prose(rng, rng.choice([0, 1, 5, 40, 200])), source))
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in out:
        assert r.size == len(WORD.findall(rows[r.doc_id][1])) and r.taken == r.copies * r.size <= 2 * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    want = fill(sizes, mixing.WEIGHTS, mixing.BUDGET, mixing.MAX_EPOCHS)
    for r in out:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
    for s in sizes:
        assert 0 <= want[s] - taken[s] + 1e-6 <= largest[s] + 1e-6
    again = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7))
    assert sorted(r.taken for r in again.collect()) == sorted(r.taken for r in out)


def test_mixed_documents_are_the_mix(spark, odd_docs, no_docs):
    plan = mixing.mix(odd_docs)
    want = Counter()
    for r in plan.collect():
        want[r.doc_id] += r.copies
    out = mixing.mixed_documents(odd_docs)
    assert out.columns == odd_docs.columns
    assert Counter(r.doc_id for r in out.collect()) == +want
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0


def maglev(names, size):
    order = sorted(names)
    prefer = {n: [(sharding._hash(n + "/offset") + k * (sharding._hash(n + "/skip") % (size - 1) + 1)) % size
                  for k in range(size)] for n in order}
    table, at = {}, dict.fromkeys(order, 0)
    while len(table) < size:
        for n in order:
            if len(table) == size:
                break
            while prefer[n][at[n]] in table:
                at[n] += 1
            table[prefer[n][at[n]]] = n
    return [table[i] for i in range(size)]


def test_lookup_table():
    names = ["c", "a", "b", "dd"]
    assert [names[i] for i in sharding.lookup_table(names, 101)] == maglev(names, 101)
    table = sharding.lookup_table(sharding.SHARDS)
    counts = Counter(table)
    assert len(counts) == len(sharding.SHARDS) and max(counts.values()) - min(counts.values()) <= 1
    fewer = sharding.lookup_table(sharding.SHARDS[:-1])
    moved = sum(a != b for a, b in zip(table, fewer) if a != len(sharding.SHARDS) - 1)
    assert moved < 0.1 * len(table)
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.lookup_table(bad)
    with pytest.raises(ValueError):
        sharding.lookup_table(["a"], 100)


def test_assign_shards(spark, odd_docs, no_docs):
    out = sharding.assign_shards(spark, odd_docs)
    assert out.columns == [c for c in odd_docs.columns if c != "shard"] + ["slot", "shard"]
    rows = out.collect()
    table = sharding.lookup_table(sharding.SHARDS)
    import hashlib
    for r in rows:
        slot = int(hashlib.md5(("" if r.doc_id is None else str(r.doc_id)).encode()).hexdigest()[:15], 16) % sharding.TABLE_SIZE
        assert (r.slot, r.shard) == (slot, sharding.SHARDS[table[slot]])
    assert sharding.assign_shards(spark, no_docs).count() == 0


def test_url_rules_and_cascade(spark, monkeypatch):
    rng = random.Random(4)
    hosts = [f"{rng.choice(['www.', '', 'a.b.'])}h{i}.example.{rng.choice(['net', 'com', 'org'])}" for i in range(700)]
    urls = [f"https://{h}{rng.choice(['', '/', '/fr/1', '/de/x?q', '/en/1#t', '/es/'])}" for h in hosts]
    odd = [None, "", "nothing", "http://", "://HOST.Example.ORG", "x://user@h1.example.net:80/p?a://b", "http://a//b"]
    listed = sorted({".".join(h.split(".")[-3:]) for h in rng.sample(hosts, 150)}) + ["never.seen"]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls + odd)], "page_id long, url string, rule string")
    keys = spark.createDataFrame([(k,) for k in listed + listed[:5] + [None]], "key string")

    def judge(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0].lower()
        path = re.match(r"[^/?#]*([^?#]*)", rest)[1]
        fits = [(len(h + p), h + p, v) for h, p, v in url_filter.RULES
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        bare = re.sub(r":[0-9]*$", "", re.sub(r"^.*@", "", host))
        hit = any(bare == k or bare.endswith("." + k) for k in listed)
        return (host, path, max(fits)[1], max(fits)[2]) if fits else (host, path, None, "block" if hit else "allow")

    want = [(i, *judge(u)) for i, u in enumerate(urls + odd)]
    passes, real = [], url_filter._judge_by_cascade
    monkeypatch.setattr(url_filter, "_judge_by_cascade", lambda *a: passes.append(a[4:]) or real(*a))
    for most in (url_filter.MAX_BYTES, url_filter.LEAST_BYTES):  # one cascade, and parts beyond its bound
        out = url_filter.judge(spark, pages, keys, max_bytes=most).select("page_id", "host", "path", "rule", "verdict")
        assert sorted(tuple(r) for r in out.collect()) == want
    parts = passes[-1][1]
    assert passes[0] == (0, 1) and parts > 1 and passes[-parts:] == [(p, parts) for p in range(parts)]
    with pytest.raises(ValueError):
        url_filter.judge(spark, pages, keys, max_bytes=1)
    none = url_filter.judge(spark, pages.limit(0), keys)
    assert none.count() == 0
    assert url_filter.judge(spark, pages, keys.limit(0)).filter("listed").count() == 0


def test_cascade_is_exact_over_the_universe(spark):
    from pyspark.sql import functions as F
    keys = spark.range(30_000).select(url_filter.hashed(F.col("id").cast("string")).alias("x"), "id").select("x.*", "id")
    inside, outside = keys.filter("id % 5 = 0").drop("id"), keys.filter("id % 5 != 0").drop("id")
    levels = url_filter.build_cascade(inside, outside)
    assert len(levels) > 2
    for part, want in ((inside, True), (outside, False)):
        t = part.toArrow()
        assert (url_filter.listed(levels, t["h1"].to_numpy(), t["h2"].to_numpy()) == want).all()
