import numpy as np
import pytest

from tierflow.llm import hard_negatives as hn


def brute(rows):
    rows = [(i, l, [int(np.floor(256 * np.float64(np.float32(c)))) for c in v]) for i, l, v in rows
            if l is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)]
    rows = [(i, (l + 1) % 10 if i is not None and i % 7 == 0 else l, v) for i, l, v in rows]
    last = lambda i: hn.NO_ID if i is None else i
    out = []
    for a, al, av in {(i, l, tuple(v)) for i, l, v in rows if i is not None and i % 100 == 0}:
        s = sorted(((-sum(p * q for p, q in zip(av, v)), last(i), l) for i, l, v in rows if i != a))
        for ps, p, _ in [x for x in s if x[2] == al][:5]:
            good = [x for x in s if x[2] != al and 30 * -ps <= 100 * -x[0] <= 90 * -ps][:10]
            out += [(a, p, k + 1, n, -ps, -ns) for k, (ns, n, _) in enumerate(good)]
    return sorted(out)


def mined(spark, rows):
    df = spark.createDataFrame([(i, l, v, 1, "s") for i, l, v in rows],
                               "vec_id long, label int, embedding array<float>, id int, slice string")
    part = hn.labelled_rows(df, "vec_id", "label", "embedding")
    moved = hn.F.when(hn.F.col("id") % 7 == 0, (hn.F.col("label") + 1) % 10).otherwise(hn.F.col("label"))
    got = hn.mine(part.withColumn("label", moved))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((a, hn.NO_ID if p is None else p, k, hn.NO_ID if n is None else n, ps, ns)
                  for a, p, k, n, ps, ns in got.collect())


def vectors(n, d=8, centres=5, seed=0):
    rng = np.random.default_rng(seed)
    c = rng.standard_normal((centres, d)) * 2
    return [(int(i * 10), int(i % 4), [float(x) for x in c[i % centres] + rng.standard_normal(d)]) for i in range(n)]


def test_matches_brute_force(spark):
    rows = vectors(600)
    assert mined(spark, rows) == brute(rows) and len(brute(rows)) > 500


def test_small_cells_and_split_clusters(spark, monkeypatch):
    monkeypatch.setattr(hn, "SHELF", 7)
    monkeypatch.setattr(hn, "BLOCK", 16)
    monkeypatch.setattr(hn, "STRIDE", 5)
    monkeypatch.setattr(hn, "MEMBERS", 10)
    rows = vectors(500, seed=3)
    hot = [(i * 100, 1 if i % 2 else 2, rows[0][2]) for i in range(60, 90)]  # one vector, many anchors, ties
    assert mined(spark, rows + hot) == brute(rows + hot)


def test_odd_rows(spark):
    rows = vectors(120, d=3, seed=5)
    odd = [(5000, None, [1.0, 2.0, 3.0]), (5100, 1, None), (5200, 1, [1.0, None, 2.0]), (5300, 1, [float("inf"), 0.0, 0.0]),
           (None, 1, [1.0, 1.0, 1.0]), (None, 2, [1.0, 1.0, 1.0]), (5400, 2, [0.0, 0.0, 0.0]), (5500, 3, [1.0]), (5600, 3, [])]
    assert mined(spark, rows + odd) == brute(rows + odd)
    again = rows + [rows[10], rows[10], rows[21]]  # an anchor and a row come again
    assert mined(spark, again) == brute(again)
    assert mined(spark, []) == [] and mined(spark, odd[:4]) == [] and mined(spark, rows[1:9]) == []


@pytest.mark.parametrize("scale", [1e4, 2e5])
def test_large_components_are_exact(spark, scale):
    rows = [(i, l, [c * scale for c in v]) for i, l, v in vectors(80, d=4, seed=6)]
    rows = [r for r in rows if abs(max(r[2], key=abs)) < 1e8]
    assert mined(spark, rows) == brute(rows)


def test_lists_end_early():
    """A tight cluster does not score rows that the bound rules out."""
    rng = np.random.default_rng(1)
    near, far = rng.normal([50, 0, 0], 1, (400, 3)), rng.normal([-50, 0, 0], 1, (4000, 3))
    x = np.floor(np.vstack([near, far])).astype(np.float64)
    table = {"key": [1, 2], "id": [0, 100], "label": [1, 1], "cluster": [0, 0], "x": x[:2], "scores": [None, None]}
    c = hn.unit(x[:2].sum(axis=0)[None])[0]
    shelf = hn.Shelf(table, c, hn.angles(x[:2], c).max(axis=0), 3, True, 5, 30, 90)
    scored = []
    real, hn.scores = hn.scores, lambda u, r, exact: scored.append(len(r)) or real(u, r, exact)
    try:
        shelf.walk(np.arange(len(x)) + 1000, np.full(len(x), 1, dtype=object), x)
    finally:
        hn.scores = real
    assert sum(scored) <= 2 * hn.STRIDE
