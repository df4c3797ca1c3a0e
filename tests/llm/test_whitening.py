import numpy as np
import pytest

from tierflow.llm import whitening as wh


def brute(vectors, k=4):
    x = np.floor(256 * np.array(vectors, dtype=np.float64)).astype(np.int64)
    f = np.unique(x, axis=0)
    n, s = len(f), f.sum(axis=0)
    c = f - s / n
    v = c.T @ c / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    dev = [int(sum(int(a) ** 2 for a in row)) for row in x.astype(object) * n - s.astype(object)]
    return n, dev, (x - s / n) @ q / np.sqrt(e), e / np.trace(v)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, x string, n string")


def check(got, rows, vectors):
    n, dev, w, share = brute(vectors)
    assert len(got) == len(rows) * w.shape[1]
    sign = {}
    for r in got:
        i, c = rows.index(r.vec_id), r.component - 1
        s = sign.setdefault(c, np.sign(r.whitened * w[i, c]) if abs(w[i, c]) > 1e-3 else 1)
        assert r.n == n and int(r.deviation) == dev[i] and r.identity_error < 1e-8
        assert r.whitened * s == pytest.approx(w[i, c], abs=1e-7) and r.explained == pytest.approx(share[c], rel=1e-9)


def test_matches_dense_eigenvectors(spark):
    rng = np.random.default_rng(0)
    v = (rng.standard_normal((300, 24)) * np.linspace(2, 0.5, 24)).astype(np.float32)
    v[40:60] = v[0]  # repeated vectors count once in the fit
    rows = list(range(300))
    df = frame(spark, [(i, [float(c) for c in v[i]], 1, "x", "n") for i in rows])
    check(wh.whiten(df).collect(), rows, v)
    model, width = wh.fit(wh.quantise(df.withColumnRenamed("x", "y"), "embedding").select("x"))
    assert width == 24 and (model.residuals <= wh.STALLED * model.values[0]).all()


def test_flat_spectrum_needs_the_filter():
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.standard_normal((96, 96)))[0]
    values = np.concatenate([[1.7, 1.6, 1.09, 1.08], np.linspace(1.075, 0.92, 92)])
    a, passes = (q * values) @ q.T, []
    e, vectors, residuals = wh.top_eigenpairs(lambda b: passes.append(1) or a @ b, 96, 4)
    assert np.allclose(e, values[:4], rtol=1e-12) and np.allclose(abs((vectors * q[:, :4]).sum(axis=0)), 1, atol=1e-10)
    assert len(passes) < 160
    # equal values and values too close for the first block
    for flat in (np.full(96, 2.0), np.concatenate([np.full(30, 1.0), np.full(66, 1 - 1e-9)])):
        e, vectors, residuals = wh.top_eigenpairs(lambda b: (q * flat) @ (q.T @ b), 96, 4)
        assert np.allclose(e, flat[:4]) and np.allclose(vectors.T @ vectors, np.eye(4), atol=1e-10)


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(c) for c in rng.standard_normal(3)], 1, "a", "b") for i in range(30)]
    odd = [(30, None, 1, "a", "b"), (31, [1.0, None, 2.0], 1, "a", "b"), (32, [float("nan"), 0.0, 0.0], 1, "a", "b"),
           (33, [float("inf"), 0.0, 0.0], 1, "a", "b")]
    got = wh.whiten(frame(spark, rows + odd)).collect()
    check(got, [r[0] for r in rows], [r[1] for r in rows])
    short = [(40, [1.0], 1, "a", "b"), (None, [], 1, "a", "b"), (0, rows[0][1], 1, "a", "b")]
    got = wh.whiten(frame(spark, rows + short)).collect()
    assert len(got) == 3 * 33 and got[0].n == 32
    w = {(r.vec_id, r.component): r.whitened for r in got}
    filled = brute([r[1] for r in rows] + [[1.0, 0, 0], [0, 0, 0]])[2]
    assert abs(w[40, 1]) == pytest.approx(abs(filled[30, 0])) and abs(w[None, 2]) == pytest.approx(abs(filled[31, 1]))
    assert wh.whiten(frame(spark, odd)).count() == 0 and wh.whiten(frame(spark, [])).count() == 0
    assert wh.whiten(frame(spark, rows[:1] * 3)).count() == 0  # no variance, no component
    two = wh.whiten(frame(spark, rows[:2])).collect()
    assert {r.component for r in two} == {1} and {round(abs(r.whitened), 9) for r in two} == {1.0}


def test_deviation_is_exact_beyond_long():
    x = np.array([[1 << 40, -(1 << 40)], [3, 4], [(1 << 62), 5]])
    n, sums = 1_000_003, [12345678901234567, -5]
    want = [sum((n * int(c) - s) ** 2 for c, s in zip(r, sums)) for r in x]
    assert wh._deviations(x, n, sums) == want
    assert wh._deviations(x[1:2], 1 << 40, [7, -9]) == [sum(((1 << 40) * c - s) ** 2 for c, s in ((3, 7), (4, -9)))]
