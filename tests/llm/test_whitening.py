"""Operator 11 against numpy's own eigenvectors and exact whole numbers."""

import math

import numpy as np
import pytest

from contrail.llm import whitening as W
from contrail.llm.queries import QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<float>, label int, n int, component string, whitened string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "c", "w") for i, v in rows], SCHEMA).repartition(3)


def brute(rows, most=8):
    """vec_id -> x, S, n, and eigenvalues / vectors of the covariance."""
    kept = [(i, [math.floor(1024 * float(np.float32(c))) + 100000 for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([v for _, v in kept], dtype=object)
    n, s = len(x), x.sum(axis=0)
    scaled = n * x - s
    y = (scaled / n).astype(float)
    e, w = np.linalg.eigh(y.T @ y / n)
    return kept, n, (scaled ** 2).sum(axis=1), y, e[::-1], w[:, ::-1]


def check(got, rows, most=8):
    kept, n, dev, y, e, w = brute(rows)
    k = min(most, y.shape[1])
    assert len(got) == len(kept) * k and all(r.n == n for r in got)
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = r
    z = np.array([[by[i][c].whitened for c in range(1, k + 1)] for i, _ in kept])
    want = y @ w[:, :k] / np.sqrt(e[:k])
    for c in range(k):
        sign = np.sign(z[:, c] @ want[:, c])
        assert np.abs(z[:, c] * sign - want[:, c]).max() < 1e-8
    for (i, _), d in zip(kept, dev):
        assert all(int(by[i][c].deviation) == d for c in range(1, k + 1))
    r = by[kept[0][0]]
    assert all(abs(r[c].explained / (e[c - 1] / e.sum()) - 1) < 1e-9 for c in range(1, k + 1))
    assert all(x.identity_error == got[0].identity_error < 1e-9 for x in got)


def rand(seed, n, d, stretch=1.0):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, d)) * np.logspace(0, -stretch, d) @ np.linalg.qr(rng.normal(size=(d, d)))[0]
    return [(i, [float(c) for c in row]) for i, row in enumerate(v)]


def test_against_numpy(spark):
    rows = rand(1, 300, 12)
    check(W.whiten(frame(spark, rows)).collect(), rows)
    rows = rand(2, 40, 3)  # fewer dimensions than components asked for
    check(W.whiten(frame(spark, rows)).collect(), rows)


def test_badly_conditioned_rows_take_more_passes(spark):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(400, 6)) * np.array([3e9, 1e7, 1e4, 100, 10, 1])
    rows = [(i, [float(np.float32(c)) for c in row]) for i, row in enumerate(v)]
    model = W.fit(frame(spark, rows).select("vec_id", "embedding"))
    _, n, _, y, e, _ = brute(rows)
    exact = np.linalg.svd(y, compute_uv=False) ** 2 / n
    assert model.passes >= 3 and np.abs(model.eigenvalues / exact - 1).max() < 1e-4
    assert W.identity_error(frame(spark, rows).select("vec_id", "embedding"), model) < 1e-4


def test_bad_rows_go_and_repeated_rows_count(spark):
    rows = rand(3, 60, 5)
    bad = [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0]), (902, [float("nan")] * 5), (903, [float("inf")] + [0.0] * 4), (904, [None] * 5)]
    got = W.whiten(frame(spark, rows + bad)).collect()
    check(got, rows)
    twice = W.whiten(frame(spark, rows + rows)).collect()
    assert len(twice) == 2 * len(got) and twice[0].n == 120
    nameless = W.whiten(frame(spark, rows[:-1] + [(None, rows[-1][1])])).collect()
    assert sum(r.vec_id is None for r in nameless) == 5


def test_no_variance(spark):
    assert W.whiten(frame(spark, [])).collect() == []
    assert W.whiten(frame(spark, [(1, None)])).collect() == []
    assert W.whiten(frame(spark, [(1, []), (2, [])])).collect() == []
    one = W.whiten(frame(spark, [(1, [1.0, 2.0])])).collect()
    assert [(r.component, r.whitened, r.explained, r.identity_error, int(r.deviation)) for r in sorted(one, key=lambda r: r.component)] == [(1, None, 0.0, None, 0), (2, None, 0.0, None, 0)]
    flat = W.whiten(frame(spark, [(i, [float(i % 5), 7.0, 2.0 * (i % 5)]) for i in range(50)])).collect()  # rank one
    by = {c: [r for r in flat if r.component == c] for c in (1, 2, 3)}
    assert all(r.whitened is not None and abs(r.explained - 1) < 1e-12 and r.identity_error < 1e-9 for r in by[1])
    assert all(r.whitened is None and r.explained == 0 for c in (2, 3) for r in by[c])


def test_short_vectors_end_in_zeros_and_large_ones_stay_exact(spark):
    rows = rand(5, 30, 4)
    short = [(i, v[:2]) for i, v in rand(6, 5, 4)]
    short = [(100 + i, v) for i, v in short]
    got = W.whiten(frame(spark, rows + short)).collect()
    check(got, rows + [(i, v + [0.0, 0.0]) for i, v in short])
    large = [(i, [2.0 ** 40 * (i % 3), float(i)]) for i in range(9)]
    got = W.whiten(frame(spark, large)).collect()
    _, _, dev, *_ = brute(large)
    assert {r.vec_id: int(r.deviation) for r in got} == {i: d for (i, _), d in zip(large, dev)}


def test_query(spark):
    got = QUERIES["op11_whitening"](spark, SF_SMALL)
    assert dict(got.dtypes)["deviation"] == "bigint"
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    check(got.collect(), rows)


@pytest.mark.parametrize("d", [1, 5, 64])
def test_triangular_solve(d):
    rng = np.random.default_rng(d)
    r = np.triu(rng.normal(size=(d, d))) + 5 * np.eye(d)
    y = rng.normal(size=(20, d))
    assert np.abs(W.solved(y, r) @ r - y).max() < 1e-10
