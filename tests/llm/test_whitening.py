"""Whitening against plain numpy."""

import math

import numpy as np
import pytest

from surgewatch.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int, x string, component int"


def made(seed=3, rows=300, dim=12):
    rng = np.random.default_rng(seed)
    data = rng.normal(size=(rows, dim)) * np.linspace(1, 0.2, dim) + 0.3
    out = [(i, [float(np.float32(c)) for c in v], 0, "x", 9) for i, v in enumerate(data)]
    out += [(1000 + i, out[i % 7][1], None, None, None) for i in range(200)]  # copies
    bad = [None, [1.0, None] + [0.0] * (dim - 2), [math.nan] * dim, [math.inf] + [0.0] * (dim - 1)]
    return out + [(2000 + i, v, 1, "y", 1) for i, v in enumerate(bad)] + [(None, out[0][1], 1, "", 1)]


def integer(c):
    return math.floor(256 * c) + 0


def expected(rows, dim, top=4):
    kept = [(i, [integer(c) for c in v] + [0] * (dim - len(v))) for i, v in rows]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array(fit, float) - np.array(sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:top]
    return kept, n, sums, values[order], vectors[:, order], values.sum()


def check(spark, rows, dim, usable):
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    kept, n, sums, values, vectors, trace = expected(usable, dim)
    assert len(got) == len(kept) * len(values)
    assert {r.n for r in got} == {n}
    errors = {r.identity_error for r in got}
    assert len(errors) == 1 and 0 <= errors.pop() < 1e-12
    by_row = {(r.vec_id, r.component): r for r in got}
    signs = np.zeros(len(values))
    for i, x in kept:
        for j, e in enumerate(values):
            r = by_row[i, j + 1]
            assert r.deviation == sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))
            want = (np.array(x) - np.array(sums) / n) @ vectors[:, j] / math.sqrt(e)
            if not signs[j] and abs(want) > 1e-3:
                signs[j] = np.sign(want * r.whitened)
            assert r.whitened == pytest.approx(signs[j] * want, abs=1e-9) or not signs[j]
            assert r.explained == pytest.approx(e / trace, rel=1e-9)


def test_equals_numpy(spark):
    rows = made()
    check(spark, rows, 12, [(r[0], r[1]) for r in rows if r[0] is None or r[0] < 2000])


def test_short_vectors_are_filled_up(spark):
    rows = [(i, v[: 3 + i % 10], *rest) for i, v, *rest in made()[:200]] + [(5000, [], 1, "", 1)]
    check(spark, rows, 12, [(r[0], r[1]) for r in rows])


def test_huge_entries_and_deviations_beyond_64_bits(spark):
    rows = [(i, [float(i), 3e38 if i else -3e38], 0, "", 0) for i in range(600)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 1200
    first = [r for r in got if r.vec_id == 0]
    x = [(256 * i, (1 << 30) * (1 if i else -1)) for i in range(600)]
    sums = [sum(c) for c in zip(*x, strict=True)]
    exact = sum((600 * c - s) ** 2 for c, s in zip(x[0], sums, strict=True))
    assert {r.deviation for r in first} == {exact if exact < 1 << 63 else None}
    assert whitening.deviations(np.array([[1 << 30], [0]]), 1 << 20, np.array([-5]))[1] == 25
    assert whitening.deviations(np.array([[1 << 30]]), 1 << 20, np.array([-5])) == [None]


def test_no_variance(spark):
    rows = [(i, [0.5, 0.5, 0.5], 0, "", 0) for i in range(5)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 15 and {(r.whitened, r.explained, r.deviation, r.n) for r in got} == {(None, 0.0, 0, 1)}
    line = [(i, [float(i), 2.0 * i, 0.0], 0, "", 0) for i in range(5)]
    got = whitening.whiten(spark.createDataFrame(line, SCHEMA)).collect()
    assert {r.component for r in got if r.whitened is not None} == {1}
    assert all(r.explained == pytest.approx(1.0) for r in got if r.component == 1)


def test_nothing_to_fit(spark):
    for rows in ([], [(1, None, 1, "", 1)], [(1, [], 1, "", 1)]):
        got = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
        assert got.columns == [c.split()[0] for c in whitening.OUT.split(",")]
        assert got.count() == 0
    with pytest.raises(ValueError, match="entries"):
        whitening.whiten(spark.createDataFrame([(1, [0.0] * 3000, 1, "", 1)], SCHEMA))


SPECTRA = {
    "apart": np.arange(64, 0, -1.0),
    "clusters": np.r_[10, 10 - 1e-6, 10 - 2e-6, 5, np.linspace(1, 1 + 1e-10, 60)],
    "equal": np.r_[3, 3, 3, 2, np.zeros(60)],
}


@pytest.mark.parametrize("name", SPECTRA)
def test_refinement_reaches_double_precision(name):
    turned = np.linalg.qr(np.random.default_rng(1).normal(size=(64, 64)))[0]
    a = (turned * SPECTRA[name]) @ turned.T
    a = (a + a.T) / 2
    start = np.linalg.eigh(a.astype(np.float32))[1].astype(float)
    assert np.abs(start.T @ start - np.eye(64)).max() > 1e-8
    x = whitening.refined(a, start)
    s = x.T @ a @ x
    assert np.abs(x.T @ x - np.eye(64)).max() < 2e-14
    assert np.abs(s - np.diag(np.diag(s))).max() < 1e-13 * SPECTRA[name].max()
    values, vectors = whitening.eigen(a, 4)
    assert values == pytest.approx(np.sort(SPECTRA[name])[::-1][:4], rel=1e-14)
    assert np.abs(vectors.T @ vectors - np.eye(4)).max() < 1e-15
    assert np.abs(a @ vectors - vectors * values).max() < 1e-14 * SPECTRA[name].max()


def test_clusters():
    found = whitening.clusters(np.array([1.0, 5.0, 1.1, 9.0, 5.05]), 0.2)
    assert sorted(sorted(g.tolist()) for g in found) == [[0, 2], [1, 4]]
