"""Whitening against numpy's eigendecomposition of exact covariances."""

import numpy as np
import pytest

from rankloom.llm import whitening as w
from rankloom.llm.queries.whitening_query import op12_whitening

SCHEMA = "vec_id long, embedding array<float>, width int, x string, component int"


def expected(vectors, components=8):
    """``{(position, component): …}`` from whole numbers in exact arithmetic, then ``eigh``."""
    x = np.array([[int(np.floor(np.float64(np.float32(c)) * 1024)) + 100_000 for c in v] for v in vectors], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    centred = x * n - sums
    deviations = (centred * centred).sum(axis=1)
    c = centred.astype(float) / n
    values, basis = np.linalg.eigh(c.T @ c / n)
    values, basis = values[::-1], basis[:, ::-1]
    kept = [i for i in range(len(values)) if values[i] > 1e-12 * values[0] > 0][:components]
    return n, deviations, c @ basis[:, kept] / np.sqrt(values[kept]), values[kept] / values.sum()


def check(got, ids, vectors, components=8):
    n, deviations, white, share = expected(vectors, components)
    at = {i: p for p, i in enumerate(ids)}
    assert len(got) == len(ids) * white.shape[1]
    signs = {}
    for r in got:
        p, j = at[r.vec_id], r.component - 1
        assert (r.n, int(r.deviation)) == (n, deviations[p])
        assert r.explained == pytest.approx(share[j], rel=1e-9)
        if j not in signs and abs(white[p, j]) > 0.5:
            signs[j] = np.sign(white[p, j]) * np.sign(r.whitened)
    for r in got:
        p, j = at[r.vec_id], r.component - 1
        assert r.whitened == pytest.approx(signs[j] * white[p, j], abs=1e-6)
    assert len({r.identity_error for r in got}) <= 1 and all(r.identity_error < 1e-9 for r in got)


def test_given_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    check(op12_whitening(spark, sf_dir).collect(), [r.vec_id for r in rows], [r.embedding for r in rows])


def test_awkward_rows(spark):
    rnd = np.random.default_rng(5)
    base = rnd.normal(size=(60, 6)) * np.array([5, 5, 1, 0.2, 1, 0])  # equal and missing directions
    base[:, 4] = base[:, 2]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)] + [(100 + i, [1.0] * 6) for i in range(40)]
    good = list(rows)
    rows += [(900, None), (901, []), (902, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (903, [float("nan")] * 6), (904, [float("inf")] * 6), (905, [1e20] * 6)]
    rows += [(800, [1.0, 2.0]), (801, [2.0, 2.0]), (802, [3.0, 1.0]), (700, [4.0])]
    frame = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA).repartition(5)
    got = w.whiten(frame).collect()
    check([r for r in got if r.vec_id < 700], [i for i, _ in good], [v for _, v in good])
    check([r for r in got if r.vec_id >= 700], [800, 801, 802], [[1.0, 2.0], [2.0, 2.0], [3.0, 1.0]])  # one vector of width 1 has no spread
    assert w.whiten(frame.where("false")).count() == 0


def test_repeated_ids_count(spark):
    frame = spark.createDataFrame([(1, [0.0, 1.0]), (1, [0.0, 1.0]), (None, [4.0, 2.0]), (2, [1.0, 7.0])], "vec_id long, embedding array<double>")
    got = w.whiten(frame, components=1).collect()
    assert sorted((r.vec_id or 0, r.n) for r in got) == [(0, 4), (1, 4), (1, 4), (2, 4)]


@pytest.mark.parametrize("seed", range(6))
def test_update_equals_eigh(seed):
    rnd = np.random.default_rng(seed)
    width = int(rnd.integers(1, 40))
    rows = rnd.normal(size=(200, width)) * 10.0 ** rnd.uniform(-6, 6, width) if seed % 2 else rnd.integers(-3, 4, size=(200, width)).astype(float)
    rows[50:90] = rows[0]
    parts = [w.Spectrum(width) for _ in range(3)]
    for i, row in enumerate(rows):
        parts[i % 3].add(row)
    whole = parts[0]
    for other in parts[1:]:
        whole.merge(w.Spectrum.unpacked(other.packed(), width))
    centred = rows - rows.mean(axis=0)
    scatter = centred.T @ centred
    scale = np.linalg.norm(scatter)
    assert np.abs(whole.basis @ np.diag(whole.values) @ whole.basis.T - scatter).max() < 1e-11 * scale
    assert np.abs(whole.basis.T @ whole.basis - np.eye(width)).max() < 1e-10
    assert np.abs(whole.values - np.linalg.eigvalsh(scatter)).max() < 1e-11 * scale
    assert whole.n == 200 and np.allclose(whole.mean, rows.mean(axis=0))


def test_large_numbers_stay_exact():
    rows = np.array([[1 << 50, 5], [-(1 << 50), 6], [3, 1 << 49]], dtype=np.int64)
    n, sums = 10**6, np.array([12345678901234567, -98765432109876543], dtype=object)
    centred = w._centred(rows, n, sums)
    want = [[int(v) * n - int(s) for v, s in zip(r, sums)] for r in rows]
    assert centred.tolist() == want
    assert w._deviations(centred) == [sum(v * v for v in r) for r in want]
