"""Rank-one spectra and whitening against plain eigendecompositions."""

import math
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from twinledger.llm.spectra import Spectrum, secular_roots
from twinledger.llm.whitening import fit_whitening, whiten


def spectrum(rows, times=1):
    out = Spectrum.empty(rows.shape[1])
    for r in rows:
        out.add(r, times, r.astype(int).tolist())
    return out


def scatter(rows):
    off = rows - rows.mean(axis=0)
    return off.T @ off


def matches(got, rows, times=1):
    want = scatter(rows) * times
    size = max(1, np.abs(want).max())
    assert np.abs(got.vectors * got.values @ got.vectors.T - want).max() < 1e-11 * size
    assert np.abs(got.vectors.T @ got.vectors - np.eye(len(want))).max() < 1e-11
    assert (np.diff(got.values) >= 0).all() and np.abs(got.values - np.linalg.eigvalsh(want)).max() < 1e-11 * size
    assert got.sums == (rows.astype(int).sum(axis=0) * times).tolist() and got.n == len(rows) * times


def cases():
    rng = np.random.default_rng(4)
    yield rng.integers(-50, 50, (200, 9)).astype(float)
    yield rng.integers(-5, 5, (60, 1)).astype(float)
    yield rng.integers(-5, 5, (3, 12)).astype(float)  # fewer rows than entries
    yield np.repeat(rng.integers(-5, 5, (4, 6)), 30, axis=0).astype(float)  # copies
    flat = rng.integers(-9, 9, (80, 8)).astype(float)
    flat[:, 3], flat[:, 5] = 7, flat[:, 4]  # a constant and a repeated entry
    yield flat
    yield np.concatenate([np.eye(7), -np.eye(7)]) * 12  # all eigenvalues equal
    yield rng.integers(-5, 5, (100, 6)) * np.array([10**6, 1, 1, 1, 1000, 1]) + 1e6  # far off, uneven


@pytest.mark.parametrize("rows", list(cases()))
def test_spectra(rows):
    matches(spectrum(rows), rows)
    matches(spectrum(rows, 3), rows, 3)
    cut = len(rows) // 3
    one, two = spectrum(rows[:cut]), spectrum(rows[cut:])
    matches(one.merge(Spectrum.unpacked(two.packed())), rows)
    matches(Spectrum.empty(rows.shape[1]).merge(two), rows[cut:])


def test_widened():
    rng = np.random.default_rng(1)
    rows = rng.integers(-9, 9, (40, 5)).astype(float)
    rows[:20, 3:] = 0
    matches(spectrum(rows[:20, :3]).merge(spectrum(rows[20:])), rows)


def test_secular_roots_of_close_values():
    d = np.array([0.0, 1e-12, 1.0, 1.0 + 1e-10, 5.0])
    z = np.array([.3, .4, .5, .1, .2])
    origin, t = secular_roots(d, z, 2.0)
    want = np.linalg.eigvalsh(np.diag(d) + 2 * np.outer(z, z))
    assert np.abs(d[origin] + t - want).max() < 1e-14 * 10
    low = d[origin] + t
    assert (low > d).all() and (low[:-1] < d[1:]).all()


def plainly(vectors, components):
    """From vectors to {row number: list of (deviation, whitened)} and shares."""
    x = np.array([[math.floor(64 * c) + 1000000 for c in v] for v in vectors])
    n, sums = len(x), x.sum(axis=0)
    off = x * n - sums
    y = np.array([[float(Fraction(int(c), n)) for c in r] for r in off])
    values, turn = np.linalg.eigh(y.T @ y / n)
    values, turn = values[::-1], turn[:, ::-1]
    return (off.astype(object) ** 2).sum(axis=1).tolist(), y @ turn[:, :components] / np.sqrt(values[:components]), values / values.sum()


def test_whiten(spark):
    rng = np.random.default_rng(7)
    vectors = (rng.standard_normal((300, 40)) * np.linspace(.5, 3, 40)).astype(np.float32)
    vectors[50:120] = vectors[3]  # copies
    rows = [(i, [float(c) for c in v], "x", 1) for i, v in enumerate(vectors)]
    bad = [(900, None, "x", 1), (901, [None] + rows[0][1][1:], "x", 1), (902, [float("nan")] * 40, "x", 1), (903, [float("inf")] + [0.0] * 39, "x", 1), (904, [-float("inf")] * 3, "x", 1)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, n string, component int").repartition(11)
    out = whiten(df, components=32).collect()
    assert len(out) == 300 * 32 and {r["n"] for r in out} == {300}
    far, white, shares = plainly([r[1] for r in rows], 32)
    got = np.zeros((300, 32))
    for r in out:
        got[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert r["deviation"] == far[r["vec_id"]] and abs(r["explained"] / shares[r["component"] - 1] - 1) < 1e-10
    signs = np.sign((got * white).sum(axis=0))
    assert np.abs(got - white * signs).max() < 1e-9
    assert len({r["identity_error"] for r in out}) == 1 and out[0]["identity_error"] < 1e-10
    assert np.abs(got.T @ got / 300 - np.eye(32)).max() < 1e-10


def test_odd_inputs(spark):
    schema = "vec_id long, embedding array<double>"
    made = lambda data, k=32: whiten(spark.createDataFrame(data, schema), components=k).collect()
    assert made([]) == [] and made([(1, None), (2, [float("nan")])]) == [] and made([(1, []), (2, [])]) == []
    alone = made([(5, [1.0, 2.0])])
    assert [(r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in alone] == [
        (1, 1, 0, None, None, None), (2, 1, 0, None, None, None)]
    # One direction only: the other components have nothing to divide by.  Repeated ids and rows without one count.
    line = made([(1, [0.0, 0.0]), (1, [1.0, 0.0]), (None, [2.0]), (None, [3.0, 0.0])])
    by = defaultdict(list)
    for r in line:
        by[r["component"]].append(r)
    assert [r["whitened"] for r in by[2]] == [None] * 4 and all(r["explained"] == 1 for r in by[1])
    assert sorted(r["whitened"] for r in by[1]) == pytest.approx([-3 / 5 ** .5, -1 / 5 ** .5, 1 / 5 ** .5, 3 / 5 ** .5])
    huge = made([(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [0.0, 7.5])])
    assert all(r["deviation"] is None for r in huge if r["vec_id"] < 3) and all(np.isfinite(r["whitened"]) for r in huge if r["component"] == 1)
    assert len(made([(i, [float(i % 3), float(i)]) for i in range(9)], 1)) == 9


def test_same_on_any_partitioning(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(i, rng.standard_normal(6).tolist()) for i in range(500)], "vec_id long, embedding array<double>")
    fits = [fit_whitening(df.repartition(k)) for k in (1, 3, 40)]
    for f in fits[1:]:
        assert f.sums == fits[0].sums and np.abs(f.vectors - fits[0].vectors).max() < 1e-12 and np.abs(f.values / fits[0].values - 1).max() < 1e-12
