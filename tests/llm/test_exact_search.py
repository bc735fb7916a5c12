"""Exact search against looking at every row."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from twinledger.llm import exact_search
from twinledger.llm.exact_search import distances, far_apart, top_scores

SCHEMA = "vec_id long, embedding array<double>, score string, _row int"


def plainly(rows, asked, k, scale=256):
    """(query id, rank, id, score) by all inner products."""
    clean = [(d, [max(-1 << 52, min(1 << 52, math.floor(scale * c))) for c in v]) for d, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for q, a in clean:
        if q is None or not asked(q):
            continue
        found = [(max(-1 << 63, min((1 << 63) - 1, sum(x * y for x, y in zip(a, b)))), c) for c, b in clean if c != q]
        found.sort(key=lambda f: (-f[0], f[1] is None, f[1] or 0))
        out += [(q, i + 1, c, s) for i, (s, c) in enumerate(found[:k])]
    return sorted(out, key=str)


def searched(spark, rows, k=5, each=7):
    df = spark.createDataFrame([(d, v, "x", 3) for d, v in rows], SCHEMA)
    return sorted(map(tuple, top_scores(df, F.col("vec_id") % each == 0, k=k).collect()), key=str)


def clustered(seed, n=260, width=6):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((8, width)) * 3
    return [(i, (centres[i % 8] + rng.standard_normal(width) * .2).tolist()) for i in range(n)]


@pytest.mark.parametrize("block, pack", [(4096, 512), (16, 4)])
def test_clusters_copies_and_ties(spark, monkeypatch, block, pack):
    monkeypatch.setattr(exact_search, "BLOCK_ROWS", block)
    monkeypatch.setattr(exact_search, "PACK_ROWS", pack)
    rows = clustered(1)
    rows += [(1000 + i, rows[14][1]) for i in range(90)]  # a hot group of copies
    rows += [(None, rows[3][1]), (None, rows[3][1]), (2001, None), (2002, [float("nan")] * 6), (2003, [None] * 6), (2009, [float("inf")] * 6),
             (2100, [1.0, 2.0]), (2101, []), (2107, [9.0] * 8), (21, rows[21][1]), (49, [0.0] * 6)]
    random.Random(1).shuffle(rows)
    assert searched(spark, rows) == plainly(rows, lambda q: q % 7 == 0, 5)


def test_few_and_none(spark):
    rows = clustered(2, n=4)
    assert searched(spark, rows, k=5, each=2) == plainly(rows, lambda q: q % 2 == 0, 5)
    assert searched(spark, rows[:1]) == [] and searched(spark, []) == [] and searched(spark, [(0, None), (7, None)]) == []
    assert searched(spark, rows, each=10**9, k=1) == plainly(rows, lambda q: q == 0, 1)
    assert searched(spark, rows[1:], each=10**9) == []


def test_large_entries(spark):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1, 1) * 10.0 ** rng.randint(0, 14) for _ in range(3)]) for i in range(60)]
    rows += [(70, [1e300, -1e300, 1.0]), (77, [1e300, 1e300, 0.0]), (84, [2.0 ** 43 + 1, 1.0, 0.0]), (85, [2.0 ** 43, 1.0, 0.0])]
    assert searched(spark, rows) == plainly(rows, lambda q: q % 7 == 0, 5)


def test_bounds_hold_and_stop_early(monkeypatch):
    rows = np.array([v for _, v in clustered(3, n=2000)])
    pivots = far_apart(rows, 12)
    assert len(np.unique(pivots, axis=0)) == 12 and len(far_apart(rows[:3].repeat(9, axis=0), 12)) == 3
    unit = exact_search.Unit(np.arange(2000), np.ones(2000, dtype=bool), np.arange(2000), np.zeros(2000), rows, distances(rows, pivots).T)
    unit.norms, unit.widest, unit.entry = (rows * rows).sum(axis=1), unit.dists.max(axis=1), float(np.abs(rows).max())
    looked = []
    count = exact_search._scores
    monkeypatch.setattr(exact_search, "_scores", lambda q, r, safe: looked.append(len(r)) or count(q, r, safe))
    for i in range(0, 2000, 50):
        picked, scores = exact_search.search(unit, unit, i, 5, -np.inf)
        want = np.delete(rows, i, axis=0) @ rows[i]
        assert np.allclose(scores, np.sort(want)[::-1][:5])
    assert sum(looked) < 40 * 2000 / 3  # most candidates are never evaluated


def test_pairs_of_far_units_are_left_out(spark, monkeypatch):
    monkeypatch.setattr(exact_search, "BLOCK_ROWS", 32)
    monkeypatch.setattr(exact_search, "PACK_ROWS", 8)
    kept = []
    pairs = exact_search.pairs_of_units
    monkeypatch.setattr(exact_search, "pairs_of_units", lambda b, p: kept.append((pairs(b, p).count(), b.count() * p.count())) or pairs(b, p))
    rows = clustered(4, n=800)
    assert searched(spark, rows) == plainly(rows, lambda q: q % 7 == 0, 5)
    assert kept[0][0] < kept[0][1]
