"""Exact clustering against plain Lloyd rounds, the bounds, and odd inputs."""

import hashlib
import math
import random

import numpy as np
import pytest

from tidemark.llm import clustering

SCHEMA = "vec_id long, embedding array<double>, x string, cluster int"


def plain(rows, k, rounds, dims):
    kept = [(i, tuple(math.floor(1024 * e) for e in v)) for i, v in rows if v is not None and len(v) == dims and all(e is not None and math.isfinite(e) for e in v)]
    kept.sort(key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in kept[:k]]
    place = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(place(v)[1], []).append(v)
        centroids = [tuple(sum(c) // len(groups[n]) for c in zip(*groups[n], strict=True)) if n in groups else old for n, old in enumerate(centroids)]
    found = [(i, *place(v)) for i, v in kept]
    total = sum(d for _, d, _ in found)
    each = {n: sum(d for _, d, m in found if m == n) for _, _, n in found}
    return sorted(((i, n, d, each[n], total, hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest()) for i, d, n in found), key=repr)


def got(spark, rows, **how):
    df = spark.createDataFrame([(i, v, "x", 7) for i, v in rows], SCHEMA).repartition(5)
    out = clustering.centroid_clusters(df, **how)
    return sorted((tuple(r) for r in out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=repr)


@pytest.mark.parametrize("seed,dims,pivots", [(1, 4, 3), (2, 6, 12), (3, 5, 1)])
def test_equals_plain_rounds(spark, seed, dims, pivots):
    r = random.Random(seed)
    middles = [[r.uniform(-3, 3) for _ in range(dims)] for _ in range(5)]
    rows = [(i, [r.gauss(m, 0.4) for m in r.choice(middles)]) for i in range(160)]
    rows += [(1000 + i, rows[7][1]) for i in range(90)] + [(3, rows[4][1]), (3, rows[5][1]), (None, rows[6][1])]
    rows += [(2000, None), (2001, [1.0]), (2002, [None] * dims), (2003, [math.nan] * dims), (2004, [math.inf] * dims), (2005, []), (2006, [0.0] * (dims + 1))]
    assert got(spark, rows, dims=dims, k=6, rounds=4, pivots=pivots) == plain(rows, 6, 4, dims)


def test_ties_and_flat_inputs(spark):
    line = [(i, [float(i % 4), 0.0, 0.0]) for i in range(40)]  # pivots can't leave a line
    assert got(spark, line, dims=3, k=4, rounds=3) == plain(line, 4, 3, 3)
    same = [(i, [0.5, -0.25]) for i in range(20)]
    assert {r[1] for r in got(spark, same, dims=2, k=3, rounds=2)} == {0}
    assert got(spark, same[:2], dims=2, k=8, rounds=2) == plain(same[:2], 8, 2, 2)
    assert got(spark, [], dims=2) == []
    assert got(spark, [(1, None)], dims=2) == []


def test_too_large_components_fail(spark):
    with pytest.raises(Exception, match="beyond"):
        got(spark, [(1, [1e9, 0.0])], dims=2)


def test_bounds_hold_and_filter():
    r = np.random.default_rng(5)
    middles = r.integers(-4000, 4000, (8, 64))
    x = middles[r.integers(0, 8, 3000)] + r.integers(-300, 300, (3000, 64))
    simplex = clustering.Simplex(x[:64], 12)
    apex, tops = simplex.apexes(x), simplex.apexes(middles)
    true = clustering.squares(x, middles)
    length = (apex**2).sum(axis=1)[:, None] + (tops**2).sum(axis=1)
    low = ((apex[:, None] - tops) ** 2).sum(axis=2)
    high = low + 4 * np.outer(apex[:, -1], tops[:, -1])
    assert (low <= true + 1e-9 * length).all() and (true <= high + 1e-9 * length).all()
    best, square, compared = clustering.nearest(x, apex, middles, tops)
    assert (best == true.argmin(axis=1)).all() and (square == true.min(axis=1)).all()
    assert compared < 0.2 * true.size, compared / true.size
