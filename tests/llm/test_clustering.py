import hashlib
import math
import random

import numpy as np
import pytest

from marketpipe.llm import clustering
from marketpipe.llm.shared import prepare

rng = random.Random(11)
SCHEMA = "vec_id bigint, embedding array<float>, cluster int, v string, apex string"


@pytest.fixture
def vectors(spark):
    prepare(spark)
    return lambda rows: spark.createDataFrame([(i, v, 1, "x", "y") for i, v in rows], SCHEMA)


def brute(rows, n, rounds, clusters=8):
    """Lloyd's rounds over Python integers: (vec_id, cluster, distance) and the centroids."""
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and len(v) == n and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:clusters]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        centroids = [[sum(c) // len(groups[k]) for c in zip(*groups[k])] if k in groups else old for k, old in enumerate(centroids)]
    return sorted(((i is None, i or 0), near(v)[1], near(v)[0]) for i, v in kept), centroids


def cloud(n, many, spread):
    middles = [[rng.gauss(0, 0.3) for _ in range(n)] for _ in range(6)]
    return [(i, [x + rng.gauss(0, spread) for x in rng.choice(middles)]) for i in range(many)]


@pytest.mark.parametrize(("many", "spread"), [(300, 0.02), (300, 0.5), (7, 0.2), (1, 0.1)])
def test_equals_rounds_over_integers(vectors, many, spread):
    rows = cloud(16, many, spread)
    rows += [(1000 + k, rows[0][1]) for k in range(many // 2)] + [(0, rows[0][1])]  # many copies, and a repeated id
    rows += [(2000, None), (2001, [0.5] * 15), (2002, [0.5] * 17), (2003, [0.5] * 15 + [None]), (2004, [math.nan] * 16), (2005, [math.inf] * 16), (2006, []), (None, [0.1] * 16), (2007, [1e30] * 16)]
    want, centroids = brute([r for r in rows if r[0] != 2007], 16, 4)
    got = clustering.cluster(vectors(rows), rounds=4, components=16).collect()
    assert sorted(((r["vec_id"] is None, r["vec_id"] or 0), r["cluster"], r["distance"]) for r in got) == want
    inertia = {k: sum(d for _, c, d in want if c == k) for k in range(8)}
    for r in got:
        assert r["cluster_inertia"] == inertia[r["cluster"]] and r["inertia"] == sum(inertia.values())
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centroids[r["cluster"]])).encode()).hexdigest()


def test_bounds_hold_and_filter(vectors):
    x = np.array([v for _, v in cloud(16, 400, 0.1)])
    v = np.floor(x * 1024).astype(np.int64)
    first = clustering.Simplex(v[:5])
    grown = clustering.Simplex(np.vstack([v[2:9], v[:1]]), first)
    a = grown.apexes(v, first.apexes(v))
    assert len(grown.pivots) == 9 and np.allclose(a, clustering.Simplex(v[:9]).apexes(v), atol=1e-3)
    d = ((v[:, None, :50] - v[None, :50]) ** 2).sum(2)
    below = ((a[:, None] - a[None, :50]) ** 2).sum(2)
    above = below + 4 * a[:, None, -1] * a[None, :50, -1]
    assert (below <= d + 1e-3).all() and (d <= above + 1e-3).all()
    best, far, n = clustering.nearest(v, a, v[:9], a[:9])
    assert (far == d[:, :9].min(1)).all() and (best == d[:, :9].argmin(1)).all()
    assert n < 0.5 * 9 * len(v)  # the pivots' own distances are known from the projection


def test_ties_equal_vectors_and_no_rows(vectors):
    same = [(i, [0.25] * 16) for i in range(20)]
    got = clustering.cluster(vectors(same), components=16, rounds=2).collect()
    assert {(r["cluster"], r["distance"], r["inertia"]) for r in got} == {(0, 0, 0)} and len(got) == 20
    empty = clustering.cluster(vectors([]), components=16)
    assert empty.count() == 0 and empty.columns == clustering.cluster(vectors(same), components=16, rounds=1).columns
    assert clustering.cluster(vectors([(1, None)]), components=16).count() == 0
