"""The tournament and the clustering beside brute force with Python integers."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from textloom.llm import centroids as ce


def brute(rows, k, rounds, dim, salt="2"):
    points = [(i, [int(np.floor(256 * float(v))) for v in x]) for i, x in rows if i is not None and x is not None and len(x) == dim and all(v is not None and np.isfinite(v) for v in x)]
    start = sorted(points, key=lambda p: (hashlib.sha256(f"{salt}:{p[0]}".encode()).hexdigest(), p[1]))[:k]
    own = [x for _, x in start]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(own))

    for _ in range(rounds):
        groups = {}
        for _, x in points:
            groups.setdefault(nearest(x)[1], []).append(x)
        own = [[sum(v) // len(groups[j]) for v in zip(*groups[j])] if j in groups else c for j, c in enumerate(own)]
    return sorted((i, nearest(x)[1], nearest(x)[0], hashlib.sha256(",".join(map(str, own[nearest(x)[1]])).encode()).hexdigest()) for i, x in points)


def frame(spark, rows):
    return spark.createDataFrame([(i, x, "c", 1) for i, x in rows], "vec_id BIGINT, embedding ARRAY<DOUBLE>, cluster STRING, x INT")


def plain(df):
    rows = df.collect()
    total = sum(r["distance"] for r in rows)
    by = {}
    for r in rows:
        by[r["cluster"]] = by.get(r["cluster"], 0) + r["distance"]
    assert all(r["inertia"] == total and r["cluster_inertia"] == by[r["cluster"]] for r in rows)
    return sorted((r["vec_id"], r["cluster"], r["distance"], r["centroid_sha256"]) for r in rows)


@pytest.mark.parametrize("dtype", [np.int64, object])
def test_tournament_is_the_nearest_with_ties_to_the_smaller_number(dtype):
    rng = np.random.default_rng(1)
    for _ in range(30):
        k, dim = rng.integers(1, 9), rng.integers(1, 4)
        own = rng.integers(-3, 4, (k, dim))  # small numbers: equal centroids and ties are frequent
        x = rng.integers(-4, 5, (50, dim))
        planes = ce.Planes(*[a.astype(dtype) for a in ce.bisecting_planes(own.tolist())])
        far = ((x[:, None, :] - own[None]) ** 2).sum(axis=2)
        assert ce.tournament(planes, x.astype(dtype)).tolist() == far.argmin(axis=1).tolist()


def test_clusters_beside_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.1, 0.25]) for _ in range(3)]) for i in range(120)]
    rows += [(5, [0.1, 0.1, 0.1]), (5, [0.1, 0.1, 0.1]), (None, [0.0] * 3), (200, None), (201, [0.0, None, 0.0])]
    rows += [(202, [0.0, float("nan"), 0.0]), (203, [0.0, float("inf"), 0.0]), (204, [0.0, 0.0]), (205, []), (-7, [9.0, -9.0, 9.0])]
    for k, rounds in ((1, 2), (7, 5), (500, 1)):
        got = plain(ce.centroid_clusters(frame(spark, rows), k, rounds, 3))
        assert got == brute(rows, k, rounds, 3)


def test_sums_and_products_beyond_64_bits_stay_exact(spark):
    rows = [(1, [3e9, 0.0]), (2, [3e9 + 512, 1.0]), (3, [-1e30, 2.0]), (4, [-1e30, 3.0]), (5, [1.5, -0.001])]
    got = {r["vec_id"]: r for r in ce.centroid_clusters(frame(spark, rows), 3, 3, 2).collect()}
    want = {i: (c, d) for i, c, d, _ in brute(rows, 3, 3, 2)}
    for i, (cluster, distance) in want.items():
        assert got[i]["cluster"] == cluster
        assert got[i]["distance"] == (distance if distance < 1 << 63 else None)
    assert ce.limbs(-1) == [-1] and sum(v << (32 * i) for i, v in enumerate(ce.limbs(-(10**40)))) == -(10**40)


def test_empty_table_and_too_many_planes(spark):
    assert ce.centroid_clusters(frame(spark, [])).collect() == []
    assert ce.centroid_clusters(frame(spark, [(1, [0.0])])).collect() == []
    with pytest.raises(ValueError):
        ce.bisecting_planes([[0] * 4096] * 200)
