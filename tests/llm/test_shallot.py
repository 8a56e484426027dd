"""Whole-number k-means with the Shallot search against plain loops."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from voltfleet.llm import shallot

SCHEMA = "vec_id long, embedding array<float>, label int, first int, v string, distance long"


def plain(rows: list[tuple]) -> list[tuple]:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of kept rows."""
    kept = []
    for vec_id, x, *_ in rows:
        if x is None or len(x) != 64 or any(e is None or not math.isfinite(e) or abs(e) >= shallot.LIMIT for e in x):
            continue
        kept.append((vec_id, [math.floor(64 * float(np.float32(e))) for e in x]))
    key = lambda r: (r[0] is None, "" if r[0] is None else hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(kept, key=key)[:16]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))

    for _ in range(3):
        own = [nearest(v)[1] for _, v in kept]
        for k in range(len(centroids)):
            mine = [v for (_, v), o in zip(kept, own) if o == k]
            if mine:
                centroids[k] = [sum(x) // len(mine) for x in zip(*mine)]
    final = [(i, *nearest(v)) for i, v in kept]
    total = sum(d for _, d, _ in final)
    inertia = {k: sum(d for _, d, o in final if o == k) for k in range(16)}
    digest = lambda k: hashlib.sha256(",".join(map(str, centroids[k])).encode()).hexdigest()
    return sorted(((i, k, d, inertia[k], total, digest(k)) for i, d, k in final), key=str)


def run(spark, tmp_path, rows) -> list[tuple]:
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    return sorted((tuple(r) for r in shallot.op12_centroids(spark, str(tmp_path)).collect()), key=str)


def row(vec_id, x):
    return (vec_id, x, 1, 2, "v", 3)


def test_awkward_rows_and_ties(spark, tmp_path):
    random.seed(3)
    near = [[random.choice([-1.0, 0.0, 0.5, 2.25]) for _ in range(64)] for _ in range(30)]
    rows = [row(i, random.choice(near)) for i in range(150)]  # many equal vectors, so many ties
    rows += [row(i, [random.gauss(i % 5, 0.4) for _ in range(64)]) for i in range(150, 260)]
    rows += [row(7, near[0]), row(7, near[1]), row(None, near[2])]
    odd = [None, [], [1.0] * 63, [1.0] * 65, [1.0] * 63 + [None], [1.0] * 63 + [float("nan")], [float("inf")] + [0.0] * 63, [3e6] + [0.0] * 63]
    rows += [row(1000 + i, x) for i, x in enumerate(odd)]
    rows += [row(2000, [2.0**20] * 64), row(2001, [-(2.0**20)] * 64)]
    assert run(spark, tmp_path, rows) == plain(rows)


@pytest.mark.parametrize("count", [0, 1, 5])
def test_fewer_vectors_than_centroids(spark, tmp_path, count):
    rows = [row(i, [float(i)] * 64) for i in range(count)]
    assert run(spark, tmp_path, rows) == plain(rows)


@pytest.mark.parametrize("spread", [0, 3, 400])
def test_search_is_exact_and_looks_at_fewer_centroids_each_round(spread):
    rng = np.random.default_rng(spread)
    v = np.floor(rng.normal(size=(3000, 8)) * 5).astype(np.int64)
    v[:, 0] += (np.arange(3000) % 12) * spread
    at = v[:12].copy()
    at[5] = at[4]  # one centroid on top of another: the smaller number wins
    centroids, state, taken = shallot.Centroids(at, np.zeros(12)), shallot.begin(len(v)), []
    for _ in range(5):
        state, n = shallot.search(v, state, centroids)
        plain_d = ((v[:, None, :] - centroids.at[None]) ** 2).sum(axis=2)
        assert (state.first == plain_d.argmin(axis=1)).all()
        second = np.sort(plain_d, axis=1)[:, 1]
        assert (state.lower <= np.sqrt(second)).all() and (state.upper >= np.sqrt(plain_d.min(axis=1))).all()
        after = np.array([v[state.first == k].sum(axis=0) // max(1, (state.first == k).sum()) for k in range(12)])
        after = np.where(np.bincount(state.first, minlength=12)[:, None] > 0, after, centroids.at)
        centroids = shallot.Centroids(after, np.sqrt(shallot.squared(after, centroids.at).astype(float)) * (1 + shallot.SLACK))
        taken.append(n / len(v))
    assert taken[-1] < taken[0] and (spread < 100 or taken[-1] < 1)
