import hashlib
import math

import numpy as np
import pytest

from marketlens.llm import centroids as C

SCHEMA = "vec_id long, embedding array<double>, label int, cluster string, key string, v string"


def brute(rows, k=8, rounds=10, dims=64, seed=3):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    kept.sort(key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    places = [v for _, v in kept[:k]]

    def nearest():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in places]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        at = nearest()
        for c in range(len(places)):
            mine = [v for (_, v), (own, _) in zip(kept, at, strict=True) if own == c]
            if mine:
                places[c] = [sum(column) // len(mine) for column in zip(*mine, strict=True)]
    at = nearest()
    total = sum(d for _, d in at)
    return sorted(
        (
            (key, c, d, sum(e for own, e in at if own == c), total, hashlib.sha256(",".join(map(str, places[c])).encode()).hexdigest())
            for (key, _), (c, d) in zip(kept, at, strict=True)
        ),
        key=str,
    )


def found(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 1, "c", "k", "v") for i, v in rows], SCHEMA).repartition(4)
    result = C.centroid_clusters(df, **options)
    assert result.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in result.collect()), key=str)


def odd_vectors():
    rng = np.random.default_rng(5)
    middles = rng.normal(0, 1, (5, 64))
    rows = [(i, (middles[i % 5] + rng.normal(0, 0.3 * (i % 3), 64)).tolist()) for i in range(60)]
    bad = [[1.0] * 63, [1.0] * 65, [], None, [None] + [0.0] * 63, [float("nan")] + [0.0] * 63, [float("inf")] + [0.0] * 63, [-float("inf")] * 64]
    rows += [(100 + i, v) for i, v in enumerate(bad)]
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[3][1]), (None, rows[4][1]), (200, [0.0] * 64), (201, [-0.0] * 64), (202, [-1e-9] * 64)]
    return rows


def test_odd_vectors(spark):
    """Wrong sizes, missing and infinite components, repeated rows and keys, null keys, ties, clashing names."""
    rows = odd_vectors()
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows, k=3, rounds=2, pivots=1) == brute(rows, 3, 2)


def test_few_or_no_vectors(spark):
    same = [(i, [0.5] * 64) for i in range(30)]
    assert found(spark, same) == brute(same)
    assert found(spark, same[:3] + [(9, [1.0] * 64)]) == brute(same[:3] + [(9, [1.0] * 64)])
    assert found(spark, []) == [] and found(spark, [(1, None), (2, [1.0])]) == []


def test_centroids_without_vectors_stay(spark):
    rows = [(i, [float(i % 4), float(i % 2)]) for i in range(40)]
    assert found(spark, rows, dims=2) == brute(rows, dims=2)


def test_too_large_components_fail(spark):
    with pytest.raises(Exception, match="beyond"):
        found(spark, [(1, [1e30] * 64)])


@pytest.mark.parametrize("kind", ["random", "clustered", "flat", "equal", "large"])
def test_bounds_hold_and_filter(kind):
    rng = np.random.default_rng(3)
    v = rng.integers(-1024, 1024, (400, 64))
    if kind == "clustered":
        v = rng.integers(-900, 900, (8, 64))[np.arange(400) % 8] + rng.integers(-60, 60, (400, 64))
    elif kind == "flat":
        v[:, 2:] = 0
    elif kind == "equal":
        v[:] = 5
    elif kind == "large":
        v = rng.integers(-C.LARGEST, C.LARGEST, (400, 64))
    simplex, places = C.Simplex(v[:16]), v[20:28]
    low, high = C.bounds(simplex.apexes(v), simplex.apexes(places), simplex.longest)
    exact = np.stack([C.squared(v, p) for p in places], axis=1)
    assert (low <= exact).all() and (exact <= high).all()
    nearest, distance, computed = C.assigned(v, simplex.apexes(v), places, simplex)
    assert (nearest == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    if kind in ("clustered", "flat"):
        assert computed < 0.5 * exact.size
