"""Clustering against plain Python integers, and the bounds of the screening against exact distances."""

import hashlib
import math
import random

import numpy as np
import pytest

from kasane.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, distance string, vector int"


def plain(rows, clusters=16, rounds=3, parts=64):
    """{row: (cluster, distance, cluster_inertia, inertia, sha)} of the rows that count."""
    kept = [(r, i, [math.floor(64 * x) for x in v]) for r, (i, v) in enumerate(rows) if v is not None and len(v) == parts and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: (i is None, hashlib.sha256(f"1:{i}".encode()).hexdigest() if i is not None else "")
    middles = [x for _, _, x in sorted(kept, key=lambda k: (name(k[1]), k[2]))[:clusters]]
    far = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c))
    for turn in range(rounds + 1):
        near = [min((far(x, c), k) for k, c in enumerate(middles)) for _, _, x in kept]
        if turn < rounds:
            for k in range(len(middles)):
                mine = [x for (_, _, x), (_, j) in zip(kept, near) if j == k]
                if mine:
                    middles[k] = [sum(p) // len(mine) for p in zip(*mine)]
    sums = {k: sum(d for d, j in near if j == k) for k in range(len(middles))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middles]
    return [(i, k, d, sums[k], sum(sums.values()), sha[k]) for (_, i, _), (d, k) in zip(kept, near)]


def check(spark, rows, **how):
    table = spark.createDataFrame([(i, v, 1, "x", "y", 2) for i, v in rows], SCHEMA).repartition(3)
    got = [tuple(r) for r in centroids.kmeans(table, **how).collect()]
    fits = lambda d: d if d < 2**63 else None
    want = [(i, k, fits(d), fits(s), fits(t), h) for i, k, d, s, t, h in plain(rows, **how)]
    assert sorted(got, key=str) == sorted(want, key=str)
    return got


def test_against_plain_integers(spark):
    rng = np.random.default_rng(5)
    bases = rng.normal(0, 0.3, (6, 64))
    rows = [(i, [float(np.float32(x)) for x in bases[i % 6] + rng.normal(0, 0.02, 64)]) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(60)] + [rows[3], rows[3]]  # copies and repeated rows
    rows += [(None, rows[7][1]), (300, None), (301, [0.5] * 63), (302, [0.5] * 65), (303, [])]
    rows += [(304, [0.5] * 63 + [None]), (305, [float("nan")] + [0.5] * 63), (306, [float("inf")] + [0.0] * 63), (307, [-0.0] * 64)]
    got = check(spark, rows)
    assert len(got) == 150 + 62 + 1 + 1
    assert len({r[1] for r in got}) > 3


def test_few_many_ties_and_none(spark):
    check(spark, [(i, [float(i % 2)] * 64) for i in range(5)])  # fewer vectors than centroids, equal centroids
    check(spark, [(i, [i % 3 / 64 * s for s in ([1.0, -1.0] * 32)]) for i in range(40)], clusters=4, rounds=2)  # ties between centroids
    assert check(spark, [(1, None), (2, [1.0])]) == []
    empty = centroids.kmeans(spark.createDataFrame([], SCHEMA))
    assert empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and empty.count() == 0


def test_components_of_any_size(spark):
    rng = random.Random(3)
    rows = [(i, [float(np.float32(rng.choice([1, -1]) * 10.0 ** rng.randint(-3, 30))) for _ in range(64)]) for i in range(12)]
    rows += [(50 + i, [float(np.float32(rng.random() * 2**24)) for _ in range(64)]) for i in range(12)] + [(90 + i, [rng.randint(-8, 8) / 8] * 64) for i in range(9)]
    got = check(spark, rows, clusters=5)
    assert any(r[2] is None for r in got) and any(r[2] is not None for r in got)


@pytest.mark.parametrize("size", [3, 10_000, 2**26])
def test_the_nearest_centroid_is_never_screened_out(size):
    """Centroids that differ by little: float32 alone would choose wrongly, the intervals keep the right one on the list."""
    rng = np.random.default_rng(size)
    middle = rng.integers(-size, size + 1, 64)
    found = middle + rng.integers(-1, 2, (16, 64))
    rows = middle + rng.integers(-1, 2, (300, 64))
    exact = ((rows[:, None, :] - found[None]) ** 2).sum(axis=2)
    listed = centroids.short_list(rows, found)
    assert listed[np.arange(300), exact.argmin(axis=1)].all()
    number, distance = centroids.nearest(rows, found)
    assert (number == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    alone = (rows.astype(np.float32) @ found.astype(np.float32).T)
    assert size < 1e6 or ((found.astype(np.float32) ** 2).sum(axis=1) - 2 * alone).argmin(axis=1).tolist() != number.tolist()


def test_screening_leaves_one_centroid_where_they_lie_apart():
    rng = np.random.default_rng(1)
    found = rng.integers(-30, 30, (16, 64))
    listed = centroids.short_list(found.repeat(20, axis=0) + rng.integers(-2, 3, (320, 64)), found)
    assert (listed.sum(axis=1) == 1).all()
