import hashlib
import math
import random

import numpy as np
import pytest

from tidemark.llm import centroids


def plain(rows, k, rounds, dims, scale, seed):
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) and abs(x) < centroids.MOST / scale for x in v)]
    if not kept:
        return []
    name = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    centers = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def place(v):
        away = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centers]
        return away.index(min(away)), min(away)

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(place(v)[0], []).append(v)
        centers = [[sum(c) // len(groups[j]) for c in zip(*groups[j])] if j in groups else c for j, c in enumerate(centers)]
    final = [(i, *place(v)) for i, v in kept]
    inertia = {}
    for _, c, d in final:
        inertia[c] = inertia.get(c, 0) + d
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, centers[c])).encode()).hexdigest())
                   for i, c, d in final), key=str)


def table(rng, n, dims):
    out = [(i, [rng.gauss(0, 0.3) for _ in range(dims)]) for i in range(n)]
    out += [(rng.randrange(n), out[3][1]) for _ in range(n // 2)]  # a crowd of equal vectors, ids that repeat
    bad = [None, [], [0.1] * (dims - 1), [0.1] * (dims + 1), [None] * dims, [float("nan")] * dims, [float("inf")] + [0.0] * (dims - 1), [1e30] * dims]
    out += [(10_000 + i, v) for i, v in enumerate(bad)]
    return out + [(None, [0.5] * dims), (None, [0.25] * dims), (-3, [-1.0] * dims), (-4, [0.0] * dims), (-5, [2.0 ** 20] * dims)]


@pytest.mark.parametrize("dims, width, segment", [(6, 2, 4096), (7, 3, 10), (4, 9, 7)])
def test_equals_the_plain_version(spark, dims, width, segment):
    rows = table(random.Random(dims), 90, dims)
    df = spark.createDataFrame([(i, v, 1, 1) for i, v in rows], "vec_id long, embedding array<double>, cluster long, x long").repartition(3)
    got = centroids.cluster(df, 5, 3, dims, 64, "1", width, segment=segment)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows, 5, 3, dims, 64, "1")


def test_fewer_vectors_than_clusters_and_none(spark):
    rows = [(1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [-0.5, 0.1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted((tuple(r) for r in centroids.cluster(df, 16, 3, 2).collect()), key=str) == plain(rows, 16, 3, 2, 64, "1")
    assert centroids.cluster(df.limit(0), 16, 3, 2).count() == 0
    assert centroids.cluster(df, 16, 3, 3).count() == 0


def test_codes_lose_nothing():
    x = np.random.default_rng(1).integers(-9, 9, (500, 10))
    dictionaries, codes = centroids.encoded(x, 3)
    assert (np.concatenate([d[c] for d, c in zip(dictionaries, codes)], axis=1) == x).all()
    assert all(len(np.unique(d, axis=0)) == len(d) for d in dictionaries)
