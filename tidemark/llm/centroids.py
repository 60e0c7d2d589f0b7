"""Exact rounds of centroid clustering over vectors kept as codes of distinct subvectors.

Components become integers, ``floor(scale * x)``. The dimensions are cut into blocks; a
segment of some thousand vectors keeps, per block, its distinct subvectors once and a code
per vector. Nothing is lost by that, and the segments are written once. In each round the
distance of every distinct subvector to every centroid is worked out once per segment; a
vector's distance is the sum of those of its codes. Sums of a cluster come from how often
each code is in it. So a crowd of equal vectors costs one subvector a block, no vector is
shuffled, and only one row per task and cluster moves.

Vectors of another length, with a null or non-finite component, or with one of 2**21 or
more in size (its distances may pass 64 bits) are left out. Equal distances go to the
smaller cluster number. Rows with equal ids are vectors of their own; among equal hashes
the smaller vector starts a cluster first. A null id is hashed as an empty one. Fewer
vectors than clusters make fewer clusters; no vector, an empty result. Columns other than
those named are left out, whatever they are called.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow import stored

# Vectors of one segment: a code takes two bytes.
SEGMENT = 4096
# Components beyond this are left out: 64 squared differences of them may not fit 64 bits.
MOST = 1 << 27

RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def whole_numbers(vectors: DataFrame, dims: int, scale: int, id_column: str, vector_column: str) -> DataFrame:
    """``vec_id, x``: the integer components of the vectors that can be used."""
    found = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("x"))
    bad = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) >= MOST / scale))
    return found.filter(F.col("x").isNotNull() & (F.size("x") == dims)).filter(~bad).select(
        "vec_id", F.transform("x", lambda v: F.floor(v * F.lit(float(scale))).cast("long")).alias("x"))


def first_centroids(numbers: DataFrame, clusters: int, seed: str) -> list[list[int]]:
    """The vectors whose ids have the smallest hashes."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = numbers.select(F.sha2(name, 256).alias("hash"), "x").orderBy("hash", "x").limit(clusters).collect()
    return [list(r["x"]) for r in rows]


def encoded(x: np.ndarray, width: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per block of dimensions: its distinct subvectors, and the code of each row."""
    dictionaries, codes = [], []
    for low in range(0, x.shape[1], width):
        part = x[:, low:low + width]
        code = np.zeros(len(x), np.int64)
        for column in part.T:
            values, at = np.unique(column, return_inverse=True)
            _, first, code = np.unique(code * len(values) + at, return_index=True, return_inverse=True)
        dictionaries.append(part[first])
        codes.append(code.astype(np.uint16))
    return dictionaries, codes


def segments(numbers: DataFrame, dims: int, width: int, size: int = SEGMENT) -> DataFrame:
    """``ids, sizes, entries, codes``: about ``size`` vectors a row, as dictionaries and codes."""
    def row(ids: list, x: np.ndarray) -> tuple:
        dictionaries, codes = encoded(x, width)
        return (ids, [len(d) for d in dictionaries], b"".join(d.astype(np.int32).tobytes() for d in dictionaries),
                b"".join(c.tobytes() for c in codes))

    def batch_of(ids: list, x: np.ndarray):
        return pa.RecordBatch.from_arrays(
            [pa.array([v], k) for v, k in zip(row(ids, x), (pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary()))],
            names=["ids", "sizes", "entries", "codes"])

    def task(batches):
        ids, parts = [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            ids += batch.column(0).to_pylist()
            parts.append(batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims))
            while len(ids) >= size:
                x = np.concatenate(parts)
                yield batch_of(ids[:size], x[:size])
                ids, parts = ids[size:], [x[size:]]
        if ids:
            yield batch_of(ids, np.concatenate(parts))

    return numbers.select("vec_id", "x").mapInArrow(task, "ids array<long>, sizes array<int>, entries binary, codes binary")


def unpacked(sizes: list[int], entries: bytes, codes: bytes, n: int, dims: int, width: int):
    """The blocks of a segment: first dimension, distinct subvectors, code of each vector."""
    flat, code, at = np.frombuffer(entries, np.int32), np.frombuffer(codes, np.uint16).reshape(-1, n), 0
    for k, size in enumerate(sizes):
        span = min(width, dims - k * width)
        yield k * width, flat[at:at + size * span].reshape(size, span).astype(np.int64), code[k]
        at += size * span


def nearest(blocks: list, centroids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Cluster and squared distance of every vector: partial distances of distinct subvectors, summed by code."""
    total = np.zeros((n, len(centroids)), np.int64)
    for low, subvectors, code in blocks:
        away = subvectors[:, None, :] - centroids[None, :, low:low + subvectors.shape[1]]
        total += (away * away).sum(axis=2)[code]
    cluster = total.argmin(axis=1)
    return cluster, total[np.arange(n), cluster]


def _segment_rows(batch: pa.RecordBatch, dims: int, width: int):
    for ids, sizes, entries, codes in zip(*(batch.column(i) for i in range(4))):
        ids = ids.as_py()
        yield ids, list(unpacked(sizes.as_py(), entries.as_py(), codes.as_py(), len(ids), dims, width))


def moved(parts: DataFrame, centroids: np.ndarray, width: int) -> np.ndarray:
    """The centroids after a round: floors of the exact means; an empty cluster keeps its own."""
    k, dims = centroids.shape

    def task(batches):
        sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for ids, blocks in _segment_rows(batch, dims, width):
                cluster, _ = nearest(blocks, centroids, len(ids))
                counts += np.bincount(cluster, minlength=k)
                for low, subvectors, code in blocks:
                    size = len(subvectors)
                    times = np.bincount(cluster * size + code, minlength=k * size).reshape(k, size)
                    sums[:, low:low + subvectors.shape[1]] += times @ subvectors
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(k), pa.int32()), pa.array(counts), pa.array(list(sums), pa.list_(pa.int64()))], names=["cluster", "n", "sums"])

    found = parts.mapInArrow(task, "cluster int, n long, sums array<long>").groupBy("cluster").agg(
        F.sum("n").alias("n"), F.array(*(F.sum(F.col("sums")[i]) for i in range(dims))).alias("sums"))
    out = centroids.copy()
    for row in found.filter("n > 0").collect():  # a row per cluster
        out[row["cluster"]] = [s // row["n"] for s in row["sums"]]
    return out


def assigned(parts: DataFrame, centroids: np.ndarray, width: int) -> DataFrame:
    """``vec_id, cluster, distance`` of every vector."""
    dims = centroids.shape[1]

    def task(batches):
        for batch in batches:
            for ids, blocks in _segment_rows(batch, dims, width):
                cluster, distance = nearest(blocks, centroids, len(ids))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return parts.mapInArrow(task, "vec_id long, cluster int, distance long")


def cluster(
    vectors: DataFrame, clusters: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: str = "1", width: int = 2,
    id_column: str = "vec_id", vector_column: str = "embedding", segment: int = SEGMENT,
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector that can be used.

    Distances are squared. The inertia is their sum, over the vector's cluster and over all.
    """
    spark = vectors.sparkSession
    numbers = whole_numbers(vectors, dims, scale, id_column, vector_column)
    centroids = np.array(first_centroids(numbers, clusters, seed), np.int64).reshape(-1, dims)
    if not len(centroids):
        return spark.createDataFrame([], RESULT)
    parts = stored(segments(numbers, dims, width, segment), "segments")
    for _ in range(rounds):
        centroids = moved(parts, centroids, width)
    rows = stored(assigned(parts, centroids, width), "assigned")
    sums = {r["cluster"]: r["s"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # a row per cluster
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = spark.createDataFrame(
        [(c, s, sum(sums.values()), names[c]) for c, s in sums.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(facts), "cluster").select(*[f.split()[0] for f in RESULT.split(", ")])
