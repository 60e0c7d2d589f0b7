"""Cosine search for a frame of queries, exact or by an inverted file of centroids.

Queries and rows are packed into blocks; a product of partitions, or a join on the key that
blocks share, brings them together, one matrix product scores them, and a task keeps its best rows per query. The
best of all tasks are merged in two steps. Neither queries nor rows go through the driver.

Exact search gives every block of rows every block of queries; the number of products is the
square of the data, what is shuffled is in proportion to it. The index keeps the rows by
their nearest centroid; a query asks only the lists of its nearest centroids, and the rows
there are scored exactly. Asking all lists is the exact search again.

Vectors must have one length: rows of another one are an error, not left out in silence.
Null vectors have no direction; neither have vectors of zeros, whose score is 0. Scores are
rounded to twelve places, and equal ones are ordered by id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.vectors import MERGE_GROUPS, filter_spec
from tidemark.session import work_dir

# Vectors of one block of queries, and of one block of rows.
QUERY_BLOCK, ROW_BLOCK = 1024, 4096
# Blocks of one Arrow batch.
BATCH_BLOCKS = 4
# Exact search: parts of the rows, and blocks of queries that a task holds; they change no result.
ROW_PARTS, GROUP_BLOCKS = 8, 16
# Decimal places of a score: equal vectors tie, wherever in a block they stand.
PLACES = 12
# Vectors that centroids are fitted on: a bound of the sample, whatever the size of the table.
SAMPLE, FIT_ROUNDS = 50_000, 10

INDEX = "list int, id string, vector array<float>"


def checked(vector: Column, dims: int) -> Column:
    """The vector if it has the right length; any other length is an error."""
    wrong = F.concat(F.lit("vector of "), F.size(vector).cast("string"), F.lit(f" values where {dims} are expected"))
    return F.when(vector.isNull() | (F.size(vector) == dims), vector).otherwise(F.raise_error(wrong).cast("array<float>"))


def unit(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(norms == 0, 1, norms)


def matrix_of(column: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dims)


def blocks(rows: DataFrame, dims: int, size: int) -> DataFrame:
    """``key, ids, unit``: the vectors of ``key, id, vector`` rows as matrices of at most ``size`` unit rows.

    Two blocks make a matrix of scores, so none may be longer, however many rows a batch has. A task holds one open block per key; where many keys are open, the blocks it closes are small.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}
        count = 0

        def out(keys):
            done = [(k, held[k][0], np.concatenate(held[k][1]).tobytes()) for k in keys]
            for k in keys:
                del held[k]
            for row in done:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[0]], pa.int64()), pa.array([row[1]], pa.list_(pa.string())), pa.array([row[2]], pa.binary())],
                    names=["key", "ids", "unit"])

        for batch in batches:
            keys, ids = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            vectors = unit(matrix_of(batch.column(2), dims)).astype(np.float64)
            order = np.argsort(keys, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(keys[order])) + 1) if len(order) else ():
                key = int(keys[part[0]])
                while len(part):
                    names, parts = held.setdefault(key, ([], []))
                    fits, part = part[: size - len(names)], part[size - len(names):]
                    names += ids.take(pa.array(fits)).to_pylist()
                    parts.append(vectors[fits])
                    if len(names) >= size:
                        yield from out([key])
            count += len(keys)
            if count >= 8 * size:
                yield from out(list(held))
                count = 0
        yield from out(list(held))

    return rows.filter("vector IS NOT NULL").select(
        F.col("key").cast("long").alias("key"), F.col("id").cast("string").alias("id"), checked(F.col("vector"), dims).alias("vector")
    ).mapInArrow(task, "key long, ids array<string>, unit binary")


def _written(df: DataFrame, purpose: str) -> DataFrame:
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _best(scores: np.ndarray, ids: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``limit`` by score, then id."""
    if len(scores) > limit:
        edge = np.partition(scores, len(scores) - limit)[len(scores) - limit]
        near = scores >= edge
        scores, ids = scores[near], ids[near]
    order = np.lexsort((ids, -scores))[:limit]
    return scores[order], ids[order]


def by_key(rows: DataFrame, queries: DataFrame) -> DataFrame:
    """Pairs of blocks with equal keys.

    How the blocks are joined is left to Spark: a small frame of queries is broadcast, a
    large one meets the rows by shuffle. Where there are fewer keys than partitions the rows
    of a key are split by salt, and its queries go out once per share.
    """
    spark = rows.sparkSession
    shares = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // max(1, queries.select("key").distinct().count()))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(F.col("ids")[0], F.size("ids")), F.lit(shares)))
    asked = queries.select("key", F.col("ids").alias("query_ids"), F.col("unit").alias("query_unit")).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    return salted.join(asked, ["key", "salt"]).select("ids", "unit", "query_ids", "query_unit")


def every_pair(rows: DataFrame, queries: DataFrame) -> DataFrame:
    """All pairs of blocks, as a product of partitions: both sides are shuffled once, and no pair is.

    Rows lie in a fixed number of parts, so that a query has so many lists of best rows at
    most; the queries of a part are held by a task, which reads the rows of a part past them.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = max(-(-parts // ROW_PARTS), -(-queries.count() // GROUP_BLOCKS))
    asked = queries.select(F.col("ids").alias("query_ids"), F.col("unit").alias("query_unit"))
    # The hint names the product of partitions, so that neither side is broadcast by a guess of its size.
    return rows.select("ids", "unit").repartition(ROW_PARTS).hint("shuffle_replicate_nl").crossJoin(asked.repartition(groups))


def meet(both: DataFrame, dims: int, limit: int, min_score: float | None) -> DataFrame:
    """``query_id, id, score``: the best rows per task of every query, over pairs of blocks."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def out():
            for name, (scores, ids) in held.items():
                if len(scores):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(ids), pa.string()), pa.array(list(ids), pa.string()), pa.array(scores)],
                        names=["query_id", "id", "score"])
            held.clear()

        for batch in batches:
            for ids, raw, names, asked_raw in zip(*(batch.column(i) for i in range(4))):
                ids, names = np.array(ids.as_py(), object), names.as_py()
                table = np.frombuffer(raw.as_buffer(), np.float64).reshape(-1, dims)
                product = np.frombuffer(asked_raw.as_buffer(), np.float64).reshape(-1, dims) @ table.T
                np.round(product, PLACES, out=product)
                for name, scores in zip(names, product):
                    found = ids
                    if min_score is not None:
                        near = scores >= min_score
                        scores, found = scores[near], found[near]
                    scores, found = _best(scores, found, limit)
                    if name in held:
                        scores, found = _best(np.concatenate([held[name][0], scores]), np.concatenate([held[name][1], found]), limit)
                    held[name] = (scores, found)
            if len(held) * limit > 2_000_000:
                yield from out()
        yield from out()

    return both.mapInArrow(task, "query_id string, id string, score double")


def merged(local: DataFrame, limit: int) -> DataFrame:
    """``query_id, id, score, rank``: the best rows of each query over all tasks, in two steps."""
    some = local.withColumn("group", F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)))
    for keys in (["query_id", "group"], ["query_id"]):
        best_first = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("id"))
        some = some.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= limit)
    return some.drop("group")


def _with_batches(spark, make) -> DataFrame:
    """Blocks are large rows: few of them make an Arrow batch while ``make`` runs; the caller's setting comes back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(BATCH_BLOCKS))
    try:
        return _written(make(), "scored")
    finally:
        spark.conf.set(name, before)


def search_frame(
    table: DataFrame, queries: DataFrame, limit: int, dims: int, min_score: float | None = None, spec: dict | None = None,
    id_col: str = "point_id", query_block: int = QUERY_BLOCK, row_block: int = ROW_BLOCK,
) -> DataFrame:
    """The best rows of every query: ``query_id, id, score, rank`` with ids as text.

    ``queries`` holds ``query_id, vector``, any number of them; ids must be unique.
    """
    spark = table.sparkSession
    asked = queries.filter("vector IS NOT NULL")
    number = max(1, -(-asked.count() // query_block))
    # A block of queries has the number that its ids hash to.
    keyed = asked.select(F.pmod(F.xxhash64("query_id"), F.lit(number)).alias("key"), F.col("query_id").alias("id"), "vector")
    packed_queries = _written(blocks(keyed.repartition("key"), dims, query_block), "queries")
    wanted = table.filter(filter_spec(table, spec)).select(F.lit(0).alias("key"), F.col(id_col).alias("id"), "vector")
    packed = _written(blocks(wanted, dims, row_block), "rows")
    return merged(_with_batches(spark, lambda: meet(every_pair(packed, packed_queries), dims, limit, min_score)), limit)


# -- inverted file


def fit_centroids(vectors: DataFrame, lists: int, dims: int, sample: int = SAMPLE, seed: int = 7) -> np.ndarray:
    """Unit centroids of ``lists`` groups, fitted on at most ``sample`` vectors taken by a hash of the vector.

    The sample decides how well lists part the space, not which rows are indexed.
    """
    usable = vectors.filter("vector IS NOT NULL").select(checked(F.col("vector"), dims).alias("vector"))
    rows = usable.withColumn("h", F.xxhash64(F.lit(seed), "vector")).orderBy("h").limit(sample).select("vector").collect()
    data = unit(np.array([r["vector"] for r in rows], np.float64).reshape(-1, dims))
    rng = np.random.default_rng(seed)
    centers = data[rng.permutation(len(data))[:lists]]
    for _ in range(FIT_ROUNDS):
        near = (data @ centers.T).argmax(axis=1) if len(centers) else np.empty(0, int)
        sums = np.zeros_like(centers)
        np.add.at(sums, near, data)
        filled = np.bincount(near, minlength=len(centers)) > 0
        centers = np.where(filled[:, None], unit(sums), centers)
    return centers


def nearest_lists(rows: DataFrame, centers: np.ndarray, probes: int, dims: int) -> DataFrame:
    """``id, vector, list``: each row with its ``probes`` nearest centroids, one row each."""
    sent = rows.sparkSession.sparkContext.broadcast(centers)  # lists x dims numbers
    probes = min(probes, len(centers))

    def task(batches):
        for batch in batches:
            scores = unit(matrix_of(batch.column(1), dims)) @ sent.value.T
            order = np.argsort(-scores, axis=1, kind="stable")[:, :probes].astype(np.int32)
            at = np.repeat(np.arange(batch.num_rows), probes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)), pa.array(order.ravel())], names=["id", "vector", "list"])

    return rows.filter("vector IS NOT NULL").select(
        F.col("id").cast("string").alias("id"), checked(F.col("vector").cast("array<float>"), dims).alias("vector")
    ).mapInArrow(task, "id string, vector array<float>, list int")


def build_index(table: DataFrame, path: str, lists: int, dims: int, id_col: str = "point_id", sample: int = SAMPLE) -> np.ndarray:
    """Write every row of the table under its nearest centroid; returns the centroids.

    Rows are rebalanced by list, so that a crowded list is written by several tasks.
    """
    rows = table.select(F.col(id_col).alias("id"), "vector")
    centers = fit_centroids(rows, lists, dims, sample)
    placed = nearest_lists(rows, centers, 1, dims)
    placed.hint("rebalance", F.col("list")).write.partitionBy("list").parquet(path)
    return centers


def search_index(
    spark, path: str, centers: np.ndarray, queries: DataFrame, limit: int, dims: int, probes: int, min_score: float | None = None,
    query_block: int = QUERY_BLOCK, row_block: int = ROW_BLOCK,
) -> DataFrame:
    """The best rows of every query among the lists of its ``probes`` nearest centroids, exactly scored.

    Only the folders of lists that some query asks are read. ``probes`` of all lists and more
    make the search exact.
    """
    asked = _written(nearest_lists(queries.select(F.col("query_id").alias("id"), "vector"), centers, probes, dims), "probes")
    wanted = [r["list"] for r in asked.select("list").distinct().collect()]  # one number per list at most
    rows = spark.read.schema(INDEX).parquet(path).filter(F.col("list").isin(wanted))
    packed = _written(blocks(rows.select(F.col("list").alias("key"), "id", "vector"), dims, row_block), "rows")
    packed_queries = _written(blocks(asked.select(F.col("list").alias("key"), "id", "vector").repartition("key"), dims, query_block), "queries")
    return merged(_with_batches(spark, lambda: meet(by_key(packed, packed_queries), dims, limit, min_score)), limit)
