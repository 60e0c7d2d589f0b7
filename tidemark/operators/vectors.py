"""The vector table: write modes, deletes, lookups and cosine search."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import text
from tidemark.operators.payload import FIELDS

# The columns of the stored table.
POINT = (
    "point_id string, text string, hash string, collection_key string, content_uuid string, "
    "chunktoken string, chunk_index int, source_id string, name string, type_alias string, "
    "content_id string, url string, filename string, lang string, created_at string, updated_at string, "
    "num_chunks int, archive int, public int, tags array<string>, ref_uuids array<string>, "
    "meta string, vector array<float>"
)

# The default visibility rule of retrieval.
VISIBLE = {"must": {"public": 1, "archive": 0}}

MODES = ("skip", "append", "replace")

# A batch of query vectors travels with every task, so its size is bounded.
QUERY_BYTES = 64 * 1024 * 1024
# Values of one lookup that are pushed down to the scan one by one.
PUSHED_VALUES = 500
# What the files of the table are written with, so that a lookup by hash or entry reads few row groups.
LOOKUP_OPTIONS = {
    "parquet.bloom.filter.enabled#hash": "true", "parquet.bloom.filter.enabled#content_uuid": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
}
# Groups of tasks whose best rows of a query are merged before the last step.
MERGE_GROUPS = 64


def with_point_ids(rows: DataFrame) -> DataFrame:
    return rows.withColumn("point_id", text.point_id(F.col("hash"), F.col("chunk_index")))


# -- writes


def skip_known(items: DataFrame, table: DataFrame) -> DataFrame:
    """Items (or rows) whose hash is not stored yet."""
    return items.join(table.select("hash").distinct(), "hash", "left_anti")


def delete_matching(table: DataFrame, content: DataFrame) -> DataFrame:
    """The table without the rows of the given ``content_uuid`` values."""
    gone = content.select("content_uuid").distinct()
    return table.join(gone, "content_uuid", "left_anti").select(*table.columns)


def upsert(table: DataFrame, rows: DataFrame, mode: str = "replace") -> DataFrame:
    """The table after a write.

    ``skip`` leaves items alone whose hash is stored, ``append`` adds and takes the place of
    points of the same id only, ``replace`` first removes all rows of the written
    ``content_uuid`` values. In every mode a point id is there once.
    """
    rows = rows.dropDuplicates(["point_id"])
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}")
    if mode == "skip":
        return table.unionByName(skip_known(rows, table).select(*table.columns))
    return replace_points(delete_matching(table, rows) if mode == "replace" else table, rows)


def replace_points(table: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per point id: a written point takes the place of the stored one."""
    return table.join(rows.select("point_id"), "point_id", "left_anti").select(*table.columns).unionByName(
        rows.select(*table.columns))


# -- filters


def filter_spec(table: DataFrame, spec: dict | None) -> Column:
    """``{"must": {field: value}}`` as a predicate; lists match when they contain the value.

    Several values of one field mean "any of them", ``None`` a missing one. Plain comparisons reach the scan.
    """
    out = F.lit(True)
    for field, value in (spec or {}).get("must", {}).items():
        wanted = list(value) if isinstance(value, (list, tuple, set)) else [value]
        col = F.col(field)
        if value is None:
            out = out & col.isNull()
            continue
        if isinstance(table.schema[field].dataType, T.ArrayType):
            test = F.array_contains(col, wanted[0]) if len(wanted) == 1 else F.arrays_overlap(col, F.array(*map(F.lit, wanted)))
        else:
            test = col == wanted[0] if len(wanted) == 1 else col.isin(wanted)
        out = test if out is None else out & test
    return out


def merge_specs(*specs: dict | None) -> dict:
    """All conditions of all specs together; contradicting ones cannot be merged."""
    must: dict = {}
    for spec in specs:
        for field, value in (spec or {}).get("must", {}).items():
            if must.setdefault(field, value) != value:
                raise ValueError(f"contradicting conditions on {field}")
    return {"must": must}


def visible(table: DataFrame, spec: dict | None = None) -> DataFrame:
    """Public rows that are not archived, and match ``spec`` too; unknown is not visible."""
    return table.filter(filter_spec(table, VISIBLE)).filter(filter_spec(table, spec))


# -- lookups


def pushed_equals(column: str, values: list) -> Column:
    """``column`` is one of ``values``, as comparisons that each reach the files' statistics and bloom filters."""
    tests = [F.col(column) == v for v in values] or [F.lit(False)]
    while len(tests) > 1:
        tests = [a | b for a, b in zip(tests[::2], tests[1::2])] + ([tests[-1]] if len(tests) % 2 else [])
    return tests[0]


def rows_with(table: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """The rows of a stored table whose ``column`` holds one of the values of ``wanted``.

    Up to a bound the values are pushed down one by one, and most row groups are not read;
    more of them are joined. Both give the same rows.
    """
    values = [r[0] for r in wanted.select(column).distinct().limit(PUSHED_VALUES + 1).collect()]
    if len(values) > PUSHED_VALUES:
        return table.join(wanted.select(column).distinct(), column, "left_semi").select(*table.columns)
    return table.filter(pushed_equals(column, [v for v in values if v is not None]))


def exists_by_hash(hashes: DataFrame, table: DataFrame) -> DataFrame:
    """Each distinct hash and whether the table holds it."""
    stored = table.select("hash").distinct().withColumn("_stored", F.lit(True))
    return hashes.select("hash").distinct().join(stored, "hash", "left").select(
        "hash", F.coalesce("_stored", F.lit(False)).alias("is_stored"))


def fetch_by_uuid(table: DataFrame, content_uuid: str, limit: int = 50) -> DataFrame:
    """The first rows of one entry in chunk order, without the vector."""
    rows = table.filter(F.col("content_uuid") == content_uuid)
    return rows.select(*[c for c in table.columns if c != "vector"]).orderBy("chunk_index", "point_id").limit(limit)


def name_tokens(name: Column) -> Column:
    """Lower-case words of a name."""
    return F.filter(F.split(F.lower(name), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def search_names(table: DataFrame, query: str, prefix: bool = False) -> DataFrame:
    """Rows whose name holds all words of the query, or words that start with them."""
    words = name_tokens(F.lit(query))
    tokens = name_tokens(F.col("name"))

    def found(word: Column) -> Column:
        return F.exists(tokens, lambda t: F.startswith(t, word)) if prefix else F.array_contains(tokens, word)

    return table.filter(F.forall(words, found) & (F.size(words) > 0))


# -- search


def _as_matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the right length as a matrix, and their positions."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.asarray(column.value_lengths().fill_null(-1))
    rows = np.flatnonzero(lengths == dim)
    flat = np.asarray(column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    return flat.reshape(len(rows), dim), rows


def search(
    table: DataFrame,
    queries: dict[str, list[float]],
    limit: int,
    min_score: float | None = None,
    spec: dict | None = None,
    id_col: str = "point_id",
) -> DataFrame:
    """The best rows per query by cosine: ``(query_id, point_id, score, rank)``.

    Filters and the column list reach the scan. Each task scores its Arrow batches with
    one matrix product and keeps its own best ``limit`` rows per query, so what is
    shuffled is ``tasks x queries x limit`` rows, however large the table is. Equal
    scores are ordered by id.
    """
    if not queries:
        raise ValueError("no query vector")
    names = sorted(queries)
    matrix = np.asarray([queries[n] for n in names], dtype=np.float64)
    if matrix.nbytes > QUERY_BYTES:
        half = len(names) // 2
        if half == 0:
            raise ValueError("one query vector exceeds the size bound")
        first, second = ({n: queries[n] for n in part} for part in (names[:half], names[half:]))
        return search(table, first, limit, min_score, spec, id_col).unionByName(
            search(table, second, limit, min_score, spec, id_col))
    dim = matrix.shape[1]
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    unit = matrix / np.where(norms == 0, 1, norms)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(names)
        id_arrow = None
        for batch in batches:
            id_arrow = batch.column(0).type
            vectors, rows = _as_matrix(batch.column(1), dim)
            if not len(rows):
                continue
            ids = np.asarray(batch.column(0).take(pa.array(rows)).to_pylist(), dtype=object)
            lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
            scores = (vectors / np.where(lengths == 0, 1, lengths)) @ unit.T
            for q in range(len(names)):
                score, key = scores[:, q], ids
                if min_score is not None:
                    keep = score >= min_score
                    score, key = score[keep], key[keep]
                if held[q] is not None:
                    score, key = np.concatenate([held[q][0], score]), np.concatenate([held[q][1], key])
                if len(score) > limit:
                    edge = np.partition(score, len(score) - limit)[len(score) - limit]
                    keep = score >= edge
                    score, key = score[keep], key[keep]
                    order = np.lexsort((key, -score))[:limit]
                    score, key = score[order], key[order]
                held[q] = (score, key)
        for q, top in enumerate(held):
            if top is not None and len(top[0]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[q]] * len(top[0])), pa.array(list(top[1]), id_arrow), pa.array(top[0])],
                    names=["query_id", id_col, "score"])

    id_type = table.schema[id_col].dataType.simpleString()
    wanted = table.filter(filter_spec(table, spec)).select(id_col, "vector")
    local = wanted.mapInArrow(best, f"query_id string, {id_col} {id_type}, score double")
    # Tasks meet in groups first: the last merge of a query reads few rows however many tasks there were.
    some = local.withColumn("group", F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)))
    for keys in (["query_id", "group"], ["query_id"]):
        best_first = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col(id_col))
        some = some.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= limit)
    return some.drop("group")


def payload_columns() -> list[str]:
    return [name for name, *_ in FIELDS] + ["meta"]
