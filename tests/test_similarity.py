"""Search over frames of queries, exact and by index, against plain numpy."""

import numpy as np
import pytest
from pyspark.errors import PySparkException

from tests.conftest import SF_SMALL
from tidemark.operators import similarity


def vectors_of(seed, n, dims, groups=12):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(groups, dims))
    return centers[rng.integers(0, groups, n)] + 0.35 * rng.normal(size=(n, dims))


def frame(spark, matrix, prefix, column):
    return spark.createDataFrame(
        [(f"{prefix}{i:05d}", [float(x) for x in v], i % 3) for i, v in enumerate(matrix)], f"{column} string, vector array<float>, public int")


def plain(table, queries, limit, min_score=None, keep=None):
    t = similarity.unit(table.astype(np.float32).astype(np.float64))
    q = similarity.unit(queries.astype(np.float32).astype(np.float64))
    out = {}
    for i, scores in enumerate(np.round(q @ t.T, similarity.PLACES)):
        rows = [(-s, f"p{j:05d}") for j, s in enumerate(scores) if (keep is None or keep(j)) and (min_score is None or s >= min_score)]
        out[f"q{i:05d}"] = [name for _, name in sorted(rows)[:limit]]
    return {k: v for k, v in out.items() if v}


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append(r.id)
    return out


def test_several_thousand_queries_equal_plain(spark):
    table, queries = vectors_of(1, 500, 8), vectors_of(2, 3000, 8)
    got = similarity.search_frame(frame(spark, table, "p", "point_id"), frame(spark, queries, "q", "query_id"), 5, 8, row_block=64)
    assert found(got) == plain(table, queries, 5)


def test_filters_scores_and_both_kinds_of_join(spark):
    table, queries = vectors_of(3, 300, 6), vectors_of(4, 40, 6)
    args = (frame(spark, table, "p", "point_id"), frame(spark, queries, "q", "query_id"), 4, 6, 0.7, {"must": {"public": 1}})
    want = plain(table, queries, 4, 0.7, lambda j: j % 3 == 1)
    assert found(similarity.search_frame(*args, query_block=7, row_block=10)) == want
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert found(similarity.search_frame(*args, query_block=7, row_block=10)) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_null_zero_and_equal_vectors(spark):
    schema = "point_id string, vector array<float>"
    table = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [1.0, 0.0]), ("n", None), ("z", [0.0, 0.0])], schema)
    queries = spark.createDataFrame([("q", [2.0, 0.0]), ("none", None)], "query_id string, vector array<float>")
    got = similarity.search_frame(table, queries, 3, 2).collect()
    assert sorted((r["rank"], r.id, round(r.score, 6)) for r in got) == [(1, "a", 1.0), (2, "b", 1.0), (3, "z", 0.0)]
    assert similarity.search_frame(table.limit(0), queries, 3, 2).count() == 0
    assert similarity.search_frame(table, queries.limit(0), 3, 2).count() == 0


def test_another_length_is_an_error(spark):
    table = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0])], "point_id string, vector array<float>")
    queries = spark.createDataFrame([("q", [2.0, 0.0])], "query_id string, vector array<float>")
    with pytest.raises(PySparkException, match="vector of 1 values where 2 are expected"):
        similarity.search_frame(table, queries, 3, 2)
    with pytest.raises(PySparkException, match="vector of 2 values where 1 are expected"):
        similarity.search_frame(table, queries, 3, 1)


def test_index_holds_every_row_and_all_lists_are_exact(spark, tmp_path):
    table, queries = vectors_of(5, 900, 8), vectors_of(6, 60, 8)
    path = str(tmp_path / "index")
    centers = similarity.build_index(frame(spark, table, "p", "point_id"), path, 12, 8, sample=300)
    assert spark.read.schema(similarity.INDEX).parquet(path).count() == 900
    asked = frame(spark, queries, "q", "query_id")
    want = plain(table, queries, 10)
    assert found(similarity.search_index(spark, path, centers, asked, 10, 8, probes=99)) == want
    few = found(similarity.search_index(spark, path, centers, asked, 10, 8, probes=4))
    recall = sum(len(set(few.get(q, [])) & set(ids)) for q, ids in want.items()) / sum(map(len, want.values()))
    assert recall >= 0.9


def test_recall_on_the_given_vectors(spark, tmp_path):
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").selectExpr("cast(vec_id AS string) AS point_id", "embedding AS vector")
    path = str(tmp_path / "index")
    centers = similarity.build_index(rows, path, 16, 64)
    asked = rows.selectExpr("point_id AS query_id", "vector")
    exact = found(similarity.search_frame(rows, asked, 10, 64))
    near = found(similarity.search_index(spark, path, centers, asked, 10, 64, probes=12))
    assert sum(len(set(near[q]) & set(ids)) for q, ids in exact.items()) >= 0.9 * sum(map(len, exact.values()))
