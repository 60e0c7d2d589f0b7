"""Registered queries against their DuckDB statements, and the plans of the hot ones."""

import contextlib
import io

import pytest

from __spark_entry__ import oracle_sql, queries
from oracle.check import check
from oracle.sql import ORACLES
from tests.conftest import SF_SMALL
from tidemark.operators import vectors
from tidemark.plans import catalog

QUICK = [
    "enqueue_changed", "enqueue_deletes", "cursor_advance", "seen_merge", "claim_batch", "claim_rejects", "stale_vs_seen",
    "item_public", "item_name", "item_tags", "item_refs", "chunk_documents", "chunk_numbers", "embed_cache_misses", "embed_chunks",
    "payload_typed", "upsert_replace", "point_ids", "search_topk", "stream_seen",
]


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) <= set(queries())
    assert set(catalog.QUERIES) == set(ORACLES)
    assert set(oracle_sql()) <= set(queries())


def test_quick_queries_equal_their_oracle(spark):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        failed = check(spark, SF_SMALL, QUICK)
    assert not failed, out.getvalue()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, tmp_path, records):
    path = str(tmp_path / "points")
    catalog.points(records).write.parquet(path)
    table = spark.read.parquet(path)
    text = plan(vectors.visible(table).select("content_uuid"))
    assert "EqualTo(public,1)" in text and "EqualTo(archive,0)" in text
    assert "ReadSchema: struct<content_uuid:string,archive:int,public:int>" in text


@pytest.mark.parametrize("name", ["search_topk", "seen_merge", "item_refs", "supersede_pending"])
def test_no_cross_join(spark, name):
    text = plan(queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
