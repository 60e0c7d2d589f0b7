"""Lookups that skip data: payload rows of a claim, points by hash, names by index; ranks by written ranges."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.operators import items, names, ranking, vectors
from tidemark.sources import schemas
from tidemark.sources.payloads import of_claim, payload_union
from tidemark.sources.views import Records


def scanned_rows(df):
    """Rows that the only scan of a plan without exchanges gave up, after the files' statistics and filters."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().get("numOutputRows").get().value() for i in range(leaves.size()))


@pytest.fixture()
def small_groups(spark, tmp_path):
    """Ten thousand rows sorted by entry, in row groups of a few hundred."""
    path = str(tmp_path / "points")
    rows = spark.range(10_000).select(
        F.upper(F.md5(F.col("id").cast("string"))).alias("content_uuid"), F.sha2(F.col("id").cast("string"), 256).alias("hash"), F.repeat(F.lit("x"), 40).alias("text"))
    rows.repartitionByRange(2, "content_uuid").sortWithinPartitions("content_uuid").write.options(
        **vectors.LOOKUP_OPTIONS, **{"parquet.block.size": "40000", "parquet.block.size.row.check.min": "100", "parquet.page.size.row.check.min": "100"}).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@pytest.mark.parametrize("column", ["hash", "content_uuid"])
def test_a_lookup_reads_few_row_groups(spark, small_groups, column):
    wanted = small_groups.select(column).limit(5)
    found = vectors.rows_with(small_groups, column, wanted)
    assert sorted(r[column] for r in found.collect()) == sorted(r[0] for r in wanted.collect())
    assert scanned_rows(found) < 5_000 < scanned_rows(small_groups.filter("length(text) > 0"))


def test_many_values_are_joined_with_the_same_result(spark, small_groups, monkeypatch):
    wanted = small_groups.select("hash").limit(40).unionByName(spark.createDataFrame([(None,), ("no",)], "hash string"))
    few = sorted(r.hash for r in vectors.rows_with(small_groups, "hash", wanted).collect())
    monkeypatch.setattr(vectors, "PUSHED_VALUES", 10)
    assert few == sorted(r.hash for r in vectors.rows_with(small_groups, "hash", wanted).collect()) and len(few) == 40
    assert vectors.rows_with(small_groups, "hash", wanted.limit(0)).count() == 0


def test_payloads_of_a_claim_are_cut_before_they_are_built(spark, tmp_path):
    r = Records(spark, SF_SMALL)
    jobs = r.jobs.filter("job_type = 'upsert'").orderBy(F.xxhash64("job_id")).limit(30)
    path = str(tmp_path / "claimed")
    items.claimed_entries(jobs, r.sysentry, r.systype).write.parquet(path)
    claimed = spark.read.parquet(path)
    cut = of_claim(r.payloads, claimed)
    assert sum(rows.count() for rows in cut.values()) == claimed.count() <= 30
    assert set(cut) == {x.dbtable for x in claimed.select("dbtable").distinct().collect()}
    plan = payload_union(cut)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("to_variant_object") < plan.index("LeftSemi")  # the join is below what is built
    args = (r.access, r.names, r.tags, r.links)
    whole = items.upsert_items(jobs, r.sysentry, r.systype, payload_union(r.payloads), *args)
    part = items.upsert_items(jobs, r.sysentry, r.systype, payload_union(cut), *args, claimed.select("entry_id"))
    columns = ["job_id", "hash", "name", "tags", "ref_uuids", "public", "size"]
    assert sorted(map(str, whole.select(*columns).collect())) == sorted(map(str, part.select(*columns).collect()))
    assert of_claim(r.payloads, claimed.limit(0)) == {}


def test_payload_of_another_table_with_the_same_id_is_not_taken(spark):
    entries = spark.createDataFrame([(1, "AA", 1, "E", 0, None, None)], schemas.ENTRY)
    types = spark.createDataFrame([(1, "contact", "contacts"), (2, "text", "texts")], schemas.ENTRY_TYPE)
    payloads = payload_union({
        "contacts": spark.createDataFrame([(1, "right")], "id bigint, x string"), "texts": spark.createDataFrame([(1, "wrong")], "id bigint, x string")})
    jobs = spark.createDataFrame([(5, "AA", "E", "contact", "upsert", "pending", 1, 0, None, None, None, None)], schemas.JOB)
    none = [spark.createDataFrame([], s) for s in (schemas.ACCESS, schemas.NAME, schemas.TAG, schemas.LINK)]
    got = items.upsert_items(jobs, entries, types, payloads, *none).select(F.to_json("content.payload").alias("p")).collect()
    assert [r.p for r in got] == ['{"id":1,"x":"right"}']


NAMES = ["Small Ring", "small  ring-box", "Ring", "Größe 12", "größer", None, "", "--", "a small thing", "RINGS small", "small small"]


@pytest.mark.parametrize("prefix", [False, True])
@pytest.mark.parametrize("pushed", [200, 1])
def test_name_index_equals_the_scan(spark, tmp_path, monkeypatch, prefix, pushed):
    monkeypatch.setattr(names, "PUSHED_WORDS", pushed)
    rng = random.Random(3)
    some = NAMES + [" ".join(rng.choice(["small", "ring", "rin", "box", "boxer", "é"]) for _ in range(rng.randrange(1, 4))) for _ in range(60)]
    table = spark.createDataFrame(list(enumerate(some)), "point_id int, name string")
    names.build_name_index(table, str(tmp_path), "point_id")
    asked = ["small ring", "SMALL", "rin", "gr", "größe", "small small", "no such", "", "--", "r s b", "1"]
    lookups = spark.createDataFrame(list(enumerate(asked)), "query_id int, query string")
    got = {(r.query_id, int(r.id)) for r in names.lookup_names(spark, str(tmp_path), lookups, prefix).collect()}
    assert got == {(i, r.point_id) for i, q in enumerate(asked) for r in vectors.search_names(table, q, prefix).collect()}


def test_name_index_of_nothing(spark, tmp_path):
    names.build_name_index(spark.createDataFrame([], "point_id string, name string"), str(tmp_path))
    lookups = spark.createDataFrame([("q", "word")], "query_id string, query string")
    assert names.lookup_names(spark, str(tmp_path), lookups).count() == 0


def test_few_words_read_their_range_only(spark, tmp_path):
    table = spark.range(4000).select(F.col("id").alias("point_id"), F.concat(F.lit("word"), F.col("id")).alias("name"))
    # So few rows would be one range; a large table has many.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        names.build_name_index(table, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    postings = spark.read.schema(names.POSTING).parquet(f"{tmp_path}/postings")
    words = spark.createDataFrame([("word17",), ("word3999",)], "word string")
    assert scanned_rows(names._ranged(postings, "token", words)) < 4000


def test_ordered_rank_equals_sorting(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(20), None if rng.random() < 0.1 else rng.randrange(5), i) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b int, i int").repartition(7)
    got = {r.i: r["rank"] for r in ranking.ordered_rank(df, [F.col("a").desc(), F.col("b").asc_nulls_last(), F.col("i")]).collect()}
    want = sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1] or 0, r[2]))
    assert got == {r[2]: n for n, r in enumerate(want, 1)}
    assert ranking.ordered_rank(df.limit(0), [F.col("a")]).count() == 0
