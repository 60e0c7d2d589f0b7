"""What keeps the work of large tables in proportion: rows moved once, short rows, blocks of bounded size."""

import re
from contextlib import contextmanager

from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators import chunks, enrich, items, names, ranking, similarity, worklist
from tidemark.plans import catalog, sync
from tidemark.sources.payloads import payload_union, table_aliases
from tidemark.sources.views import Sources


@contextmanager
def setting(spark, name, value):
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_packed_texts_come_back(spark):
    values = ["0123456789ABCDEF" * 2, "0123456789abcdef" * 2, "0123456789ABCDEF" * 2 + "\n", "A" * 31, "A" * 33, "", " ", "é\U0001f600", "\x01" + "x" * 16, None]
    rows = spark.createDataFrame([(v,) for v in values], "v string").select("v", text.packed(F.col("v")).alias("p"))
    got = rows.select("v", "p", text.unpacked(F.col("p")).alias("again")).collect()
    assert [r.again for r in got] == values and len({r.p and bytes(r.p) for r in got}) == len(values)
    assert len(got[0].p) == 17


def test_bare_packed_texts_and_ids_come_back(spark):
    h, g = "0123456789ABCDEF" * 2, "F" * 32
    values = [h, h.lower(), h + "\n", "x" * 14, "x" * 15, "x" * 16, "\x00" + "x" * 15, "\x00" + "x" * 14, "\x01" + "x" * 14, "\x01" + "x" * 15, "\x02", "", "-", ",", "é" * 8, "\U0001f600" * 4, "\U0001f600" * 3 + "abc", None]
    rows = spark.createDataFrame([(v,) for v in values], "v string").select("v", text.packed(F.col("v"), bare=True).alias("p"))
    got = rows.select("v", "p", text.unpacked(F.col("p"), bare=True).alias("again")).collect()
    assert [r.again for r in got] == values and len({r.p and bytes(r.p) for r in got}) == len(values)
    assert [len(r.p) for r in got if r.v == h] == [16] and all(r.p is None or len(r.p) != 16 for r in got if r.v != h)

    threes = [(u, v, e) for u in values if u is not None for v in [*values, g] for e in [*values, g]]
    rows = spark.createDataFrame(threes, "u string, v string, e string")
    rows = rows.select("*", text.packed_ids(*[text.packed(F.col(c), bare=True) for c in ("u", "v", "e")]).alias("p"))
    got = rows.select("u", "v", "e", "p", *[c.alias(f"a{i}") for i, c in enumerate(text.unpacked_ids(F.col("p")))]).collect()
    assert all((r.u, r.v, r.e) == (r.a0, r.a1, r.a2) for r in got) and len({bytes(r.p) for r in got}) == len(threes)
    assert {len(r.p) for r in got if r.u == h and r.v == r.e == g} == {33}


def test_items_move_no_names_of_types(spark):
    """Types are joined to rows that have met their payload; rows of unknown types and of repeated ones stay as they were."""
    ts = "timestamp_ntz'2024-01-01 00:00:00'"
    jobs = spark.sql("SELECT id AS job_id, cast(id AS string) AS source_uuid, 'v' AS source_version, 'k' AS collection_key, 'upsert' AS job_type FROM range(1, 6)")
    entries = spark.sql(f"SELECT id, cast(id AS string) AS uuid, cast(id AS int) AS type_id, 'v' AS etag, 0 AS archive, {ts} AS created, {ts} AS changed FROM range(1, 6)")
    types = spark.createDataFrame([(1, "file", "t1"), (2, "", ""), (3, "text", "t1"), (3, "text", "t1"), (5, None, None)], "id int, alias string, dbtable string")
    payloads = payload_union({"t1": spark.sql("SELECT id, 'x' AS a FROM range(1, 6)")})
    none = [spark.sql(q) for q in ("SELECT 1L AS entry_id, 1 AS user_id, 'visitor' AS mode", "SELECT 1L AS entry_id, 1 AS lang_id, 'n' AS name", "SELECT 1L AS entry_id, 'T' AS tag", "SELECT 1L AS entry_id, 7L AS peer_id")]
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        built = items.upsert_items(jobs, entries, types, payloads, *none)
        plan = built._jdf.queryExecution().optimizedPlan().toString()
        assert sorted((r.job_id, r.type_alias) for r in built.collect()) == [(1, "file"), (3, "text"), (3, "text")]
    kinds = next(x for x in plan.split("\n") if "strategy=broadcast" in x)
    payload = next(x for x in plan.split("\n") if "Join Inner" in x and "entry_id" in x)
    assert kinds.index("Join") < payload.index("Join")  # above it, so later


def test_items_are_built_from_listed_references(spark, records):
    """What lists them is shuffled in an earlier step, and their join moves them no more."""
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        built = catalog.QUERIES["item_build"](spark, records.sf_dir)
        plan = plan_of(built)
        assert "REPARTITION_BY_COL" not in plan and "collect_set" not in plan
        assert "Bucketed: true" in plan and re.search(r"refs_[0-9a-f]{32}", plan)
        want = items.upsert_items(
            worklist.accepted(records.jobs), records.sysentry, records.systype, payload_union(records.payloads), records.access, records.names, records.tags, records.links)
        got, want = ({r.job_id: r for r in df.collect()} for df in (built, catalog.plain(catalog._item_columns(want))))
        assert got == want and any(r.ref_uuids for r in got.values())


def test_tables_in_buckets_are_joined_in_place(spark):
    rows = spark.sql("SELECT id AS entry_id, array(cast(id AS string)) AS ref_uuids FROM range(500) UNION ALL SELECT null, array('x')")
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        kept = catalog.in_buckets(rows, "kept", "entry_id")
        assert sorted(map(str, kept.collect())) == sorted(map(str, rows.collect()))
        assert all(".zstd." in f for f in kept.inputFiles())
        both = spark.range(300).withColumnRenamed("id", "entry_id").join(kept, "entry_id", "left")
        assert plan_of(both).count("Exchange hashpartitioning") == 1 and both.filter("ref_uuids[0] = cast(entry_id AS string)").count() == 300


def test_items_are_moved_once_and_as_bytes(spark, records):
    r = records
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        built = items.upsert_items(r.jobs, r.sysentry, r.systype, payload_union(r.payloads), r.access, r.names, r.tags, r.links)
        plan = plan_of(built)
    assert "hashpartitioning(type_id" not in plan
    joined = [re.sub(r"#\d+L?", "", x) for x in re.findall(r"SortMergeJoin \[([^\]]*)\], \[[^\]]*\], (?:Inner, \(|LeftOuter)", plan)]
    assert len(joined) >= 5 and not any("dbtable" in x for x in joined)
    assert "hashpartitioning(dbtable" not in plan and "hashpartitioning(_table" not in plan and "unhex" in plan


def test_a_payload_of_another_table_is_no_payload(spark):
    ts = "timestamp_ntz'2024-01-01 00:00:00'"
    jobs = spark.sql("SELECT 1L AS job_id, 'AA' AS source_uuid, cast(null AS string) AS source_version, 'k' AS collection_key, 'upsert' AS job_type "
                     "UNION ALL SELECT 2L, 'BB', 'v', 'k', 'upsert' UNION ALL SELECT 3L, 'CC', 'v', 'k', 'upsert'")
    entries = spark.sql(f"SELECT id, uuid, 1 AS type_id, etag, 0 AS archive, {ts} AS created, {ts} AS changed FROM VALUES (5L, 'aa', 'e'), (6L, 'bb', null), (7L, 'CC', 'E'), (7L, 'CC', 'E') AS t(id, uuid, etag)")
    types = spark.createDataFrame([(1, "file", "t1")], "id int, alias string, dbtable string")
    payloads = payload_union({"t1": spark.sql("SELECT 5L AS id, 'x' AS a UNION ALL SELECT 7L, 'y'"), "t2": spark.sql("SELECT 6L AS id, 'z' AS a UNION ALL SELECT 5L, 'w'")})
    none = [spark.sql(q) for q in ("SELECT 5L AS entry_id, 1 AS user_id, 'visitor' AS mode", "SELECT 5L AS entry_id, 1 AS lang_id, 'n' AS name", "SELECT 5L AS entry_id, 'T' AS tag", "SELECT 5L AS entry_id, 7L AS peer_id")]
    got = items.upsert_items(jobs, entries, types, payloads, *none).select("job_id", "content_uuid", "content_version", "content.sysentry.etag").collect()
    assert sorted(tuple(r) for r in got if r.job_id == 1) == [(1, "AA", None, "E")] and [r.job_id for r in got].count(3) == 2 and len(got) == 3


def test_references_are_the_first_of_equal_ids_in_order(spark):
    a, b, c = "A" * 32, "B" * 32, "C" * 32
    entries = spark.createDataFrame([(4, a), (2, b), (3, a.lower()), (1, c), (1, c), (9, "short"), (8, None)], "id long, uuid string")
    links = spark.createDataFrame([(7, p) for p in (4, 3, 2, 1, 9, 8, 5, 4, None)] + [(6, 4), (6, 4), (None, 2)], "entry_id long, peer_id long")
    got = {r.entry_id: r.ref_uuids for r in items.entry_refs(links, entries).collect()}
    assert got == {7: [c, b, a], 6: [a], None: [b]}
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        assert len(re.findall("Exchange hashpartitioning", plan_of(items.entry_refs(links, entries)))) == 4


def test_texts_are_cut_above_the_join_that_picks_them(spark):
    texts = spark.createDataFrame([(1, "ab cd ef"), (2, "   "), (3, None), (4, ""), (5, "abc")], "id long, text string")
    picked = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 5, 6)], "id long")
    cut = chunks.chunk_rows(texts.join(picked, "id"), max_length=3, min_length=1, overlap=0)
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" in plan and "regexp_extract_all" not in plan[plan.index("Join Inner"):]
    got = sorted((r.id, r.chunk_index, r.num_chunks, r.text) for r in cut.collect())
    assert got == [(1, 0, 3, "ab "), (1, 1, 3, "cd "), (1, 2, 3, "ef"), (5, 0, 1, "abc")]


def test_a_large_claim_cuts_payloads_and_side_tables_and_keeps_every_item(spark, tmp_path):
    ts = "timestamp_ntz'2024-01-01 00:00:00'"
    jobs = spark.sql("SELECT 1L AS job_id, 'AA' AS source_uuid, cast(null AS string) AS source_version, 'k' AS collection_key, 'upsert' AS job_type "
                     "UNION ALL SELECT 2L, 'BB', 'v', 'k', 'upsert' UNION ALL SELECT 3L, 'CC', 'v', 'k', 'upsert' UNION ALL SELECT 3L, 'CC', 'v', 'k', 'upsert' "
                     "UNION ALL SELECT 4L, 'DD', 'v', 'k', 'delete' UNION ALL SELECT null, 'EE', 'v', 'k', 'upsert'")
    entries = spark.sql(f"SELECT id, uuid, t AS type_id, etag, 0 AS archive, {ts} AS created, {ts} AS changed FROM VALUES "
                        "(5L, 'aa', 'e', 1), (6L, 'bb', null, 1), (7L, 'CC', 'E', 2), (7L, 'CC', 'E', 2), (8L, 'DD', 'E', 1), (9L, 'EE', 'E', 2), (null, 'AA', 'x', 1), (4L, null, 'x', 1) AS t(id, uuid, etag, t)")
    types = spark.createDataFrame([(1, "tag", "t1"), (2, "text", "t2"), (3, "file", "t3")], "id int, alias string, dbtable string")
    payloads = {
        "t1": spark.sql("SELECT * FROM VALUES (5L, ' x '), (7L, 'wrong'), (8L, 'y'), (null, 'z'), (1L, 'unclaimed') AS t(id, tag)"),
        "t2": spark.sql("SELECT * FROM VALUES (7L, 'one'), (7L, 'one'), (9L, null), (6L, 'wrong') AS t(id, text)"),
        "t3": spark.sql("SELECT 7L AS id, 'f' AS filename")}
    sides = [spark.sql(q) for q in (
        "SELECT * FROM VALUES (5L, 1, 'visitor'), (5L, 1, 'visitor'), (1L, 1, 'visitor'), (null, 1, 'visitor') AS t(entry_id, user_id, mode)",
        "SELECT * FROM VALUES (5L, 1, 'n'), (5L, 2, ' m '), (7L, 1, null), (1L, 1, 'o') AS t(entry_id, lang_id, name)",
        "SELECT * FROM VALUES (7L, ' T'), (7L, 't'), (null, 'u'), (1L, 'v') AS t(entry_id, tag)",
        "SELECT * FROM VALUES (5L, 7L), (5L, 7L), (1L, 5L), (null, 5L) AS t(entry_id, peer_id)")]
    src = Sources(entries, types, payloads, *sides)
    path = str(tmp_path / "wanted")
    items.wanted_jobs(jobs, entries, types).write.parquet(path)
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        rows = sync.wanted_rows(spark.read.parquet(path), src)
        whole = items.upsert_items(jobs, entries, types, enrich.enriched_union(payloads, table_aliases(types)), *sides)
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("LeftSemi") >= 5 and plan.index("to_variant_object") < plan.index("LeftSemi")
        assert len(re.findall("BroadcastHashJoin", plan_of(rows))) == 0  # its ids may be too many to send to every task
        columns = [c for c in whole.columns if c != "content"] + [F.to_json("content").alias("content")]
        got, want = (sorted(map(str, df.select(*columns).collect())) for df in (rows, whole))
    assert got == want and len(want) == 10
    assert sync.wanted_rows(spark.read.parquet(path).limit(0), src).count() == 0


def test_letters_and_ids_are_folded_as_before(spark):
    values = ["aB-c9", "AbCdEf0123456789" * 2, "abc", "A B", "\u212a\u0130X", "Äz", "", " ", "g", "0\n", None]
    rows = spark.createDataFrame([(v,) for v in values], "v string")
    got = rows.select("v", text.lower(F.col("v")).alias("l"), text.upper_hex(F.col("v")).alias("h")).collect()
    fold = str.maketrans(text.UPPER, text.LOWER)
    assert [r.l for r in got] == [v if v is None else v.translate(fold) for v in values]
    assert [r.h for r in got] == [v if v is None else re.sub("[^0-9a-fA-F]", "", v).upper() for v in values]


def test_blocks_are_never_longer_than_asked(spark):
    rows = spark.range(0, 1000, 1, 1).selectExpr("0 AS key", "cast(id AS string) AS id", "array(cast(id AS float), 1f) AS vector")
    got = similarity.blocks(rows, 2, 64).selectExpr("size(ids) AS n", "length(unit) AS bytes").collect()
    assert sorted(r.n for r in got) == [40] + [64] * 15 and all(r.bytes == r.n * 16 for r in got)


def test_exact_search_shuffles_in_proportion(spark):
    """Blocks of rows are not repeated for blocks of queries before they move."""
    rows = spark.range(600).selectExpr("cast(id AS string) AS point_id", "array(cast(id % 97 AS float), cast(id % 13 AS float)) AS vector").withColumn("query_id", F.col("point_id"))
    seen, plain = [], similarity.meet
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        try:
            similarity.meet = lambda both, *a: (seen.append(plan_of(both)), plain(both, *a))[1]
            got = similarity.search_frame(rows, rows.select("query_id", "vector"), 3, 2, query_block=32, row_block=16)
        finally:
            similarity.meet = plain
    assert "CartesianProduct" in seen[0] and "Generate" not in seen[0] and seen[0].count("Exchange RoundRobin") == 2
    assert got.count() == 1800


def test_the_name_dictionary_holds_each_word_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(names, "RANGE_ROWS", 100)
    table = spark.range(1000).selectExpr("cast(id % 900 AS string) AS point_id", "concat('shared name of entry', id % 900, ' shared') AS name")
    names.build_name_index(table, str(tmp_path))
    postings, words = (spark.read.parquet(f"{tmp_path}/{x}") for x in ("postings", "words"))
    assert words.count() == 903 and postings.count() == 900 * 4
    assert len(postings.inputFiles()) > 20  # 4,000 rows in ranges of a hundred
    asked = spark.createDataFrame([("a", "entry89 sh"), ("b", "na of"), ("c", "entry8999"), ("d", "")], "query_id string, query string")
    got = names.lookup_names(spark, str(tmp_path), asked, prefix=True).groupBy("query_id").count().collect()
    assert {r.query_id: r["count"] for r in got} == {"a": 11, "b": 900}


def test_rows_are_made_once_for_their_ranks(spark):
    made = spark.sparkContext.accumulator(0)

    def seen(x):
        made.add(1)
        return x

    rows = spark.range(500).select(F.udf(seen, "long")("id").alias("id"))
    ranked = ranking.ordered_rank(rows, [F.col("id").desc()])
    assert {r.id: r["rank"] for r in ranked.collect()} == {i: 500 - i for i in range(500)} and made.value == 500


def test_encoding_and_decoding_do_not_share_a_task(spark):
    import corpus_pipeline

    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    coded = corpus_pipeline.byte_bpe(spark, docs, "")
    assert plan_of(coded).count("MapInArrow") == 1
    assert {r.doc_id: r.text for r in coded.collect()} == {1: "some words", 2: ""}
