"""Operators against brute force on small fixtures."""

import json
import math
import random
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators import chunks, embed, items, payload, ranking, vectors, worklist
from tidemark.sources.payloads import is_safe_table, payload_union
from tidemark.sources.store import SnapshotStore


def cut(body, longest=2000, shortest=500, overlap=50):
    """Chunks by slicing, one start after the other."""
    step, out, start = longest - overlap, [], 0
    while True:
        out.append(body[start:start + longest])
        if start + longest >= len(body):
            break
        start += step
    if len(out) > 1 and len(out[-1]) < shortest:
        last = out.pop()
        out[-1] += last[overlap:]
    return out


@pytest.mark.parametrize("limits", [(2000, 500, 50), (10, 4, 3), (7, 7, 0), (5, 1, 4)])
def test_chunks_equal_slicing(spark, limits):
    longest, shortest, overlap = limits
    rnd = random.Random(5)
    alphabet = "abc é\n😀"
    sizes = [0, 1, 4, 5, 6, 7, 9, 10, 11, 13, 14, 17, 24, 25, 100] + ([1999, 2000, 2001, 2499, 2500, 3950, 9001] if longest > 100 else [])
    bodies = ["".join(rnd.choice(alphabet) for _ in range(n)) for n in sizes]
    frame = spark.createDataFrame(list(enumerate(bodies)), "i int, text string")
    got = {r.i: r.c for r in frame.select("i", chunks.chunk_texts(F.col("text"), longest, shortest, overlap).alias("c")).collect()}
    for i, body in enumerate(bodies):
        assert got[i] == cut(body, *limits), (i, len(body))
        assert got[i][0][:1] == body[:1] and got[i][-1][-1:] == body[-1:]


def test_chunk_numbers_are_dense(spark):
    frame = spark.createDataFrame([(1, "   ab" + " " * 30 + "cd"), (2, "  "), (3, "x")], "i int, text string")
    rows = chunks.chunk_rows(frame, max_length=5, min_length=1, overlap=0).orderBy("i", "chunk_index").collect()
    assert [(r.i, r.chunk_index, r.num_chunks) for r in rows] == [(1, 0, 2), (1, 1, 2), (3, 0, 1)]
    with pytest.raises(ValueError):
        chunks.chunk_texts(F.lit("x"), 10, 5, 10)


def test_number_chunks_of_a_long_item(spark):
    rows = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("item"), F.col("id").alias("pos"),
        F.when(F.col("id") % 7 == 0, " ").otherwise("t").alias("text"))
    got = chunks.number_chunks(rows, "item", "pos").filter("item = 1").agg(
        F.count("*").alias("n"), F.countDistinct("chunk_index").alias("d"), F.min("chunk_index").alias("lo"),
        F.max("chunk_index").alias("hi"), F.max("num_chunks").alias("num")).first()
    expected = sum(1 for i in range(300_000) if (i % 3 == 0 or i == 1) and i % 7)
    assert (got.n, got.d, got.lo, got.hi, got.num) == (expected, expected, 0, expected - 1, expected)


def test_bucketed_rank_equals_sorting(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice([1, 1, 1, 2, 9]), rnd.randrange(100), rnd.choice("ab")) for i in range(500)]
    frame = spark.createDataFrame(rows, "i int, a int, b int, g string")
    got = {r.i: r["rank"] for r in ranking.bucketed_rank(frame, [F.col("a"), F.expr("b div 10")], [F.col("b"), F.col("i")]).collect()}
    order = sorted(rows, key=lambda r: (r[1], r[2], r[0]))
    assert got == {r[0]: n + 1 for n, r in enumerate(order)}
    within = ranking.bucketed_rank(frame, [F.col("a")], [F.col("b"), F.col("i")], within=["g"], total="n").collect()
    for r in within:
        mine = [x[0] for x in order if x[3] == r.g]
        assert (mine.index(r.i) + 1, len(mine)) == (r["rank"], r.n)


def test_large_limit_equals_top_k(spark, monkeypatch):
    jobs = spark.range(1, 400).select(
        F.col("id").alias("job_id"), (F.col("id") % 3).cast("int").alias("priority"), F.lit("pending").alias("state"),
        F.when(F.col("id") % 5 == 0, F.lit("2030-01-01 00:00:00")).cast("timestamp_ntz").alias("locked_until"))
    small = {r.job_id for r in worklist.claimable(jobs, "2024-01-01 00:00:00", 50).collect()}
    monkeypatch.setattr(ranking, "TOP_K_LIMIT", 10)
    assert {r.job_id for r in worklist.claimable(jobs, "2024-01-01 00:00:00", 50).collect()} == small
    expected = sorted(((-(i % 3), i) for i in range(1, 400) if i % 5))[:50]
    assert small == {i for _, i in expected}
    assert worklist.claim_limit(0) == worklist.claim_limit(-3) == 5


@pytest.mark.parametrize("attempts, retry, state", [(1, True, "pending"), (1, False, "error"), (5, True, "error"), (4, True, "pending")])
def test_retry_ladder(spark, attempts, retry, state):
    row = spark.range(1).select(worklist.failed_state(F.lit(retry), F.lit(attempts)).alias("s")).first()
    assert row.s == state


def test_hashes_and_ids(spark):
    frame = spark.createDataFrame([("h%d" % i, i) for i in range(50)], "h string, i int")
    for r in frame.select("h", "i", text.point_id(F.col("h"), F.col("i")).alias("p"), text.chunk_token(F.col("h"), F.col("i")).alias("t")).collect():
        assert r.p == str(uuid.uuid5(uuid.NAMESPACE_DNS, f"{r.h}{r.i}"))
        assert r.t == (f"{r.h}-{r.i}" if r.i else r.h)
    row = spark.range(1).select(
        text.lower(F.lit("ÄbC")).alias("l"), text.trim(F.lit("\x00\t a \x0b\n")).alias("t"), text.upper_hex(F.lit("aa-zz-9")).alias("x"),
        text.normalise_strings(F.array(*map(F.lit, [" Foo ", "foo", "BAR", "", "  "])), fold_case=True).alias("tags"),
        text.normalise_strings(F.array(*map(F.lit, ["aa-bb", "AABB", "  aabb  ", "zz", ""])), hex_only=True).alias("refs"),
        text.collection_key(F.lit("  ")).alias("k")).first()
    assert (row.l, row.t, row.x, row.tags, row.refs, row.k) == ("Äbc", "a", "AA9", ["foo", "bar"], ["AABB"], "default")


def chunk(**changes):
    base = {"key": "XRM", "index": 0, "text": " Hello ", "hash": "HASH", "meta": {"content_uuid": "aa-bb-cc"}}
    base.update(changes)
    return base


PAYLOAD_CASES = [
    (chunk(), None), (chunk(key=" "), payload.NO_KEY), (chunk(index=-1), payload.BAD_INDEX), (chunk(text="\n "), payload.NO_TEXT),
    (chunk(hash=" "), payload.NO_HASH), (chunk(meta="x"), payload.NO_METADATA), (chunk(meta={}), payload.NO_UUID),
    (chunk(meta={"content_uuid": 5}), payload.NO_UUID), (chunk(meta={"content_uuid": "a", "tags": "x"}), payload.NOT_ARRAY % "tags"),
    (chunk(meta={"content_uuid": "a", "tags": None}), payload.NOT_ARRAY % "tags"),
    (chunk(meta={"content_uuid": "a", "ref_uuids": 1}), payload.NOT_ARRAY % "ref_uuids"),
    (chunk(meta={"content_uuid": "a", "num_chunks": "x"}), payload.NOT_INTEGER),
    (chunk(meta={"content_uuid": "a", "num_chunks": 1.5}), payload.NOT_INTEGER),
    (chunk(meta={"content_uuid": "a", "num_chunks": 0}), payload.NOT_POSITIVE),
    (chunk(meta={"content_uuid": "a", "num_chunks": "0"}), payload.NOT_POSITIVE),
    (chunk(meta={"content_uuid": "a", "archive": 2}), payload.NOT_FLAG % "archive"),
    (chunk(meta={"content_uuid": "a", "public": "2"}), payload.NOT_FLAG % "public"),
    (chunk(meta={"content_uuid": "a", "public": None}), payload.NOT_FLAG % "public"),
    (chunk(meta={"content_uuid": "a", "num_chunks": "3", "archive": True, "public": 0, "tags": {"x": "T"}}), None),
]


def chunk_frame(spark, cases):
    rows = [(i, c["key"], c["index"], c["text"], c["hash"], json.dumps(c["meta"])) for i, c in enumerate(cases)]
    return spark.createDataFrame(rows, "job_id int, chunk_collection_key string, chunk_index int, text string, hash string, m string").withColumn(
        "metadata", F.parse_json("m")).drop("m")


def test_payload_messages(spark):
    frame = chunk_frame(spark, [c for c, _ in PAYLOAD_CASES])
    got = {r.job_id: r.invalid_reason for r in payload.reject_chunks(frame).drop("metadata").collect()}
    assert got == {i: reason for i, (_, reason) in enumerate(PAYLOAD_CASES) if reason}
    valid = {r.job_id: r for r in payload.build_payload(frame).collect()}
    assert set(valid) == {i for i, (_, reason) in enumerate(PAYLOAD_CASES) if not reason}
    assert (valid[0].text, valid[0].content_uuid, valid[0].chunktoken, valid[0].collection_key) == ("Hello", "AABBCC", "HASH", "xrm")
    last = valid[len(PAYLOAD_CASES) - 1]
    assert (last.num_chunks, last.archive, last.public, last.tags, last.meta) == (3, 1, 0, ["t"], None)


def test_payload_fields(spark):
    meta = {
        "content_uuid": "zz", "name": "  ", "tags": [" Foo ", "foo", "BAR", "", 7, True, {"a": 1}], "ref_uuids": ["aa-bb", "AABB", "zz"],
        "job_id": 1, "state": "x", "action": "y", "collectionKey": "z", "custom": 1, "nested": {"a": 1}, "url": 12, "filename": True, "lang": 1.5}
    row = payload.build_payload(chunk_frame(spark, [chunk(meta=meta, index=3)])).first()
    assert (row.content_uuid, row.name, row.tags, row.ref_uuids, row.chunktoken) == ("", None, ["foo", "bar", "7", "1"], ["AABB"], "HASH-3")
    assert (row.url, row.filename, row.lang) == ("12", "1", "1.5")
    assert json.loads(row.meta) == {"custom": 1, "nested": {"a": 1}}


def test_search_equals_brute_force(spark):
    rnd = np.random.default_rng(1)
    data = rnd.normal(size=(400, 8)).astype(np.float32)
    data[50] = data[51] = data[52]
    frame = spark.createDataFrame(
        [(f"p{i:03d}", row.tolist(), i % 2, 0) for i, row in enumerate(data)], "point_id string, vector array<float>, public int, archive int").repartition(7)
    frame = frame.unionByName(spark.createDataFrame([("short", [1.0], 1, 0), ("none", None, 1, 0), ("zero", [0.0] * 8, 1, 0)], frame.schema))
    queries = {f"q{i}": rnd.normal(size=8).tolist() for i in range(5)} | {"hit": data[51].tolist()}
    got = vectors.search(frame, queries, 6, min_score=0.2, spec={"must": {"public": [0, 1]}}).collect()
    for name, q in queries.items():
        q = np.asarray(q)
        scores = sorted(
            ((-(row.astype(float) @ q) / math.sqrt((row.astype(float) ** 2).sum() * (q @ q)), f"p{i:03d}") for i, row in enumerate(data)))
        expected = [p for s, p in scores if -s >= 0.2][:6]
        mine = sorted((r["rank"], r.point_id) for r in got if r.query_id == name)
        if name == "hit":
            assert [p for _, p in mine][:3] == ["p050", "p051", "p052"]
        else:
            assert [p for _, p in mine] == expected
    visible = {r.point_id for r in vectors.visible(frame, {"must": {"point_id": ["p001", "p002", "zero"]}}).collect()}
    assert visible == {"p001", "zero"}
    with pytest.raises(ValueError):
        vectors.merge_specs({"must": {"public": 1}}, {"must": {"public": 0}})


def test_many_queries_are_split(spark, monkeypatch):
    frame = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(20)], "point_id int, vector array<float>")
    queries = {f"q{i}": [1.0, float(i)] for i in range(7)}
    whole = sorted(map(tuple, vectors.search(frame, queries, 2).collect()))
    monkeypatch.setattr(vectors, "QUERY_BYTES", 40)
    assert sorted(map(tuple, vectors.search(frame, queries, 2).collect())) == whole


def test_cache_embeds_each_text_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def model(texts):
        calls.add(len(texts))
        return [[] if t == "bad" else [float(len(t))] for t in texts]

    rows = spark.createDataFrame([(i, "same" if i < 90 else f"t{i}" if i < 99 else "bad") for i in range(100)], "job_id int, text string")
    empty = spark.createDataFrame([], embed.CACHE)
    cache = spark.createDataFrame(embed.embed_texts(embed.cache_misses(rows, empty, "m"), model, "m").collect(), embed.CACHE)
    assert calls.value == 11 and cache.count() == 10
    assert embed.attach_vectors(rows, cache, "m").count() == 99
    assert [r.text for r in embed.cache_misses(rows, cache, "m").collect()] == ["bad"]
    assert embed.cache_misses(rows, cache, "other").count() == 11


def test_names_and_lookup(spark):
    table = spark.createDataFrame(
        [("A", 1, "h1", "Ärger mit Süd-West"), ("A", 0, "h1", "Southern"), ("B", 0, "h2", None)],
        "content_uuid string, chunk_index int, hash string, name string").withColumn("vector", F.array(F.lit(1.0))).withColumn("point_id", F.col("hash"))
    assert [r.chunk_index for r in vectors.search_names(table, "süd").collect()] == [1]
    assert vectors.search_names(table, "sou").count() == 0
    assert [r.chunk_index for r in vectors.search_names(table, "sou", prefix=True).collect()] == [0]
    assert vectors.search_names(table, " ").count() == 0
    got = vectors.fetch_by_uuid(table, "A", 1)
    assert "vector" not in got.columns and [r.chunk_index for r in got.collect()] == [0]
    hashes = spark.createDataFrame([("h1",), ("h9",), ("h1",)], "hash string")
    assert {r.hash: r.is_stored for r in vectors.exists_by_hash(hashes, table).collect()} == {"h1": True, "h9": False}


def test_private_columns_and_table_names(spark):
    account = spark.createDataFrame([(1, "a", "secret", "d0", "d4", "k")], "id int, accounttype string, description string, data0 string, data4 string, keep string")
    row = payload_union({"account": account, "no good; --": account}).select("dbtable", F.to_json("payload").alias("p")).collect()
    assert [(r.dbtable, json.loads(r.p)) for r in row] == [("account", {"id": 1, "accounttype": "a", "keep": "k"})]
    assert is_safe_table("a_1") and not is_safe_table("a b") and not is_safe_table("") and not is_safe_table("a\n")


def test_refs_and_tags_of_a_hot_entry(spark):
    links = spark.range(50_000).select(F.lit(1).cast("bigint").alias("entry_id"), (F.col("id") % 3 + 10).alias("peer_id"))
    entries = spark.createDataFrame([(10, "A" * 32), (11, "B" * 31), (12, "0" * 32)], "id bigint, uuid string")
    assert items.entry_refs(links, entries).first().ref_uuids == ["A" * 32, "0" * 32]
    tags = links.select("entry_id", F.concat(F.lit(" T"), F.col("peer_id") % 2).alias("tag"))
    assert items.entry_tags(tags).first().tags == ["t0", "t1"]


def test_store_keeps_untouched_partitions(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    schema = "k int, v string"
    assert store.read("t", schema).count() == 0 and store.cursor()["last_changed"] == "1970-01-01 00:00:00"
    rows = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, p string")
    store.write("t", rows, by="p", run="one")
    store.write("t", spark.createDataFrame([(3, "c", "y")], rows.schema), by="p", touched=["y", "z"], run="two")
    store.write("t", rows.limit(0), by="p", run="one")  # repeated step
    assert sorted(map(tuple, store.read("t", schema).collect())) == [(1, "a", "x"), (3, "c", "y")]
    store.write("t", rows.limit(0), by="p", touched=["x"])
    assert [r.k for r in store.read("t", schema).collect()] == [3]
    store.save_cursor(last_changed="2024-01-01 00:00:00", last_run_at=" ")
    assert store.cursor() == {"last_changed": "2024-01-01 00:00:00", "last_uuid": "", "last_run_at": "1970-01-01 00:00:00"}
