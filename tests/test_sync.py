"""Enqueue and worker runs on a small set of records, end to end and repeated."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from tidemark.operators import embed, enrich, ranking, vectors, worklist
from tidemark.operators.changes import timestamp
from tidemark.plans import sync
from tidemark.sources import schemas
from tidemark.sources.payloads import payload_union
from tidemark.sources.store import SnapshotStore
from tidemark.sources.views import Sources

MODEL = "words"
BUCKETS = sync.Limits(buckets=8)


def uid(n):
    return f"{n:032X}"


def sources(spark, entries):
    """``entries``: (n, type id, etag number, minute of change)."""
    rows = [(n, uid(n), t, uid(e), n % 2, m) for n, t, e, m in entries]
    frame = spark.createDataFrame(rows, "id bigint, uuid string, type_id int, etag string, archive int, m int").select(
        "id", "uuid", "type_id", "etag", "archive", timestamp("2024-01-01 00:00:00").alias("created"),
        (timestamp("2024-01-01 00:00:00") + F.make_dt_interval(mins="m")).alias("changed"))
    contacts = [(n, f" First{n} ", "x" * 10) for n in range(1, 40, 2) if n != 7]
    texts = [(n, "word " * (n * 100), "text/plain") for n in range(2, 40, 2)]
    return Sources(
        entries=frame,
        types=spark.createDataFrame([(1, "contact", "contacts"), (2, "text", "texts"), (3, "odd", "bad name")], schemas.ENTRY_TYPE),
        payloads={
            "contacts": spark.createDataFrame(contacts, "id bigint, firstname string, lastname string"),
            "texts": spark.createDataFrame(texts, "id bigint, text string, mime string"),
            "bad name": spark.createDataFrame([(9, "x")], "id bigint, x string"),
        },
        access=spark.createDataFrame([(2, 1, "visitor"), (3, 2, "visitor")], schemas.ACCESS),
        names=spark.createDataFrame([(2, 1, "one"), (2, 2, " Two "), (3, 1, "x"), (3, 2, " ")], schemas.NAME),
        tags=spark.createDataFrame([(2, " B "), (2, "a"), (2, "b"), (2, " ")], schemas.TAG),
        links=spark.createDataFrame([(2, 4), (2, 1), (2, 4), (2, 999)], schemas.LINK))


@pytest.fixture()
def store(spark, tmp_path):
    return SnapshotStore(spark, str(tmp_path / "tables"))


def jobs_of(store):
    return {(r.source_uuid, r.source_version, r.job_type): r for r in store.read("jobs", schemas.JOB).collect()}


def points_of(store):
    return {(r.content_uuid, r.chunk_index): r for r in store.read("vectors", vectors.POINT).collect()}


def work(store, src, now, mode="replace", **limits):
    return sync.worker_run(
        store, src, now, embed.bag_of_words(16), MODEL, mode, sync.Limits(**{"buckets": 8, **limits}))


def test_life_of_entries(spark, store):
    first = [(1, 1, 1, 10), (2, 2, 1, 10), (3, 1, 1, 11), (4, 2, 1, 12), (7, 1, 1, 13), (40, 3, 1, 14), (50, 9, 1, 15)]
    src = sources(spark, first)
    done = sync.enqueue_run(store, src, "2024-02-01 00:00:00")
    assert done == {"skipped": False, "changed": 6, "deleted": 0}  # type 9 is unknown
    assert sync.enqueue_run(store, src, "2024-02-01 00:10:00")["skipped"]
    jobs = store.read("jobs", schemas.JOB).orderBy("job_id").collect()
    assert [j.job_id for j in jobs] == [1, 2, 3, 4, 5, 6]
    assert [j.source_uuid for j in jobs] == [uid(n) for n in (1, 2, 3, 4, 7, 40)]
    assert store.cursor()["last_changed"] == "2024-01-01 00:14:00"

    # Entry 7 has no payload row; entry 40's table name is not allowed.
    got = work(store, src, "2024-02-01 01:00:00")
    assert got == {"num_items_done": 4, "num_items_failed": 2, "num_chunks": 4, "num_vectors": 4}
    jobs = jobs_of(store)
    assert jobs[uid(1), uid(1), "upsert"].state == "done"
    retry = jobs[uid(7), uid(1), "upsert"]
    assert (retry.state, retry.attempts, retry.locked_until) == ("pending", 1, None)
    assert retry.error_message == "Extractor: missing payload / sysentry not found"
    two = points_of(store)[uid(2), 0]
    assert (two.public, two.archive, two.name, two.tags, two.ref_uuids) == (1, 0, "Two", ["a", "b"], [uid(1), uid(4)])
    assert two.meta == '{"content_version":"%s","text":{"mime":"text/plain"}}' % uid(1)
    assert points_of(store)[uid(3), 0].name is None
    assert '"contact":{"firstname":"First1"' in points_of(store)[uid(1), 0].meta

    # The same run again changes nothing.
    before = {t: store.version(t) for t in ("jobs", "seen", "vectors", "cache", "chunks")}
    assert work(store, src, "2024-02-01 01:00:00") == got
    assert before == {t: store.version(t) for t in before}

    # Entry 1 changes, entry 3 vanishes.
    src = sources(spark, [(1, 1, 2, 20), (2, 2, 1, 10), (4, 2, 1, 12), (7, 1, 1, 13)])
    assert sync.enqueue_run(store, src, "2024-02-01 02:00:00") == {"skipped": False, "changed": 1, "deleted": 2}
    seen = {r.source_uuid: r for r in store.read("seen", schemas.SEEN).collect()}
    assert seen[uid(3)].missing_since is not None and seen[uid(3)].deleted_at is None
    assert seen[uid(3)].delete_job_id == jobs_of(store)[uid(3), uid(1), "delete"].job_id
    got = work(store, src, "2024-02-01 03:00:00")
    assert (uid(3), 0) not in points_of(store)
    assert '"content_version":"%s"' % uid(2) in points_of(store)[uid(1), 0].meta
    assert len(points_of(store)) == 3
    seen = {r.source_uuid: r for r in store.read("seen", schemas.SEEN).collect()}
    assert seen[uid(3)].deleted_at is not None and seen[uid(1)].last_seen_version == uid(2)

    # Entry 3 returns: its delete marks go and it gets a new point.
    src = sources(spark, [(1, 1, 2, 20), (2, 2, 1, 10), (3, 1, 5, 30), (4, 2, 1, 12), (7, 1, 1, 13)])
    sync.enqueue_run(store, src, "2024-02-01 04:00:00")
    back = {r.source_uuid: r for r in store.read("seen", schemas.SEEN).collect()}[uid(3)]
    assert (back.missing_since, back.delete_job_id, back.deleted_at) == (None, None, None)
    work(store, src, "2024-02-01 05:00:00")
    assert (uid(3), 0) in points_of(store)

    states = store.read("jobs", schemas.JOB).groupBy("job_id").count().filter("count > 1").count()
    assert states == 0


def test_limits_and_order(spark, store):
    src = sources(spark, [(n, 1, 1, 10) for n in (1, 3, 5, 9, 11)])
    for step, expected in enumerate((2, 2, 1, 0)):
        got = sync.enqueue_run(store, src, f"2024-02-01 0{step}:00:00", sync.Limits(changed=2))
        assert got["changed"] == expected  # equal timestamps are not lost at the cut
    assert work(store, src, "2024-02-01 05:00:00", claim=2)["num_items_done"] == 2
    assert {u for u, _ in points_of(store)} == {uid(1), uid(3)}
    assert work(store, src, "2024-02-01 06:00:00", claim=100)["num_items_done"] == 3
    assert len(points_of(store)) == 5


def test_modes(spark, store):
    src = sources(spark, [(2, 2, 1, 10), (38, 2, 1, 10)])
    sync.enqueue_run(store, src, "2024-02-01 00:00:00")
    first = work(store, src, "2024-02-01 00:00:00")
    assert first["num_chunks"] == first["num_vectors"] == 11
    # Free the same jobs once more.
    again = store.read("jobs", schemas.JOB).withColumn("state", F.lit("pending"))
    store.write("jobs", again, by="state")
    assert work(store, src, "2024-02-02 00:00:00", "skip") == {
        "num_items_done": 2, "num_items_failed": 0, "num_chunks": 0, "num_vectors": 0}
    store.write("jobs", store.read("jobs", schemas.JOB).withColumn("state", F.lit("pending")), by="state")
    work(store, src, "2024-02-03 00:00:00", "append")
    # The same version of the same entries: the same points.
    assert store.read("vectors", vectors.POINT).count() == 11
    with pytest.raises(ValueError):
        work(store, src, "2024-02-04 00:00:00", "merge")


def test_last_job_of_an_entry_wins(spark):
    rows = [
        (1, "A", "upsert", 1), (2, "A", "delete", 1), (3, "B", "delete", 1), (4, "B", "upsert", 1),
        (5, "C", "upsert", 1), (6, "C", "upsert", 2), (7, "D", "upsert", 1), (8, "D", "upsert", 1),
    ]
    jobs = spark.createDataFrame(rows, "job_id bigint, source_uuid string, job_type string, priority int")
    kept = {m: sorted(r.job_id for r in sync.lasting_upserts(jobs, m).collect()) for m in vectors.MODES}
    assert kept["replace"] == [4, 5, 8]
    assert kept["append"] == kept["skip"] == [4, 5, 6, 7, 8]


def test_policies(spark):
    from tidemark.operators import changes

    job = spark.createDataFrame(
        [(1, "U", "V", "k", "upsert", "pending"), (2, "U", "W", "k", "upsert", "pending"), (3, "U", "V", "x", "upsert", "pending"),
         (4, "U", "X", "k", "upsert", "running"), (5, "U", "V", "k", "delete", "pending")],
        "job_id bigint, source_uuid string, source_version string, collection_key string, job_type string, state string")
    for name in schemas.columns(schemas.JOB):
        if name not in job.columns:
            dtype = dict(p.split() for p in schemas.JOB.split(", "))[name]
            job = job.withColumn(name, F.lit(None).cast(dtype))
    request = spark.createDataFrame([("U", "V", "k", "upsert")], "source_uuid string, source_version string, collection_key string, job_type string")
    request = request.withColumn("changed", timestamp("2024-01-01 00:00:00"))

    def states(policy):
        out = sync.next_jobs(job.select(*schemas.columns(schemas.JOB)), request, "2024-02-01 00:00:00", policy)
        return {r.job_id: r.state for r in out.collect()}

    assert states("reference") == {1: "superseded", 2: "superseded", 3: "pending", 4: "running", 5: "pending"}
    assert states("keep_same_version") == {1: "pending", 2: "superseded", 3: "pending", 4: "running", 5: "pending"}
    assert changes.should_run("", "2024-01-01 00:00:00") and changes.should_run("junk", "2024-01-01 00:00:00")
    assert changes.should_run("1970-01-01 00:00:00", "1970-01-01 00:00:01")
    assert not changes.should_run("2024-01-01 00:00:00", "2024-01-01 00:14:59")
    assert changes.should_run("2024-01-01 00:00:00", "2024-01-01 00:15:00")


def test_failing_texts_fail_their_items_only(spark, store):
    src = sources(spark, [(2, 2, 1, 10), (4, 2, 1, 10), (6, 2, 1, 10)])
    bodies = [(2, "good words", "text/plain"), (4, "a hot text", "text/plain"), (6, "an empty one", "text/plain")]
    src = dataclasses.replace(src, payloads={**src.payloads, "texts": spark.createDataFrame(bodies, "id bigint, text string, mime string")})
    sync.enqueue_run(store, src, "2024-02-01 00:00:00")
    plain = embed.bag_of_words(8)

    def model(texts):
        if any("hot" in t for t in texts):
            raise RuntimeError("too hot")
        return [[] if "empty" in t else v for t, v in zip(texts, plain(texts))]

    got = sync.worker_run(store, src, "2024-02-01 01:00:00", model, "m", limits=BUCKETS)
    assert got == {"num_items_done": 1, "num_items_failed": 2, "num_chunks": 3, "num_vectors": 1}
    jobs = {r.source_uuid: (r.state, r.error_message) for r in store.read("jobs", schemas.JOB).collect()}
    assert jobs == {uid(2): ("done", None), uid(4): ("pending", "Embedding: too hot"), uid(6): ("pending", embed.EMPTY_VECTOR)}
    again = sync.worker_run(store, src, "2024-02-01 02:00:00", plain, "m", limits=BUCKETS)
    assert again["num_items_done"] == 2 and {u for u, _ in points_of(store)} == {uid(2), uid(4), uid(6)}


def test_bucket_count_stays_with_the_table(spark, store):
    src = sources(spark, [(2, 2, 1, 10), (4, 2, 1, 10)])
    sync.enqueue_run(store, src, "2024-02-01 00:00:00")
    work(store, src, "2024-02-01 00:00:00", buckets=8)
    before = points_of(store)
    store.write("jobs", store.read("jobs", schemas.JOB).withColumn("state", F.lit("pending")), by="state")
    work(store, src, "2024-02-02 00:00:00", buckets=256)
    assert points_of(store).keys() == before.keys()
    assert store.read("vectors", vectors.POINT).count() == len(before)


@pytest.mark.parametrize("top_k", [100_000, 1])
def test_limited_runs_see_every_change_once(spark, tmp_path, monkeypatch, top_k):
    """Changes within one second, ties among them, taken a few at a time by either kind of limit."""
    monkeypatch.setattr(ranking, "TOP_K_LIMIT", top_k)
    store = SnapshotStore(spark, str(tmp_path / "ranked"))
    src = sources(spark, [(n, 1, 1, 10) for n in range(1, 12)])
    ids = {uid(n) for n in range(1, 12)}
    # The smaller the id, the later the change; two share a time.
    late = (F.lit(12) - F.when(F.col("id") == 5, 6).otherwise(F.col("id"))).cast("int") * 1000
    src = dataclasses.replace(src, entries=src.entries.withColumn(
        "changed", F.col("changed") + F.expr("INTERVAL 1 SECOND") * (late / 1_000_000)).withColumn("uuid", F.lower("uuid")))
    seen = []
    for step in range(6):
        got = sync.enqueue_run(store, src, f"2024-02-01 0{step}:00:00", sync.Limits(changed=2))
        seen.append(got["changed"])
    assert seen == [2, 2, 2, 2, 2, 1]
    jobs = store.read("jobs", schemas.JOB).collect()
    assert {j.source_uuid for j in jobs} == ids and len(jobs) == 11


def test_private_columns_follow_the_routed_type(spark):
    rows = spark.createDataFrame([(1, " Gold ", "secret", "d0", "k")], "id bigint, accounttype string, description string, data0 string, keep string")
    for table, alias in (("crm_account", " AcCoUnT "), ("account", None), ("Account", "other")):
        aliases = {table: alias} if alias else {}
        union = payload_union({table: rows}, aliases).select(F.to_json("payload").alias("p")).first().p
        assert "secret" not in union and "d0" not in union and '"keep":"k"' in union
        out = enrich.enriched_union({table: rows}, aliases).select("parser", F.to_json("payload").alias("p")).first()
        assert "secret" not in out.p and "d0" not in out.p
    assert enrich.enriched_union({"crm_account": rows}, {"crm_account": " AcCoUnT "}).first().parser == "account"


def test_null_levels_keep_their_rows(spark):
    rows = [(1, None, 5), (2, "a", None), (3, "a", 1), (4, None, None), (5, "b", 2)]
    frame = spark.createDataFrame(rows, "i int, g string, n int")
    ranked = ranking.bucketed_rank(frame, [F.col("n")], [F.col("i")], within=["g"], total="size").collect()
    assert {(r.i, r["rank"], r["size"]) for r in ranked} == {(4, 1, 2), (1, 2, 2), (2, 1, 2), (3, 2, 2), (5, 1, 1)}


def test_unset_filter_and_unset_times(spark):
    table = spark.createDataFrame([(1, "de"), (2, None)], "id int, lang string")
    assert [r.id for r in table.filter(vectors.filter_spec(table, {"must": {"lang": None}})).collect()] == [2]
    job = spark.createDataFrame([(1, "done")], "job_id bigint, state string")
    job = job.select("*", *(F.lit(None).cast(t.split()[1]).alias(t.split()[0]) for t in schemas.JOB.split(", ") if t.split()[0] not in job.columns))
    assert worklist.retire(job, "2024-01-01 00:00:00").count() == 1


def test_cleanup_frees_the_jobs_of_a_crashed_worker(spark, store):
    src = sources(spark, [(2, 2, 1, 10), (4, 2, 1, 10)])
    sync.enqueue_run(store, src, "2024-02-01 00:00:00")
    jobs = store.read("jobs", schemas.JOB)
    store.write("jobs", worklist.claim_batch(jobs, "2024-02-01 01:00:00", 1), by="state")
    assert work(store, src, "2024-02-01 02:00:00")["num_items_done"] == 1  # the other one is locked for good
    assert sync.cleanup_run(store, "2024-02-01 03:00:00") == {"skipped": False, "jobs": 0, "seen": 0, "freed": 1}
    assert sync.cleanup_run(store, "2024-02-01 04:00:00")["skipped"]
    assert work(store, src, "2024-02-01 05:00:00")["num_items_done"] == 1
    assert sync.cleanup_run(store, "2024-04-01 05:00:00") == {"skipped": False, "jobs": 2, "seen": 0, "freed": 0}


def test_exhausted_jobs_go_on_request(spark):
    rows = [(1, "error", 5), (2, "error", 1), (3, "running", 5)]
    jobs = spark.createDataFrame(rows, "job_id bigint, state string, attempts int")
    jobs = jobs.select("*", *(F.lit(None).cast(t.split()[1]).alias(t.split()[0]) for t in schemas.JOB.split(", ") if t.split()[0] not in jobs.columns))
    kept = worklist.retire(jobs, "2024-01-01 00:00:00", drop_exhausted=True).collect()
    assert sorted(r.job_id for r in kept) == [2, 3]


def test_counters_are_kept_with_what_was_written(spark, store):
    rows = spark.range(10).withColumn("part", F.col("id") % 2)
    store.write("t", rows, by="part", run="one", counts={"rows": F.count("*"), "sum": F.sum("id")}, dims=7)
    assert store.counts("t") == {"rows": 10, "sum": 45} and store.fact("t", "dims") == 7
    store.write("t", rows.limit(1), by="part", run="one", counts={"rows": F.count("*")})
    assert store.counts("t") == {"rows": 10, "sum": 45}
    store.write("t", rows.limit(0), by="part", run="two", counts={"rows": F.count("*")})
    assert store.counts("t") == {"rows": 0} and store.fact("t", "dims") == 7 and store.counts("none") == {}


def test_vectors_of_another_length_fail_their_text(spark, store):
    src = sources(spark, [(1, 1, 1, 10), (2, 2, 1, 10)])
    sync.enqueue_run(store, src, "2024-02-01 00:00:00")
    model = embed.bag_of_words(16)
    sync.worker_run(store, src, "2024-02-01 01:00:00", model, MODEL, limits=BUCKETS, dims=16)
    assert store.fact("vectors", "dims") == 16 and store.read("vectors", vectors.POINT).count() == 2
    src = sources(spark, [(1, 1, 2, 20), (2, 2, 2, 20)])
    sync.enqueue_run(store, src, "2024-02-01 02:00:00")
    # Another model, with another length: the table's own length counts.
    got = sync.worker_run(store, src, "2024-02-01 03:00:00", embed.bag_of_words(8), "other", limits=BUCKETS)
    assert got == {"num_items_done": 0, "num_items_failed": 2, "num_chunks": 2, "num_vectors": 0}
    messages = {r.error_message for r in store.read("jobs", schemas.JOB).filter("error_message IS NOT NULL").collect()}
    assert messages == {"Embedding: vector of 8 values where 16 are expected"}


def test_an_outage_of_the_model_is_no_ones_failure(spark):
    def out(texts):
        raise ConnectionError("no way to the model")

    texts = spark.createDataFrame([("k", "some text")], "cache_key string, text string")
    with pytest.raises(Exception, match="no way to the model"):
        embed.embed_results(texts, out, MODEL).collect()


def test_small_claims_read_their_payloads_only(spark, store):
    src = sources(spark, [(n, 1 + (n + 1) % 2, 1, 10 + n) for n in range(1, 30)])
    sync.enqueue_run(store, src, "2024-02-01 00:00:00")
    got = work(store, src, "2024-02-01 01:00:00", claim=4)
    assert got == {"num_items_done": 4, "num_items_failed": 0, "num_chunks": got["num_chunks"], "num_vectors": got["num_chunks"]}
    assert {k[0] for k in points_of(store)} == {uid(n) for n in (1, 2, 3, 4)}
    # A claim of jobs that no longer have an entry finds nothing to read.
    gone = dataclasses.replace(src, entries=src.entries.filter("id > 20"))
    assert work(store, gone, "2024-02-01 02:00:00", claim=3)["num_items_failed"] == 3
