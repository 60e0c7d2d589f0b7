"""The change feed by snapshots and by state, over the same landed files."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.sources import schemas
from tidemark.sources.store import SnapshotStore
from tidemark.streaming import feed

NOW = "2024-02-01 00:00:00"
DAY = dt.datetime(2024, 1, 1)


def uid(n):
    return f"{n:032X}"


def at(minutes):
    return DAY + dt.timedelta(minutes=minutes)


def plain(batches):
    """What is known of each entry after the batches, and the requests made: one change after the other."""
    known, requests = {}, []
    for batch in batches:
        last = {}
        for row in batch:
            uuid, etag, minutes, deleted = row
            if uuid and minutes is not None and (deleted or etag):
                order = (minutes, deleted, etag or "")
                last[uuid.upper()] = max(last.get(uuid.upper(), (order, row)), (order, row), key=lambda x: x[0])
        for uuid, (_, (_, etag, minutes, deleted)) in last.items():
            seen = known.get(uuid)
            if deleted:
                if seen and not seen["gone"] and minutes >= seen["minutes"]:
                    seen.update(gone=True, minutes=minutes)
                    requests.append((uuid, seen["etag"], "delete"))
            elif not seen or minutes > seen["minutes"] or (minutes == seen["minutes"] and (etag != seen["etag"] or seen["gone"])):
                known[uuid] = {"etag": etag, "minutes": minutes, "gone": False}
                requests.append((uuid, etag, "upsert"))
    return known, requests


def awkward():
    """Older and equal times, repeats, deletes of unseen and of gone entries, returns, rows that cannot be used."""
    return [
        [(uid(1), "A", 10, False), (uid(2), "A", 10, False), (uid(3), "A", 10, True), (uid(4), "A", 5, False), (uid(4), "B", 5, False), (None, "A", 1, False),
         (uid(5), None, 3, False), (uid(6), "A", None, False), ("ab" * 16, "A", 4, False), (uid(7), "A", 1, False), (uid(7), "B", 2, True)],
        [(uid(1), "B", 10, False), (uid(2), "A", 10, False), (uid(4), "C", 4, False), ("AB" * 16, "B", 6, False), (uid(3), "B", 9, False)],
        [(uid(1), None, 12, True), (uid(2), None, 9, True), (uid(3), "C", 9, False), (uid(4), "B", 5, True)],
        [(uid(1), "B", 12, False), (uid(4), None, 8, True), (uid(2), "D", 30, False), (uid(3), "C", 9, False)],
        [(uid(1), "C", 11, False), (uid(4), "E", 7, False), (uid(2), None, 30, True)],
        [],
    ]


def land(spark, folder, batches, run):
    for i, batch in enumerate(batches):
        rows = [(u, e, None if m is None else at(m), "contact", d) for u, e, m, d in batch]
        spark.createDataFrame(rows, feed.CHANGE).coalesce(1).write.parquet(f"{folder}/changes/{i}")
        run().awaitTermination()


@pytest.mark.parametrize("seed", [None, 1])
def test_both_forms_equal_the_plain_version(spark, tmp_path, seed):
    batches = awkward()
    if seed:
        rng = random.Random(seed)
        batches = [[(uid(rng.randrange(9)), rng.choice("ABC"), rng.randrange(8), rng.random() < 0.3) for _ in range(12)] for _ in range(3)]
    known, requests = plain(batches)
    store = SnapshotStore(spark, str(tmp_path / "tables"))
    changes = f"{tmp_path}/changes/*"

    def both():
        feed.watch(spark, changes, store, str(tmp_path / "a"), now=NOW).awaitTermination()
        return feed.follow(spark, changes, str(tmp_path / "log"), str(tmp_path / "b"))

    land(spark, tmp_path, batches, both)
    seen = {r.source_uuid: (r.last_seen_version, r.last_seen_changed, r.missing_since is not None) for r in store.read("seen", schemas.SEEN).collect()}
    assert seen == {u: (k["etag"], at(k["minutes"]), k["gone"]) for u, k in known.items()}
    log = spark.read.schema(feed.REQUEST_LOG).parquet(str(tmp_path / "log"))
    rows = sorted(log.collect(), key=lambda r: (r.source_uuid, r.number))
    want = {}
    for u, e, kind in requests:
        want.setdefault(u, []).append((e, kind))
    assert [(r.source_uuid, r.number, r.source_version, r.job_type) for r in rows] == [
        (u, i, *r) for u in sorted(want) for i, r in enumerate(want[u], 1)]
    last = {r.source_uuid: r.job_type for r in feed.latest_requests(log).collect()}
    assert last == {u: r[-1][1] for u, r in want.items()}
    # Every delete that took effect is linked to its job.
    jobs = {r.job_id: r for r in store.read("jobs", schemas.JOB).collect()}
    for r in store.read("seen", schemas.SEEN).filter("missing_since IS NOT NULL").collect():
        assert (jobs[r.delete_job_id].source_uuid, jobs[r.delete_job_id].source_version) == (r.source_uuid, r.last_seen_version)


def test_entries_without_a_word_are_swept_and_can_return(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "tables"))
    entries = str(tmp_path / "entries")
    spark.createDataFrame([(uid(1).lower(),), (uid(3),)], "uuid string").write.parquet(entries)

    def run():
        return feed.watch(spark, f"{tmp_path}/changes/*", store, str(tmp_path / "c"), now=NOW, entries=entries, sweep_every=2)

    land(spark, tmp_path, [[(uid(1), "A", 1, False), (uid(2), "A", 1, False)]], run)
    gone = lambda: {r.source_uuid for r in store.read("seen", schemas.SEEN).filter("missing_since IS NOT NULL").collect()}
    assert gone() == set()
    spark.createDataFrame([(uid(3), "A", at(2), "contact", False)], feed.CHANGE).write.parquet(f"{tmp_path}/changes/x1")
    run().awaitTermination()
    assert gone() == {uid(2)}
    version = store.version("jobs")
    feed.sweep(store, spark.read.parquet(entries), NOW, f"sweep {tmp_path / 'c'} 1")  # the same sweep again changes nothing
    assert store.version("jobs") == version
    spark.createDataFrame([(uid(2), "B", at(9), "contact", False)], feed.CHANGE).write.parquet(f"{tmp_path}/changes/x2")
    run().awaitTermination()
    assert gone() == set()


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "tables"))
    rows = spark.createDataFrame([(uid(1), "A", at(1), "contact", False)], feed.CHANGE).withColumn("landed", F.lit(DAY).cast("timestamp_ltz"))
    feed.apply_batch(store, rows, NOW, "one")
    before = {t: store.version(t) for t in ("requests", "jobs", "seen")}
    feed.apply_batch(store, rows, NOW, "one")
    assert before == {t: store.version(t) for t in before}
    feed.apply_batch(store, rows, NOW, "two")
    assert store.read("requests", "source_uuid string").count() == 0


def test_bounded_suppression_equals_a_batch_statement(spark, tmp_path):
    """A version comes once; a change that is older than all before by more than the bound is late."""
    minutes = [[0, 10, 20, 30], [10, 25, 60, 0], [29, 61, 30, 60, 35], [100, 35, 61, 95]]
    batches = [[(uid(m), "A", m, False) for m in batch] for batch in minutes]
    land(spark, tmp_path, batches, lambda: feed.collect_changes(
        spark, f"{tmp_path}/changes/*", str(tmp_path / "table"), str(tmp_path / "c"), "30 minutes"))
    want, top, got_once = [], None, set()
    for batch in minutes:
        for m in batch:
            if (top is None or m > top - 30) and m not in got_once:
                got_once.add(m)
                want.append(m)
        top = max([*batch, *([top] if top is not None else [])])
    got = [int(r.uuid, 16) for r in spark.read.schema(feed.CHANGE).parquet(str(tmp_path / "table")).collect()]
    assert sorted(got) == sorted(want)


def test_settings_of_the_session_come_back(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    with feed.state_store(spark):
        assert spark.conf.get(name) == feed.STATE_PROVIDER
    assert spark.conf.get(name) == before
