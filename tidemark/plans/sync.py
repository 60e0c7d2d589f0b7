"""The two runs that keep the vector table in step: enqueue changes, then work them off.

Each run reads the current snapshots, writes what several later steps need to a table
once, and ends by swapping pointers. Snapshots carry the name of the run that wrote
them, so a run started again after a crash takes up where it stopped and repeats
nothing.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import changes, chunks, embed, enrich, items, payload, vectors, worklist
from tidemark.sources.payloads import of_claim, payload_keys, table_aliases
from tidemark.sources.schemas import JOB, SEEN
from tidemark.sources.store import SnapshotStore, bucket_of
from tidemark.sources.views import Sources

REQUEST = "source_uuid string, source_version string, collection_key string, job_type string, changed timestamp_ntz"
CLAIMED = "dbtable string, entry_id bigint"
OUTCOME = "job_id bigint, ok boolean, message string, retry boolean"

# The states that a claim takes jobs from and puts them in.
CLAIM_STATES = ["pending", "running"]

# A day between two cleanups.
CLEANUP_SECONDS = 86_400

# Messages of items that ended without a stored chunk.
NOTHING_STORED = "No chunk was stored"


@dataclass(frozen=True)
class Limits:
    """Sizes of one run; ``None`` takes everything."""

    changed: int | None = None
    deleted: int | None = None
    claim: int | None = None
    # Claims up to this size cut payload and side tables to the claimed entries first; their ids are broadcast.
    small_claim: int = 1_000_000
    buckets: int = 256


# -- enqueue


def enqueue_run(
    store: SnapshotStore,
    src: Sources,
    now: str,
    limits: Limits = Limits(),
    policy: str = "reference",
    exact_cursor: bool = True,
    min_seconds: int = changes.MIN_INTERVAL_SECONDS,
) -> dict:
    """Turn changed and vanished entries into jobs; returns the numbers of both.

    ``exact_cursor`` continues inside equal timestamps when a limit cut them; without it
    the cursor is the plain timestamp.
    """
    cursor = store.cursor()
    if not changes.should_run(cursor["last_run_at"], now, min_seconds):
        return {"skipped": True, "changed": 0, "deleted": 0}
    run = "enqueue {last_changed} {last_uuid} {last_run_at}".format(**cursor)
    after_uuid = cursor["last_uuid"] if exact_cursor and cursor["last_uuid"] else None
    scanned = changes.changed_entries(src.entries, src.types, cursor["last_changed"], after_uuid, limits.changed)
    gone = changes.vanished_entries(store.read("seen", SEEN), src.entries, limits.deleted)
    found = changes.upsert_requests(changes.accepted_changes(scanned)).unionByName(changes.delete_requests(gone, now))
    settle_requests(store, found, now, policy, run)
    last = store.read("requests", REQUEST).agg(
        F.count_if(F.col("job_type") == "upsert").alias("changed"),
        F.count_if(F.col("job_type") == "delete").alias("deleted"),
        F.max(F.when(F.col("job_type") == "upsert", F.struct("changed", "source_uuid"))).alias("last")).first()
    moved = {"last_changed": str(last["last"]["changed"]), "last_uuid": last["last"]["source_uuid"]} if last["last"] else {}
    store.save_cursor(last_run_at=now, **moved)
    return {"skipped": False, "changed": last["changed"], "deleted": last["deleted"]}


def settle_requests(
    store: SnapshotStore, found: DataFrame, now: str, policy: str, run: str, deletes_move_time: bool = False
) -> None:
    """Write the requests down once, then bring work list and seen table up to them.

    With ``deletes_move_time`` the time of a delete request becomes the entry's last time.
    """
    store.write("requests", found, run=run)
    requests = store.read("requests", REQUEST)
    store.write("jobs", next_jobs(store.read("jobs", JOB), requests, now, policy), by="state", run=run)
    store.write("seen", next_seen(store.read("seen", SEEN), requests, store.read("jobs", JOB), now, deletes_move_time), run=run)


def next_jobs(jobs: DataFrame, requests: DataFrame, now: str, policy: str = "reference") -> DataFrame:
    """Supersede pending jobs of the changed entries, then add the requests not yet listed."""
    return changes.insert_if_absent(changes.supersede_pending(jobs, requests, now, policy), requests, now)


def next_seen(seen: DataFrame, requests: DataFrame, jobs: DataFrame, now: str, deletes_move_time: bool = False) -> DataFrame:
    accepted = requests.filter("job_type = 'upsert'").select(
        F.col("source_uuid").alias("uuid"), F.col("source_version").alias("etag"), "changed", "collection_key")
    gone = requests.filter("job_type = 'delete'").select(
        "source_uuid", F.col("source_version").alias("last_seen_version"), "collection_key", *(["changed"] if deletes_move_time else []))
    marked = changes.mark_missing(changes.merge_seen(seen, accepted, now), gone, now)
    return changes.link_delete_jobs(marked, gone, jobs)


# -- work off


def claim_tables(src: Sources, claimed: DataFrame | None, bounded: bool = True) -> dict[str, DataFrame]:
    """The payload tables, cut to a claim if there is one; a claim of nothing leaves empty tables."""
    if claimed is None:
        return src.payloads
    return of_claim(src.payloads, claimed, bounded) or {name: rows.limit(0) for name, rows in src.payloads.items()}


def item_rows(batch: DataFrame, src: Sources, claimed: DataFrame | None = None) -> DataFrame:
    """Enriched items of a batch of guarded upsert jobs.

    ``claimed`` is the written table of ``items.claimed_entries`` of a small claim: with it,
    payload and side tables are cut to the claim where they are scanned.
    """
    ids = None if claimed is None else claimed.select("entry_id")
    payloads = enrich.enriched_union(claim_tables(src, claimed), table_aliases(src.types))
    return items.upsert_items(batch, src.entries, src.types, payloads, src.access, src.names, src.tags, src.links, ids)


def wanted_rows(wanted: DataFrame, src: Sources) -> DataFrame:
    """Enriched items of a claim of any size.

    ``wanted`` is the written table of ``items.wanted_jobs``. Payload and side tables are cut to its
    entries by joins before anything is made of them, so that typed metadata and lists are not made for the others.
    """
    payloads = enrich.enriched_union(claim_tables(src, wanted, bounded=False), table_aliases(src.types))
    return items.wanted_items(
        wanted, src.entries, payloads, src.access, src.names, src.tags, src.links, wanted.select("entry_id"))


def chunk_items(rows: DataFrame) -> DataFrame:
    """Typed chunk rows of enriched items, ready to become payload rows."""
    metadata = F.struct(
        "content_uuid", "content_version", "type_alias", "archive", "public", "tags", "ref_uuids", "name", *enrich.RULES)
    return chunks.chunk_rows(rows.select(
        "job_id", F.col("collection_key").alias("chunk_collection_key"), "hash", metadata.alias("metadata"),
        F.coalesce("body", F.to_json("content.payload")).alias("text")))


def outcomes_of(
    rejects: DataFrame, missing: DataFrame, deletes: DataFrame, upserts: DataFrame, skipped: DataFrame, stored: DataFrame,
    errors: DataFrame | None = None,
) -> DataFrame:
    """``(job_id, ok, message, retry)`` of every job of a batch.

    An upsert succeeds only when at least one of its chunks was stored, or when its hash
    was stored before and the mode skips it. One that failed says why, by ``errors``
    (``job_id, error``). Chunks are counted before they are joined.
    """
    why = F.lit(NOTHING_STORED)
    if errors is not None:
        upserts = upserts.join(errors, "job_id", "left")
        why = F.coalesce("error", why)
    counts = stored.groupBy("job_id").agg(F.count("*").alias("n"))
    done = F.coalesce(F.col("n"), F.lit(0)) > 0
    none = F.lit(None).cast("string")
    frames = [
        rejects.select("job_id", F.lit(False).alias("ok"), F.col("reject_reason").alias("message"), F.lit(False).alias("retry")),
        missing.select("job_id", F.lit(False).alias("ok"), F.lit(worklist.MISSING_PAYLOAD).alias("message"), F.lit(True).alias("retry")),
        deletes.select("job_id", F.lit(True).alias("ok"), none.alias("message"), F.lit(True).alias("retry")),
        skipped.select("job_id", F.lit(True).alias("ok"), none.alias("message"), F.lit(True).alias("retry")),
        upserts.join(counts, "job_id", "left").select(
            "job_id", done.alias("ok"), F.when(~done, why).alias("message"), F.lit(True).alias("retry")),
    ]
    return reduce(DataFrame.unionByName, frames)


def run_summary(outcomes: DataFrame, chunk_rows: DataFrame, stored: DataFrame) -> DataFrame:
    """One row of counters: items done and failed, chunks cut, vectors stored."""
    counts = outcomes.agg(
        F.count_if("ok").alias("num_items_done"), F.count_if(~F.col("ok")).alias("num_items_failed"))
    return counts.select(
        "*", chunk_rows.agg(F.count("*")).scalar().alias("num_chunks"),
        stored.agg(F.count("*")).scalar().alias("num_vectors"))


def worker_run(
    store: SnapshotStore,
    src: Sources,
    now: str,
    embedder: embed.Embedder,
    model: str,
    mode: str = "replace",
    limits: Limits = Limits(),
    dims: int | None = None,
) -> dict:
    """Claim jobs, carry them out on the vector table, and settle them; returns counters.

    All vectors of the table have one length: the one remembered with it, else ``dims``. A
    text that the model gives another length for has failed. The counters are taken as the
    rows are written.
    """
    if mode not in vectors.MODES:
        raise ValueError(f"mode must be one of {', '.join(vectors.MODES)}")
    run = f"work {now} {store.version('requests')}"
    jobs = store.read("jobs", JOB)
    taken = jobs.join(worklist.claimable(jobs, now, limits.claim), "job_id", "left_semi")
    store.write("batch", worklist.mark_claimed(taken, taken, now), run=run)
    batch = store.read("batch", JOB)
    # A claim moves jobs between two states only; the others stay where they are.
    active = jobs.filter(F.col("state").isin(*CLAIM_STATES))
    store.write("jobs", worklist.mark_claimed(active, batch, now), by="state", touched=CLAIM_STATES, run=f"{run} claim")

    seen = store.read("seen", SEEN)
    flagged = worklist.flag_stale(worklist.accepted(batch), seen)
    live = flagged.filter("NOT is_stale").drop("is_stale")
    claimed = None
    if limits.claim is not None and limits.claim <= limits.small_claim:
        store.write("claimed", items.claimed_entries(live, src.entries, src.types), run=run)
        claimed = store.read("claimed", CLAIMED)
        rows = item_rows(live, src, claimed)
    else:
        wanted = items.wanted_jobs(live, src.entries, src.types)
        store.write("wanted", wanted, run=run)
        rows = wanted_rows(store.read("wanted", wanted.schema), src)
    skipped = live.select("job_id").limit(0)
    if mode == "skip":
        known = store.read("vectors", vectors.POINT).select("hash").distinct()
        skipped, rows = rows.join(known, "hash", "left_semi").select("job_id"), rows.join(known, "hash", "left_anti")
    cut = chunk_items(rows)
    store.write("chunks", cut, run=run, counts={"num_chunks": F.count("*")})
    if mode == "skip":
        store.write("skipped", skipped, run=run)
        skipped = store.read("skipped", "job_id bigint")
    cut = store.read("chunks", cut.schema)

    misses = embed.cache_misses(cut, store.read("cache", embed.CACHE), model)
    part = f"{store.version('cache') + 1:08d}"
    dims = store.fact("vectors", "dims") or dims
    store.write("embedded", embed.embed_results(misses, embedder, model, dims=dims), run=run)
    results = store.read("embedded", embed.RESULT)
    fresh = results.filter("vector IS NOT NULL").drop("error").withColumn("part", F.lit(part))
    store.write("cache", fresh, by="part", touched=[part], run=run)
    embedded = embed.attach_vectors(cut, store.read("cache", embed.CACHE), model)
    if dims:  # the cache may hold vectors of the model's older lengths
        embedded = embedded.filter(F.size("vector") == dims)
    # Several steps below need these rows: they are made once.
    made = vectors.with_point_ids(payload.build_payload(embedded))
    store.write("stored", made, run=run, counts={"num_vectors": F.count("*")})
    stored = store.read("stored", made.schema)

    deletes = items.delete_items(live)
    final = stored.join(lasting_upserts(live, mode), "job_id", "left_semi")
    store_points(store, final, deletes, mode, limits.buckets, run, dims)

    missing = items.missing_payload(live, src.entries, src.types, payload_keys(claim_tables(src, claimed)))
    upserts = live.filter("job_type = 'upsert'").select("job_id").join(missing.select("job_id"), "job_id", "left_anti")
    upserts = upserts.join(skipped, "job_id", "left_anti")
    ended = outcomes_of(worklist.rejected(batch), missing, deletes, upserts, skipped, stored, embed.item_errors(cut, results, model))
    store.write("outcomes", ended, run=run, counts={
        "num_items_done": F.count_if("ok"), "num_items_failed": F.count_if(~F.col("ok"))})
    settled = store.read("outcomes", OUTCOME)

    running = worklist.drop_stale(store.read("jobs", JOB), flagged.filter("is_stale"), now)
    store.write("jobs", worklist.apply_outcomes(running, settled, now), by="state", run=f"{run} settle")
    acknowledged = live.filter("job_type = 'delete'").select("source_uuid", "collection_key")
    store.write("seen", worklist.mark_deleted(seen, acknowledged, now), run=run)
    return {**store.counts("outcomes"), **store.counts("chunks"), **store.counts("stored")}


# -- clean up


def cleanup_run(
    store: SnapshotStore, now: str, min_seconds: int = CLEANUP_SECONDS, drop_exhausted: bool = False, deleted_days: int = 180
) -> dict:
    """Retire old jobs and entries and free the jobs of crashed workers, once a day.

    Returns the numbers of jobs and seen entries that went, and of jobs set free.
    """
    last = store.last_cleanup()
    if not changes.should_run(last, now, min_seconds):
        return {"skipped": True, "jobs": 0, "seen": 0, "freed": 0}
    run = f"cleanup {last} {now}"
    tables = {
        "jobs": (JOB, lambda rows: worklist.retire(rows, now, drop_exhausted=drop_exhausted), "state",
                 {"rows": F.count("*"), "running": F.count_if(F.col("state") == "running")}),
        "seen": (SEEN, lambda rows: worklist.retire_seen(rows, now, deleted_days), None, {"rows": F.count("*")}),
    }
    gone = {}
    for table, (schema, step, by, counts) in tables.items():
        before = Observation()
        rows = store.read(table, schema).observe(before, *[c.alias(name) for name, c in counts.items()])
        store.write(table, step(rows), by=by, run=run, counts=counts, observed={"before_": before})
        found = store.counts(table)
        gone[table] = {name: found[f"before_{name}"] - found[name] for name in counts}
    store.save_cleanup(now)
    return {"skipped": False, "jobs": gone["jobs"]["rows"], "seen": gone["seen"]["rows"], "freed": gone["jobs"]["running"]}


def lasting_upserts(jobs: DataFrame, mode: str) -> DataFrame:
    """Upsert jobs whose rows are there after the whole batch, as ``job_id``.

    Jobs of one entry take effect in claim order: a delete removes what came before it,
    and in mode ``replace`` so does an upsert.
    """
    turn = F.struct((-F.col("priority")).alias("p"), F.col("job_id").alias("j"))
    wipes = F.lit(True) if mode == "replace" else F.col("job_type") == "delete"
    last = jobs.groupBy("source_uuid").agg(F.max(F.when(wipes, turn)).alias("last"))
    lasting = F.col("last").isNull() | (turn >= F.col("last"))
    return jobs.filter("job_type = 'upsert'").join(last, "source_uuid").filter(lasting).select("job_id")


def store_points(
    store: SnapshotStore, rows: DataFrame, deletes: DataFrame, mode: str, buckets: int, run: str, dims: int | None = None
) -> None:
    """Write points into the buckets they and the deletes touch; other buckets stay as they are.

    Files are sorted by entry and carry bloom filters, so that lookups skip row groups.

    The number of buckets is the table's own; ``buckets`` counts for a new table only. The
    write is rebalanced: a bucket with a hot entry is split over many tasks, small buckets
    share one.
    """
    buckets = (store.pointer("vectors") or {}).get("buckets") or buckets
    bucket = bucket_of(F.col("content_uuid"), buckets)
    touched = rows.select("content_uuid").unionByName(deletes.select("content_uuid")).select(
        bucket.alias("bucket")).distinct()
    names = [r.bucket for r in touched.collect()]  # at most ``buckets`` short texts
    if not names:
        return
    table = store.read("vectors", vectors.POINT)
    columns = T.StructType.fromDDL(vectors.POINT).names
    if "bucket" in table.columns:
        table = table.filter(F.col("bucket").isin(names)).select(*columns)
    out = vectors.upsert(
        vectors.delete_matching(table, deletes), rows.select(*columns), "append" if mode == "skip" else mode)
    out = out.withColumn("bucket", bucket).hint("rebalance", F.col("bucket"))
    store.write("vectors", out.sortWithinPartitions("bucket", "content_uuid", "chunk_index"), by="bucket", touched=names, run=run, buckets=buckets,
                options=vectors.LOOKUP_OPTIONS, **({"dims": dims} if dims else {}))
