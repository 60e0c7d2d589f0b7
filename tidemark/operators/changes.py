"""Change capture: what changed or vanished since the last run, and what to do about it."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators.ranking import ordered_rank, take_first
from tidemark.sources.schemas import JOB, JOB_KEY, SEEN, columns

MIN_INTERVAL_SECONDS = 900
CHANGED_BATCH = 5000
DELETE_BATCH = 2000

# Fixed value: the cursor before the first run.
EPOCH = "1970-01-01 00:00:00"


def timestamp(value: str) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def should_run(last_run_at: str, now: str, min_seconds: int = MIN_INTERVAL_SECONDS) -> bool:
    """Whether the spacing between runs has passed; unreadable values mean "yes"."""
    last = (last_run_at or "").strip()
    if last in ("", EPOCH):
        return True
    try:
        last_time = datetime.fromisoformat(last)
    except ValueError:
        return True
    return (datetime.fromisoformat(now) - last_time).total_seconds() >= min_seconds


# -- scan


def changed_levels(uuid: str = "uuid") -> list[Column]:
    """Prefixes of the order by change time and id: day, second, millisecond, exact time, id prefix."""
    changed = F.col("changed")
    return [F.to_date(changed), F.date_trunc("second", changed), F.date_trunc("millisecond", changed), changed, F.substring(uuid, 1, 3)]


def changed_entries(
    entries: DataFrame,
    types: DataFrame,
    cursor: str = EPOCH,
    cursor_uuid: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Entries changed after the cursor, oldest first, as ``(uuid, etag, changed, type_alias)``.

    Ids come in upper case, as all later steps use them. Entries of unknown type are dropped. With ``limit`` the batch ends in the middle of
    equal timestamps; a plain cursor then loses the rest of them. ``cursor_uuid`` makes
    the cursor a pair and takes up at the exact row.
    """
    entries = entries.withColumn("uuid", F.upper("uuid"))
    after = F.col("changed") > timestamp(cursor)
    if cursor_uuid is not None:
        after |= (F.col("changed") == timestamp(cursor)) & (F.col("uuid") > cursor_uuid)
    found = (
        entries.filter(after)
        .join(F.broadcast(types.select(F.col("id").alias("type_id"), F.col("alias").alias("type_alias"))), "type_id")  # a short row per type
        .select("uuid", "etag", "changed", "type_alias"))
    order = [F.col("changed"), F.col("uuid")]
    return take_first(found, order, changed_levels(), order, limit)


def accepted_changes(scanned: DataFrame) -> DataFrame:
    """Usable rows, one per entry (the latest), with their collection key."""
    usable = scanned.filter("coalesce(uuid, '') <> '' AND coalesce(etag, '') <> '' AND changed IS NOT NULL")
    latest = usable.groupBy("uuid").agg(
        F.max(F.struct("changed", "etag", "type_alias")).alias("last"))
    return latest.select(
        "uuid", "last.etag", "last.changed",
        text.collection_key(F.coalesce("last.type_alias", F.lit(""))).alias("collection_key"))


def cursor_after(scanned: DataFrame, cursor: str = EPOCH) -> DataFrame:
    """One row ``(last_changed, last_uuid)``: the new cursor, never before the old one."""
    usable = scanned.filter("coalesce(uuid, '') <> '' AND coalesce(etag, '') <> '' AND changed IS NOT NULL")
    last = usable.agg(F.max(F.struct("changed", "uuid")).alias("last"))
    moved = F.col("last.changed") > timestamp(cursor)
    return last.select(
        F.when(moved, F.col("last.changed")).otherwise(timestamp(cursor)).alias("last_changed"),
        F.col("last.uuid").alias("last_uuid"))


def vanished_entries(seen: DataFrame, entries: DataFrame, limit: int | None = None) -> DataFrame:
    """Seen entries that no longer exist and are not yet marked missing."""
    gone = (
        seen.filter("missing_since IS NULL")
        .join(entries.select(F.upper("uuid").alias("source_uuid")), "source_uuid", "left_anti"))
    order = [F.col("source_uuid")]
    levels = [F.substring("source_uuid", 1, 3), F.substring("source_uuid", 4, 3)]
    return (
        take_first(gone, order, levels, order, limit)
        .filter("coalesce(source_uuid, '') <> '' AND coalesce(last_seen_version, '') <> ''")
        .select("source_uuid", "last_seen_version",
                text.collection_key(F.coalesce("last_seen_collection_key", F.lit(""))).alias("collection_key")))


# -- work list


def upsert_requests(accepted: DataFrame) -> DataFrame:
    return accepted.select(
        F.col("uuid").alias("source_uuid"), F.col("etag").alias("source_version"),
        "collection_key", F.lit("upsert").alias("job_type"), "changed")


def delete_requests(vanished: DataFrame, now: str) -> DataFrame:
    return vanished.select(
        "source_uuid", F.col("last_seen_version").alias("source_version"),
        "collection_key", F.lit("delete").alias("job_type"), timestamp(now).alias("changed"))


def supersede_pending(jobs: DataFrame, requests: DataFrame, now: str, policy: str = "reference") -> DataFrame:
    """Mark pending upserts of the requested ``(uuid, key)`` pairs as superseded.

    Policy ``reference`` also supersedes a pending job of the requested version; since
    the insert is then ignored, no pending job is left. ``keep_same_version`` leaves
    such a job pending.
    """
    wanted = requests.filter("job_type = 'upsert'").groupBy("source_uuid", "collection_key").agg(
        F.max("source_version").alias("_version"))
    older = F.lit(True) if policy == "reference" else ~F.col("source_version").eqNullSafe(F.col("_version"))
    hit = (
        F.col("_version").isNotNull() & (F.col("job_type") == "upsert") & (F.col("state") == "pending") & older)
    joined = jobs.join(wanted, ["source_uuid", "collection_key"], "left")
    return joined.select(*[
        F.when(hit, "superseded").otherwise(F.col("state")).alias("state") if c == "state"
        else F.when(hit, timestamp(now)).otherwise(F.col(c)).alias(c) if c == "updated_at"
        else F.col(c)
        for c in columns(JOB)])


def new_jobs(jobs: DataFrame, requests: DataFrame, now: str) -> DataFrame:
    """The requests not yet in the work list, as pending jobs with the next ids.

    A request without a version never equals an existing one. Ids follow the order of
    change: the new requests are written once, sorted, and an id is the place in a range
    plus the rows of the ranges before.
    """
    fresh = requests.groupBy(*JOB_KEY).agg(F.min("changed").alias("changed"))
    fresh = fresh.join(jobs.select(*JOB_KEY), JOB_KEY, "left_anti")
    ranked = ordered_rank(
        fresh, [F.col("changed"), F.col("source_uuid"), F.col("source_version"), F.col("collection_key"), F.col("job_type")])
    last_id = jobs.agg(F.coalesce(F.max("job_id"), F.lit(0).cast("bigint"))).scalar()
    none_ts = F.lit(None).cast("timestamp_ntz")
    return ranked.select(
        (last_id + F.col("rank")).alias("job_id"), *JOB_KEY,
        F.lit("pending").alias("state"), F.lit(1).alias("priority"), F.lit(0).alias("attempts"),
        none_ts.alias("locked_until"), timestamp(now).alias("created_at"), timestamp(now).alias("updated_at"),
        F.lit(None).cast("string").alias("error_message"),
    ).select(*columns(JOB))


def insert_if_absent(jobs: DataFrame, requests: DataFrame, now: str) -> DataFrame:
    return jobs.select(*columns(JOB)).unionByName(new_jobs(jobs, requests, now))


# -- seen


def merge_seen(seen: DataFrame, accepted: DataFrame, now: str) -> DataFrame:
    """Insert or update the accepted entries; a returning entry loses its delete marks."""
    fresh = accepted.select(
        F.col("uuid").alias("source_uuid"), F.col("etag").alias("_version"),
        F.col("changed").alias("_changed"), F.col("collection_key").alias("_key"))
    hit = F.col("_version").isNotNull()
    none_ts = F.lit(None).cast("timestamp_ntz")
    return seen.join(fresh, "source_uuid", "full").select(
        "source_uuid",
        F.coalesce("_version", "last_seen_version").alias("last_seen_version"),
        F.coalesce("_changed", "last_seen_changed").alias("last_seen_changed"),
        F.when(hit, timestamp(now)).otherwise(F.col("last_seen_at")).alias("last_seen_at"),
        F.coalesce("_key", "last_seen_collection_key").alias("last_seen_collection_key"),
        F.when(hit, none_ts).otherwise(F.col("missing_since")).alias("missing_since"),
        F.when(hit, F.lit(None).cast("bigint")).otherwise(F.col("delete_job_id")).alias("delete_job_id"),
        F.when(hit, none_ts).otherwise(F.col("deleted_at")).alias("deleted_at"))


def mark_missing(seen: DataFrame, vanished: DataFrame, now: str) -> DataFrame:
    """Set ``missing_since`` of the vanished entries where it is not set.

    If ``vanished`` tells when an entry ``changed``, that becomes the time it was last seen at
    a change.
    """
    time = F.col("changed") if "changed" in vanished.columns else F.lit(None).cast("timestamp_ntz")
    gone = vanished.select("source_uuid", F.lit(True).alias("_gone"), time.alias("_changed"))
    marked = {
        "missing_since": F.when(F.col("_gone") & F.col("missing_since").isNull(), timestamp(now)).otherwise(F.col("missing_since")),
        "last_seen_changed": F.coalesce("_changed", "last_seen_changed"),
    }
    return seen.join(gone, "source_uuid", "left").select(*[marked.get(c, F.col(c)).alias(c) for c in columns(SEEN)])


def link_delete_jobs(seen: DataFrame, vanished: DataFrame, jobs: DataFrame) -> DataFrame:
    """Store on each vanished entry the id of its delete job, new or already there."""
    ids = vanished.select("source_uuid", F.col("last_seen_version").alias("source_version"), "collection_key").join(
        jobs.filter("job_type = 'delete'").select("source_uuid", "source_version", "collection_key", "job_id"),
        ["source_uuid", "source_version", "collection_key"])
    ids = ids.groupBy("source_uuid").agg(F.min("job_id").alias("_job_id"))
    link = F.coalesce(F.col("_job_id"), F.col("delete_job_id"))
    return seen.join(ids, "source_uuid", "left").select(*[
        link.alias(c) if c == "delete_job_id" else F.col(c) for c in columns(SEEN)])
