"""The work list: claim, guard, drop stale work, acknowledge, retry, retire."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators.changes import timestamp
from tidemark.operators.ranking import take_first
from tidemark.sources.schemas import JOB, SEEN, columns

CLAIM_LIMIT = 5
LOCK_MINUTES = 10
MAX_ATTEMPTS = 5
MESSAGE_CHARS = 4000

# The messages stored with refused and failed jobs.
UNSUPPORTED_TYPE = "Extractor: unsupported job_type '%s'"
MISSING_FIELDS = "Extractor: missing job_id/source_uuid/collection_key"
MISSING_PAYLOAD = "Extractor: missing payload / sysentry not found"


def _update(rows: DataFrame, schema: str, changes: dict[str, Column]) -> DataFrame:
    return rows.select(*[changes[c].alias(c) if c in changes else F.col(c) for c in columns(schema)])


def claim_limit(value: int | None) -> int | None:
    """``None`` claims everything; zero or less means the default."""
    return value if value is None or value > 0 else CLAIM_LIMIT


def claimable(jobs: DataFrame, now: str, limit: int | None = CLAIM_LIMIT) -> DataFrame:
    """Ids of the next jobs: pending, not locked, highest priority and lowest id first."""
    free = jobs.filter("state = 'pending'").filter(
        F.col("locked_until").isNull() | (F.col("locked_until") < timestamp(now))).select("job_id", "priority")
    order = [F.col("priority").desc(), F.col("job_id")]
    # A byte of priorities, then id ranges of 2^36 and 2^18.
    levels = [-F.col("priority"), F.shiftright("job_id", 36), F.shiftright("job_id", 18)]
    return take_first(free, order, levels, [F.col("job_id")], claim_limit(limit)).select("job_id")


def claim_batch(jobs: DataFrame, now: str, limit: int | None = CLAIM_LIMIT) -> DataFrame:
    """The work list after the claim: claimed jobs run, are locked and count one attempt."""
    return mark_claimed(jobs, claimable(jobs, now, limit), now)


def mark_claimed(jobs: DataFrame, ids: DataFrame, now: str) -> DataFrame:
    taken = ids.select("job_id", F.lit(True).alias("_taken"))
    hit = F.col("_taken").isNotNull()
    lock = timestamp(now) + F.expr(f"INTERVAL {LOCK_MINUTES} MINUTES")
    return _update(jobs.join(taken, "job_id", "left"), JOB, {
        "state": F.when(hit, "running").otherwise(F.col("state")),
        "locked_until": F.when(hit, lock).otherwise(F.col("locked_until")),
        "attempts": F.col("attempts") + hit.cast("int"),
        "updated_at": F.when(hit, timestamp(now)).otherwise(F.col("updated_at")),
    })


def guard(claimed: DataFrame) -> DataFrame:
    """Add ``reject_reason``: null for usable jobs, else the final error message.

    The job's type, ids and key come out in the form the later steps use.
    """
    kind = text.lower(F.coalesce("job_type", F.lit("")))
    rows = claimed.withColumns({
        "job_type": kind,
        "source_uuid": F.upper(F.coalesce("source_uuid", F.lit(""))),
        "source_version": F.nullif(F.upper("source_version"), F.lit("")),
        "collection_key": text.trim(F.coalesce("collection_key", F.lit(""))),
    })
    incomplete = (F.coalesce("job_id", F.lit(0)) <= 0) | (F.col("source_uuid") == "") | (F.col("collection_key") == "")
    return rows.withColumn(
        "reject_reason",
        F.when(~F.col("job_type").isin("upsert", "delete"), F.format_string(UNSUPPORTED_TYPE, "job_type"))
        .when(incomplete, MISSING_FIELDS))


def rejected(claimed: DataFrame) -> DataFrame:
    return guard(claimed).filter("reject_reason IS NOT NULL")


def accepted(claimed: DataFrame) -> DataFrame:
    return guard(claimed).filter("reject_reason IS NULL").drop("reject_reason")


def flag_stale(guarded: DataFrame, seen: DataFrame) -> DataFrame:
    """Add ``is_stale``: an upsert whose entry was seen under the same key at another version."""
    current = seen.select(
        "source_uuid", F.upper("last_seen_version").alias("_seen_version"),
        F.col("last_seen_collection_key").alias("_seen_key"))
    stale = (
        (F.col("job_type") == "upsert") & F.col("source_version").isNotNull()
        & (F.coalesce("_seen_version", F.lit("")) != "") & (F.col("_seen_key") == F.col("collection_key"))
        & (F.col("_seen_version") != F.col("source_version")))
    return guarded.join(current, "source_uuid", "left").select(
        *guarded.columns, F.coalesce(stale, F.lit(False)).alias("is_stale"))


def drop_stale(jobs: DataFrame, stale: DataFrame, now: str) -> DataFrame:
    """The work list with the stale jobs superseded and unlocked."""
    hit = F.col("_stale").isNotNull()
    marked = jobs.join(stale.select("job_id", F.lit(True).alias("_stale")), "job_id", "left")
    return _update(marked, JOB, {
        "state": F.when(hit, "superseded").otherwise(F.col("state")),
        "locked_until": F.when(hit, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("locked_until")),
        "updated_at": F.when(hit, timestamp(now)).otherwise(F.col("updated_at")),
    })


def failed_state(retry: Column, attempts: Column) -> Column:
    final = ~retry | (F.greatest(attempts, F.lit(0)) >= MAX_ATTEMPTS)
    return F.when(final, "error").otherwise("pending")


def apply_outcomes(jobs: DataFrame, outcomes: DataFrame, now: str) -> DataFrame:
    """Acknowledge or fail jobs; ``outcomes`` is ``(job_id, ok, message, retry)``.

    Both unlock the job. Success clears the message; a failure keeps its first
    characters and goes back to pending while a retry is left.
    """
    out = outcomes.filter("job_id > 0").select(
        "job_id", F.col("ok").alias("_ok"), F.col("message").alias("_message"), F.col("retry").alias("_retry"))
    hit = F.col("_ok").isNotNull()
    state = F.when(F.col("_ok"), "done").otherwise(failed_state(F.coalesce("_retry", F.lit(True)), F.col("attempts")))
    message = F.when(~F.col("_ok"), F.substring(F.coalesce("_message", F.lit("")), 1, MESSAGE_CHARS))
    return _update(jobs.join(out, "job_id", "left"), JOB, {
        "state": F.when(hit, state).otherwise(F.col("state")),
        "locked_until": F.when(hit, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("locked_until")),
        "updated_at": F.when(hit, timestamp(now)).otherwise(F.col("updated_at")),
        "error_message": F.when(hit, message).otherwise(F.col("error_message")),
    })


def mark_deleted(seen: DataFrame, acknowledged_deletes: DataFrame, now: str) -> DataFrame:
    """Set ``deleted_at`` where entry and key match an acknowledged delete."""
    done = acknowledged_deletes.select(
        F.upper(text.trim(F.col("source_uuid"))).alias("source_uuid"),
        text.trim(F.col("collection_key")).alias("last_seen_collection_key"),
    ).filter("source_uuid <> '' AND last_seen_collection_key <> ''").distinct().withColumn("_done", F.lit(True))
    joined = seen.join(done, ["source_uuid", "last_seen_collection_key"], "left")
    return _update(joined, SEEN, {
        "deleted_at": F.when(F.col("_done"), timestamp(now)).otherwise(F.col("deleted_at"))})


def retire(
    jobs: DataFrame,
    now: str,
    superseded_days: int = 7,
    done_days: int = 30,
    error_days: int = 90,
    drop_exhausted: bool = False,
) -> DataFrame:
    """Drop closed jobs past their retention and free running jobs whose lock ran out.

    A closed job without a time stays. ``drop_exhausted`` also drops failed jobs that have
    used up their attempts, whatever their age.
    """
    if drop_exhausted:
        jobs = jobs.filter(~((F.col("state") == "error") & (F.col("attempts") >= MAX_ATTEMPTS)))
    keep_days = (
        F.when(F.col("state") == "superseded", superseded_days)
        .when(F.col("state") == "done", done_days).when(F.col("state") == "error", error_days))
    age_limit = timestamp(now) - F.make_dt_interval(days=keep_days)
    expired = (F.col("state") == "running") & (F.col("locked_until") < timestamp(now))
    return _update(jobs.filter(keep_days.isNull() | F.coalesce(F.col("updated_at") >= age_limit, F.lit(True))), JOB, {
        "state": F.when(expired, "pending").otherwise(F.col("state")),
        "locked_until": F.when(expired, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("locked_until")),
        "updated_at": F.when(expired, timestamp(now)).otherwise(F.col("updated_at")),
    })


def retire_seen(seen: DataFrame, now: str, deleted_days: int = 180) -> DataFrame:
    """Drop entries whose delete was carried out long ago."""
    return seen.filter(F.coalesce(
        F.col("deleted_at") >= timestamp(now) - F.expr(f"INTERVAL {int(deleted_days)} DAYS"), F.lit(True)))
