"""A continuous change feed: landed change files keep work list and seen table current.

Two forms take the same changes to the same end. ``watch`` brings the work list and the
seen table up to each micro-batch and also finds entries that vanished without a word.
``follow`` keeps what is known of an entry in Spark's state store and appends requests to
a log: its work grows with the changes of a batch, not with the entries ever seen.

The last change of an entry in a batch counts: by time, then by the landing of its file,
then by version. It is dropped if it is older than what was seen of the entry, or the same
version at the same time; another version at the same time arrived later and counts. A
delete mark ends an entry that was seen and is not gone yet; a later change revives it.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions import text
from tidemark.operators import changes
from tidemark.plans.sync import settle_requests
from tidemark.sources.schemas import SEEN
from tidemark.sources.store import SnapshotStore

CHANGE = "uuid string, etag string, changed timestamp_ntz, type_alias string, deleted boolean"
# Requests in the log: the number tells the requests of one entry apart, in order.
REQUEST_LOG = "source_uuid string, source_version string, collection_key string, job_type string, changed timestamp_ntz, number bigint"

STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# -- changes


def change_files(spark: SparkSession, path: str, files_per_batch: int) -> DataFrame:
    """The landed changes, in the form the later steps use, with the time their file landed."""
    rows = spark.readStream.schema(CHANGE).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return rows.withColumns({
        "uuid": F.upper("uuid"), "deleted": F.coalesce("deleted", F.lit(False)), "landed": F.col("_metadata.file_modification_time")})


def without_repeats(rows: DataFrame, within: str) -> DataFrame:
    """Each version of an entry once, as long as its repeats come ``within`` that time of each other.

    What is remembered is bounded by that time. A change older than the latest of all
    batches before, less that time, is late and dropped.
    """
    timed = rows.withColumn("_time", F.col("changed").cast("timestamp_ltz")).withWatermark("_time", within)
    return timed.dropDuplicatesWithinWatermark(["uuid", "etag", "deleted"]).drop("_time")


def usable(rows: DataFrame) -> DataFrame:
    """Changes with an entry and a time; one that is no delete needs a version, too."""
    return rows.filter("coalesce(uuid, '') <> '' AND changed IS NOT NULL AND (deleted OR coalesce(etag, '') <> '')")


def last_changes(rows: DataFrame) -> DataFrame:
    """The change that counts of each entry of a batch: ``uuid, etag, changed, deleted, collection_key``."""
    order = F.struct("changed", "landed", "deleted", "etag", "type_alias")
    last = usable(rows).groupBy("uuid").agg(F.max(order).alias("last"))
    return last.select(
        "uuid", "last.etag", "last.changed", "last.deleted",
        text.collection_key(F.coalesce("last.type_alias", F.lit(""))).alias("collection_key"))


# -- by snapshots


def requests_of(last: DataFrame, seen: DataFrame) -> DataFrame:
    """Requests of the changes that count against what was seen.

    Deletes ask for the version and key that were seen, so that they reach what is stored.
    """
    known = seen.select(
        F.col("source_uuid").alias("uuid"), "last_seen_version", "last_seen_changed", "last_seen_collection_key",
        F.col("missing_since").isNotNull().alias("gone"))
    rows = last.join(known, "uuid", "left")
    is_new = F.col("last_seen_changed").isNull() | (F.col("changed") > F.col("last_seen_changed"))
    other = (F.col("changed") == F.col("last_seen_changed")) & ((F.col("etag") != F.col("last_seen_version")) | F.col("gone"))
    ends = F.col("deleted") & ~F.col("gone") & (F.col("changed") >= F.col("last_seen_changed"))
    upserts = rows.filter(~F.col("deleted") & (is_new | other)).select(*last.columns)
    deletes = rows.filter(ends).select(
        F.col("uuid").alias("source_uuid"), F.col("last_seen_version").alias("source_version"),
        text.collection_key(F.coalesce("last_seen_collection_key", F.lit(""))).alias("collection_key"),
        F.lit("delete").alias("job_type"), "changed")
    return changes.upsert_requests(upserts).unionByName(deletes)


def apply_batch(store: SnapshotStore, rows: DataFrame, now: str, run: str, policy: str = "reference") -> None:
    """One micro-batch: the change that counts of each entry becomes a request; a repeated batch does nothing."""
    found = requests_of(last_changes(rows), store.read("seen", SEEN))
    settle_requests(store, found, now, policy, run, deletes_move_time=True)


def sweep(store: SnapshotStore, entries: DataFrame, now: str, run: str, policy: str = "reference") -> None:
    """Delete requests for seen entries that are no longer in ``entries``, a snapshot with ``uuid``."""
    gone = changes.vanished_entries(store.read("seen", SEEN), entries)
    settle_requests(store, changes.delete_requests(gone, now), now, policy, run)


def watch(
    spark: SparkSession,
    path: str,
    store: SnapshotStore,
    checkpoint: str,
    now: str | None = None,
    files_per_batch: int = 1000,
    every: str | None = None,
    entries: str | None = None,
    sweep_every: int = 1,
    repeats_within: str | None = None,
) -> StreamingQuery:
    """Follow change files under ``path``.

    ``every`` (such as ``15 minutes``) keeps running at that spacing; without it the
    query takes what is there and stops. The checkpoint takes the place of the cursor.
    ``entries`` names a snapshot of all entries; after every ``sweep_every``-th batch the
    seen entries that it lacks are taken as deleted. A batch does not start before its
    changes have landed, so a snapshot must be newer than the changes it is held against.
    ``repeats_within`` bounds how long repeated changes are looked for before the tables
    are.
    """
    rows = change_files(spark, path, files_per_batch)
    if repeats_within:
        rows = without_repeats(rows, repeats_within)

    def step(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        moment = now or str(session.sql("SELECT date_format(now(), 'yyyy-MM-dd HH:mm:ss')").first()[0])
        apply_batch(store, batch, moment, f"stream {checkpoint} {batch_id}")
        if entries and (batch_id + 1) % sweep_every == 0:
            sweep(store, session.read.parquet(entries), moment, f"sweep {checkpoint} {batch_id}")

    with state_store(spark):
        return _trigger(rows.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint), every).start()


def _trigger(writer, every: str | None):
    return writer.trigger(**({"processingTime": every} if every else {"availableNow": True}))


# -- by state


@contextmanager
def state_store(spark: SparkSession):
    """Queries started inside keep their state in files that grow with what changes."""
    settings = {
        "spark.sql.streaming.stateStore.providerClass": STATE_PROVIDER,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


class EntryState(StatefulProcessor):
    """What is known of one entry: version, time, key, whether it is gone, and its requests so far."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState("known", "etag string, micros bigint, collection_key string, gone boolean, number bigint")

    def handleInputRows(self, key, rows, timer_values):
        """Rows are the changes of one entry in a batch; the last one counts."""
        last = max(rows, key=lambda r: (r.micros, r.landed, r.deleted, r.etag or ""))
        seen = self.known.get() if self.known.exists() else None
        if last.deleted:
            if seen is None or seen[3] or last.micros < seen[1]:
                return
            request = ("delete", seen[0], seen[2])
        else:
            if seen is not None and (last.micros < seen[1] or (last.micros == seen[1] and last.etag == seen[0] and not seen[3])):
                return
            request = ("upsert", last.etag, last.collection_key)
        number = (seen[4] if seen else 0) + 1
        kind, version, collection_key = request
        self.known.update((version, last.micros, collection_key, kind == "delete", number))
        yield Row(source_uuid=key[0], source_version=version, collection_key=collection_key, job_type=kind, micros=last.micros, number=number)

    def close(self) -> None:
        pass


START = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def follow(
    spark: SparkSession,
    path: str,
    log: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    every: str | None = None,
    repeats_within: str | None = None,
) -> StreamingQuery:
    """Follow change files under ``path`` and append requests to the table ``log``, each once.

    The state of an entry lives in the state store under ``checkpoint``, parted by entry;
    no table is read or rewritten.
    """
    rows = change_files(spark, path, files_per_batch)
    if repeats_within:
        rows = without_repeats(rows, repeats_within)
    keyed = usable(rows).select(
        "uuid", "etag", "deleted", F.expr(f"timestampdiff(MICROSECOND, {START}, changed)").alias("micros"),
        F.unix_micros("landed").alias("landed"), text.collection_key(F.coalesce("type_alias", F.lit(""))).alias("collection_key"))
    found = keyed.groupBy("uuid").transformWithState(
        EntryState(), "source_uuid string, source_version string, collection_key string, job_type string, micros bigint, number bigint",
        "Append", "None")
    out = found.withColumn("changed", F.expr(f"timestampadd(MICROSECOND, micros, {START})")).select(*[f.split()[0] for f in REQUEST_LOG.split(", ")])
    with state_store(spark):
        writer = out.writeStream.format("parquet").option("path", log).option("checkpointLocation", checkpoint)
        return _trigger(writer.outputMode("append"), every).start()


def collect_changes(
    spark: SparkSession, path: str, table: str, checkpoint: str, within: str, files_per_batch: int = 1000, every: str | None = None
) -> StreamingQuery:
    """Follow change files under ``path`` and append each change once to ``table``; see ``without_repeats``."""
    kept = without_repeats(change_files(spark, path, files_per_batch), within).drop("landed")
    with state_store(spark):
        writer = kept.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint)
        return _trigger(writer.outputMode("append"), every).start()


def latest_requests(log: DataFrame) -> DataFrame:
    """The last request of each entry in a log: what is to be done of it."""
    names = [f.split()[0] for f in REQUEST_LOG.split(", ")]
    last = log.groupBy("source_uuid").agg(F.max(F.struct("number", *[n for n in names if n not in ("source_uuid", "number")])).alias("last"))
    return last.select(*[F.col(n if n == "source_uuid" else f"last.{n}").alias(n) for n in names])
