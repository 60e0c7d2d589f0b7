"""Item assembly: every job of a batch joined once with all it needs."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text

# The access row that makes an entry public, and the content types.
PUBLIC_USER_ID = 1
PUBLIC_MODE = "visitor"
UPSERT_CONTENT = "application/x-xrm-sysentry-json"
DELETE_CONTENT = "application/x-embedding-job-delete"


def entries_of(jobs: DataFrame, entries: DataFrame, types: DataFrame) -> DataFrame:
    """Jobs with the current row of their entry and its type; unknown ones are dropped."""
    return _typed(_current(jobs, entries), types)


def _current(jobs: DataFrame, entries: DataFrame, code: Callable[[Column], Column] = lambda c: c) -> DataFrame:
    """Jobs with the current row of their entry.

    ``code`` is what the ``source_uuid`` of the jobs is coded by; ``etag`` comes out so, too.
    """
    current = entries.select(
        code(F.upper("uuid")).alias("source_uuid"), F.col("id").alias("entry_id"), "type_id", code(F.col("etag")).alias("etag"),
        "archive", "created", "changed")
    return jobs.join(current, "source_uuid")


def _typed(rows: DataFrame, types: DataFrame) -> DataFrame:
    """Rows with their type, if it is known."""
    kinds = types.select(F.col("id").alias("type_id"), F.col("alias").alias("type_alias"), "dbtable")
    return rows.join(F.broadcast(kinds), "type_id")  # a short row per type


def public_flags(access: DataFrame) -> DataFrame:
    """``(entry_id, public = 1)`` of entries the public user may visit."""
    return (
        access.filter((F.col("user_id") == PUBLIC_USER_ID) & (F.col("mode") == PUBLIC_MODE))
        .select("entry_id").distinct().withColumn("public", F.lit(1)))


def display_names(names: DataFrame) -> DataFrame:
    """The name in the highest language; a blank one is absent, with no fall back."""
    top = names.groupBy("entry_id").agg(F.max(F.struct("lang_id", "name")).alias("top"))
    return top.select("entry_id", text.non_blank(F.col("top.name")).alias("name")).filter("name IS NOT NULL")


def entry_tags(tags: DataFrame) -> DataFrame:
    """Distinct trimmed lower-case tags per entry, in order.

    Repeats go before the lists are built, so a hot entry costs only its distinct tags.
    """
    clean = tags.select("entry_id", text.lower(text.non_blank(F.col("tag"))).alias("tag")).filter("tag IS NOT NULL")
    return clean.distinct().groupBy("entry_id").agg(F.array_sort(F.collect_list("tag")).alias("tags"))


def entry_refs(links: DataFrame, entries: DataFrame) -> DataFrame:
    """Ids of the entries each entry points to, in entry order; vanished peers drop out.

    Edges are made distinct before the join, so a popular pair is joined once. An edge moves to
    its entry once, with the id as bytes; of peers with one id the first stays.
    """
    peers = entries.select(F.col("id").alias("peer_id"), text.upper_hex(F.col("uuid")).alias("hex"))
    peers = peers.filter(F.length("hex") == 32).select("peer_id", F.unhex("hex").alias("code"))
    edges = links.select("entry_id", "peer_id").distinct().join(peers, "peer_id").repartition("entry_id")
    listed = edges.groupBy("entry_id").agg(F.array_sort(F.collect_set(F.struct("peer_id", "code"))).alias("refs"))
    return listed.select("entry_id", F.array_distinct(F.transform("refs", lambda r: F.hex(r["code"]))).alias("ref_uuids"))


def delete_items(jobs: DataFrame) -> DataFrame:
    """Items of delete jobs: identity only, no lookups."""
    return jobs.filter("job_type = 'delete'").select(
        "job_id", F.lit("delete").alias("action"), "collection_key",
        text.item_hash(F.col("collection_key"), F.col("source_uuid"), F.col("source_version")).alias("hash"),
        F.lit(DELETE_CONTENT).alias("content_type"), F.lit(0).cast("bigint").alias("size"),
        F.col("source_uuid").alias("content_uuid"), F.col("source_version").alias("content_version"))


def _wanted(jobs: DataFrame, entries: DataFrame, types: DataFrame) -> DataFrame:
    """Upsert jobs with their entry, where a payload row can be looked for."""
    return entries_of(jobs.filter("job_type = 'upsert'"), entries, types).filter("entry_id > 0 AND dbtable <> ''")


def wanted_jobs(jobs: DataFrame, entries: DataFrame, types: DataFrame) -> DataFrame:
    """What ``upsert_items`` starts from: upsert jobs with their entry, ids and versions as bytes in ``ids``."""
    return _typed(_untyped(jobs, entries), types).filter("dbtable <> ''")


def _untyped(jobs: DataFrame, entries: DataFrame) -> DataFrame:
    """``wanted_jobs`` without the names of their types, which take room in every row."""
    code = partial(text.packed, bare=True)
    short = jobs.filter("job_type = 'upsert'").select("job_id", "collection_key", *[code(F.col(c)).alias(c) for c in ("source_uuid", "source_version")])
    rows = _current(short, entries, code).filter("entry_id > 0")
    ids = text.packed_ids(F.col("source_uuid"), F.col("source_version"), F.col("etag"))
    return rows.withColumn("ids", ids).drop("source_uuid", "source_version", "etag")


def claimed_entries(jobs: DataFrame, entries: DataFrame, types: DataFrame) -> DataFrame:
    """``(dbtable, entry_id)`` of the payload rows that the upsert jobs of a claim need."""
    return _wanted(jobs, entries, types).select("dbtable", "entry_id").distinct()


def missing_payload(jobs: DataFrame, entries: DataFrame, types: DataFrame, keys: DataFrame) -> DataFrame:
    """Upsert jobs for which no item can be built: the entry or its payload row is gone.

    ``keys`` are the ``(dbtable, entry_id)`` pairs that have a payload row.
    """
    built = _wanted(jobs, entries, types).join(keys, ["dbtable", "entry_id"], "left_semi")
    return jobs.filter("job_type = 'upsert'").join(built.select("job_id"), "job_id", "left_anti")


def upsert_items(
    jobs: DataFrame,
    entries: DataFrame,
    types: DataFrame,
    payloads: DataFrame,
    access: DataFrame,
    names: DataFrame,
    tags: DataFrame,
    links: DataFrame,
    batch: DataFrame | None = None,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Items of upsert jobs with payload and metadata; jobs without payload are left out.

    Further columns of ``payloads``, such as namespaces, stay on the item. ``batch``
    (``entry_id``) cuts the side tables to a small claim before they are
    grouped. Leave it out when most entries are claimed: the cut would cost more than
    it saves. ``keep`` writes a table by ``entry_id`` and reads it back: with it the references are
    listed first, so that what was shuffled to list them need not stay until the items are made.
    """
    return wanted_items(_untyped(jobs, entries), entries, payloads, access, names, tags, links, batch, types, keep)


def wanted_items(
    wanted: DataFrame,
    entries: DataFrame,
    payloads: DataFrame,
    access: DataFrame,
    names: DataFrame,
    tags: DataFrame,
    links: DataFrame,
    batch: DataFrame | None = None,
    types: DataFrame | None = None,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The items of ``wanted_jobs``, as ``upsert_items`` makes them; ``types`` are those of rows still without."""
    # The entry id alone names a payload row but for the table; joined on it, this join and those of
    # the side tables share one partitioning, and the payload is moved once. Written as "=", the table
    # would be made a join key, and all rows would be moved again for the side tables. Ids and versions
    # are moved as bytes.
    named = payloads.withColumnRenamed("dbtable", "_table")
    base = wanted.join(named, "entry_id")
    if types is not None:
        base = _typed(base, types).filter("dbtable <> ''")
    base = base.filter("dbtable >= _table AND dbtable <= _table").drop("_table")

    def of_batch(rows: DataFrame) -> DataFrame:
        return rows if batch is None else rows.join(batch, "entry_id", "left_semi")

    refs = entry_refs(of_batch(links), entries)
    if keep is not None:
        refs = keep(refs)

    joined = (
        base.join(public_flags(of_batch(access)), "entry_id", "left")
        .join(entry_tags(of_batch(tags)), "entry_id", "left")
        .join(refs, "entry_id", "left")
        .join(display_names(of_batch(names)), "entry_id", "left"))
    joined = joined.withColumns(dict(zip(("source_uuid", "source_version", "etag"), text.unpacked_ids(F.col("ids")))))
    item = joined.select(
        "job_id", F.lit("upsert").alias("action"), "collection_key",
        text.item_hash(F.col("collection_key"), F.col("source_uuid"), F.col("source_version")).alias("hash"),
        F.lit(UPSERT_CONTENT).alias("content_type"),
        F.col("source_uuid").alias("content_uuid"), F.col("source_version").alias("content_version"),
        F.nullif("type_alias", F.lit("")).alias("type_alias"),
        F.when(F.col("archive") == 1, 1).otherwise(0).alias("archive"),
        F.coalesce("public", F.lit(0)).alias("public"),
        "tags", "ref_uuids", "name",
        *[c for c in payloads.columns if c not in ("dbtable", "entry_id", "payload")],
        F.struct(
            F.struct(
                F.col("entry_id").alias("id"), F.col("source_uuid").alias("uuid"), "type_id",
                F.date_format("changed", "yyyy-MM-dd HH:mm:ss").alias("changed"),
                F.date_format("created", "yyyy-MM-dd HH:mm:ss").alias("created"),
                F.upper(F.coalesce("etag", "source_version", F.lit(""))).alias("etag"),
            ).alias("sysentry"),
            F.struct(F.col("type_id").alias("id"), F.col("type_alias").alias("alias"), F.col("dbtable").alias("table")).alias("type"),
            "payload",
        ).alias("content"))
    return item.withColumn("size", content_size())


def content_size():
    """Bytes of the content as JSON; absent keys take no space, unknown content counts 0."""
    return F.coalesce(F.octet_length(F.to_json("content", {"ignoreNullFields": "false"})), F.lit(0)).cast("bigint")
