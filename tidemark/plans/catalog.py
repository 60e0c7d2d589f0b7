"""The registered queries: every operator over the whole record model of a data folder.

Results hold plain columns only: integers, texts and rounded doubles. Lists are joined
with ``|``, times are text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import text
from tidemark.operators import (
    changes, chunks, embed, enrich, items, names, payload, ranking, similarity, vectors, worklist)
from tidemark.plans import sync
from tidemark.session import free_shuffles, work_dir
from tidemark.sources.payloads import of_claim, payload_keys, payload_union
from tidemark.sources.schemas import JOB, SEEN
from tidemark.sources.store import SnapshotStore
from tidemark.sources.views import TYPES, Records
from tidemark.streaming import feed

NOW = "2024-02-01 00:00:00"
CURSOR = "2024-01-02 00:00:00"
MODEL = "bag-of-words-64"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[Records], DataFrame]):
    """Register ``fn`` under its name; it gets the record model of the folder."""
    QUERIES[fn.__name__] = lambda spark, sf_dir: plain(fn(Records(spark, sf_dir)))
    return fn


def plain(df: DataFrame) -> DataFrame:
    """Columns another engine can compare: no lists, times, flags or narrow integers."""
    out = []
    for field in df.schema:
        c = F.col(field.name)
        if isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.ArrayType):
            c = F.array_join(c, "|")
        elif isinstance(field.dataType, (T.BooleanType, T.IntegralType)):
            c = c.cast("bigint")
        out.append(c.alias(field.name))
    return df.select(*out)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """A table written once to the shared folder and read back."""
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_buckets(df: DataFrame, purpose: str, key: str) -> DataFrame:
    """A table written once to the shared folder, in as many buckets of ``key`` as a shuffle has partitions.

    Joins by the key do not move it, and the shuffles that made it can go.
    """
    spark, name = df.sparkSession, f"{purpose}_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(parts, key).option("path", work_dir(spark, purpose)).saveAsTable(name)
    del df
    free_shuffles(spark)
    return spark.table(name)


# -- sources


@query
def payload_rows(r: Records) -> DataFrame:
    return payload_union(r.payloads).select("dbtable", "entry_id", F.to_json("payload").alias("payload_json"))


# -- change capture


def _accepted(r: Records) -> DataFrame:
    return changes.accepted_changes(changes.changed_entries(r.sysentry, r.systype, CURSOR))


def _vanished(r: Records) -> DataFrame:
    return changes.vanished_entries(r.seen, r.sysentry)


def _requests(r: Records) -> DataFrame:
    return changes.upsert_requests(_accepted(r)).unionByName(changes.delete_requests(_vanished(r), NOW))


@query
def enqueue_changed(r: Records) -> DataFrame:
    return _accepted(r)


@query
def enqueue_changed_batch(r: Records) -> DataFrame:
    scanned = changes.changed_entries(r.sysentry, r.systype, CURSOR, limit=changes.CHANGED_BATCH)
    return changes.accepted_changes(scanned)


@query
def enqueue_changed_ranked(r: Records) -> DataFrame:
    scanned = changes.changed_entries(r.sysentry, r.systype, CURSOR)
    order = [F.col("changed"), F.col("uuid")]
    return ranking.bucketed_rank(scanned, changes.changed_levels(), order).select("uuid", "changed", "rank")


@query
def cursor_advance(r: Records) -> DataFrame:
    return changes.cursor_after(changes.changed_entries(r.sysentry, r.systype, CURSOR), CURSOR)


@query
def enqueue_deletes(r: Records) -> DataFrame:
    return _vanished(r)


@query
def supersede_pending(r: Records) -> DataFrame:
    out = changes.supersede_pending(r.jobs, changes.upsert_requests(_accepted(r)), NOW)
    return out.select("job_id", "state", "updated_at")


@query
def supersede_keep_same_version(r: Records) -> DataFrame:
    out = changes.supersede_pending(r.jobs, changes.upsert_requests(_accepted(r)), NOW, "keep_same_version")
    return out.select("job_id", "state", "updated_at")


@query
def job_insert_ignore(r: Records) -> DataFrame:
    return changes.insert_if_absent(r.jobs, _requests(r), NOW)


@query
def delete_job_link(r: Records) -> DataFrame:
    gone = _vanished(r)
    jobs = changes.insert_if_absent(r.jobs, changes.delete_requests(gone, NOW), NOW)
    return changes.link_delete_jobs(r.seen, gone, jobs).select("source_uuid", "delete_job_id")


@query
def seen_merge(r: Records) -> DataFrame:
    return changes.merge_seen(r.seen, _accepted(r), NOW)


@query
def seen_mark_missing(r: Records) -> DataFrame:
    return changes.mark_missing(r.seen, _vanished(r), NOW).select("source_uuid", "missing_since")


# -- work list


@query
def claim_batch(r: Records) -> DataFrame:
    out = worklist.claim_batch(r.jobs, NOW)
    return out.select("job_id", "state", "locked_until", "attempts", "updated_at")


@query
def claim_all(r: Records) -> DataFrame:
    out = worklist.claim_batch(r.jobs, NOW, limit=None)
    return out.select("job_id", "state", "locked_until", "attempts", "updated_at")


def _running(r: Records) -> DataFrame:
    return r.jobs.filter("state = 'running'")


@query
def claim_rejects(r: Records) -> DataFrame:
    return worklist.rejected(r.jobs).select("job_id", "reject_reason")


@query
def stale_vs_seen(r: Records) -> DataFrame:
    flagged = worklist.flag_stale(worklist.accepted(r.jobs), r.seen)
    out = worklist.drop_stale(r.jobs, flagged.filter("is_stale"), NOW)
    return out.select("job_id", "state", "locked_until", "updated_at")


def _outcomes(r: Records) -> DataFrame:
    """Running jobs end well or badly by id; messages are longer than what is kept."""
    job = F.col("job_id")
    return _running(r).select(
        "job_id", (job % 3 != 0).alias("ok"),
        F.concat(F.lit("failed "), F.repeat(F.lit("x"), 5000)).alias("message"), (job % 2 == 0).alias("retry"))


@query
def ack_apply(r: Records) -> DataFrame:
    out = worklist.apply_outcomes(r.jobs, _outcomes(r).filter("ok"), NOW)
    return out.select("job_id", "state", "locked_until", "updated_at", "error_message")


@query
def ack_seen(r: Records) -> DataFrame:
    deletes = r.jobs.filter("job_type = 'delete'")
    return worklist.mark_deleted(r.seen, deletes, NOW).select("source_uuid", "deleted_at")


@query
def fail_apply(r: Records) -> DataFrame:
    out = worklist.apply_outcomes(r.jobs, _outcomes(r).filter("NOT ok"), NOW)
    return out.select("job_id", "state", "locked_until", "attempts", F.length("error_message").alias("message_length"))


@query
def retention_cleanup(r: Records) -> DataFrame:
    return worklist.retire(r.jobs, NOW).select("job_id", "state", "locked_until", "updated_at")


@query
def retention_seen(r: Records) -> DataFrame:
    seen = worklist.mark_deleted(r.seen, r.jobs.filter("job_type = 'delete'"), "2023-01-01 00:00:00")
    return worklist.retire_seen(seen, NOW).select("source_uuid", "deleted_at")


# -- items


def _usable(r: Records) -> DataFrame:
    return worklist.accepted(r.jobs)


def _item_columns(built: DataFrame) -> DataFrame:
    return built.select(
        "job_id", "action", "collection_key", "hash", "content_type", "content_uuid", "content_version",
        "type_alias", "archive", "public", "tags", "ref_uuids", "name",
        F.col("content.sysentry.id").alias("entry_id"), F.col("content.sysentry.changed").alias("changed"),
        F.col("content.sysentry.etag").alias("etag"), F.col("content.type.table").alias("type_table"))


@query
def item_build(r: Records) -> DataFrame:
    return _item_columns(items.upsert_items(
        _usable(r), r.sysentry, r.systype, payload_union(r.payloads), r.access, r.names, r.tags, r.links,
        keep=lambda refs: in_buckets(refs, "refs", "entry_id")))


@query
def item_build_claimed(r: Records) -> DataFrame:
    """The items of a claim of a thousand jobs, from the payload rows of that claim only."""
    ids = worklist.claimable(r.jobs, NOW, 1000)
    batch = written(worklist.accepted(r.jobs.join(ids, "job_id", "left_semi")), "batch")
    claimed = written(items.claimed_entries(batch, r.sysentry, r.systype), "claimed")
    payloads = payload_union(of_claim(r.payloads, claimed))
    return _item_columns(items.upsert_items(
        batch, r.sysentry, r.systype, payloads, r.access, r.names, r.tags, r.links, claimed.select("entry_id")))


@query
def item_size(r: Records) -> DataFrame:
    built = items.upsert_items(
        _usable(r), r.sysentry, r.systype, payload_union(r.payloads), r.access, r.names, r.tags, r.links)
    return built.select("job_id", "size")


def _missing(r: Records, jobs: DataFrame) -> DataFrame:
    """Jobs without an item, where every thirteenth entry has lost its payload row."""
    keys = payload_keys(r.payloads).filter("entry_id % 13 <> 5")
    return items.missing_payload(jobs, r.sysentry, r.systype, keys)


@query
def item_missing_payload(r: Records) -> DataFrame:
    return _missing(r, _usable(r)).select("job_id", "source_uuid")


@query
def item_public(r: Records) -> DataFrame:
    flags = items.public_flags(r.access)
    return r.sysentry.select(F.col("id").alias("entry_id")).join(flags, "entry_id", "left").select(
        "entry_id", F.coalesce("public", F.lit(0)).alias("public"))


@query
def item_name(r: Records) -> DataFrame:
    return items.display_names(r.names)


@query
def item_tags(r: Records) -> DataFrame:
    return items.entry_tags(r.tags)


@query
def item_refs(r: Records) -> DataFrame:
    return items.entry_refs(r.links, r.sysentry)


@query
def item_hash(r: Records) -> DataFrame:
    return r.jobs.select(
        "job_id", text.item_hash(F.col("collection_key"), F.col("source_uuid"), F.col("source_version")).alias("hash"))


@query
def item_deletes(r: Records) -> DataFrame:
    return items.delete_items(_usable(r))


# -- enrichment


@query
def route_type(r: Records) -> DataFrame:
    content_alias = F.when(F.col("k") % 4 == 0, F.concat(F.lit("  "), F.upper("alias"), F.lit("\t"))).when(
        F.col("k") % 4 == 1, F.lit(" ")).when(F.col("k") % 4 == 2, F.lit("unknown"))
    routed = enrich.route(content_alias, F.col("alias"))
    return r.every_entry.select("id", routed.alias("routed"), enrich.parser_of(routed).alias("parser"))


@query
def meta_merge(r: Records) -> DataFrame:
    k = F.col("k")
    old = F.create_map(F.lit("keep"), F.col("alias"), F.lit("name"), F.lit("old"))
    new = F.when(k % 3 == 0, F.create_map(F.lit("name"), F.col("label"), F.lit("added"), k.cast("string"))).when(
        k % 3 == 1, F.expr("cast(map() AS map<string,string>)"))
    merged = enrich.merge_maps(old, new)
    return r.every_entry.select("id", merged.alias("m")).select(
        "id", F.col("m.keep").alias("keep"), F.col("m.name").alias("name"), F.col("m.added").alias("added"))


def _enrich_query(alias: str):
    def run(r: Records) -> DataFrame:
        return enrich.enrich_payload(r.payload(alias), alias)

    run.__name__ = f"enrich_{alias}"
    return run


for _, _alias in TYPES:
    query(_enrich_query(_alias))


@query
def enrich_union(r: Records) -> DataFrame:
    rows = enrich.enriched_union(r.payloads, {alias: alias for _, alias in TYPES})
    spaces = F.to_json(F.struct(*enrich.RULES))
    return rows.select("entry_id", "parser", spaces.alias("meta_json"))


@query
def enrich_open(r: Records) -> DataFrame:
    """The same over open payloads: one frame of variants, typed per row."""
    rows = payload_union(r.payloads)
    content = F.struct(F.struct(F.col("dbtable").alias("alias")).alias("type"), "payload")
    frame = rows.select("entry_id", F.lit(None).cast("string").alias("type_alias"), content.alias("content"))
    spaces = F.to_json(F.struct(*enrich.RULES))
    return enrich.enrich_items(frame).select("entry_id", "parser", spaces.alias("meta_json"))


# -- chunks and vectors of texts


@query
def chunk_documents(r: Records) -> DataFrame:
    rows = chunks.chunk_rows(r.table("documents").select("doc_id", "text"))
    return rows.select("doc_id", "chunk_index", F.md5("text").alias("text_md5"), F.char_length("text").alias("n_chars"))


@query
def chunk_numbers(r: Records) -> DataFrame:
    """Turns of a conversation as chunks made elsewhere; every fifth turn is blank."""
    blank = (F.col("conv_id") + F.col("turn")) % 5 == 0
    turns = r.table("conversations").withColumn("text", F.when(blank, "  ").otherwise(F.col("text")))
    meta = chunks.merged_metadata(
        F.create_map(F.lit("role"), F.lit("item"), F.lit("conv"), F.col("conv_id").cast("string")),
        F.create_map(F.lit("conv"), F.lit("parsed")), F.create_map(F.lit("role"), F.col("role")))
    return chunks.number_chunks(turns.withColumn("meta", meta), "conv_id", "turn").select(
        "conv_id", "chunk_index", "num_chunks", F.md5("text").alias("text_md5"),
        F.col("meta.role").alias("role"), F.col("meta.conv").alias("conv"))


@query
def embed_cache_misses(r: Records) -> DataFrame:
    rows = chunks.chunk_rows(r.table("documents").select("doc_id", "text"))
    known = rows.filter("doc_id % 3 = 0").select(
        embed.cache_key(MODEL, F.col("text")).alias("cache_key"), F.lit(MODEL).alias("model")).distinct()
    return embed.cache_misses(rows, known, MODEL).select("cache_key", F.md5("text").alias("text_md5"))


@query
def embed_chunks(r: Records) -> DataFrame:
    rows = chunks.chunk_rows(r.table("documents").select("doc_id", "text"))
    empty = r.spark.createDataFrame([], embed.CACHE)
    cached = embed.embed_texts(embed.cache_misses(rows, empty, MODEL), embed.bag_of_words(64), MODEL)
    used = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.get("vector", i) != 0)
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return cached.select(
        "cache_key", F.size("vector").alias("dims"), used.alias("buckets"), F.round(square, 3).alias("square"))


def moody(texts: list[str]) -> list[list[float]]:
    """A model that refuses some texts, gives nothing for others, and a shorter vector for a few."""
    if any(len(t) % 7 == 0 for t in texts):
        raise ValueError("refused")
    return [[] if len(t) % 11 == 0 else [1.0] * (3 if len(t) % 13 == 0 else 4) for t in texts]


@query
def embed_failures(r: Records) -> DataFrame:
    """Every distinct chunk under a model that fails on some: a vector or the reason why not."""
    rows = chunks.chunk_rows(r.table("documents").select("doc_id", "text"))
    found = embed.embed_results(embed.cache_misses(rows, r.spark.createDataFrame([], embed.CACHE), MODEL), moody, MODEL, dims=4)
    return found.select("cache_key", F.size("vector").alias("dims"), "error")


# -- payload rows


def doc_chunks(r: Records, stale: bool = False) -> DataFrame:
    """Typed chunk rows of all documents; ``stale`` gives every fourth an older version."""
    docs = r.table("documents").select("doc_id", "lang", "source", "text")
    entry = r.every_entry.filter("alias = 'text'").select(F.col("k").alias("doc_id"), "uuid", "etag", "archive")
    old = F.upper(F.md5(F.concat(F.lit("stale:"), "uuid")))
    version = F.when(F.col("doc_id") % 4 == 0, old).otherwise(F.col("etag")) if stale else F.col("etag")
    metadata = F.struct(
        F.col("uuid").alias("content_uuid"), version.alias("content_version"), F.lit("text").alias("type_alias"),
        F.concat(F.lit(" "), "source").alias("name"), "lang", "archive",
        F.when(F.col("doc_id") % 3 == 0, 1).otherwise(0).alias("public"),
        F.array(F.lit(" Doc "), F.upper("lang"), "lang", F.lit("")).alias("tags"),
        F.array("uuid", F.lower("uuid"), F.lit("zz")).alias("ref_uuids"),
        F.when(F.col("doc_id") % 2 == 0, F.struct(F.lit("text/plain").alias("mime"))).alias("text"))
    return chunks.chunk_rows(docs.join(entry, "doc_id").select(
        F.lit("text").alias("chunk_collection_key"),
        text.item_hash(F.lit("text"), F.col("uuid"), version).alias("hash"), metadata.alias("metadata"), "text"))


def points(r: Records, stale: bool = False) -> DataFrame:
    return vectors.with_point_ids(payload.build_payload(doc_chunks(r, stale)))


def open_chunks(r: Records) -> DataFrame:
    """Chunks with open metadata, many of them broken in one way or another."""
    rows = r.spark.sql("""
        SELECT doc_id,
            CASE WHEN doc_id % 31 = 3 THEN ' ' ELSE 'XRM' END AS chunk_collection_key,
            CASE WHEN doc_id % 29 = 4 THEN -1 ELSE cast(doc_id % 4 AS int) END AS chunk_index,
            CASE WHEN doc_id % 37 = 5 THEN ' ' ELSE concat('  ', text) END AS text,
            CASE WHEN doc_id % 41 = 6 THEN '' ELSE concat(' ', md5(text)) END AS hash,
            concat(
                '{{"content_uuid":', CASE doc_id % 43 WHEN 7 THEN 'null' WHEN 8 THEN '5' WHEN 9 THEN '" "'
                    ELSE concat('"aa-', md5(cast(doc_id AS string)), '"') END,
                ',"tags":', CASE doc_id % 11 WHEN 1 THEN '"x"' WHEN 2 THEN 'null' WHEN 3 THEN '[]'
                    ELSE concat('[" Foo ","foo","', lang, '",7,true,"  ",{{"a":1}}]') END,
                ',"ref_uuids":', CASE doc_id % 13 WHEN 1 THEN '"x"'
                    ELSE concat('["aa-bb","AABB","  aabb  ","zz","","', md5(cast(doc_id AS string)), '"]') END,
                CASE doc_id % 17 WHEN 1 THEN ',"num_chunks":"x"' WHEN 2 THEN ',"num_chunks":0'
                    WHEN 3 THEN ',"num_chunks":"3"' WHEN 4 THEN ',"num_chunks":null' WHEN 5 THEN ''
                    ELSE ',"num_chunks":7' END,
                CASE doc_id % 19 WHEN 1 THEN ',"archive":2' WHEN 2 THEN ',"archive":true'
                    WHEN 3 THEN ',"archive":"1"' WHEN 4 THEN '' ELSE ',"archive":0' END,
                CASE doc_id % 23 WHEN 1 THEN ',"public":"2"' WHEN 2 THEN ',"public":false' ELSE ',"public":1' END,
                ',"name":', CASE WHEN doc_id % 3 = 0 THEN '"  "' ELSE concat('" Name ', doc_id, ' "') END,
                CASE WHEN doc_id % 5 = 0 THEN '' ELSE concat(',"custom":{{"a":', doc_id, '}},"added":"x"') END,
                ',"job_id":5,"state":"x","action":"upsert"',
                CASE WHEN doc_id % 2 = 0 THEN concat(',"lang":"', lang, '"') ELSE ',"lang":12' END,
                '}}') AS metadata_json
        FROM {documents}""", documents=r.table("documents"))
    return rows.withColumn("metadata", F.parse_json("metadata_json")).drop("metadata_json")


@query
def payload_rejects(r: Records) -> DataFrame:
    return payload.reject_chunks(open_chunks(r)).select("doc_id", "invalid_reason")


@query
def payload_build(r: Records) -> DataFrame:
    rows = payload.build_payload(open_chunks(r).withColumnRenamed("doc_id", "job_id"))
    return rows.select(
        F.col("job_id").alias("doc_id"), F.md5("text").alias("text_md5"), "hash", "collection_key", "content_uuid",
        "chunktoken", "chunk_index", "name", "lang", "num_chunks", "archive", "public", "tags", "ref_uuids")


@query
def payload_meta(r: Records) -> DataFrame:
    rows = payload.build_payload(open_chunks(r).withColumnRenamed("doc_id", "job_id"))
    return rows.select(F.col("job_id").alias("doc_id"), "meta")


@query
def payload_typed(r: Records) -> DataFrame:
    rows = payload.build_payload(doc_chunks(r))
    return rows.select(
        "content_uuid", "chunk_index", "chunktoken", "name", "lang", "num_chunks", "archive", "public", "tags",
        "ref_uuids", "meta")


# -- the vector table


def _point_columns(df: DataFrame) -> DataFrame:
    return df.select("content_uuid", "chunk_index", "hash", F.md5("text").alias("text_md5"))


@query
def upsert_skip(r: Records) -> DataFrame:
    return _point_columns(vectors.upsert(points(r, stale=True), points(r), "skip"))


@query
def upsert_append(r: Records) -> DataFrame:
    return _point_columns(vectors.upsert(points(r, stale=True), points(r), "append"))


@query
def upsert_replace(r: Records) -> DataFrame:
    return _point_columns(vectors.upsert(points(r, stale=True), points(r), "replace"))


@query
def vector_delete(r: Records) -> DataFrame:
    """Points of deleted entries leave the table."""
    gone = items.delete_items(_usable(r)).select("content_uuid")
    return _point_columns(vectors.delete_matching(points(r), gone))


@query
def exists_by_hash(r: Records) -> DataFrame:
    return vectors.exists_by_hash(points(r), points(r, stale=True))


@query
def point_ids(r: Records) -> DataFrame:
    return points(r).select("content_uuid", "chunk_index", "point_id")


@query
def visible_rows(r: Records) -> DataFrame:
    return vectors.visible(points(r)).select("content_uuid", "chunk_index", "public", "archive")


@query
def filter_spec(r: Records) -> DataFrame:
    table = points(r)
    spec = vectors.merge_specs(vectors.VISIBLE, {"must": {"tags": "de", "type_alias": "text"}})
    return table.filter(vectors.filter_spec(table, spec)).select("content_uuid", "chunk_index", "tags")


@query
def fetch_by_uuid(r: Records) -> DataFrame:
    longest = r.table("documents").agg(F.max_by("doc_id", F.struct("n_chars", "doc_id")).alias("k"))
    uuid = longest.select(F.upper(F.md5(F.concat(F.lit("text:"), F.col("k").cast("string")))).alias("u")).first().u
    return vectors.fetch_by_uuid(points(r), uuid).select("content_uuid", "chunk_index", "chunktoken", "name")


@query
def name_search(r: Records) -> DataFrame:
    return vectors.search_names(points(r), "SRC1").select("content_uuid", "chunk_index", "name")


@query
def name_search_prefix(r: Records) -> DataFrame:
    return vectors.search_names(points(r), "Src1", prefix=True).select("content_uuid", "chunk_index", "name")


def embedding_points(r: Records) -> DataFrame:
    """The supplied vectors with the payload fields retrieval filters on."""
    k = F.col("vec_id")
    return r.table("embeddings").select(
        F.col("vec_id").alias("point_id"), F.col("embedding").alias("vector"),
        F.when(k % 3 == 0, 0).otherwise(1).alias("public"), F.when(k % 7 == 0, 1).otherwise(0).alias("archive"),
        F.array(F.concat(F.lit("label-"), F.col("label").cast("string"))).alias("tags"))


def _query_vectors(r: Records, ids: list[int]) -> dict[str, list[float]]:
    rows = r.table("embeddings").filter(F.col("vec_id").isin(ids)).collect()
    return {f"q{row.vec_id:03d}": list(row.embedding) for row in rows}


@query
def search_topk(r: Records) -> DataFrame:
    """The best ten for one vector among visible points above a score."""
    found = vectors.search(
        embedding_points(r), _query_vectors(r, [7]), limit=10, min_score=0.1, spec=vectors.VISIBLE)
    return found.select("point_id", F.round("score", 4).alias("score"), "rank")


@query
def search_many(r: Records) -> DataFrame:
    """The best five for several vectors at once, over one label."""
    found = vectors.search(
        embedding_points(r), _query_vectors(r, [1, 2, 3, 5, 8, 13, 21, 34]), limit=5,
        spec={"must": {"tags": "label-3"}})
    return found.select("query_id", "point_id", F.round("score", 4).alias("score"), "rank")


@query
def search_frame(r: Records) -> DataFrame:
    """The best five visible points for every vector of the table."""
    asked = r.table("embeddings").select(F.col("vec_id").cast("string").alias("query_id"), F.col("embedding").alias("vector"))
    found = similarity.search_frame(embedding_points(r), asked, 5, 64, spec=vectors.VISIBLE)
    return found.select("query_id", F.col("id").alias("point_id"), F.round("score", 4).alias("score"), "rank")


@query
def search_index_all(r: Records) -> DataFrame:
    """The best five for every fifth vector by the inverted file, asking all of its lists."""
    path = f"{work_dir(r.spark, 'index')}/lists"
    centers = similarity.build_index(embedding_points(r), path, 16, 64)
    asked = r.table("embeddings").filter("vec_id % 5 = 0").select(F.col("vec_id").cast("string").alias("query_id"), F.col("embedding").alias("vector"))
    found = similarity.search_index(r.spark, path, centers, asked, 5, 64, probes=16)
    return found.select("query_id", F.col("id").alias("point_id"), F.round("score", 4).alias("score"), "rank")


@query
def lookup_many_hashes(r: Records) -> DataFrame:
    """The stored points of every hundredth document, by hash, from files laid out for that."""
    path = f"{work_dir(r.spark, 'points')}/rows"
    table = points(r)
    table.repartitionByRange("content_uuid").sortWithinPartitions("content_uuid", "chunk_index").write.options(**vectors.LOOKUP_OPTIONS).parquet(path)
    stored = r.spark.read.schema(table.schema).parquet(path)
    entry = r.every_entry.filter("alias = 'text' AND k % 100 = 0")
    wanted = entry.select(text.item_hash(F.lit("text"), F.col("uuid"), F.col("etag")).alias("hash"))
    return vectors.rows_with(stored, "hash", wanted).select("content_uuid", "chunk_index", "hash")


def _name_index(r: Records) -> str:
    path = work_dir(r.spark, "names")
    names.build_name_index(items.display_names(r.names), path, "entry_id")
    return path


@query
def name_index_lookup(r: Records) -> DataFrame:
    """All entries whose name holds all words of a product name, for every product name."""
    asked = r.table("part").select(F.col("p_name").alias("query_id"), F.col("p_name").alias("query")).distinct()
    found = names.lookup_names(r.spark, _name_index(r), asked)
    return found.select("query_id", F.col("id").cast("long").alias("entry_id"))


@query
def name_index_prefix(r: Records) -> DataFrame:
    """The same by the first two letters of each word."""
    short = F.regexp_replace("p_name", r"([a-z]{2})[a-z]*", "$1")
    asked = r.table("part").select(short.alias("query_id"), short.alias("query")).distinct()
    found = names.lookup_names(r.spark, _name_index(r), asked, prefix=True)
    return found.select("query_id", F.col("id").cast("long").alias("entry_id"))


# -- whole runs


def _batch(r: Records) -> DataFrame:
    """The upsert jobs of a run that claims everything, without refused and stale ones."""
    claimed = r.jobs.join(worklist.claimable(r.jobs, NOW, limit=None), "job_id", "left_semi")
    flagged = worklist.flag_stale(worklist.accepted(claimed), r.seen)
    return flagged.filter("NOT is_stale AND job_type = 'upsert'")


@query
def sync_entries(r: Records) -> DataFrame:
    """A whole worker run up to its payload rows: claim, guard, items, metadata, chunks, ids."""
    wanted = written(items.wanted_jobs(_batch(r), r.sysentry, r.systype), "wanted")
    rows = sync.chunk_items(sync.wanted_rows(wanted, r.sources))
    return vectors.with_point_ids(payload.build_payload(rows)).select(
        "point_id", "content_uuid", "chunk_index", "chunktoken", "type_alias", "name", "num_chunks", "archive",
        "public", "tags", "ref_uuids", "meta", F.md5("text").alias("text_md5"))


def _job_outcomes(r: Records) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Outcomes of the running jobs when only the chunks of documents get stored.

    Some entries have no payload row, and the hash of some jobs was stored before.
    """
    running = r.jobs.filter("state = 'running'")
    usable = worklist.accepted(running)
    upserts = usable.filter("job_type = 'upsert'")
    entries = r.every_entry.select(F.col("uuid").alias("content_uuid"), F.col("id").alias("job_id"))
    cut = doc_chunks(r).select("metadata.content_uuid", "chunk_index").join(entries, "content_uuid")
    stored = cut.join(upserts.select("job_id"), "job_id", "left_semi")
    missing = _missing(r, usable).select("job_id")
    live = upserts.join(missing, "job_id", "left_anti")
    rows = sync.outcomes_of(
        worklist.rejected(running), missing, usable.filter("job_type = 'delete'"), live.filter("job_id % 10 <> 3"),
        live.filter("job_id % 10 = 3").select("job_id"), stored)
    return rows, cut, stored


@query
def job_outcomes(r: Records) -> DataFrame:
    return _job_outcomes(r)[0]


@query
def run_summary(r: Records) -> DataFrame:
    return sync.run_summary(*_job_outcomes(r))


@query
def cleanup_run(r: Records) -> DataFrame:
    """The counters of a cleanup, and what it leaves."""
    store = SnapshotStore(r.spark, f"{work_dir(r.spark, 'cleanup')}/tables")
    store.write("jobs", r.jobs, by="state")
    store.write("seen", worklist.mark_deleted(r.seen, r.jobs.filter("job_type = 'delete'"), "2023-01-01 00:00:00"))
    done = sync.cleanup_run(store, NOW)
    left = store.read("jobs", JOB).groupBy("state").count()
    return left.select("state", F.col("count").alias("n"), *[F.lit(done[c]).alias(c) for c in ("jobs", "seen", "freed")])


# -- streaming


def _stream(r: Records) -> SnapshotStore:
    """Changes of contacts, taken from the event stream, cut into files by day and followed."""
    base = work_dir(r.spark, "feed")
    day = F.date_format("ts", "yyyy-MM-dd")
    rows = r.table("events").select(
        F.upper(F.md5(F.concat(F.lit("contact:"), F.col("user_id").cast("string")))).alias("uuid"),
        F.upper(F.md5(F.concat(F.lit("event:"), F.col("event_id").cast("string")))).alias("etag"),
        F.col("ts").alias("changed"), F.lit("contact").alias("type_alias"), day.alias("day"))
    rows.hint("rebalance", F.col("day")).write.partitionBy("day").parquet(f"{base}/changes")
    store = SnapshotStore(r.spark, f"{base}/tables")
    files = r.spark.read.parquet(f"{base}/changes").inputFiles()
    feed.watch(
        r.spark, f"{base}/changes/*", store, f"{base}/checkpoint", now=NOW,
        files_per_batch=max(1, len(files) // 3)).awaitTermination()
    return store


@query
def stream_changes(r: Records) -> DataFrame:
    """Pending jobs after the feed: one per entry, at its latest version."""
    jobs = _stream(r).read("jobs", JOB)
    return jobs.filter("state = 'pending'").select("source_uuid", "source_version", "collection_key")


@query
def stream_seen(r: Records) -> DataFrame:
    """Per-entry state after the feed."""
    return _stream(r).read("seen", SEEN).select(
        "source_uuid", "last_seen_version", "last_seen_changed", "last_seen_collection_key", "missing_since")


def _event_changes(r: Records) -> DataFrame:
    """Events as changes of the contact of their user; an error deletes it. ``slice`` is the third of the month."""
    ts = F.col("ts")
    third = F.when(ts < F.lit("2024-01-11").cast("timestamp_ntz"), 0).when(ts < F.lit("2024-01-21").cast("timestamp_ntz"), 1).otherwise(2)
    return r.table("events").select(
        F.upper(F.md5(F.concat(F.lit("contact:"), F.col("user_id").cast("string")))).alias("uuid"),
        F.upper(F.md5(F.concat(F.lit("event:"), F.col("event_id").cast("string")))).alias("etag"),
        ts.alias("changed"), F.lit("contact").alias("type_alias"), (F.col("event_type") == "error").alias("deleted"),
        "user_id", "event_id", third.alias("slice"))


def _life_slices(r: Records) -> list[DataFrame]:
    """Three thirds of the changes, then odd ones: another version at the time of the last, one that comes late, a repeat."""
    rows = _event_changes(r)
    last = rows.groupBy("user_id").agg(F.max(F.struct("changed", "deleted", "etag", "uuid", "type_alias", "event_id")).alias("c")).select("user_id", "c.*")

    def version(word: str) -> Column:
        return F.upper(F.md5(F.concat(F.lit(f"{word}:"), F.col("event_id").cast("string"))))

    kind = F.col("user_id") % 10
    odd = last.filter(kind.isin(3, 4, 5)).select(
        "uuid", F.when(kind == 3, version("again")).when(kind == 4, version("late")).otherwise(F.col("etag")).alias("etag"),
        F.when(kind == 4, F.lit("2023-12-01").cast("timestamp_ntz")).otherwise(F.col("changed")).alias("changed"), "type_alias",
        (F.col("deleted") & (kind == 5)).alias("deleted"))
    return [*(rows.filter(F.col("slice") == i) for i in range(3)), odd]


def _landing(r: Records, slices: list[DataFrame], purpose: str, run: Callable[[str], StreamingQuery]) -> str:
    """Lands the slices one after the other under a new folder; the feed takes each before the next one lands."""
    base = work_dir(r.spark, purpose)
    for i, rows in enumerate(slices):
        rows.select("uuid", "etag", "changed", "type_alias", "deleted").write.parquet(f"{base}/changes/{i}")
        run(base).awaitTermination()
    return base


@query
def stream_deletes(r: Records) -> DataFrame:
    """Per-entry state after a feed with delete marks and, at its end, a look for entries that are gone."""
    entries = f"{work_dir(r.spark, 'snapshot')}/entries"
    _event_changes(r).filter("user_id % 10 <> 7").select("uuid").distinct().write.parquet(entries)
    base = _landing(r, _life_slices(r), "deletes", lambda base: feed.watch(
        r.spark, f"{base}/changes/*", SnapshotStore(r.spark, f"{base}/tables"), f"{base}/checkpoint", now=NOW, entries=entries, sweep_every=4))
    store = SnapshotStore(r.spark, f"{base}/tables")
    jobs = store.read("jobs", JOB).select(F.col("job_id").alias("delete_job_id"), F.col("source_version").alias("delete_version"))
    return store.read("seen", SEEN).join(jobs, "delete_job_id", "left").select(
        "source_uuid", "last_seen_version", "last_seen_changed", F.col("missing_since").isNotNull().alias("is_missing"), "delete_version")


@query
def stream_state(r: Records) -> DataFrame:
    """The last request of every entry, from a log that the state store keeps free of repeats."""
    base = _landing(r, _life_slices(r), "state", lambda base: feed.follow(
        r.spark, f"{base}/changes/*", f"{base}/log", f"{base}/checkpoint"))
    return feed.latest_requests(r.spark.read.schema(feed.REQUEST_LOG).parquet(f"{base}/log"))


@query
def stream_dedup(r: Records) -> DataFrame:
    """Changes that come up to three times, and some that come after their time."""
    rows = _event_changes(r)
    first, held = rows.filter("slice = 0 AND event_id % 7 <> 0"), rows.filter("slice = 0 AND event_id % 7 = 0")
    slices = [
        first, rows.filter("slice = 1").unionByName(first.filter("event_id % 3 = 0")),
        rows.filter("slice = 2").unionByName(first.filter("event_id % 5 = 0")).unionByName(held)]
    base = _landing(r, slices, "repeats", lambda base: feed.collect_changes(
        r.spark, f"{base}/changes/*", f"{base}/table", f"{base}/checkpoint", "12 days"))
    return r.spark.read.schema(feed.CHANGE).parquet(f"{base}/table").select("uuid", "etag", "changed", "deleted")
