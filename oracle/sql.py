"""One DuckDB statement per registered query."""

from __future__ import annotations

from oracle.views import TIME, ts, with_views

NOW = "TIMESTAMP '2024-02-01 00:00:00'"
NOW_TEXT = "'2024-02-01 00:00:00'"
TRIM = r"E' \t\n\r\x0B'"


def _strict(column: str) -> str:
    """Seconds of a strict date, null otherwise."""
    return (
        f"CASE WHEN regexp_full_match({column}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') "
        f"THEN epoch(try_cast({column} AS DATE))::BIGINT END")


def _lenient(column: str) -> str:
    """Seconds of a date-time; the one impossible day in the data rolls over to March 2."""
    return (
        f"CASE WHEN {column} = '2024-02-31' THEN epoch(TIMESTAMP '2024-03-02 00:00:00')::BIGINT "
        f"ELSE epoch(try_cast({column} AS TIMESTAMP))::BIGINT END")


def _flag(column: str) -> str:
    return (
        f"CASE WHEN lower(trim({column})) IN ('1','true','yes','y','on') THEN 1 "
        f"WHEN lower(trim({column})) IN ('0','false','no','n','off') THEN 0 END::BIGINT")


ENRICH = {
    "account": "SELECT 100000000 + k AS id, nullif(trim(accounttype), '') AS accounttype FROM src_account",
    "address": """SELECT 200000000 + k AS id,
        CASE WHEN try_cast(lat AS DOUBLE) BETWEEN -90 AND 90 AND try_cast(lng AS DOUBLE) BETWEEN -180 AND 180 THEN try_cast(lat AS DOUBLE) END AS lat,
        CASE WHEN try_cast(lat AS DOUBLE) BETWEEN -90 AND 90 AND try_cast(lng AS DOUBLE) BETWEEN -180 AND 180 THEN try_cast(lng AS DOUBLE) END AS lng,
        nullif(trim(city), '') AS city, nullif(trim(country), '') AS country FROM src_address""",
    "contact": f"""SELECT 300000000 + k AS id, nullif(trim(firstname), '') AS firstname, nullif(trim(lastname), '') AS lastname,
        CASE WHEN {_strict('dateofbirth')} IS NOT NULL THEN dateofbirth END AS dateofbirth, {_strict('dateofbirth')} AS birth_ts FROM src_contact""",
    "date": f"""SELECT 400000000 + k AS id, {_lenient('start')} AS start_ts, {_lenient('"end"')} AS end_ts, {_flag('allday')} AS allday FROM src_date""",
    "file": """SELECT 500000000 + k AS id, trim(mime) AS mime_type, trim(filename) AS filename,
        CASE WHEN regexp_full_match(size, '[0-9]+') AND size::BIGINT > 0 THEN size::BIGINT END AS size, trim(url) AS url FROM src_file""",
    "product": """SELECT 600000000 + k AS id, trim(code) AS code,
        CASE WHEN regexp_full_match(trim(weight), '-?[0-9]+') THEN trim(weight)::BIGINT END AS weight FROM src_product""",
    "project": f"""SELECT 700000000 + k AS id, trim(projid) AS projid, trim(alias) AS alias, {_strict('start')} AS start_ts, {_strict('deadline')} AS deadline_ts FROM src_project""",
    "resource": "SELECT 800000000 + k AS id, round(quota)::BIGINT AS quota, used::BIGINT AS used FROM src_resource",
    "tag": "SELECT 900000000 + k AS id, trim(tag) AS tag FROM src_tag",
    "task": f"""SELECT 1000000000 + k AS id, {_strict('start')} AS start_ts, {_strict('deadline')} AS deadline_ts,
        CASE WHEN regexp_full_match(expense, '-?[0-9]+') THEN expense::BIGINT END AS expense, {_flag('done')} AS done FROM src_task""",
    "text": "SELECT 1100000000 + k AS id, nullif(trim(mime), '') AS mime FROM src_text",
}

# Field order inside a namespace, as the struct lists it.
FIELD_ORDER = {
    "account": ["accounttype"], "address": ["lat", "lng", "city", "country"],
    "contact": ["firstname", "lastname", "dateofbirth", "birth_ts"], "date": ["start_ts", "end_ts", "allday"],
    "file": ["filename", "size", "url", "mime_type"], "product": ["code", "weight"],
    "project": ["projid", "alias", "start_ts", "deadline_ts"], "resource": ["quota", "used"], "tag": ["tag"],
    "task": ["expense", "done", "start_ts", "deadline_ts"], "text": ["mime"],
}


def _namespace_json(alias: str) -> str:
    """The enriched rows of one type as JSON without null fields; empty objects vanish."""
    parts = ", ".join(
        f"""CASE WHEN {f} IS NOT NULL THEN '"{f}":' || to_json({f})::VARCHAR END""" for f in FIELD_ORDER[alias])
    return f"""SELECT id AS entry_id, '{alias}' AS parser,
        CASE WHEN concat_ws(',', {parts}) = '' THEN '{{}}' ELSE '{{"{alias}":{{' || concat_ws(',', {parts}) || '}}}}' END AS meta_json
        FROM ({ENRICH[alias]})"""


ENRICH_ALL = " UNION ALL ".join(_namespace_json(a) for a in ENRICH)

PAYLOAD_FIELDS = {
    "account": ["accounttype"], "address": ["city", "country", "id", "lat", "lng"],
    "contact": ["dateofbirth", "firstname", "id", "lastname"], "date": ["allday", "end", "id", "start"],
    "file": ["filename", "id", "mime", "size", "url"], "product": ["code", "id", "weight"],
    "project": ["alias", "deadline", "id", "projid", "start"], "resource": ["id", "quota", "used"],
    "tag": ["id", "tag"], "task": ["deadline", "done", "expense", "id", "start"], "text": ["id", "mime", "text"],
}
PAYLOAD_FIELDS["account"].append("id")


def _payload_json(type_id: int, alias: str) -> str:
    pairs = ", ".join(f"'{f}', \"{f}\"" for f in PAYLOAD_FIELDS[alias])
    return f"""SELECT '{alias}' AS dbtable, id AS entry_id, json_object({pairs})::VARCHAR AS payload_json
        FROM (SELECT *, {type_id}00000000::BIGINT + k AS id FROM src_{alias})"""


PAYLOADS = " UNION ALL ".join(_payload_json(i, a) for i, a in enumerate(PAYLOAD_FIELDS, 1))

JOB_COLUMNS = f"""job_id, source_uuid, source_version, collection_key, job_type, state, priority, attempts,
    {ts('locked_until')}, {ts('created_at')}, {ts('updated_at')}, error_message"""

FRESH = f"""SELECT (SELECT max(job_id) FROM jobs) + row_number() OVER (ORDER BY w.changed, w.source_uuid) AS job_id,
    w.source_uuid, w.source_version, w.collection_key, w.job_type FROM wanted w
    LEFT JOIN jobs j ON j.source_uuid = w.source_uuid AND j.source_version = w.source_version
        AND j.collection_key = w.collection_key AND j.job_type = w.job_type WHERE j.job_id IS NULL"""

CLAIMABLE = f"""SELECT job_id FROM claim_list WHERE state = 'pending' AND (locked_until IS NULL OR locked_until < {NOW})
    ORDER BY priority DESC, job_id"""


def _claim(chosen: str) -> str:
    return f"""SELECT j.job_id, CASE WHEN c.job_id IS NULL THEN state ELSE 'running' END AS state,
        CASE WHEN c.job_id IS NULL THEN {TIME.format('locked_until')} ELSE '2024-02-01 00:10:00' END AS locked_until,
        attempts + (c.job_id IS NOT NULL)::BIGINT AS attempts,
        CASE WHEN c.job_id IS NULL THEN {TIME.format('updated_at')} ELSE {NOW_TEXT} END AS updated_at
        FROM claim_list j LEFT JOIN ({chosen}) c ON c.job_id = j.job_id"""


def _supersede(extra: str) -> str:
    hit = f"m.uuid IS NOT NULL AND j.job_type = 'upsert' AND j.state = 'pending' {extra}"
    return f"""SELECT j.job_id, CASE WHEN {hit} THEN 'superseded' ELSE j.state END AS state,
        CASE WHEN {hit} THEN {NOW_TEXT} ELSE {TIME.format('j.updated_at')} END AS updated_at
        FROM jobs j LEFT JOIN moved m ON m.uuid = j.source_uuid AND m.collection_key = j.collection_key"""


POINT = "content_uuid, chunk_index, hash, text_md5"

ITEM_COLUMNS = f"""b.job_id, 'upsert' AS action, b.collection_key, sha256(b.collection_key || ':' || b.source_uuid || ':' || coalesce(b.source_version, '')) AS hash,
    'application/x-xrm-sysentry-json' AS content_type, b.source_uuid AS content_uuid, b.source_version AS content_version, b.alias AS type_alias,
    b.archive, CASE WHEN p.entry_id IS NULL THEN 0 ELSE 1 END AS public, t.tags, r.ref_uuids, n.name, b.entry_id, {ts('b.changed')},
    b.entry_etag AS etag, b.alias AS type_table"""
ITEM_TABLES = """LEFT JOIN publics p ON p.entry_id = b.entry_id LEFT JOIN taglists t ON t.entry_id = b.entry_id
    LEFT JOIN reflists r ON r.entry_id = b.entry_id LEFT JOIN topnames n ON n.entry_id = b.entry_id"""

BODIES: dict[str, str] = {
    "payload_rows": PAYLOADS,
    "enqueue_changed": f"SELECT uuid, etag, {ts('changed')}, collection_key FROM moved",
    "enqueue_changed_batch": f"SELECT uuid, etag, {ts('changed')}, collection_key FROM (SELECT * FROM moved m ORDER BY m.changed, m.uuid LIMIT 5000)",
    "enqueue_changed_ranked": f"SELECT uuid, {ts('moved.changed')}, row_number() OVER (ORDER BY moved.changed, uuid) AS rank FROM moved",
    "cursor_advance": f"SELECT {ts('changed')[:-len(' AS changed')]} AS last_changed, uuid AS last_uuid FROM (SELECT * FROM moved m ORDER BY m.changed DESC, m.uuid DESC LIMIT 1)",
    "enqueue_deletes": "SELECT source_uuid, last_seen_version, collection_key FROM gone",
    "supersede_pending": _supersede(""),
    "supersede_keep_same_version": _supersede("AND j.source_version IS DISTINCT FROM m.etag"),
    "job_insert_ignore": f"""SELECT {JOB_COLUMNS} FROM jobs UNION ALL
        SELECT job_id, source_uuid, source_version, collection_key, job_type, 'pending', 1, 0, NULL, {NOW_TEXT}, {NOW_TEXT}, NULL FROM ({FRESH})""",
    "delete_job_link": f"""SELECT s.source_uuid, coalesce(o.job_id, n.job_id) AS delete_job_id FROM seen s
        LEFT JOIN gone g ON g.source_uuid = s.source_uuid
        LEFT JOIN jobs o ON o.source_uuid = g.source_uuid AND o.source_version = g.last_seen_version AND o.collection_key = g.collection_key AND o.job_type = 'delete'
        LEFT JOIN (SELECT (SELECT max(job_id) FROM jobs) + row_number() OVER (ORDER BY source_uuid) AS job_id, source_uuid FROM gone
            WHERE NOT EXISTS (SELECT 1 FROM jobs o WHERE o.source_uuid = gone.source_uuid AND o.source_version = gone.last_seen_version
                AND o.collection_key = gone.collection_key AND o.job_type = 'delete')) n ON n.source_uuid = g.source_uuid""",
    "seen_merge": f"""SELECT coalesce(m.uuid, s.source_uuid) AS source_uuid, coalesce(m.etag, s.last_seen_version) AS last_seen_version,
        {TIME.format('coalesce(m.changed, s.last_seen_changed)')} AS last_seen_changed,
        CASE WHEN m.uuid IS NULL THEN {TIME.format('s.last_seen_at')} ELSE {NOW_TEXT} END AS last_seen_at,
        coalesce(m.collection_key, s.last_seen_collection_key) AS last_seen_collection_key,
        CASE WHEN m.uuid IS NULL THEN {TIME.format('s.missing_since')} END AS missing_since,
        CASE WHEN m.uuid IS NULL THEN s.delete_job_id END AS delete_job_id,
        CASE WHEN m.uuid IS NULL THEN {TIME.format('s.deleted_at')} END AS deleted_at
        FROM seen s FULL JOIN moved m ON m.uuid = s.source_uuid""",
    "seen_mark_missing": f"""SELECT source_uuid, CASE WHEN source_uuid IN (SELECT source_uuid FROM gone) AND missing_since IS NULL
        THEN {NOW_TEXT} ELSE {TIME.format('missing_since')} END AS missing_since FROM seen""",
    "claim_batch": _claim(f"{CLAIMABLE} LIMIT 5"),
    "claim_all": _claim(CLAIMABLE),
    "claim_rejects": """SELECT job_id, CASE WHEN job_type NOT IN ('upsert', 'delete') THEN 'Extractor: unsupported job_type ''' || job_type || ''''
        ELSE 'Extractor: missing job_id/source_uuid/collection_key' END AS reject_reason
        FROM jobs WHERE job_type NOT IN ('upsert', 'delete') OR job_id <= 0 OR trim(collection_key) = ''""",
    "stale_vs_seen": f"""SELECT j.job_id, CASE WHEN x.job_id IS NULL THEN j.state ELSE 'superseded' END AS state,
        CASE WHEN x.job_id IS NULL THEN {TIME.format('j.locked_until')} END AS locked_until,
        CASE WHEN x.job_id IS NULL THEN {TIME.format('j.updated_at')} ELSE {NOW_TEXT} END AS updated_at
        FROM jobs j LEFT JOIN (SELECT u.job_id FROM usable u JOIN seen s ON s.source_uuid = u.source_uuid AND s.last_seen_collection_key = u.collection_key
            WHERE u.job_type = 'upsert' AND u.source_version <> s.last_seen_version) x ON x.job_id = j.job_id""",
    "ack_apply": f"""SELECT job_id, CASE WHEN ok THEN 'done' ELSE state END AS state, CASE WHEN ok THEN NULL ELSE {TIME.format('locked_until')} END AS locked_until,
        CASE WHEN ok THEN {NOW_TEXT} ELSE {TIME.format('updated_at')} END AS updated_at, CASE WHEN ok THEN NULL ELSE error_message END AS error_message
        FROM (SELECT *, state = 'running' AND job_id % 3 <> 0 AND job_id > 0 AS ok FROM jobs)""",
    "ack_seen": f"""SELECT s.source_uuid, CASE WHEN EXISTS (SELECT 1 FROM jobs j WHERE j.job_type = 'delete' AND j.source_uuid = s.source_uuid
        AND trim(j.collection_key) = s.last_seen_collection_key) THEN {NOW_TEXT} END AS deleted_at FROM seen s""",
    "fail_apply": f"""SELECT job_id, CASE WHEN NOT bad THEN state WHEN job_id % 2 <> 0 OR attempts >= 5 THEN 'error' ELSE 'pending' END AS state,
        CASE WHEN bad THEN NULL ELSE {TIME.format('locked_until')} END AS locked_until, attempts,
        CASE WHEN bad THEN 4000 ELSE length(error_message) END AS message_length
        FROM (SELECT *, state = 'running' AND job_id % 3 = 0 AS bad FROM jobs)""",
    "retention_cleanup": f"""SELECT job_id, CASE WHEN free THEN 'pending' ELSE state END AS state,
        CASE WHEN free THEN NULL ELSE {TIME.format('locked_until')} END AS locked_until,
        CASE WHEN free THEN {NOW_TEXT} ELSE {TIME.format('updated_at')} END AS updated_at
        FROM (SELECT *, coalesce(state = 'running' AND locked_until < {NOW}, false) AS free FROM jobs
            WHERE NOT (state = 'superseded' AND updated_at < {NOW} - INTERVAL 7 DAY)
            AND NOT (state = 'done' AND updated_at < {NOW} - INTERVAL 30 DAY) AND NOT (state = 'error' AND updated_at < {NOW} - INTERVAL 90 DAY))""",
    "retention_seen": """SELECT s.source_uuid, NULL::VARCHAR AS deleted_at FROM seen s
        WHERE NOT EXISTS (SELECT 1 FROM jobs j WHERE j.job_type = 'delete' AND j.source_uuid = s.source_uuid
        AND trim(j.collection_key) = s.last_seen_collection_key)""",
    "item_build": f"SELECT {ITEM_COLUMNS} FROM built b {ITEM_TABLES}",
    "item_build_claimed": f"SELECT {ITEM_COLUMNS} FROM built b JOIN ({CLAIMABLE} LIMIT 1000) c ON c.job_id = b.job_id {ITEM_TABLES}",
    "item_size": f"""SELECT b.job_id, strlen('{{"sysentry":' || json_object('id', b.entry_id, 'uuid', b.source_uuid, 'type_id', b.type_id,
            'changed', {TIME.format('b.changed')}, 'created', {TIME.format('b.created')}, 'etag', b.entry_etag)::VARCHAR
        || ',"type":' || json_object('id', b.type_id, 'alias', b.alias, 'table', b.alias)::VARCHAR
        || ',"payload":' || p.payload_json || '}}') AS size
        FROM built b JOIN ({PAYLOADS}) p ON p.entry_id = b.entry_id""",
    "item_missing_payload": """SELECT u.job_id, u.source_uuid FROM usable u
        WHERE u.job_type = 'upsert' AND u.source_uuid NOT IN (SELECT e.uuid FROM sysentry e WHERE e.id % 13 <> 5)""",
    "item_public": "SELECT e.id AS entry_id, CASE WHEN p.entry_id IS NULL THEN 0 ELSE 1 END AS public FROM sysentry e LEFT JOIN publics p ON p.entry_id = e.id",
    "item_name": "SELECT entry_id, name FROM topnames",
    "item_tags": "SELECT entry_id, tags FROM taglists",
    "item_refs": "SELECT entry_id, ref_uuids FROM reflists",
    "item_hash": "SELECT job_id, sha256(collection_key || ':' || source_uuid || ':' || coalesce(source_version, '')) AS hash FROM jobs",
    "item_deletes": """SELECT job_id, 'delete' AS action, collection_key, sha256(collection_key || ':' || source_uuid || ':' || coalesce(source_version, '')) AS hash,
        'application/x-embedding-job-delete' AS content_type, 0 AS size, source_uuid AS content_uuid, source_version AS content_version
        FROM usable WHERE job_type = 'delete'""",
    "route_type": """SELECT id, CASE WHEN k % 4 = 2 THEN 'unknown' ELSE alias END AS routed, CASE WHEN k % 4 = 2 THEN 'fallback' ELSE alias END AS parser FROM every_entry""",
    "meta_merge": """SELECT id, alias AS keep, CASE WHEN k % 3 = 0 THEN label ELSE 'old' END AS name, CASE WHEN k % 3 = 0 THEN k::VARCHAR END AS added FROM every_entry""",
    **{f"enrich_{alias}": sql for alias, sql in ENRICH.items()},
    "enrich_union": ENRICH_ALL,
    "enrich_open": ENRICH_ALL,
    "chunk_documents": "SELECT doc_id, chunk_index, md5(text) AS text_md5, length(text) AS n_chars FROM chunks",
    "chunk_numbers": """SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS chunk_index,
        count(*) OVER (PARTITION BY conv_id) AS num_chunks, md5(text) AS text_md5, role, 'parsed' AS conv
        FROM conversations WHERE (conv_id + turn) % 5 <> 0 AND trim(text) <> ''""",
    "embed_cache_misses": """SELECT sha256('bag-of-words-64'::BLOB || '\\x00'::BLOB || encode(text)) AS cache_key, md5(text) AS text_md5
        FROM (SELECT text FROM chunks GROUP BY text HAVING bool_and(doc_id % 3 <> 0))""",
    "embed_chunks": """WITH words AS (SELECT text, unnest(regexp_extract_all(text, '[A-Za-z0-9]+')) AS w FROM (SELECT DISTINCT text FROM chunks)),
        hits AS (SELECT DISTINCT text, ('0x' || substr(md5(lower(w)), 1, 8))::BIGINT % 64 AS b FROM words),
        lists AS (SELECT text, string_agg(b::VARCHAR, '|' ORDER BY b) AS buckets FROM hits GROUP BY text)
        SELECT sha256('bag-of-words-64'::BLOB || '\\x00'::BLOB || encode(t.text)) AS cache_key, 64 AS dims, coalesce(buckets, '') AS buckets,
            CASE WHEN buckets IS NULL THEN 0.0 ELSE 1.0 END::DOUBLE AS square
        FROM (SELECT DISTINCT text FROM chunks) t LEFT JOIN lists l ON l.text = t.text""",
    "payload_rejects": "SELECT doc_id, reason AS invalid_reason FROM judged WHERE reason IS NOT NULL",
    "payload_build": f"""SELECT doc_id, md5(trim(text, {TRIM})) AS text_md5, trim(hash) AS hash, 'xrm' AS collection_key,
        upper(regexp_replace(m->>'$.content_uuid', '[^0-9a-fA-F]', '', 'g')) AS content_uuid,
        trim(hash) || CASE WHEN chunk_index > 0 THEN '-' || chunk_index::VARCHAR ELSE '' END AS chunktoken, chunk_index,
        nullif(trim(m->>'$.name'), '') AS name, m->>'$.lang' AS lang, try_cast(m->>'$.num_chunks' AS BIGINT) AS num_chunks,
        CASE m->>'$.archive' WHEN 'true' THEN 1 ELSE try_cast(m->>'$.archive' AS BIGINT) END AS archive,
        CASE m->>'$.public' WHEN 'false' THEN 0 ELSE try_cast(m->>'$.public' AS BIGINT) END AS public,
        CASE WHEN json_array_length(m->'$.tags') > 0 THEN 'foo|' || (m->>'$.tags[2]') || '|7|1' END AS tags,
        'AABB|' || upper(md5(doc_id::VARCHAR)) AS ref_uuids FROM judged WHERE reason IS NULL""",
    "payload_meta": """SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN '{"added":"x","custom":{"a":' || doc_id::VARCHAR || '}}' END AS meta FROM judged WHERE reason IS NULL""",
    "payload_typed": """SELECT content_uuid, chunk_index, hash || CASE WHEN chunk_index > 0 THEN '-' || chunk_index::VARCHAR ELSE '' END AS chunktoken,
        source AS name, lang, num_chunks, archive, public, 'doc|' || lang AS tags, content_uuid AS ref_uuids,
        '{"content_version":"' || version || '"' || CASE WHEN doc_id % 2 = 0 THEN ',"text":{"mime":"text/plain"}' ELSE '' END || '}' AS meta FROM points""",
    "upsert_skip": f"SELECT {POINT} FROM old_points UNION ALL SELECT {POINT} FROM points WHERE hash NOT IN (SELECT hash FROM old_points)",
    "upsert_append": f"""SELECT {POINT} FROM old_points o WHERE NOT EXISTS (SELECT 1 FROM points p WHERE p.hash = o.hash AND p.chunk_index = o.chunk_index)
        UNION ALL SELECT {POINT} FROM points""",
    "upsert_replace": f"SELECT {POINT} FROM points",
    "vector_delete": f"""SELECT {POINT} FROM points WHERE content_uuid NOT IN (SELECT u.source_uuid FROM usable u WHERE u.job_type = 'delete')""",
    "exists_by_hash": "SELECT DISTINCT hash, (hash IN (SELECT hash FROM old_points))::BIGINT AS is_stored FROM points",
    "point_ids": """SELECT content_uuid, chunk_index, substr(d, 1, 8) || '-' || substr(d, 9, 4) || '-5' || substr(d, 14, 3) || '-'
        || substr('89ab89ab89ab89ab', strpos('0123456789abcdef', substr(d, 17, 1)), 1) || substr(d, 18, 3) || '-' || substr(d, 21, 12) AS point_id
        FROM (SELECT *, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(hash || chunk_index::VARCHAR)) AS d FROM points)""",
    "visible_rows": "SELECT content_uuid, chunk_index, public, archive FROM points WHERE public = 1 AND archive = 0",
    "filter_spec": "SELECT content_uuid, chunk_index, 'doc|' || lang AS tags FROM points WHERE public = 1 AND archive = 0 AND lang = 'de'",
    "fetch_by_uuid": """SELECT content_uuid, chunk_index, hash || CASE WHEN chunk_index > 0 THEN '-' || chunk_index::VARCHAR ELSE '' END AS chunktoken, source AS name
        FROM points WHERE doc_id = (SELECT doc_id FROM documents ORDER BY n_chars DESC, doc_id DESC LIMIT 1) ORDER BY chunk_index LIMIT 50""",
    "name_search": "SELECT content_uuid, chunk_index, source AS name FROM points WHERE source = 'src1'",
    "name_search_prefix": "SELECT content_uuid, chunk_index, source AS name FROM points WHERE source LIKE 'src1%'",
    "search_topk": """SELECT point_id, round(s, 4) AS score, row_number() OVER (ORDER BY s DESC, point_id) AS rank FROM
        (SELECT p.point_id, list_cosine_similarity(p.v, q.v) AS s FROM embedding_points p, embedding_points q
            WHERE q.point_id = 7 AND p.public = 1 AND p.archive = 0) WHERE s >= 0.1 ORDER BY s DESC, point_id LIMIT 10""",
    "search_many": """SELECT query_id, point_id, round(s, 4) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, point_id) AS rank FROM
        (SELECT 'q' || lpad(q.point_id::VARCHAR, 3, '0') AS query_id, p.point_id, list_cosine_similarity(p.v, q.v) AS s FROM embedding_points p, embedding_points q
            WHERE q.point_id IN (1, 2, 3, 5, 8, 13, 21, 34) AND p.label = 3)) WHERE rank <= 5""",
}


BODIES |= {
    "embed_failures": """SELECT sha256('bag-of-words-64'::BLOB || '\\x00'::BLOB || encode(text)) AS cache_key,
        CASE WHEN n % 7 = 0 OR n % 11 = 0 OR n % 13 = 0 THEN NULL ELSE 4 END AS dims,
        CASE WHEN n % 7 = 0 THEN 'Embedding: refused' WHEN n % 11 = 0 THEN 'Embedding: empty vector'
            WHEN n % 13 = 0 THEN 'Embedding: vector of 3 values where 4 are expected' END AS error
        FROM (SELECT DISTINCT text, length(text) AS n FROM chunks)""",
    "search_frame": """SELECT query_id, point_id, round(s, 4) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, point_id) AS rank FROM
        (SELECT q.point_id::VARCHAR AS query_id, p.point_id::VARCHAR AS point_id, round(list_cosine_similarity(p.v, q.v), 12) AS s
            FROM embedding_points p, embedding_points q WHERE p.public = 1 AND p.archive = 0)) WHERE rank <= 5""",
    "search_index_all": """SELECT query_id, point_id, round(s, 4) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, point_id) AS rank FROM
        (SELECT q.point_id::VARCHAR AS query_id, p.point_id::VARCHAR AS point_id, round(list_cosine_similarity(p.v, q.v), 12) AS s
            FROM embedding_points p, embedding_points q WHERE q.point_id % 5 = 0)) WHERE rank <= 5""",
    "lookup_many_hashes": "SELECT content_uuid, chunk_index, hash FROM points WHERE doc_id % 100 = 0",
    "name_index_lookup": """SELECT p_name AS query_id, entry_id FROM (SELECT DISTINCT p_name, string_split(p_name, ' ') AS words FROM part) q,
        (SELECT entry_id, regexp_extract_all(lower(name), '[\\p{L}\\p{N}]+') AS tokens FROM topnames) t WHERE list_has_all(tokens, words)""",
    "name_index_prefix": """SELECT short AS query_id, entry_id FROM (SELECT DISTINCT left(split_part(p_name, ' ', 1), 2) || ' ' || left(split_part(p_name, ' ', 2), 2) AS short,
            left(split_part(p_name, ' ', 1), 2) AS a, left(split_part(p_name, ' ', 2), 2) AS b FROM part) q,
        (SELECT entry_id, regexp_extract_all(lower(name), '[\\p{L}\\p{N}]+') AS tokens FROM topnames) t
        WHERE len(list_filter(tokens, lambda x: starts_with(x, a))) > 0 AND len(list_filter(tokens, lambda x: starts_with(x, b))) > 0""",
    "cleanup_run": f"""WITH kept AS (SELECT CASE WHEN state = 'running' AND locked_until < {NOW} THEN 'pending' ELSE state END AS state FROM jobs
            WHERE NOT (state = 'superseded' AND updated_at < {NOW} - INTERVAL 7 DAY)
            AND NOT (state = 'done' AND updated_at < {NOW} - INTERVAL 30 DAY) AND NOT (state = 'error' AND updated_at < {NOW} - INTERVAL 90 DAY))
        SELECT state, count(*) AS n, (SELECT count(*) FROM jobs) - (SELECT count(*) FROM kept) AS jobs,
            (SELECT count(*) FROM seen s WHERE EXISTS (SELECT 1 FROM jobs j WHERE j.job_type = 'delete' AND j.source_uuid = s.source_uuid
                AND trim(j.collection_key) = s.last_seen_collection_key)) AS seen,
            (SELECT count(*) FROM jobs WHERE state = 'running' AND locked_until < {NOW}) AS freed FROM kept GROUP BY state""",
}

# The latest event per user is the state of the contact with that number.
FEED = """SELECT upper(md5('contact:' || user_id::VARCHAR)) AS source_uuid, upper(md5('event:' || event_id::VARCHAR)) AS version, ts
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, upper(md5('event:' || event_id::VARCHAR)) DESC) AS r FROM events) WHERE r = 1"""

# Upserts among the running jobs: documents store their chunks, nothing else is stored.
ENDED = """SELECT j.job_id, CASE WHEN j.job_type NOT IN ('upsert', 'delete') THEN 'Extractor: unsupported job_type ''' || j.job_type || ''''
        WHEN trim(j.collection_key) = '' THEN 'Extractor: missing job_id/source_uuid/collection_key'
        WHEN j.job_type = 'upsert' AND j.source_uuid NOT IN (SELECT e.uuid FROM sysentry e WHERE e.id % 13 <> 5) THEN 'Extractor: missing payload / sysentry not found'
        WHEN j.job_type = 'upsert' AND j.job_id % 10 <> 3 AND p.content_uuid IS NULL THEN 'No chunk was stored' END AS message,
        j.job_type IN ('upsert', 'delete') AND trim(j.collection_key) <> '' AS usable, j.job_type, p.n
    FROM jobs j LEFT JOIN (SELECT content_uuid, count(*) AS n FROM points GROUP BY content_uuid) p ON p.content_uuid = j.source_uuid
    WHERE j.state = 'running'"""

BODIES |= {
    "stream_changes": f"SELECT source_uuid, version AS source_version, 'contact' AS collection_key FROM ({FEED})",
    "stream_seen": f"""SELECT source_uuid, version AS last_seen_version, {TIME.format('ts')} AS last_seen_changed,
        'contact' AS last_seen_collection_key, NULL::VARCHAR AS missing_since FROM ({FEED})""",
    "job_outcomes": f"SELECT job_id, (message IS NULL)::BIGINT AS ok, message, usable::BIGINT AS retry FROM ({ENDED})",
    "run_summary": f"""SELECT count_if(message IS NULL) AS num_items_done, count_if(message IS NOT NULL) AS num_items_failed,
        (SELECT count(*) FROM points) AS num_chunks, coalesce(sum(CASE WHEN usable AND job_type = 'upsert' THEN n END), 0)::BIGINT AS num_vectors FROM ({ENDED})""",
    "sync_entries": f"""WITH bodies AS (SELECT entry_id, CASE WHEN dbtable = 'text' AND trim(b.text, {TRIM}) <> '' THEN trim(b.text, {TRIM}) ELSE payload_json END AS text
            FROM ({PAYLOADS}) y LEFT JOIN (SELECT doc_id, text FROM documents) b ON y.dbtable = 'text' AND y.entry_id = 1100000000 + b.doc_id),
        claimed AS (SELECT u.* FROM usable u LEFT JOIN seen z ON z.source_uuid = u.source_uuid AND z.last_seen_collection_key = u.collection_key
            WHERE u.state = 'pending' AND (u.locked_until IS NULL OR u.locked_until < {NOW}) AND u.job_type = 'upsert'
            AND NOT coalesce(u.source_version <> z.last_seen_version, false)),
        item AS (SELECT e.id, f.source_uuid AS uuid, f.source_version AS etag, f.collection_key, e.alias, e.archive, b.text, length(b.text) AS n
            FROM claimed f JOIN sysentry e ON e.uuid = f.source_uuid JOIN bodies b ON b.entry_id = e.id),
        starts AS (SELECT *, CASE WHEN n <= 2000 THEN 1 ELSE ceil((n - 2000) / 1950.0)::BIGINT + 1 END AS c FROM item),
        kept AS (SELECT *, unnest(range(k)) AS i FROM (SELECT *, CASE WHEN c > 1 AND n - (c - 1) * 1950 < 500 THEN c - 1 ELSE c END AS k FROM starts)),
        cut AS (SELECT * EXCLUDE (text), CASE WHEN i = k - 1 THEN substr(text, (i * 1950 + 1)::BIGINT) ELSE substr(text, (i * 1950 + 1)::BIGINT, 2000) END AS text FROM kept),
        numbered AS (SELECT * EXCLUDE (i), row_number() OVER (PARTITION BY id ORDER BY i) - 1 AS i, count(*) OVER (PARTITION BY id) AS num FROM cut WHERE trim(text, {TRIM}) <> ''),
        hashed AS (SELECT *, sha256(collection_key || ':' || uuid || ':' || coalesce(etag, '')) AS h FROM numbered),
        marked AS (SELECT *, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(h || i::VARCHAR)) AS d FROM hashed),
        spaces AS ({ENRICH_ALL})
        SELECT substr(d, 1, 8) || '-' || substr(d, 9, 4) || '-5' || substr(d, 14, 3) || '-' || substr('89ab89ab89ab89ab', strpos('0123456789abcdef', substr(d, 17, 1)), 1)
            || substr(d, 18, 3) || '-' || substr(d, 21, 12) AS point_id,
        x.uuid AS content_uuid, x.i AS chunk_index, x.h || CASE WHEN x.i > 0 THEN '-' || x.i::VARCHAR ELSE '' END AS chunktoken, x.alias AS type_alias, nm.name,
        x.num AS num_chunks, x.archive, CASE WHEN p.entry_id IS NULL THEN 0 ELSE 1 END AS public, t.tags, r.ref_uuids,
        CASE WHEN x.etag IS NULL THEN nullif(s.meta_json, '{{}}') WHEN s.meta_json = '{{}}' THEN '{{"content_version":"' || x.etag || '"}}'
             WHEN x.alias IN ('account', 'address', 'contact') THEN left(s.meta_json, length(s.meta_json) - 1) || ',"content_version":"' || x.etag || '"}}'
             ELSE '{{"content_version":"' || x.etag || '",' || substr(s.meta_json, 2) END AS meta,
        md5(trim(x.text, {TRIM})) AS text_md5
        FROM marked x LEFT JOIN publics p ON p.entry_id = x.id LEFT JOIN taglists t ON t.entry_id = x.id
        LEFT JOIN reflists r ON r.entry_id = x.id LEFT JOIN topnames nm ON nm.entry_id = x.id JOIN spaces s ON s.entry_id = x.id""",
}

# The feed with deletes. Of each third the last change of a user counts; an upsert always takes effect, a delete
# only after an upsert. The odd changes of the last landing: another version at the same time, and one that is
# late unless nothing was ever seen of its user.
LIFE = """WITH ev AS (SELECT user_id, upper(md5('event:' || event_id::VARCHAR)) AS etag, ts, event_type = 'error' AS del, event_id,
        CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 0 WHEN ts < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END AS slice FROM events),
    thirds AS (SELECT user_id, etag, ts, del, slice FROM ev QUALIFY row_number() OVER (PARTITION BY user_id, slice ORDER BY ts DESC, del DESC, etag DESC) = 1),
    lasts AS (SELECT * FROM ev QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, del DESC, etag DESC) = 1),
    steps AS (SELECT * FROM thirds
        UNION ALL SELECT user_id, upper(md5('again:' || event_id::VARCHAR)), ts, false, 3 FROM lasts WHERE user_id % 10 = 3
        UNION ALL SELECT user_id, upper(md5('late:' || event_id::VARCHAR)), TIMESTAMP '2023-12-01', false, 3 FROM lasts WHERE user_id % 10 = 4
            AND user_id NOT IN (SELECT user_id FROM thirds WHERE NOT del)),
    turns AS (SELECT *, lag(del) OVER w AS del_before, lag(etag) OVER w AS etag_before FROM steps WINDOW w AS (PARTITION BY user_id ORDER BY slice)),
    accepted AS (SELECT user_id, del, ts, CASE WHEN del THEN etag_before ELSE etag END AS version,
        row_number() OVER (PARTITION BY user_id ORDER BY slice) AS number FROM turns WHERE NOT del OR coalesce(NOT del_before, false)),
    final AS (SELECT *, upper(md5('contact:' || user_id::VARCHAR)) AS uuid FROM accepted QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY number DESC) = 1)"""

BODIES |= {
    "stream_deletes": f"""{LIFE} SELECT uuid AS source_uuid, version AS last_seen_version, {TIME.format('ts')} AS last_seen_changed,
        (del OR user_id % 10 = 7)::BIGINT AS is_missing, CASE WHEN del OR user_id % 10 = 7 THEN version END AS delete_version FROM final""",
    "stream_state": f"""{LIFE} SELECT uuid AS source_uuid, version AS source_version, 'contact' AS collection_key,
        CASE WHEN del THEN 'delete' ELSE 'upsert' END AS job_type, {TIME.format('ts')} AS changed, number FROM final""",
    # What was held back counts if it is later than the latest change landed before it, less twelve days.
    "stream_dedup": f"""SELECT upper(md5('contact:' || user_id::VARCHAR)) AS uuid, upper(md5('event:' || event_id::VARCHAR)) AS etag,
        {TIME.format('ts')} AS changed, (event_type = 'error')::BIGINT AS deleted FROM events
        WHERE ts >= TIMESTAMP '2024-01-11' OR event_id % 7 <> 0 OR ts > (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 12 DAY FROM events
            WHERE ts < TIMESTAMP '2024-01-21' AND (ts >= TIMESTAMP '2024-01-11' OR event_id % 7 <> 0))""",
}


def _statement(body: str) -> str:
    sql = with_views(body)
    # A body with its own WITH continues the list of views.
    return sql.replace(")\nWITH ", "),\n", 1)


ORACLES = {name: _statement(body) for name, body in BODIES.items()}
