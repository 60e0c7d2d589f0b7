"""The record model as DuckDB common table expressions, written apart from the Spark code."""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {
    "systype": """SELECT * FROM (VALUES (1,'account'),(2,'address'),(3,'contact'),(4,'date'),(5,'file'),(6,'product'),
        (7,'project'),(8,'resource'),(9,'tag'),(10,'task'),(11,'text')) t(id, alias)""",
    "src_account": """SELECT s_suppkey AS k, s_nationkey::VARCHAR AS rev, s_name AS label,
        CASE s_suppkey % 4 WHEN 0 THEN '  Premium  ' WHEN 1 THEN 'Standard' WHEN 2 THEN '   ' END AS accounttype FROM supplier""",
    "src_address": """SELECT n_nationkey::BIGINT AS k, n_regionkey::VARCHAR AS rev, n_name AS label,
        CASE WHEN n_nationkey % 5 = 0 THEN '200' WHEN n_nationkey % 7 = 3 THEN 'x' ELSE (n_nationkey * 2 - 20)::VARCHAR || '.5' END AS lat,
        (n_nationkey * 7 - 90)::VARCHAR || '.25' AS lng, '  ' || n_name || ' ' AS city,
        CASE WHEN n_nationkey % 6 = 0 THEN NULL ELSE r_name || ' ' END AS country
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "src_contact": """SELECT c_custkey AS k, c_mktsegment AS rev, c_name AS label,
        ' ' || substr(c_name, 1, 8) || ' ' AS firstname,
        CASE WHEN c_custkey % 9 = 0 THEN '  ' ELSE c_mktsegment END AS lastname,
        CASE WHEN c_custkey % 13 = 0 THEN lpad((1 + c_custkey % 28)::VARCHAR, 2, '0') || '.01.1980'
             ELSE (1950 + c_custkey % 60)::VARCHAR || '-' || lpad((1 + c_custkey % 12)::VARCHAR, 2, '0') || '-' || lpad((1 + c_custkey % 31)::VARCHAR, 2, '0') END AS dateofbirth
        FROM customer""",
    "src_date": """SELECT event_id AS k, event_type AS rev, event_type || ' ' || event_id::VARCHAR AS label,
        CASE WHEN event_id % 29 = 0 THEN '0000-00-00 00:00:00' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS start,
        CASE WHEN event_id % 31 = 0 THEN '2024-02-31' WHEN event_id % 37 = 0 THEN 'not-a-date' ELSE strftime(ts, '%Y-%m-%d') END AS "end",
        CASE event_id % 6 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' WHEN 2 THEN '1' WHEN 3 THEN 'off' WHEN 4 THEN 'maybe' ELSE ' TRUE ' END AS allday
        FROM events""",
    "src_file": """SELECT page_id AS k, length(url)::VARCHAR AS rev, url AS label, ' text/html ' AS mime,
        'page-' || page_id::VARCHAR || '.html' AS filename,
        CASE WHEN page_id % 9 = 0 THEN '42.5' WHEN page_id % 10 = 0 THEN '0' ELSE '00' || length(html)::VARCHAR END AS size,
        ' ' || url AS url FROM pages""",
    "src_product": """SELECT p_partkey AS k, p_size::VARCHAR AS rev, p_name AS label, ' P-' || p_partkey::VARCHAR || ' ' AS code,
        CASE WHEN p_partkey % 8 = 0 THEN p_size::VARCHAR || '.5' WHEN p_partkey % 8 = 1 THEN ' -' || p_size::VARCHAR || ' ' ELSE p_size::VARCHAR END AS weight
        FROM part""",
    "src_project": """SELECT o_orderkey AS k, o_orderstatus AS rev, o_orderpriority AS label, 'PRJ-' || o_orderkey::VARCHAR AS projid,
        ' ' || o_orderpriority || ' ' AS alias, strftime(o_orderdate, '%Y-%m-%d') AS start,
        year(o_orderdate)::VARCHAR || '-' || lpad((1 + o_orderkey % 12)::VARCHAR, 2, '0') || '-' || lpad((1 + o_orderkey % 31)::VARCHAR, 2, '0') AS deadline
        FROM orders""",
    "src_resource": """SELECT vec_id AS k, label::VARCHAR AS rev, 'vector ' || vec_id::VARCHAR AS label, (vec_id - 100) * 0.5::DOUBLE AS quota, label AS used
        FROM embeddings""",
    "src_tag": """SELECT r_regionkey::BIGINT AS k, r_name AS rev, r_name AS label, '  ' || r_name || ' ' AS tag FROM region""",
    "src_task": """SELECT l_orderkey AS k, max(l_linestatus) AS rev, 'task ' || l_orderkey::VARCHAR AS label,
        strftime(min(l_shipdate), '%Y-%m-%d') AS start, strftime(max(l_shipdate), '%Y-%m-%d') AS deadline,
        CASE WHEN l_orderkey % 10 = 3 THEN '1.5' ELSE sum(l_quantity)::BIGINT::VARCHAR END AS expense,
        CASE WHEN l_orderkey % 14 = 0 THEN 'maybe' WHEN max(l_linestatus) = 'F' THEN 'yes' ELSE 'no' END AS done
        FROM lineitem GROUP BY l_orderkey""",
    "src_text": """SELECT doc_id AS k, n_chars::VARCHAR AS rev, source AS label,
        CASE WHEN doc_id % 19 = 0 THEN NULL ELSE ' text/plain ' END AS mime, text FROM documents""",
    "keys": " UNION ALL ".join(
        f"SELECT {i} AS type_id, '{a}' AS alias, k, rev, label FROM src_{a}" for i, a in enumerate(
            ["account", "address", "contact", "date", "file", "product", "project", "resource", "tag", "task", "text"], 1)),
    "every_entry": """SELECT type_id * 100000000::BIGINT + k AS id, upper(md5(alias || ':' || k::VARCHAR)) AS uuid, type_id,
        upper(md5(alias || ':' || k::VARCHAR || ':' || rev)) AS etag, CASE WHEN k % 7 = 0 THEN 1 ELSE 0 END AS archive,
        TIMESTAMP '2024-01-01 00:00:00' AS created, TIMESTAMP '2024-01-01 00:00:00' + to_minutes((k % 40000)::INT) AS changed,
        alias, k, label FROM keys""",
    "sysentry": "SELECT * FROM every_entry WHERE k % 11 <> 0",
    "access": """SELECT id AS entry_id, 1 AS user_id, 'visitor' AS mode FROM every_entry WHERE k % 3 = 0
        UNION ALL SELECT id, 1, 'owner' FROM every_entry WHERE k % 4 = 0
        UNION ALL SELECT id, 2, 'visitor' FROM every_entry WHERE k % 5 = 0
        UNION ALL SELECT id, 1, 'visitor' FROM every_entry WHERE k % 9 = 0""",
    "names": """SELECT id AS entry_id, 1 AS lang_id, ' ' || label AS name FROM every_entry
        UNION ALL SELECT id, 2, CASE WHEN k % 17 = 0 THEN '  ' ELSE label || ' (2)' END FROM every_entry WHERE k % 5 <> 0""",
    "tags": """SELECT 1100000000 + doc_id AS entry_id, unnest([
            CASE WHEN doc_id % 2 = 0 THEN ' ' || upper(lang) ELSE lang END, source, upper(source) || '  ',
            'Quality-' || quality::VARCHAR, CASE WHEN toxic = 1 THEN 'toxic' END, CASE WHEN doc_id % 6 = 0 THEN '  ' END]) AS tag
        FROM documents LEFT JOIN labels USING (doc_id)""",
    "links": """SELECT 700000000 + o_orderkey AS entry_id, 300000000 + o_custkey AS peer_id FROM orders
        UNION ALL SELECT 1000000000 + l_orderkey, 700000000 + l_orderkey FROM lineitem
        UNION ALL SELECT 1000000000 + l_orderkey, 600000000 + l_partkey FROM lineitem
        UNION ALL SELECT 300000000 + c_custkey, 200000000 + c_nationkey FROM customer""",
    "seen": """SELECT uuid AS source_uuid, CASE WHEN k % 4 = 0 THEN upper(md5('stale:' || uuid)) ELSE etag END AS last_seen_version,
        changed AS last_seen_changed, changed + INTERVAL 1 HOUR AS last_seen_at,
        CASE WHEN k % 23 = 0 THEN 'legacy' ELSE alias END AS last_seen_collection_key,
        CASE WHEN k % 22 = 0 THEN TIMESTAMP '2024-01-20 00:00:00' END AS missing_since,
        NULL::BIGINT AS delete_job_id, NULL::TIMESTAMP AS deleted_at FROM every_entry WHERE k % 5 <> 0""",
    "jobs": """SELECT id AS job_id, uuid AS source_uuid,
        CASE WHEN k % 6 = 0 THEN upper(md5('stale:' || uuid)) WHEN k % 53 = 7 THEN NULL ELSE etag END AS source_version,
        CASE WHEN k % 89 = 4 THEN ' ' ELSE alias END AS collection_key,
        CASE WHEN k % 97 = 5 THEN 'refresh' WHEN k % 11 = 0 THEN 'delete' ELSE 'upsert' END AS job_type,
        CASE WHEN k % 10 < 5 THEN 'pending' WHEN k % 10 = 5 THEN 'running' WHEN k % 10 = 6 THEN 'done' WHEN k % 10 = 7 THEN 'error' ELSE 'superseded' END AS state,
        1 + k % 3 AS priority, k % 7 AS attempts,
        CASE WHEN k % 4 = 1 THEN TIMESTAMP '2024-01-15 00:00:00' WHEN k % 4 = 3 THEN TIMESTAMP '2024-02-01 00:05:00' END AS locked_until,
        changed AS created_at, changed AS updated_at, CASE WHEN k % 10 = 7 THEN 'failed before' END AS error_message FROM every_entry""",
    # The work list again with what a claim needs only: keys straight from the base tables.
    "claim_keys": """SELECT 1 AS type_id, s_suppkey AS k FROM supplier UNION ALL SELECT 2, n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey
        UNION ALL SELECT 3, c_custkey FROM customer UNION ALL SELECT 4, event_id FROM events UNION ALL SELECT 5, page_id FROM pages
        UNION ALL SELECT 6, p_partkey FROM part UNION ALL SELECT 7, o_orderkey FROM orders UNION ALL SELECT 8, vec_id FROM embeddings
        UNION ALL SELECT 9, r_regionkey FROM region UNION ALL SELECT DISTINCT 10, l_orderkey FROM lineitem UNION ALL SELECT 11, doc_id FROM documents""",
    "claim_list": """SELECT type_id * 100000000::BIGINT + k AS job_id, 1 + k % 3 AS priority, k % 7 AS attempts,
        CASE WHEN k % 10 < 5 THEN 'pending' WHEN k % 10 = 5 THEN 'running' WHEN k % 10 = 6 THEN 'done' WHEN k % 10 = 7 THEN 'error' ELSE 'superseded' END AS state,
        CASE WHEN k % 4 = 1 THEN TIMESTAMP '2024-01-15 00:00:00' WHEN k % 4 = 3 THEN TIMESTAMP '2024-02-01 00:05:00' END AS locked_until,
        TIMESTAMP '2024-01-01 00:00:00' + to_minutes((k % 40000)::INT) AS updated_at FROM claim_keys""",
    "moved": """SELECT e.uuid, e.etag, e.changed, coalesce(nullif(trim(t.alias), ''), 'default') AS collection_key
        FROM sysentry e JOIN systype t ON t.id = e.type_id WHERE e.changed > TIMESTAMP '2024-01-02 00:00:00'""",
    "gone": """SELECT s.source_uuid, s.last_seen_version, s.last_seen_collection_key AS collection_key
        FROM seen s LEFT JOIN sysentry e ON e.uuid = s.source_uuid WHERE e.uuid IS NULL AND s.missing_since IS NULL""",
    "wanted": """SELECT uuid AS source_uuid, etag AS source_version, collection_key, 'upsert' AS job_type, changed FROM moved
        UNION ALL SELECT source_uuid, last_seen_version, collection_key, 'delete', TIMESTAMP '2024-02-01 00:00:00' FROM gone""",
    "usable": """SELECT * FROM jobs WHERE job_type IN ('upsert', 'delete') AND trim(collection_key) <> ''""",
    "built": """SELECT u.*, e.id AS entry_id, e.etag AS entry_etag, e.archive, e.changed, e.created, e.alias, e.type_id
        FROM usable u JOIN sysentry e ON e.uuid = u.source_uuid WHERE u.job_type = 'upsert'""",
    "publics": "SELECT DISTINCT entry_id FROM access WHERE user_id = 1 AND mode = 'visitor'",
    "taglists": """SELECT entry_id, string_agg(tag, '|' ORDER BY tag) AS tags FROM
        (SELECT DISTINCT entry_id, lower(trim(tag)) AS tag FROM tags WHERE trim(tag) <> '') GROUP BY entry_id""",
    "reflists": """SELECT entry_id, string_agg(uuid, '|' ORDER BY id) AS ref_uuids FROM
        (SELECT DISTINCT l.entry_id, e.id, e.uuid FROM links l JOIN sysentry e ON e.id = l.peer_id) GROUP BY entry_id""",
    "topnames": """SELECT entry_id, trim(name) AS name FROM
        (SELECT *, row_number() OVER (PARTITION BY entry_id ORDER BY lang_id DESC) AS r FROM names) WHERE r = 1 AND trim(name) <> ''""",
    # Chunks by position, one row per start; a short last piece joins the one before.
    "docs": "SELECT doc_id, text, length(text) AS n FROM documents",
    "pieces": """SELECT doc_id, n, text, starts, i, CASE WHEN starts > 1 AND n - (starts - 1) * 1950 < 500 THEN starts - 1 ELSE starts END AS kept
        FROM (SELECT *, unnest(range(starts)) AS i FROM
            (SELECT *, CASE WHEN n <= 2000 THEN 1 ELSE ceil((n - 2000) / 1950.0)::BIGINT + 1 END AS starts FROM docs))""",
    "raw_chunks": """SELECT doc_id, i, CASE WHEN i = kept - 1 THEN substr(text, (i * 1950 + 1)::BIGINT) ELSE substr(text, (i * 1950 + 1)::BIGINT, 2000) END AS text
        FROM pieces WHERE i < kept""",
    "chunks": """SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS chunk_index,
        count(*) OVER (PARTITION BY doc_id) AS num_chunks, text FROM raw_chunks WHERE trim(text, E' \\t\\n\\r\\x0B') <> ''""",
    "doc_entries": """SELECT d.doc_id, d.lang, d.source, e.uuid, e.etag, upper(md5('stale:' || e.uuid)) AS old_etag, e.archive
        FROM documents d JOIN every_entry e ON e.alias = 'text' AND e.k = d.doc_id""",
    "points": """SELECT d.uuid AS content_uuid, c.chunk_index, c.num_chunks, sha256('text:' || d.uuid || ':' || d.etag) AS hash, md5(trim(c.text, E' \\t\\n\\r\\x0B')) AS text_md5,
        d.doc_id, d.lang, d.source, d.archive, CASE WHEN d.doc_id % 3 = 0 THEN 1 ELSE 0 END AS public, d.etag AS version
        FROM chunks c JOIN doc_entries d USING (doc_id)""",
    "old_points": """SELECT content_uuid, chunk_index, num_chunks, CASE WHEN doc_id % 4 = 0 THEN sha256('text:' || content_uuid || ':' || upper(md5('stale:' || content_uuid))) ELSE hash END AS hash,
        text_md5, doc_id FROM points""",
    "open_chunks": """SELECT doc_id, CASE WHEN doc_id % 31 = 3 THEN ' ' ELSE 'XRM' END AS chunk_collection_key,
        CASE WHEN doc_id % 29 = 4 THEN -1 ELSE doc_id % 4 END AS chunk_index,
        CASE WHEN doc_id % 37 = 5 THEN ' ' ELSE '  ' || text END AS text,
        CASE WHEN doc_id % 41 = 6 THEN '' ELSE ' ' || md5(text) END AS hash,
        ('{"content_uuid":' || CASE doc_id % 43 WHEN 7 THEN 'null' WHEN 8 THEN '5' WHEN 9 THEN '" "' ELSE '"aa-' || md5(doc_id::VARCHAR) || '"' END
        || ',"tags":' || CASE doc_id % 11 WHEN 1 THEN '"x"' WHEN 2 THEN 'null' WHEN 3 THEN '[]' ELSE '[" Foo ","foo","' || lang || '",7,true,"  ",{"a":1}]' END
        || ',"ref_uuids":' || CASE doc_id % 13 WHEN 1 THEN '"x"' ELSE '["aa-bb","AABB","  aabb  ","zz","","' || md5(doc_id::VARCHAR) || '"]' END
        || CASE doc_id % 17 WHEN 1 THEN ',"num_chunks":"x"' WHEN 2 THEN ',"num_chunks":0' WHEN 3 THEN ',"num_chunks":"3"' WHEN 4 THEN ',"num_chunks":null' WHEN 5 THEN '' ELSE ',"num_chunks":7' END
        || CASE doc_id % 19 WHEN 1 THEN ',"archive":2' WHEN 2 THEN ',"archive":true' WHEN 3 THEN ',"archive":"1"' WHEN 4 THEN '' ELSE ',"archive":0' END
        || CASE doc_id % 23 WHEN 1 THEN ',"public":"2"' WHEN 2 THEN ',"public":false' ELSE ',"public":1' END
        || ',"name":' || CASE WHEN doc_id % 3 = 0 THEN '"  "' ELSE '" Name ' || doc_id::VARCHAR || ' "' END
        || CASE WHEN doc_id % 5 = 0 THEN '' ELSE ',"custom":{"a":' || doc_id::VARCHAR || '},"added":"x"' END
        || ',"job_id":5,"state":"x","action":"upsert"'
        || CASE WHEN doc_id % 2 = 0 THEN ',"lang":"' || lang || '"' ELSE ',"lang":12' END || '}')::JSON AS m FROM documents""",
    "judged": """SELECT *, CASE
        WHEN trim(chunk_collection_key) = '' THEN 'AgentEmbeddingChunk.collectionKey is required.'
        WHEN chunk_index < 0 THEN 'AgentEmbeddingChunk.chunkIndex must be >= 0.'
        WHEN trim(text, E' \\t\\n\\r\\x0B') = '' THEN 'AgentEmbeddingChunk.text must be non-empty for XRM.'
        WHEN trim(hash) = '' THEN 'AgentEmbeddingChunk.hash must be non-empty for XRM upsert.'
        WHEN json_type(m->'$.content_uuid') <> 'VARCHAR' OR trim(m->>'$.content_uuid') = '' THEN 'Missing required metadata field ''content_uuid'' for XRM.'
        WHEN json_type(m->'$.tags') <> 'ARRAY' THEN 'metadata field ''tags'' must be an array if provided.'
        WHEN json_type(m->'$.ref_uuids') <> 'ARRAY' THEN 'metadata field ''ref_uuids'' must be an array if provided.'
        WHEN json_type(m->'$.num_chunks') NOT IN ('UBIGINT', 'BIGINT', 'VARCHAR') THEN 'metadata field ''num_chunks'' must be an integer if provided.'
        WHEN NOT regexp_full_match(m->>'$.num_chunks', '-?[0-9]+') THEN 'metadata field ''num_chunks'' must be an integer if provided.'
        WHEN try_cast(m->>'$.num_chunks' AS BIGINT) <= 0 THEN 'metadata field ''num_chunks'' must be > 0 if provided.'
        WHEN (m->>'$.archive') NOT IN ('0', '1', 'true', 'false') THEN 'metadata field ''archive'' must be 0 or 1 if provided.'
        WHEN (m->>'$.public') NOT IN ('0', '1', 'true', 'false') THEN 'metadata field ''public'' must be 0 or 1 if provided.'
        END AS reason FROM open_chunks""",
    "embedding_points": """SELECT vec_id AS point_id, embedding::DOUBLE[] AS v, CASE WHEN vec_id % 3 = 0 THEN 0 ELSE 1 END AS public,
        CASE WHEN vec_id % 7 = 0 THEN 1 ELSE 0 END AS archive, label FROM embeddings""",
}

TIME = "strftime({0}, '%Y-%m-%d %H:%M:%S')"


def ts(column: str) -> str:
    """A time as text, under the column's own name."""
    return f"{TIME.format(column)} AS {column.split('.')[-1]}"


def with_views(body: str) -> str:
    """Put the needed views, in order and each computed once, in front of a query."""
    needed: dict[str, None] = {}

    def visit(sql: str) -> None:
        for word in dict.fromkeys(re.findall(r"[a-z_]+", sql)):
            if word in VIEWS and word not in needed:
                visit(VIEWS[word])
                needed[word] = None

    visit(body)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({VIEWS[n]})" for n in needed) + "\n" + body
