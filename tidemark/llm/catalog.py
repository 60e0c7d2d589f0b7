"""The registered queries of this package and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe, centroids, decontaminate, hamming, jaccard, langid, lm_score, packing, pii, repeats, resample, token_counts, warc)
from tidemark.session import work_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(table(spark, sf_dir, "documents"))


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


@query
def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op3_benchmark_decontamination"] = """
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents WHERE text IS NOT NULL),
item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
doc_shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM doc_words WHERE len(w) > 0),
item_shingles AS (
  SELECT DISTINCT item_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM item_words WHERE len(w) > 0),
sizes AS (SELECT item_id, count(*) AS n_item FROM item_shingles GROUP BY item_id)
SELECT d.doc_id, i.item_id, z.n_item, count(*) AS n_shared
FROM doc_shingles d JOIN item_shingles i USING (s) JOIN sizes z ON z.item_id = i.item_id
GROUP BY d.doc_id, i.item_id, z.n_item HAVING 10 * count(*) >= 8 * z.n_item
"""


@query
def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.detect(table(spark, sf_dir, "documents")))


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query
def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("text_bytes").alias("n_bytes"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = hamming.sign_codes(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return hamming.top_k(codes, codes.filter(F.col("id") % 100 == 0)).select(
        "query_id", F.col("rank").cast("long").alias("rank"), F.col("id").alias("vec_id"), F.col("distance").cast("long").alias("distance"))


ORACLES["op8_exact_top_k"] = """
WITH codes AS (
  SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS code
  FROM embeddings WHERE embedding IS NOT NULL),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    len(list_filter(list_zip(q.code, c.code), lambda p: p[1] <> p[2])) AS distance
  FROM codes q JOIN codes c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank, vec_id, distance
FROM pairs QUALIFY rank <= 10
"""


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packs = packing.pack(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    packs = packing.write(packs, work_dir(spark, "packs"))
    return packs.select(
        "pack_id", "n_tokens", "lengths", "doc_ids", "doc_rows", "doc_offsets",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("positions", 256).alias("positions_sha256"))


@query
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    coded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path, pattern), path, pattern)
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# CRC-32 by its table of 256 steps, which the statement works out itself.
ORACLES["op11_importance_resampling"] = """
WITH steps AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8),
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
target_words AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM benchmark),
found AS (SELECT doc_id, unnest(w) AS word FROM doc_words),
vocabulary AS (SELECT word, hex(word) AS h FROM (SELECT word FROM found UNION SELECT word FROM target_words)),
bytes AS (SELECT word, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT) AS b FROM vocabulary),
buckets AS (
  SELECT word, xor(4294967295, list_reduce(b, lambda c, x: xor(c >> 8, t[1 + xor(c & 255, x)]), 4294967295)) % 10000 AS bucket
  FROM bytes, steps),
s AS (SELECT bucket, count(*) AS n FROM found JOIN buckets USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM target_words JOIN buckets USING (word) GROUP BY bucket),
gains AS (
  SELECT s.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT sum(n) FROM s) + 10000)
    / ((s.n + 1)::DOUBLE * ((SELECT count(*) FROM target_words) + 10000))))::BIGINT AS gain
  FROM s LEFT JOIN t ON t.bucket = s.bucket),
weights AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM found JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, len(d.w) AS n_features, coalesce(x.weight, 0) AS weight,
    coalesce(x.weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id::VARCHAR), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM doc_words d LEFT JOIN weights x ON x.doc_id = d.doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
    count(*) FILTER (n_features >= 20) OVER () AS fit FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= fit * 10 // 100 THEN place END AS rank FROM ranked
"""


@query
def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), folder)
    return warc.summary(warc.read(spark, folder))


ORACLES["op12_warc"] = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
named AS (
  SELECT page_id, strlen(html) AS payload_bytes, max(page_id) OVER (PARTITION BY html) AS original,
    translate(list_aggregate(list_transform(range(4), lambda i: to_base(('0x' || substr(h, (10 * i + 1)::BIGINT, 10))::BIGINT, 32, 8)), 'string_agg', ''),
      '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest
  FROM payloads)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> original THEN original END AS refers_to FROM named
"""


@query
def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def _round(now: int) -> str:
    """The centroids after one more round, with what it assigned."""
    return f"""
away{now} AS (SELECT r, cluster, sum((x.v - c.v) * (x.v - c.v))::BIGINT AS distance FROM parts x JOIN centers{now} c USING (d) GROUP BY r, cluster),
near{now} AS (SELECT r, cluster, distance FROM away{now} QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, cluster) = 1),
sums{now} AS (SELECT cluster, d, sum(v)::BIGINT AS s, count(*) AS n FROM parts JOIN near{now} USING (r) GROUP BY cluster, d),
centers{now + 1} AS (SELECT c.cluster, c.d, CASE WHEN n IS NULL THEN c.v ELSE (s - (((s % n) + n) % n)) // n END AS v
  FROM centers{now} c LEFT JOIN sums{now} m ON m.cluster = c.cluster AND m.d = c.d),"""


ORACLES["op13_centroid_clustering"] = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT r, unnest(range(64)) AS d, unnest(x) AS v FROM kept),
firsts AS (SELECT x, row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR)) - 1 AS cluster FROM kept QUALIFY cluster < 16),
centers0 AS (SELECT cluster, unnest(range(64)) AS d, unnest(x) AS v FROM firsts),{"".join(_round(i) for i in range(3))}
away3 AS (SELECT r, cluster, sum((x.v - c.v) * (x.v - c.v))::BIGINT AS distance FROM parts x JOIN centers3 c USING (d) GROUP BY r, cluster),
near3 AS (SELECT r, cluster, distance FROM away3 QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, cluster) = 1),
names AS (SELECT cluster, sha256(string_agg(v::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM centers3 GROUP BY cluster)
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
  (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM near3 JOIN kept USING (r) JOIN names USING (cluster)
"""
