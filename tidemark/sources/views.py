"""The record model over the supplied star-schema tables.

Eleven record types are read from the tables; every column below is a deterministic
function of a row, so another engine can compute the same rows from the same files.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import prepare, work_dir

TYPES = [
    (1, "account"), (2, "address"), (3, "contact"), (4, "date"), (5, "file"), (6, "product"),
    (7, "project"), (8, "resource"), (9, "tag"), (10, "task"), (11, "text"),
]
TYPE_IDS = {alias: type_id for type_id, alias in TYPES}
ID_STEP = 100_000_000

# One SELECT per type: key ``k``, revision ``rev``, a label for names, then the payload.
SELECTS = {
    "account": """
        SELECT s_suppkey AS k, cast(s_nationkey AS string) AS rev, s_name AS label,
               CASE s_suppkey % 4 WHEN 0 THEN '  Premium  ' WHEN 1 THEN 'Standard' WHEN 2 THEN '   ' END AS accounttype,
               concat('about ', s_name) AS description,
               'd0' AS data0, 'd1' AS data1, 'd2' AS data2, 'd3' AS data3, 'd4' AS data4
        FROM {supplier}""",
    "address": """
        SELECT cast(n_nationkey AS bigint) AS k, cast(n_regionkey AS string) AS rev, n_name AS label,
               CASE WHEN n_nationkey % 5 = 0 THEN '200' WHEN n_nationkey % 7 = 3 THEN 'x'
                    ELSE concat(n_nationkey * 2 - 20, '.5') END AS lat,
               concat(n_nationkey * 7 - 90, '.25') AS lng,
               concat('  ', n_name, ' ') AS city,
               CASE WHEN n_nationkey % 6 = 0 THEN NULL ELSE concat(r_name, ' ') END AS country
        FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "contact": """
        SELECT c_custkey AS k, c_mktsegment AS rev, c_name AS label,
               concat(' ', substr(c_name, 1, 8), ' ') AS firstname,
               CASE WHEN c_custkey % 9 = 0 THEN '  ' ELSE c_mktsegment END AS lastname,
               CASE WHEN c_custkey % 13 = 0 THEN concat(lpad(1 + c_custkey % 28, 2, '0'), '.01.1980')
                    ELSE concat(1950 + c_custkey % 60, '-', lpad(1 + c_custkey % 12, 2, '0'), '-',
                                lpad(1 + c_custkey % 31, 2, '0')) END AS dateofbirth
        FROM {customer}""",
    "date": """
        SELECT event_id AS k, event_type AS rev, concat(event_type, ' ', event_id) AS label,
               CASE WHEN event_id % 29 = 0 THEN '0000-00-00 00:00:00'
                    ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss') END AS start,
               CASE WHEN event_id % 31 = 0 THEN '2024-02-31' WHEN event_id % 37 = 0 THEN 'not-a-date'
                    ELSE date_format(ts, 'yyyy-MM-dd') END AS end,
               CASE event_id % 6 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' WHEN 2 THEN '1' WHEN 3 THEN 'off'
                    WHEN 4 THEN 'maybe' ELSE ' TRUE ' END AS allday
        FROM {events}""",
    "file": """
        SELECT page_id AS k, cast(length(url) AS string) AS rev, url AS label,
               ' text/html ' AS mime, concat('page-', page_id, '.html') AS filename,
               CASE WHEN page_id % 9 = 0 THEN '42.5' WHEN page_id % 10 = 0 THEN '0'
                    ELSE concat('00', length(html)) END AS size,
               concat(' ', url) AS url
        FROM {pages}""",
    "product": """
        SELECT p_partkey AS k, cast(p_size AS string) AS rev, p_name AS label,
               concat(' P-', p_partkey, ' ') AS code,
               CASE WHEN p_partkey % 8 = 0 THEN concat(p_size, '.5') WHEN p_partkey % 8 = 1 THEN concat(' -', p_size, ' ')
                    ELSE cast(p_size AS string) END AS weight
        FROM {part}""",
    "project": """
        SELECT o_orderkey AS k, o_orderstatus AS rev, o_orderpriority AS label,
               concat('PRJ-', o_orderkey) AS projid, concat(' ', o_orderpriority, ' ') AS alias,
               date_format(o_orderdate, 'yyyy-MM-dd') AS start,
               concat(year(o_orderdate), '-', lpad(1 + o_orderkey % 12, 2, '0'), '-',
                      lpad(1 + o_orderkey % 31, 2, '0')) AS deadline
        FROM {orders}""",
    "resource": """
        SELECT vec_id AS k, cast(label AS string) AS rev, concat('vector ', vec_id) AS label,
               cast((vec_id - 100) * 0.5D AS double) AS quota, label AS used
        FROM {embeddings}""",
    "tag": """
        SELECT cast(r_regionkey AS bigint) AS k, r_name AS rev, r_name AS label, concat('  ', r_name, ' ') AS tag
        FROM {region}""",
    "task": """
        SELECT l_orderkey AS k, max(l_linestatus) AS rev, concat('task ', l_orderkey) AS label,
               date_format(min(l_shipdate), 'yyyy-MM-dd') AS start,
               date_format(max(l_shipdate), 'yyyy-MM-dd') AS deadline,
               CASE WHEN l_orderkey % 10 = 3 THEN '1.5' ELSE cast(cast(sum(l_quantity) AS bigint) AS string) END AS expense,
               CASE WHEN l_orderkey % 14 = 0 THEN 'maybe' WHEN max(l_linestatus) = 'F' THEN 'yes' ELSE 'no' END AS done
        FROM {lineitem} GROUP BY l_orderkey""",
    "text": """
        SELECT doc_id AS k, cast(n_chars AS string) AS rev, source AS label,
               CASE WHEN doc_id % 19 = 0 THEN NULL ELSE ' text/plain ' END AS mime, text
        FROM {documents}""",
}


@dataclass(frozen=True)
class Sources:
    """The tables a run reads; ``types`` maps payload tables to type aliases."""

    entries: DataFrame
    types: DataFrame
    payloads: dict[str, DataFrame]
    access: DataFrame
    names: DataFrame
    tags: DataFrame
    links: DataFrame


class Records:
    """Entries, side tables and pipeline tables of one data folder.

    The entry table stands for a table that a deployment already has, so it is written
    once per session to the shared work folder and read from there with pruned columns.
    """

    _landed: dict[tuple[str, str], str] = {}
    _schemas: dict[tuple[str, str], T.StructType] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = prepare(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def _read(self, path: str) -> DataFrame:
        """A table; its schema is inferred once per session."""
        key = (self.spark.sparkContext.applicationId, path)
        if key not in self._schemas:
            self._schemas[key] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self._schemas[key]).parquet(path)

    def table(self, name: str) -> DataFrame:
        return self._read(f"{self.sf_dir}/{name}.parquet")

    def source(self, alias: str) -> DataFrame:
        """Key, revision, label and payload columns of one type."""
        query = SELECTS[alias]
        names = [n for n in (
            "supplier", "nation", "region", "customer", "events", "pages", "part", "orders",
            "embeddings", "lineitem", "documents",
        ) if f"{{{n}}}" in query]
        return self.spark.sql(query, **{n: self.table(n) for n in names})

    @cached_property
    def systype(self) -> DataFrame:
        rows = [(type_id, alias, alias) for type_id, alias in TYPES]
        return self.spark.createDataFrame(rows, "id int, alias string, dbtable string")

    def payload(self, alias: str) -> DataFrame:
        """The payload table of one type: ``id`` and its own columns."""
        rows = self.source(alias)
        entry_id = (F.lit(TYPE_IDS[alias] * ID_STEP) + F.col("k")).alias("id")
        return rows.select(entry_id, *[c for c in rows.columns if c not in ("k", "rev", "label")])

    @cached_property
    def payloads(self) -> dict[str, DataFrame]:
        return {alias: self.payload(alias) for _, alias in TYPES}

    @cached_property
    def every_entry(self) -> DataFrame:
        """All entries, also those deleted since."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir)
        if key not in self._landed:
            path = f"{work_dir(self.spark, 'entries')}/every_entry"
            self.derive_entries().write.parquet(path)
            self._landed[key] = path
        return self._read(self._landed[key])

    def derive_entries(self) -> DataFrame:
        def one(type_id: int, alias: str) -> DataFrame:
            return self.source(alias).select(
                F.lit(type_id).alias("type_id"), F.lit(alias).alias("alias"), "k", "rev", "label")

        rows = reduce(DataFrame.unionByName, [one(*t) for t in TYPES])
        k = F.col("k")
        key = F.concat_ws(":", "alias", k.cast("string"))
        start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
        changed = start + F.make_dt_interval(mins=(k % 40000).cast("int"))
        return rows.select(
            (F.col("type_id") * F.lit(ID_STEP).cast("bigint") + k).alias("id"),
            F.upper(F.md5(key)).alias("uuid"),
            "type_id",
            F.upper(F.md5(F.concat_ws(":", key, "rev"))).alias("etag"),
            F.when(k % 7 == 0, 1).otherwise(0).alias("archive"),
            start.alias("created"),
            changed.alias("changed"),
            "alias", "k", "label",
        )

    @cached_property
    def sysentry(self) -> DataFrame:
        return self.every_entry.filter("k % 11 <> 0").select(
            "id", "uuid", "type_id", "etag", "archive", "created", "changed")

    @cached_property
    def access(self) -> DataFrame:
        """Visitor rows for every third entry, with rows of other users and modes."""
        rules = F.array(
            F.when(F.col("k") % 3 == 0, F.struct(F.lit(1).alias("user_id"), F.lit("visitor").alias("mode"))),
            F.when(F.col("k") % 4 == 0, F.struct(F.lit(1).alias("user_id"), F.lit("owner").alias("mode"))),
            F.when(F.col("k") % 5 == 0, F.struct(F.lit(2).alias("user_id"), F.lit("visitor").alias("mode"))),
            F.when(F.col("k") % 9 == 0, F.struct(F.lit(1).alias("user_id"), F.lit("visitor").alias("mode"))),
        )
        return (
            self.every_entry.select(F.col("id").alias("entry_id"), F.explode(rules).alias("r"))
            .filter("r IS NOT NULL").select("entry_id", "r.user_id", "r.mode"))

    @cached_property
    def names(self) -> DataFrame:
        second = F.when(F.col("k") % 17 == 0, "  ").otherwise(F.concat("label", F.lit(" (2)")))
        rows = F.array(
            F.struct(F.lit(1).alias("lang_id"), F.concat(F.lit(" "), "label").alias("name")),
            F.when(F.col("k") % 5 != 0, F.struct(F.lit(2).alias("lang_id"), second.alias("name"))),
        )
        return (
            self.every_entry.select(F.col("id").alias("entry_id"), F.explode(rows).alias("r"))
            .filter("r IS NOT NULL").select("entry_id", "r.lang_id", "r.name"))

    @cached_property
    def tags(self) -> DataFrame:
        """Tags of text entries, with case and space variants and repeats."""
        docs = self.table("documents").select("doc_id", "lang", "source")
        labels = self.table("labels")
        tags = F.array(
            F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit(" "), F.upper("lang"))).otherwise(F.col("lang")),
            F.col("source"),
            F.concat(F.upper("source"), F.lit("  ")),
            F.when(F.col("quality").isNotNull(), F.concat(F.lit("Quality-"), "quality")),
            F.when(F.col("toxic") == 1, F.lit("toxic")),
            F.when(F.col("doc_id") % 6 == 0, F.lit("  ")),
        )
        entry_id = F.lit(TYPE_IDS["text"] * ID_STEP) + F.col("doc_id")
        return (
            docs.join(labels, "doc_id", "left")
            .select(entry_id.alias("entry_id"), F.explode(tags).alias("tag"))
            .filter("tag IS NOT NULL"))

    @cached_property
    def links(self) -> DataFrame:
        """Directed references: project to contact, task to project, contact to address."""
        def edge(rows: DataFrame, source: str, key: str, target: str, peer: str) -> DataFrame:
            return rows.select(
                (F.lit(TYPE_IDS[source] * ID_STEP) + F.col(key)).alias("entry_id"),
                (F.lit(TYPE_IDS[target] * ID_STEP) + F.col(peer)).alias("peer_id"))

        orders, items = self.table("orders"), self.table("lineitem")
        return (
            edge(orders, "project", "o_orderkey", "contact", "o_custkey")
            .unionByName(edge(items, "task", "l_orderkey", "project", "l_orderkey"))
            .unionByName(edge(items, "task", "l_orderkey", "product", "l_partkey"))
            .unionByName(edge(self.table("customer"), "contact", "c_custkey", "address", "c_nationkey")))

    @property
    def sources(self) -> Sources:
        return Sources(
            self.sysentry, self.systype, self.payloads, self.access, self.names, self.tags, self.links)

    @cached_property
    def seen(self) -> DataFrame:
        k = F.col("k")
        stale = F.upper(F.md5(F.concat(F.lit("stale:"), "uuid")))
        none_ts = F.lit(None).cast("timestamp_ntz")
        return self.every_entry.filter("k % 5 <> 0").select(
            F.col("uuid").alias("source_uuid"),
            F.when(k % 4 == 0, stale).otherwise(F.col("etag")).alias("last_seen_version"),
            F.col("changed").alias("last_seen_changed"),
            (F.col("changed") + F.expr("INTERVAL 1 HOUR")).alias("last_seen_at"),
            F.when(k % 23 == 0, "legacy").otherwise(F.col("alias")).alias("last_seen_collection_key"),
            F.when(k % 22 == 0, F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")).otherwise(none_ts).alias("missing_since"),
            F.lit(None).cast("bigint").alias("delete_job_id"),
            none_ts.alias("deleted_at"),
        )

    @cached_property
    def jobs(self) -> DataFrame:
        """A work list with every state and some rows that must be refused."""
        k = F.col("k")
        stale = F.upper(F.md5(F.concat(F.lit("stale:"), "uuid")))
        state = (
            F.when(k % 10 < 5, "pending").when(k % 10 == 5, "running").when(k % 10 == 6, "done")
            .when(k % 10 == 7, "error").otherwise("superseded"))
        job_type = F.when(k % 97 == 5, "refresh").when(k % 11 == 0, "delete").otherwise("upsert")
        lock = F.when(k % 4 == 1, F.lit("2024-01-15 00:00:00")).when(k % 4 == 3, F.lit("2024-02-01 00:05:00"))
        return self.every_entry.select(
            F.col("id").alias("job_id"),
            F.col("uuid").alias("source_uuid"),
            F.when(k % 6 == 0, stale).when(k % 53 == 7, F.lit(None).cast("string")).otherwise(F.col("etag")).alias("source_version"),
            F.when(k % 89 == 4, " ").otherwise(F.col("alias")).alias("collection_key"),
            job_type.alias("job_type"),
            state.alias("state"),
            (1 + k % 3).cast("int").alias("priority"),
            (k % 7).cast("int").alias("attempts"),
            lock.cast("timestamp_ntz").alias("locked_until"),
            F.col("changed").alias("created_at"),
            F.col("changed").alias("updated_at"),
            F.when(k % 10 == 7, "failed before").cast("string").alias("error_message"),
        )
