"""Payload rows: validation with a reason per chunk, and one projection to fixed fields.

A chunk has ``chunk_collection_key``, ``chunk_index``, ``text``, ``hash`` and ``metadata``.
The metadata is a struct with one field per key, where null means absent, or an open
``VARIANT``, where an explicit null is present. :class:`Metadata` hides the difference;
both become Catalyst expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import text
from tidemark.functions import values as v

# The one physical collection and its vector layout.
CANONICAL_KEY = "xrm"
COLLECTION = "xrm_content_v1"
VECTOR_SIZE = 1536
DISTANCE = "Cosine"

# Payload fields in order, with their index type and whether they are indexed.
FIELDS = [
    ("text", "text", False), ("hash", "keyword", True), ("collection_key", "keyword", True),
    ("content_uuid", "keyword", True), ("chunktoken", "keyword", True), ("chunk_index", "integer", True),
    ("source_id", "keyword", False), ("name", "text", True), ("type_alias", "keyword", True),
    ("content_id", "keyword", False), ("url", "keyword", False), ("filename", "keyword", False),
    ("lang", "keyword", False), ("created_at", "keyword", False), ("updated_at", "keyword", False),
    ("num_chunks", "integer", False), ("archive", "integer", True), ("public", "integer", True),
    ("tags", "keyword", True), ("ref_uuids", "keyword", True),
]

# Metadata keys with a field of their own, and control keys never stored.
KNOWN_KEYS = [
    "content_uuid", "hash", "chunk_index", "chunktoken", "collection_key", "source_id", "name",
    "type_alias", "content_id", "url", "filename", "lang", "created_at", "updated_at", "num_chunks",
    "archive", "public", "tags", "ref_uuids",
]
CONTROL_KEYS = [
    "job_id", "attempts", "locked_until", "claim_token", "claimed_at", "state", "error_message",
    "action", "collectionKey", "collection_key",
]
TEXT_KEYS = ["source_id", "name", "type_alias", "content_id", "url", "filename", "lang", "created_at", "updated_at"]
READ_KEYS = ["content_uuid", *TEXT_KEYS, "num_chunks", "archive", "public", "tags", "ref_uuids"]

# The rejection messages.
NO_KEY = "AgentEmbeddingChunk.collectionKey is required."
BAD_INDEX = "AgentEmbeddingChunk.chunkIndex must be >= 0."
NO_TEXT = "AgentEmbeddingChunk.text must be non-empty for XRM."
NO_HASH = "AgentEmbeddingChunk.hash must be non-empty for XRM upsert."
NO_METADATA = "AgentEmbeddingChunk.metadata must be an array."
NO_UUID = "Missing required metadata field 'content_uuid' for XRM."
NOT_ARRAY = "metadata field '%s' must be an array if provided."
NOT_INTEGER = "metadata field 'num_chunks' must be an integer if provided."
NOT_POSITIVE = "metadata field 'num_chunks' must be > 0 if provided."
NOT_FLAG = "metadata field '%s' must be 0 or 1 if provided."

@dataclass(frozen=True)
class Metadata:
    """The metadata column of a chunk frame, read key by key."""

    frame: DataFrame
    types: dict[str, T.DataType] | None

    @staticmethod
    def of(frame: DataFrame) -> "Metadata":
        """Open metadata is read once per key, into columns of their own."""
        dtype = frame.schema["metadata"].dataType
        if isinstance(dtype, T.StructType):
            return Metadata(frame, {f.name: f.dataType for f in dtype})
        picked = {f"_meta_{key}": v.variant_value(F.col("metadata"), key).col for key in READ_KEYS}
        return Metadata(frame.withColumns(picked), None)

    def value(self, key: str) -> v.Value:
        if self.types is None:
            return v.Value(F.col(f"_meta_{key}"), T.VariantType())
        if key in self.types:
            return v.Value(F.col("metadata")[key], self.types[key])
        return v.Value(F.lit(None).cast("string"), T.StringType())

    def has(self, key: str) -> Column:
        return self.value(key).col.isNotNull()

    def is_object(self) -> Column:
        if self.types is not None:
            return F.col("metadata").isNotNull()
        return F.coalesce(F.schema_of_variant("metadata").rlike("^(OBJECT|ARRAY)<"), F.lit(False))

    def is_list(self, key: str) -> Column:
        value = self.value(key)
        if self.types is not None:
            return F.lit(isinstance(value.dtype, T.ArrayType))
        return F.coalesce(F.schema_of_variant(value.col).rlike("^(OBJECT|ARRAY)<"), F.lit(False))

    def strings(self, key: str) -> Column:
        """The list as texts; elements that are not scalars are null."""
        value = self.value(key)
        if self.types is not None:
            return value.col if isinstance(value.dtype, T.ArrayType) else F.lit(None).cast("array<string>")
        listed = F.coalesce(
            F.try_variant_get(value.col, "$", "array<variant>"),
            F.map_values(F.try_variant_get(value.col, "$", "map<string,variant>")))
        return F.transform(listed, lambda x: v.scalar_text(v.Value(x, T.VariantType())))

    def remainder(self) -> Column:
        """All other keys as a JSON object, null when there are none."""
        hidden = KNOWN_KEYS + CONTROL_KEYS
        if self.types is None:
            keys = F.map_filter(
                F.try_variant_get("metadata", "$", "map<string,variant>"), lambda k, _: ~k.isin(hidden))
            return F.when(F.size(keys) > 0, F.to_json(F.to_variant_object(keys)))
        rest = sorted(set(self.types) - set(hidden))
        if not rest:
            return F.lit(None).cast("string")
        return F.nullif(F.to_json(F.struct(*[F.col("metadata")[key].alias(key) for key in rest])), F.lit("{}"))


def invalid_reason(meta: Metadata) -> Column:
    """The first failed check, or null for a valid chunk."""
    def present(key: str, ok: Column) -> Column:
        return meta.has(key) & ~F.coalesce(ok, F.lit(False))

    uuid = v.string_text(meta.value("content_uuid"))
    count = meta.value("num_chunks")
    is_integer = F.coalesce(v.by_kind(count, {
        "int": lambda c: F.lit(True), "string": lambda c: c.rlike(r"^[0-9]+\z")}), F.lit(False))
    blank = F.lit("")
    return (
        F.when(text.trim(F.coalesce("chunk_collection_key", blank)) == "", NO_KEY)
        .when(F.coalesce("chunk_index", F.lit(-1)) < 0, BAD_INDEX)
        .when(text.trim(F.coalesce("text", blank)) == "", NO_TEXT)
        .when(text.trim(F.coalesce("hash", blank)) == "", NO_HASH)
        .when(~meta.is_object(), NO_METADATA)
        .when(uuid.isNull(), NO_UUID)
        .when(present("tags", meta.is_list("tags")), NOT_ARRAY % "tags")
        .when(present("ref_uuids", meta.is_list("ref_uuids")), NOT_ARRAY % "ref_uuids")
        .when(present("num_chunks", is_integer), NOT_INTEGER)
        .when(present("num_chunks", v.positive_int_or_null(count).isNotNull()), NOT_POSITIVE)
        .when(present("archive", v.strict_flag_or_null(meta.value("archive")).isNotNull()), NOT_FLAG % "archive")
        .when(present("public", v.strict_flag_or_null(meta.value("public")).isNotNull()), NOT_FLAG % "public"))


def reject_chunks(chunks: DataFrame) -> DataFrame:
    """Chunks that fail validation, with ``invalid_reason``."""
    meta = Metadata.of(chunks)
    judged = meta.frame.withColumn("invalid_reason", invalid_reason(meta)).filter("invalid_reason IS NOT NULL")
    return judged.select(*chunks.columns, "invalid_reason")


def build_payload(chunks: DataFrame) -> DataFrame:
    """Payload rows of the valid chunks; ``job_id`` and ``vector`` pass through.

    Null means that the field is absent. Metadata without a field of its own ends up in
    ``meta``, a JSON object.
    """
    meta = Metadata.of(chunks)
    hash_ = text.trim(F.col("hash"))
    cols = {
        "text": text.trim(F.col("text")),
        "hash": hash_,
        "collection_key": F.lit(CANONICAL_KEY),
        "content_uuid": text.upper_hex(v.scalar_text(meta.value("content_uuid"))),
        "chunktoken": text.chunk_token(hash_, F.col("chunk_index")),
        "chunk_index": F.col("chunk_index").cast("int"),
        **{key: v.scalar_text(meta.value(key)) for key in TEXT_KEYS},
        "num_chunks": v.positive_int_or_null(meta.value("num_chunks")).try_cast("int"),
        "archive": v.strict_flag_or_null(meta.value("archive")),
        "public": v.strict_flag_or_null(meta.value("public")),
        "tags": text.normalise_strings(meta.strings("tags"), fold_case=True),
        "ref_uuids": text.normalise_strings(meta.strings("ref_uuids"), hex_only=True),
        "meta": meta.remainder(),
    }
    extra = [c for c in ("job_id", "vector") if c in chunks.columns]
    valid = meta.frame.filter(invalid_reason(meta).isNull())
    return valid.select(*[cols[name].alias(name) for name, *_ in FIELDS], cols["meta"].alias("meta"), *extra)
