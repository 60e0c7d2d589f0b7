"""Text helpers: trimming, ASCII case, hex identifiers, hashes and tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a trim removes.
TRIM_CHARS = " \t\n\r\x00\x0b"

# ASCII-only case folding.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

# RFC 4122 namespace for DNS names.
POINT_NAMESPACE = "6ba7b8109dad11d180b400c04fd430c8"


def trim(c: Column) -> Column:
    return F.btrim(c, F.lit(TRIM_CHARS))


def lower(c: Column) -> Column:
    """Lower-case ASCII letters only; letters outside ASCII stay as they are."""
    is_ascii = F.octet_length(c) == F.char_length(c)  # most texts are, and need no look-up per letter
    return F.when(is_ascii, F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def non_blank(c: Column) -> Column:
    """The trimmed text, or null when nothing is left."""
    return F.nullif(trim(c), F.lit(""))


def collection_key(alias: Column) -> Column:
    """The trimmed type alias in lower case, or ``default``: keys that differ in case are one."""
    return F.coalesce(lower(non_blank(alias)), F.lit("default"))


def upper_hex(c: Column) -> Column:
    """Hex digits only, upper case; may be empty."""
    return F.when(F.unhex(c).isNotNull(), F.upper(c)).otherwise(F.upper(F.regexp_replace(c, "[^0-9a-fA-F]", "")))


def packed(c: Column, bare: bool = False) -> Column:
    """A text as bytes, one to one, for shuffles: 32 upper-case hex digits, as ids and versions are, take half the room.

    A first byte tells digits from other texts. If ``bare``, 16 bytes are digits, without that byte.
    """
    is_hex = (F.octet_length(c) == 32) & (F.hex(F.unhex(c)) == c)
    other = F.concat(F.lit(b"\x00"), c.cast("binary"))
    if bare:
        return F.when(is_hex, F.unhex(c)).when(F.octet_length(c) == 15, F.concat(F.lit(b"\x01"), c.cast("binary"), F.lit(b"\x00"))).otherwise(other)
    return F.when(is_hex, F.concat(F.lit(b"\x01"), F.unhex(c))).otherwise(other)


def unpacked(c: Column, bare: bool = False) -> Column:
    """The text that ``packed`` made ``c`` from."""
    rest = F.substring(c, 2, (1 << 31) - 1)
    marked = F.substring(c, 1, 1) == F.lit(b"\x01")
    if bare:
        return F.when(F.length(c) == 16, F.hex(c)).when(marked, F.substring(c, 2, 15).cast("string")).otherwise(rest.cast("string"))
    return F.when(marked, F.hex(rest)).otherwise(rest.cast("string"))


def packed_ids(uuid: Column, version: Column, etag: Column) -> Column:
    """Three bare ``packed`` columns as one, one to one; a version that equals the etag takes no room."""
    own = F.when(version.eqNullSafe(etag), F.lit(b"")).otherwise(F.coalesce(version, F.lit(b"\x02")))
    spelled = F.concat_ws(",", *[F.coalesce(F.hex(c), F.lit("-")) for c in (uuid, version, etag)])
    is_hex = (F.length(uuid) == 16) & (F.length(etag) == 16)
    return F.when(is_hex, F.concat(F.lit(b"\x01"), uuid, etag, own)).otherwise(F.concat(F.lit(b"\x00"), spelled.cast("binary")))


def unpacked_ids(c: Column) -> tuple[Column, Column, Column]:
    """The texts of uuid, version and etag that ``packed_ids`` made ``c`` from."""
    uuid, etag, own = F.substring(c, 2, 16), F.substring(c, 18, 16), F.substring(c, 34, (1 << 31) - 1)
    version = F.when(F.length(own) == 0, etag).when(own != F.lit(b"\x02"), own)
    spelled = F.split(F.substring(c, 2, (1 << 31) - 1).cast("string"), ",")
    is_hex = F.substring(c, 1, 1) == F.lit(b"\x01")
    parts = [F.when(is_hex, p).otherwise(F.unhex(F.nullif(F.get(spelled, F.lit(i)), F.lit("-")))) for i, p in enumerate((uuid, version, etag))]
    return tuple(unpacked(p, bare=True) for p in parts)


def item_hash(key: Column, uuid_hex: Column, version_hex: Column) -> Column:
    """Identity of one version of one entry under one key."""
    version = F.coalesce(version_hex, F.lit(""))
    return F.sha2(F.concat_ws(":", key, uuid_hex, version), 256)


def chunk_token(hash_: Column, index: Column) -> Column:
    return F.when(index > 0, F.concat_ws("-", hash_, index.cast("string"))).otherwise(hash_)


def point_id(hash_: Column, index: Column, namespace: str = POINT_NAMESPACE) -> Column:
    """Version 5 UUID of hash and chunk index, so that a repeated write keeps its id."""
    name = F.concat(hash_, index.cast("string"))
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8")))
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def normalise_strings(values: Column, hex_only: bool = False, fold_case: bool = False) -> Column:
    """Trim each element, drop blanks, keep the first of equal ones; null when empty."""
    out = F.transform(values, trim)
    if hex_only:
        out = F.transform(out, upper_hex)
    out = F.filter(out, lambda v: v != "")
    if fold_case:
        out = F.transform(out, lower)
    out = F.array_distinct(out)
    return F.when(F.size(out) > 0, out)
