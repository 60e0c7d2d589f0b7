"""Cut texts into overlapping chunks inside their row; no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text as t
from tidemark.operators.enrich import merge_maps
from tidemark.operators.ranking import bucketed_rank

MAX_LENGTH = 2000
MIN_LENGTH = 500
OVERLAP = 50


def chunk_texts(text: Column, max_length: int = MAX_LENGTH, min_length: int = MIN_LENGTH, overlap: int = OVERLAP) -> Column:
    """All chunks of a text as an array.

    Each chunk starts ``max_length - overlap`` characters after the one before it; a last
    chunk shorter than ``min_length`` joins the one before. One regular-expression pass
    yields every piece, so the cost is linear in the length of the text.
    """
    if not 0 <= overlap < max_length or min_length > max_length:
        raise ValueError("need 0 <= overlap < max_length and min_length <= max_length")
    step = max_length - overlap
    pieces = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{1,{max_length}}})).{{1,{step}}}"), F.lit(1))
    length = F.char_length(text)
    count = F.when(length <= max_length, 1).otherwise(F.ceil((length - max_length) / step) + 1).cast("int")
    short_tail = (count > 1) & (length - (count - 1) * step < min_length)

    def cut(parts: Column) -> Column:
        joined = F.concat(F.element_at(parts, count - 1), F.substring(F.element_at(parts, count), overlap + 1, max_length))
        merged = F.concat(F.slice(parts, 1, F.greatest(count - 2, F.lit(0))), F.array(joined))
        return F.when(short_tail, merged).otherwise(F.slice(parts, 1, count))

    # The lambda binds the pieces once; writing them out twice would match twice.
    cut_once = F.element_at(F.transform(F.array(pieces), cut), 1)
    return F.when(length <= max_length, F.array(text)).otherwise(cut_once)


def chunk_rows(rows: DataFrame, text_col: str = "text", **limits: int) -> DataFrame:
    """Replace the text column by ``chunk_index``, ``num_chunks`` and the chunk's ``text``.

    Blank chunks go first, so that indexes are dense and ``num_chunks`` is the same on
    all chunks of a row. A ``metadata`` struct gets ``num_chunks`` too.
    """
    kept = [c for c in rows.columns if c != text_col]
    raw = F.filter(chunk_texts(F.col(text_col), **limits), lambda c: t.trim(c) != "")
    cut = rows.select(*kept, raw.alias("_chunks"))
    # An inner explode makes Spark filter on the size of the list, and that filter, the whole cutting, moves below
    # every join to all rows that may be joined. The outer one leaves it here.
    out = cut.select(
        *kept, F.size("_chunks").alias("num_chunks"), F.posexplode_outer("_chunks").alias("chunk_index", "text")).filter("chunk_index IS NOT NULL")
    if "metadata" in kept:
        out = out.withColumn("metadata", F.col("metadata").withField("num_chunks", F.col("num_chunks")))
    return out


def number_chunks(rows: DataFrame, item: str, position: str) -> DataFrame:
    """Number chunk rows made elsewhere: blank ones go, the rest get a dense index.

    An item may hold any share of the rows: positions are counted in ranges of 65,536,
    so a long item is numbered by many tasks.
    """
    live = rows.filter(t.trim(F.coalesce("text", F.lit(""))) != "")
    ranked = bucketed_rank(
        live, [F.shiftright(position, 32), F.shiftright(position, 16)], [F.col(position)],
        name="chunk_index", within=[item], total="num_chunks")
    return ranked.withColumn("chunk_index", F.col("chunk_index") - 1)


def merged_metadata(item: Column, parsed: Column, chunk: Column) -> Column:
    """Item metadata, then parsed metadata, then the chunk's own; later keys win."""
    return merge_maps(merge_maps(item, parsed), chunk)
