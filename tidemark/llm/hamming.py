"""Exact k nearest binary codes by multi-index hashing with growing radii.

A code is cut into segments. If two codes differ in at most ``m * (r + 1) - 1`` bits, one
of the ``m`` segments differs in at most ``r``. Each round looks up the segment values that
lie one bit further from the query's; a query is done when its k-th verified distance is
within what the rounds so far prove. Equal codes are one entry of the index with its
smallest ids, and equal queries are searched once, so a crowd of equal rows is no hot key.

Null vectors have no code: they are neither found nor do they find. Shorter vectors are
filled with zero bits. Rows with equal ids are distinct neighbours of others; a query never
finds rows with its own id. Fewer than k other rows give fewer neighbours. An empty table
gives an empty result. Columns other than those named are left out, whatever they are called.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrow import stored

WORD = 64


def sign_codes(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``id, code``: one bit per value, set where it is above 0, in words of 64 bits."""
    length = vectors.agg(F.max(F.size(vector_column))).first()[0] or 0
    words = max(1, math.ceil(max(0, length) / WORD))

    def word(w: int) -> Column:
        bits = [F.when(F.get(vector_column, F.lit(w * WORD + i)) > 0, F.shiftleft(F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))
                for i in range(min(WORD, max(1, length - w * WORD)))]
        return reduce(lambda a, b: a.bitwiseOR(b), bits)

    return vectors.filter(F.col(vector_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("id"), F.array(*(word(w) for w in range(words))).alias("code"))


def segment_bits(distinct: int) -> int:
    """About log2 of the number of codes, as a divisor of a word."""
    return 8 if distinct < 1 << 12 else 16 if distinct < 1 << 24 else 32


def segments(bits: int, words: int) -> Column:
    """All segments of ``code`` as structs of number and value."""
    per, mask = WORD // bits, (1 << bits) - 1
    return F.array(*(
        F.struct(F.lit(w * per + s).alias("segment"),
                 F.shiftrightunsigned(F.col("code")[w], s * bits).bitwiseAND(F.lit(mask)).alias("value"))
        for w in range(words) for s in range(per)))


def distance(a: str, b: str, words: int) -> Column:
    return reduce(lambda x, y: x + y, [F.bit_count(F.col(a)[w].bitwiseXOR(F.col(b)[w])) for w in range(words)])


def top_k(codes: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """``query_id, rank, id, distance`` of the ``k`` nearest rows, ties by id.

    Both inputs hold ``id, code``. A query row searches all rows but those of its own id.
    """
    rows = stored(codes.select("id", "code"), "codes")
    asked = stored(queries.select(F.col("id").alias("query_id"), F.col("code").alias("query")).distinct(), "queries")
    first = rows.select(F.size("code").alias("n")).first()
    if first is None:
        return _none(rows)
    words, keep = first["n"], k + 1
    # Own rows may repeat: a query needs k others beyond the rows that bear its id.
    own = rows.join(asked.select(F.col("query_id").alias("id")).distinct(), "id", "left_semi").groupBy("id").count()
    keep = k + (own.agg(F.max("count")).first()[0] or 1)

    by_code = Window.partitionBy("code").orderBy("id")
    index = stored(
        rows.withColumn("n", F.row_number().over(by_code)).filter(F.col("n") <= keep)
        .groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "index")
    distinct = index.count()
    bits = segment_bits(distinct)
    parts = words * WORD // bits
    entries = index.select("code", F.size("ids").alias("n"), F.col("ids")[0].alias("least"), F.explode(segments(bits, words)).alias("s")) \
        .select("code", "n", "least", "s.*")

    frontier = stored(
        asked.select(F.col("query").alias("code")).distinct().withColumn("s", F.explode(segments(bits, words)))
        .select(F.col("code").alias("query"), "s.*", F.lit(-1).alias("top")), "frontier")
    best: DataFrame | None = None
    done: list[DataFrame] = []
    order = Window.partitionBy("query").orderBy("distance", "least", "code")
    for radius in range(bits + 1):
        met = frontier.join(entries, ["segment", "value"]).select(
            "query", "code", "n", "least", distance("query", "code", words).alias("distance"))
        found = (met if best is None else met.unionByName(best)).distinct()
        ranked = found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= keep).drop("place")
        best = stored(ranked, "found")
        proven = parts * (radius + 1) - 1
        ready = best.filter(F.col("distance") <= proven).groupBy("query").agg(F.sum("n").alias("n")).filter(F.col("n") >= keep)
        if radius == bits:
            done.append(best)
            break
        ready = stored(ready.select("query"), "ready")
        done.append(best.join(ready, "query", "left_semi"))
        best = best.join(ready, "query", "left_anti")
        # One more bit, always above the highest one changed so far: each value comes once.
        steps = F.explode(F.sequence(F.col("top") + 1, F.lit(bits - 1)))
        frontier = stored(
            frontier.filter(F.col("top") < bits - 1).join(ready, "query", "left_anti").withColumn("bit", steps)
            .select("query", "segment",
                    F.col("value").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("value"),
                    F.col("bit").alias("top")), "frontier")
        if frontier.isEmpty():
            done.append(best)
            break
    nearest = reduce(DataFrame.unionByName, done).select("query", "code", "distance")
    others = asked.join(nearest, "query").join(index.select("code", "ids"), "code") \
        .select("query_id", "distance", F.explode("ids").alias("id")).filter(~F.col("id").eqNullSafe(F.col("query_id")))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "id"))
    return others.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "id", "distance")


def _none(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), "id", F.lit(0).alias("distance")).limit(0)
