"""Ranks and limits without a sort of everything, or of a hot group, in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import work_dir

# Up to this many rows one task merges a top-k; beyond it the rank is computed from bucket
# counts. Both give the same rows: the levels of a limit are prefixes of its order.
TOP_K_LIMIT = 100_000


def bucketed_rank(
    df: DataFrame,
    levels: list[Column],
    order: list[Column],
    name: str = "rank",
    within: list[str] | None = None,
    total: str | None = None,
) -> DataFrame:
    """Add the 1-based rank in the order ``levels + order``, per group of ``within``.

    ``levels`` cut the order into nested buckets, coarse to fine; each level must have a
    bounded number of values inside the one before it. Null levels and groups are values of
    their own, before all others. Bucket counts are summed level by level, so no task sorts more than one leaf bucket: neither a window over the whole
    table nor one over a hot group is needed. The result depends on the rows only, so a
    recomputed task gives the same ranks. ``total`` also adds the number of rows of the
    group.
    """
    groups = within or []
    keys = [f"_level{i}" for i in range(len(levels))]
    keyed = df.select("*", *[c.alias(k) for c, k in zip(levels, keys)])
    counts = keyed.groupBy(*groups, *keys).agg(F.count("*").alias("_n"))
    offsets = None
    for depth in range(len(keys)):
        outer, inner = groups + keys[:depth], keys[depth]
        level = counts.groupBy(*outer, inner).agg(F.sum("_n").alias("_n"))
        around = Window.partitionBy(*outer)
        before = around.orderBy(inner).rowsBetween(Window.unboundedPreceding, -1)
        cols = [F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(f"_before{depth}")]
        if total and depth == 0:
            cols.append(F.sum("_n").over(around).alias(total))
        level = level.select(*outer, inner, *cols)
        offsets = level if offsets is None else join_null_safe(level, offsets, outer)
    leaf = Window.partitionBy(*groups, *keys).orderBy(*order)
    start = reduce(lambda a, b: a + b, [F.col(f"_before{i}") for i in range(len(keys))])
    ranked = join_null_safe(keyed.select("*", F.row_number().over(leaf).alias("_row")), offsets, groups + keys)
    extra = [total] if total else []
    return ranked.select(*df.columns, (start + F.col("_row")).alias(name), *extra)


def ordered_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Add the 1-based rank in ``order`` over the whole table, which is written once, sorted.

    The table is parted into ranges of the order, each sorted by one task. A row's rank is
    its place in its range plus the rows of the ranges before, of which there is one number
    per shuffle partition. ``order`` should tell all rows apart: equal rows share a range.
    The ranges need a first pass over the rows, so these are written down before and made once.
    """
    spark = df.sparkSession
    path, parts = work_dir(spark, "ranked"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    unsorted = work_dir(spark, "unranked")
    df.write.parquet(unsorted)
    df = spark.read.schema(df.schema).parquet(unsorted)
    # The place holds the number of the range above its 33 bits for rows.
    placed = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
    placed.write.parquet(path)
    written = spark.read.schema(placed.schema).parquet(path)
    counts = written.groupBy(F.shiftright("_place", 33).alias("part")).count().collect()  # a row per shuffle partition
    before, offsets = 0, {}
    for part, n in sorted((r["part"], r["count"]) for r in counts):
        offsets[part] = before
        before += n
    start = spark.createDataFrame(list(offsets.items()), "_part long, _before long")
    ranked = written.withColumn("_part", F.shiftright("_place", 33)).join(F.broadcast(start), "_part")
    row = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return ranked.select(*df.columns, (F.col("_before") + row + 1).alias(name))


def join_null_safe(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Inner join in which nulls are equal; the columns of ``on`` come once."""
    named = right.select(*[F.col(c).alias(f"_right_{c}") if c in on else F.col(c) for c in right.columns])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in on])
    return left.join(named, same).drop(*[f"_right_{c}" for c in on])


def take_first(df: DataFrame, order: list[Column], levels: list[Column], leaf_order: list[Column], limit: int | None) -> DataFrame:
    """The first ``limit`` rows of ``order``; all rows when ``limit`` is ``None``.

    A small limit becomes one top-k. A large one keeps the rows whose rank is within it,
    so that neither the driver nor one task has to hold them.
    """
    if limit is None:
        return df
    if limit <= TOP_K_LIMIT:
        return df.orderBy(*order).limit(limit)
    return bucketed_rank(df, levels, leaf_order, "_rank").filter(F.col("_rank") <= limit).drop("_rank")
