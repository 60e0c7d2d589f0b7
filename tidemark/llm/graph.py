"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow import stored


def components(links: DataFrame) -> DataFrame:
    """``node, root``: the smallest node that each linked node reaches. Links are ``a, b``.

    Every step is a grouped minimum and a join with one row per node; a node with very many
    links is split by the adaptive join. Each round is written to the shared folder.
    """
    now = stored(links.select("a", "b").filter("a <> b").distinct(), "links")
    mark = None
    while True:
        now = stored(_small(_large(now)), "links")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 40))).first()
        if seen == mark:
            break
        mark = seen
    return now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _large(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    others = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
