"""Lookup of names by word or by the beginning of a word, over an index instead of all names.

The index is two written tables: postings, which hold a row per word of a name, and a
dictionary of the distinct words. Both are sorted by word, in ranges, so that a lookup of
few words reads their ranges only; many lookups are one join. The words with one beginning
lie side by side in the dictionary, so a beginning is a range of it, too. ``vectors.search_names`` is the scan that gives the same rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.vectors import name_tokens, pushed_equals
from tidemark.session import work_dir

POSTING = "token string, id string"
WORD = "token string"
# Distinct words of all lookups up to which their ranges are named to the scan.
PUSHED_WORDS = 200
# Rows of one sorted range: what bounds the memory of the task that sorts it.
RANGE_ROWS = 250_000


def _sorted(rows: DataFrame, key: str, path: str) -> None:
    """Write the distinct rows in ranges of ``key``; the other columns part the ranges of a key that fills more than one.

    Equal rows meet in their range, so one shuffle serves to find them and to sort. The rows are
    written down first, so that they are made once; their number decides how many ranges there
    are, so that no task sorts more than about ``RANGE_ROWS``.
    """
    spark, flat = rows.sparkSession, work_dir(rows.sparkSession, "unsorted")
    rows.write.parquet(flat)
    made = spark.read.schema(rows.schema).parquet(flat)
    order = [key, *[c for c in rows.columns if c != key]]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-made.count() // RANGE_ROWS))
    made.repartitionByRange(parts, *order).distinct().sortWithinPartitions(*order).write.parquet(path)


def build_name_index(table: DataFrame, path: str, id_col: str = "point_id", name_col: str = "name") -> None:
    """Index the words of all names under ``path``; null and wordless names are in no posting."""
    words = F.explode(F.array_distinct(name_tokens(F.col(name_col)))).alias("token")
    _sorted(table.select(words, F.col(id_col).cast("string").alias("id")), "token", f"{path}/postings")
    postings = table.sparkSession.read.schema(POSTING).parquet(f"{path}/postings")
    _sorted(postings.select("token").distinct(), "token", f"{path}/words")


def _few(words: DataFrame) -> list[str] | None:
    """The distinct words, if they are few enough to be named to a scan."""
    few = [r[0] for r in words.select("word").distinct().limit(PUSHED_WORDS + 1).collect()]
    return few if len(few) <= PUSHED_WORDS else None


def _ranged(rows: DataFrame, key: str, words: DataFrame) -> DataFrame:
    """The rows of a sorted table that any of the words can be in."""
    few = _few(words)
    return rows if few is None else rows.filter(pushed_equals(key, few))


def _begun(dictionary: DataFrame, words: DataFrame) -> DataFrame:
    """``word, token``: every word of the dictionary with each of the asked words that it begins with.

    A word of the dictionary is cut to the lengths that are asked for, no others.
    """
    asked = words.select("word").distinct()
    few = _few(asked)
    if few is not None:
        dictionary = dictionary.filter(reduce(lambda a, b: a | b, (F.startswith(F.col("token"), F.lit(w)) for w in few), F.lit(False)))
    lengths = sorted(r[0] for r in asked.select(F.char_length("word")).distinct().collect())  # a number per length of a word
    cut = F.explode(F.array(*(F.lit(n) for n in lengths)).cast("array<int>")).alias("n")
    ends = dictionary.select("token", cut).filter(F.col("n") <= F.char_length("token"))
    return ends.select(F.substr("token", F.lit(1), F.col("n")).alias("word"), "token").join(asked, "word")


def lookup_names(spark: SparkSession, path: str, lookups: DataFrame, prefix: bool = False) -> DataFrame:
    """``query_id, id`` of the names that hold all words of a query, or words that begin with them.

    ``lookups`` holds ``query_id, query``, any number of them. A query without words finds nothing.
    """
    asked = lookups.select("query_id", F.array_distinct(name_tokens(F.col("query"))).alias("words")).filter(F.size("words") > 0)
    words = asked.select("query_id", F.size("words").alias("n"), F.explode("words").alias("word"))
    postings = spark.read.schema(POSTING).parquet(f"{path}/postings")
    if prefix:
        pairs = _begun(spark.read.schema(WORD).parquet(f"{path}/words"), words)
        near = _ranged(postings, "token", pairs.select(F.col("token").alias("word")))
        # Grouped by what the hits are counted by, so that the rows are moved once for both.
        found = words.join(pairs, "word").join(near, "token").select("query_id", "n", "word", "id").repartition("query_id", "id").distinct()
    else:
        found = words.join(_ranged(postings, "token", words).withColumnRenamed("token", "word"), "word")
    hits = found.groupBy("query_id", "id").agg(F.count("*").alias("hits"), F.first("n").alias("n"))
    return hits.filter("hits = n").select("query_id", "id")
