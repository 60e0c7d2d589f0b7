"""Documents linked by the Jaccard similarity of their word shingles, with a count-vector R-tree.

A document's shingles are hashed into groups; the counts per group are a point. The sum of
the smaller coordinates of two points bounds the shingles they share, and so does a point
with the upper corner of a box of points: an R-tree over the points of one neighbourhood
finds the pairs that may be similar enough, and their sets decide.

Neighbourhoods come from prefixes: under any one order of all shingles, two sets that are
similar enough share one of their first ``n - ceil(0.8 n) + 1``. The order puts shingles
first that are not known to be frequent. Equal sets are one node.

Components come first. Each node is held against one node of each of its neighbourhoods, a
different one in each: the most likely one, then the others that are not in its component
yet. Where that joins a whole neighbourhood nothing is left to search. The rest is searched
by tree, in pairs of blocks where it is large, for pairs between the components so far. So a
crowd of near copies costs about its number of shingles there, and no link between
components is lost.

All links lie inside components. ``classes`` counts them there: the sets of a component, or
of two of its blocks, meet in one task, a tree gives each the ones it may be linked with,
and the sets decide. Every pair meets once, so only a number per set and task goes out and
no pair is ever a row. That count compares a crowd of near copies with itself.

Documents without words are linked with nothing. A null id is larger than all others: a
component of null ids only has none. Rows with equal ids are documents of their own; rows
equal in id and text stay or go together. Sets are told apart by a 64-bit hash. An empty
table gives an empty result. Columns other than ``doc_id`` and ``text`` are never looked at,
whatever they are called.
"""

from __future__ import annotations

import uuid
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow import batches_of, chunks, documents, forget, free_shuffles, per_document, stored
from tidemark.llm.graph import components
from tidemark.llm.repeats import partitions, whole_groups
from tidemark.llm.shingles import mixed, shingle_sets
from tidemark.session import work_dir

# Similarity as a fraction: 100 * shared >= 80 * union.
PART, WHOLE = 4, 5
# Fewest and most bits of a group number; between them a set has about two shingles a group.
LEAST_BITS, MOST_BITS = 7, 14
# A count takes four bits.
MOST_COUNT = 15
# Sets that a task remembers to have sent the text of.
NODES_SEEN = 100_000
# Text among which a task counts the documents of a shingle.
COUNTED_BYTES = 2_000_000
# Frequent shingles that are sent to every task, and how many documents of a chunk hold one.
FREQUENT, OFTEN = 1 << 17, 4
# Nodes of one block of a neighbourhood; points of one leaf.
BLOCK, LEAF = 4096, 32
# Rows of neighbourhoods with one first node that share a task.
TASK_ROWS = 2000
# Nodes of one block of a component, and shingles of one.
INNER, INNER_SHINGLES = 512, 500_000
# Shingles that are held against a set at once; pairs of sets of one Arrow batch.
HELD, VERIFIED_ROWS = 500_000, 100


def prefix_size(n: int) -> int:
    return n - (PART * n + WHOLE - 1) // WHOLE + 1


def least_shared(a, b):
    """Shared shingles that sets of sizes ``a`` and ``b`` need: ``shared / (a + b - shared) >= 4 / 5``."""
    return -(-PART * (a + b) // (PART + WHOLE))


def node_of(found: np.ndarray) -> int:
    """A 64-bit name of a set, from two sums over its members."""
    x = np.array([found.sum(dtype=np.uint64), len(found)], np.uint64)
    y = mixed(found + np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(mixed(mixed(x[:1]) + y + x[1:]).astype(np.int64)[0])


def text_key(text: str | None) -> int | None:
    """What ``F.xxhash64`` gives for a text."""
    h = xxhash.xxh64_intdigest((text or "").encode(), seed=42)
    return None if text is None else h - (1 << 64) if h >> 63 else h


def sets_of(docs: DataFrame) -> DataFrame:
    """``doc_id, n, node, text, key`` per row, and rows of ``hash, times`` with the shingles that are frequent in a chunk.

    The text is there once per set and task. The key is its hash in every row.
    """
    names = ["doc_id", "n", "node", "text", "hash", "times", "key"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]

    def task(batches):
        seen: set[int] = set()
        for ids, texts in chunks(batches, COUNTED_BYTES):
            sets = shingle_sets(texts)
            nodes = [node_of(s) if len(s) else None for s in sets]
            fresh = [t if x is not None and not (x in seen or seen.add(x)) else None for x, t in zip(nodes, texts)]
            if len(seen) > NODES_SEEN:
                seen.clear()
            h, times = np.unique(np.concatenate(sets), return_counts=True)
            h, times = h[times >= OFTEN].astype(np.int64), times[times >= OFTEN]
            blank, none = [None] * len(h), [None] * len(ids)
            columns = [*([*c, *blank] for c in (ids, [len(s) for s in sets], nodes, fresh)), [*none, *h.tolist()], [*none, *times.tolist()],
                       [*map(text_key, texts), *blank]]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return documents(docs).mapInArrow(task, "doc_id long, n long, node long, text string, hash long, times long, key long")


def frequent(found: DataFrame, most: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, at most ``most``, sorted by hash, and how often they were met."""
    times = stored(found.filter("hash is not null").groupBy("hash").agg(F.sum("times").alias("times")), "frequent")
    level = F.floor(F.log2("times") * 8)
    taken, least = 0, None
    for row in sorted(times.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"]):  # under 600 levels
        if taken + row["count"] > most:
            break
        taken, least = taken + row["count"], row["level"]
    rows = times.filter(level >= least).collect() if least is not None else []
    h = np.array([r["hash"] for r in rows], np.int64).astype(np.uint64)
    order = np.argsort(h)
    return h[order], np.array([r["times"] for r in rows], np.int64)[order]


def prefix(found: np.ndarray, common: np.ndarray, times: np.ndarray) -> np.ndarray:
    """The first shingles of a set: those not known as frequent, then the less frequent, by hash."""
    size = prefix_size(len(found))
    if not len(common):
        return found[:size]
    at = np.minimum(np.searchsorted(common, found), len(common) - 1)
    weight = np.where(common[at] == found, times[at], 0)
    return found[np.lexsort((found, weight))[:size]]


def distinct_texts(counted: DataFrame) -> DataFrame:
    """``node, text``: one text per set, written once in buckets of the node."""
    return in_buckets(counted.filter("text IS NOT NULL").select("node", "text").dropDuplicates(["node"]), "sets")


def neighbourhoods(texts: DataFrame, common: np.ndarray, times: np.ndarray) -> DataFrame:
    """``sign, node, lead``: prefix shingles that several nodes share, each with one of its nodes to lead it."""
    sent = texts.sparkSession.sparkContext.broadcast((common, times))

    def signs(nodes, found):
        sets = [prefix(s, *sent.value) for s in shingle_sets(found)]
        return pa.array(np.concatenate(sets).astype(np.int64)), pa.array(np.repeat(np.array(nodes, np.int64), [len(s) for s in sets]))

    def lead(batches):
        """Rows come sorted by sign; a run is not held, but for its first row."""
        sign = first = None
        alone = False
        for batch in batches:
            signs_, nodes = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            starts = np.flatnonzero(np.concatenate([[True], signs_[1:] != signs_[:-1]]))
            leads = np.repeat(nodes[starts], np.diff(np.append(starts, len(signs_))))
            if signs_[0] == sign:
                leads[signs_ == sign] = first
            kept = np.concatenate([signs_[1:] == signs_[:-1], [False]]) | np.concatenate([[signs_[0] == sign], signs_[1:] == signs_[:-1]])
            before = [(sign, first)] if alone and signs_[0] == sign else []
            out = [np.concatenate([np.array([b[k] for b in before], np.int64), c[kept]])
                   for k, c in ((0, signs_), (1, nodes), (1, leads))]
            alone = not kept[-1]
            sign, first = int(signs_[-1]), int(leads[-1])
            if len(out[0]):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], names=["sign", "node", "lead"])

    rows = per_document(texts.select(F.col("node").alias("doc_id"), "text"), signs, "sign long, node long")
    return rows.repartition(partitions(texts), "sign").sortWithinPartitions("sign", F.xxhash64("sign", "node")).mapInArrow(
        lead, "sign long, node long, lead long")


def in_buckets(rows: DataFrame, purpose: str) -> DataFrame:
    """Write rows made from a bucketed table: a task holds one bucket, so nothing is shuffled."""
    spark, name = rows.sparkSession, f"{purpose}_{uuid.uuid4().hex}"
    rows.write.bucketBy(partitions(rows), "node").option("path", work_dir(spark, purpose)).saveAsTable(name)
    del rows
    free_shuffles(spark)
    return spark.table(name)


def points(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, n, counts`` of the nodes named."""

    def work(ids, found):
        sets = shingle_sets(found)
        return ids, [len(s) for s in sets], [count_vector(s).tobytes() for s in sets]

    named = texts.join(nodes, "node", "left_semi").select(F.col("node").alias("doc_id"), "text")
    return in_buckets(per_document(named, work, "node long, n long, counts binary"), "points")


def sets_for(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """``node, shingles`` of the nodes of the pairs."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    named = texts.join(nodes, "node", "left_semi").select(F.col("node").alias("doc_id"), "text")
    return in_buckets(per_document(
        named, lambda ids, found: (ids, [s.tobytes() for s in shingle_sets(found)]), "node long, shingles binary"), "shingles")


def count_vector(found: np.ndarray) -> np.ndarray:
    """Shingles per group, two groups a byte. What four bits cannot hold is made up for by the size.

    A larger set has more groups. A group of fewer bits is some neighbouring ones of more,
    so vectors of two lengths can be compared at the shorter one.
    """
    bits = min(MOST_BITS, max(LEAST_BITS, (len(found) // 2).bit_length()))
    counts = np.bincount((found >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    counts = np.minimum(counts, MOST_COUNT).astype(np.uint8)
    return (counts[::2] << 4) | counts[1::2]


def unpacked(raw: bytes, rows: int) -> np.ndarray:
    """Packed vectors of one length as a matrix of counts."""
    packed = np.frombuffer(raw, np.uint8).reshape(rows, -1)
    out = np.empty((rows, 2 * packed.shape[1]), np.uint8)
    out[:, ::2], out[:, 1::2] = packed >> 4, packed & 15
    return out


def folded(counts: np.ndarray, groups: int) -> np.ndarray:
    """Rows of counts with fewer, wider groups."""
    if counts.shape[1] == groups:
        return counts.astype(np.uint16)
    return counts.reshape(len(counts), groups, -1).sum(axis=2, dtype=np.uint16)


def bounds(counts: pa.Array, n: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For pairs of places: the most shingles that they can share."""
    groups = 2 * pc.binary_length(counts).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros(len(a), np.int64)
    both = groups[a] * (1 << 20) + groups[b]
    for kind in np.unique(both):
        at = np.flatnonzero(both == kind)
        low = int(min(kind >> 20, kind & ((1 << 20) - 1)))
        for part in np.array_split(at, len(at) * low // 4_000_000 + 1):
            rows = [folded(unpacked(b"".join(counts.take(pa.array(side[part])).to_pylist()), len(part)), low)
                    for side in (a, b)]
            slack = [n[side[part]] - r.sum(axis=1, dtype=np.int64) for side, r in zip((a, b), rows)]
            out[part] = np.minimum(*rows).sum(axis=1, dtype=np.int64) + np.minimum(*slack)
    return out


class Tree:
    """An R-tree over count vectors: boxes of about equally large sets with their upper corners.

    ``label`` is what tells points that need not be compared; a box of one label has it too.
    """

    def __init__(self, counts: np.ndarray, n: np.ndarray, label: np.ndarray):
        self.order = np.lexsort((counts.argmax(axis=1), n))
        self.counts, self.n, self.label = counts[self.order], n[self.order], label[self.order]
        self.slack = self.n - self.counts.sum(axis=1, dtype=np.int64)
        self.levels = []
        upper, low, high, slack, one, other = self.counts, self.n, self.n, self.slack, self.label, self.label
        while len(upper) > LEAF:
            cut = np.arange(0, len(upper), LEAF)
            upper, high, slack = (np.maximum.reduceat(x, cut) for x in (upper, high, slack))
            low, one, other = np.minimum.reduceat(low, cut), np.minimum.reduceat(one, cut), np.maximum.reduceat(other, cut)
            self.levels.append((upper, low, high, slack, one, other))

    def near(self, counts: np.ndarray, n: int, label: int) -> np.ndarray:
        """Places of the points of other labels whose set may be similar enough."""
        spare = n - int(counts.sum(dtype=np.int64))
        open_ = None
        for upper, low, high, slack, one, other in [*reversed(self.levels), (self.counts, self.n, self.n, self.slack, self.label, self.label)]:
            if open_ is not None:
                open_ = (open_[:, None] * LEAF + np.arange(LEAF)).ravel()
                open_ = open_[open_ < len(low)]
            else:
                open_ = np.arange(len(low))
            # Sizes first: they are one number each.
            fit = (high[open_] * WHOLE >= PART * n) & (low[open_] * PART <= WHOLE * n) & ~((one[open_] == label) & (other[open_] == label))
            open_ = open_[fit]
            if not len(open_):
                break
            shared = np.minimum(upper[open_], counts).sum(axis=1, dtype=np.int64) + np.minimum(slack[open_], spare)
            open_ = open_[shared >= least_shared(n, low[open_])]
        return self.order[open_]


def led_pairs(members: DataFrame) -> DataFrame:
    """``a, b``: each node with the leads of its neighbourhoods."""
    return members.filter("node <> lead").select(F.col("node").alias("a"), F.col("lead").alias("b")).distinct()


def bounded(pairs: DataFrame, at: DataFrame) -> DataFrame:
    """The pairs whose count vectors allow enough shared shingles, and how ``near`` they can be at most."""
    left = pairs.join(at.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("counts").alias("c_a")), "a")
    both = left.join(at.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("counts").alias("c_b")), "b") \
        .filter(f"{WHOLE} * n_a >= {PART} * n_b AND {WHOLE} * n_b >= {PART} * n_a").select("a", "b", "n_a", "n_b", "c_a", "c_b")

    def task(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            n_a, n_b = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
            size, first = batch.num_rows, np.arange(batch.num_rows)
            shared = bounds(pa.concat_arrays([batch.column(4), batch.column(5)]), np.concatenate([n_a, n_b]), first, first + size)
            kept = np.flatnonzero(shared >= least_shared(n_a, n_b))
            near = pa.array(shared[kept] / (n_a + n_b)[kept])
            yield pa.RecordBatch.from_arrays([*(batch.column(i).take(pa.array(kept)) for i in (0, 1)), near], names=["a", "b", "near"])

    return both.mapInArrow(task, "a long, b long, near double")


def verified(pairs: DataFrame, at: DataFrame) -> DataFrame:
    """The pairs whose sets are similar enough, written; ``at`` holds ``node, shingles``."""
    left = pairs.select("a", "b").join(at.select(F.col("node").alias("a"), F.col("shingles").alias("s_a")), "a")
    both = left.join(at.select(F.col("node").alias("b"), F.col("shingles").alias("s_b")), "b").select("a", "b", "s_a", "s_b")

    def task(batches):
        for batch in batches:
            kept = []
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                shared = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                if shared >= least_shared(len(x), len(y)):
                    kept.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(i).take(pa.array(kept, pa.int64())) for i in (0, 1)], names=["a", "b"])

    with batches_of(pairs.sparkSession, VERIFIED_ROWS):
        return stored(both.mapInArrow(task, "a long, b long"), "links")


def apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose nodes are not in one component."""
    left = pairs.join(roots.select(F.col("node").alias("a"), F.col("root").alias("r_a")), "a", "left")
    both = left.join(roots.select(F.col("node").alias("b"), F.col("root").alias("r_b")), "b", "left")
    return both.filter(F.coalesce("r_a", "a") != F.coalesce("r_b", "b")).select("a", "b")


def searched(members: DataFrame, roots: DataFrame, at: DataFrame, block: int = BLOCK) -> DataFrame:
    """``a, b``: pairs between components that meet in a neighbourhood and that the tree lets through."""
    placed = stored(
        members.select("sign", "node").join(roots, "node", "left").select("sign", "node", F.coalesce("root", "node").alias("root")), "placed")
    split = placed.groupBy("sign").agg(
        F.min("root").alias("least"), F.max("root").alias("most"), F.min("node").alias("first"),
        F.ceil(F.count("*") / block).cast("int").alias("blocks"), F.count("*").alias("size")).filter("least <> most")
    # Neighbourhoods with the same first node share many pairs: a task sends each of them once. Where they
    # have many rows, all of them are cut into the same blocks, so that this still holds.
    shares = split.groupBy("first").agg(F.ceil(F.sqrt(F.sum("size") * 2 / TASK_ROWS)).cast("int").alias("shares"))
    split = split.join(shares, "first").select("sign", "first", F.greatest("blocks", "shares").alias("blocks"))
    rows = placed.join(split, "sign").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn(
        "with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.join(at.select("node", "n", "counts"), "node").select(
        F.xxhash64("sign", F.least("block", "with"), F.greatest("block", "with")).alias("key"),
        F.xxhash64("first", F.least("block", "with"), F.greatest("block", "with")).alias("task"),
        F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "node", "root", "n", "counts")

    def task(batches):
        sent: set[tuple[int, int]] = set()
        for columns in whole_groups(batches):
            key, _, i, j, own, node, root, n = (columns[k].to_numpy(zero_copy_only=False) for k in range(8))
            cuts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]), [True]]))
            size = np.diff(cuts)
            # Neighbourhoods of two are one comparison each: all of them at once.
            a = cuts[:-1][size == 2]
            a = a[(root[a] != root[a + 1]) & ((i[a] == j[a]) | (own[a] != own[a + 1]))
                  & (WHOLE * n[a] >= PART * n[a + 1]) & (WHOLE * n[a + 1] >= PART * n[a])]
            a = a[bounds(columns[8], n, a, a + 1) >= least_shared(n[a], n[a + 1])]
            found = [zip(node[a].tolist(), node[a + 1].tolist())]
            for low, high in zip(cuts[:-1][size > 2].tolist(), cuts[1:][size > 2].tolist()):
                part = slice(low, high)
                found.append(pairs_within(node[part], root[part], n[part], columns[8].slice(low, high - low), own[part], bool(i[low] == j[low])))
            out = []
            for a, b in chain.from_iterable(found):
                pair = (a, b) if a < b else (b, a)
                if pair not in sent:
                    sent.add(pair)
                    out.append(pair)
                if len(out) >= 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b"])
                    out = []
                if len(sent) > 200_000:
                    sent.clear()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b"])

    return rows.repartition(partitions(at), "task").sortWithinPartitions("key").mapInArrow(task, "a long, b long").distinct()


def pairs_within(node, root, n, counts: pa.Array, own, same: bool):
    """Pairs of different components; the largest component is looked up, not looked from.

    With ``same`` unset the rows are two blocks, and pairs of one block belong elsewhere.
    One tree per length of vector: linked sets have the same length or the next one.
    """
    names, label = np.unique(root, return_inverse=True)
    if len(names) < 2:
        return
    largest = int(np.bincount(label).argmax())
    groups = 2 * pc.binary_length(counts).to_numpy(zero_copy_only=False).astype(np.int64)
    raw = counts.to_pylist()
    places = {int(g): np.flatnonzero(groups == g) for g in np.unique(groups)}
    matrices = {g: unpacked(b"".join(raw[p] for p in at.tolist()), len(at)) for g, at in places.items()}
    trees: dict[tuple[int, int], Tree] = {}
    for mine, at in places.items():
        ask = np.flatnonzero(label[at] != largest)
        for other in {mine // 2, mine, mine * 2} & places.keys() if len(ask) else ():
            low, there = min(mine, other), places[other]
            if (other, low) not in trees:
                trees[other, low] = Tree(folded(matrices[other], low), n[there], label[there])
            vectors = folded(matrices[mine][ask], low)
            for q, vector in zip(at[ask].tolist(), vectors):
                for p in there[trees[other, low].near(vector, int(n[q]), int(label[q]))].tolist():
                    if label[p] != label[q] and (same or own[p] != own[q]):
                        yield int(node[q]), int(node[p])


def prepared(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The rows with their nodes, one text per node, the neighbourhoods, and the points in them."""
    spark = docs.sparkSession
    made = work_dir(spark, "shingle-sets")
    counted = stored(sets_of(docs), "shingle-sets", made)
    rows = stored(counted.filter("hash is null").select("doc_id", "n", "node", "key"), "rows")
    common = frequent(counted)
    texts = distinct_texts(counted)
    forget(spark, made)
    members = stored(neighbourhoods(texts, *common), "members")
    free_shuffles(spark)
    return rows, texts, members, points(texts, members.select("node").distinct())


def spanning(texts: DataFrame, members: DataFrame, at: DataFrame, block: int = BLOCK) -> DataFrame:
    """``a, b``: as many linked pairs of nodes as the components need, not all of them."""
    spark = texts.sparkSession
    led = stored(bounded(led_pairs(members), at), "led")
    free_shuffles(spark)
    sets = sets_for(texts, led)
    first = stored(led.groupBy("a").agg(F.max_by("b", F.struct("near", "b")).alias("b")), "first")
    links = verified(first, sets)
    roots = stored(components(links), "roots")
    others = led.join(first, ["a", "b"], "left_anti")
    links = links.unionByName(verified(apart(others, roots), sets))
    roots = stored(components(links), "roots")
    # Pairs that were held against each other before need not be again.
    tried = led.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    found = stored(searched(members, roots, at, block).join(tried, ["a", "b"], "left_anti"), "found")
    free_shuffles(spark)
    return links.unionByName(verified(found, sets_for(texts, found)))


def inner_links(texts: DataFrame, named: DataFrame, inner: int = INNER) -> DataFrame:
    """``node, beyond``: the rows of other sets that each node of a component is linked with.

    ``named`` holds ``node, root, copies, n`` of all nodes with links. A component is cut into
    blocks; each pair of blocks is one task's work, so that each pair of nodes meets once.
    """
    cut = named.groupBy("root").agg(
        F.greatest(F.ceil(F.count("*") / inner), F.ceil(F.sum("n") / INNER_SHINGLES)).cast("int").alias("blocks"))
    placed = named.join(cut, "root").select("node", "root", "copies", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"), "blocks")

    def sets(ids, found):
        return ids, [s.tobytes() for s in shingle_sets(found)]

    made = per_document(texts.join(named.select("node"), "node", "left_semi").select(F.col("node").alias("doc_id"), "text"), sets, "node long, shingles binary")
    met = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = made.join(placed, "node").withColumn("with", met).select(
        F.xxhash64("root", F.least("block", "with"), F.greatest("block", "with")).alias("key"),
        (F.col("block") == F.col("with")).alias("same"), (F.col("block") < F.col("with")).alias("asks"), "node", "copies", "shingles")
    # A component of one block meets itself; of several, each block meets itself and every other one.
    def task(batches):
        for columns in whole_groups(batches, INNER_SHINGLES * 16):
            key, same, asks, node, copies = (columns[k].to_numpy(zero_copy_only=False) for k in range(5))
            cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
            for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                own = [np.frombuffer(columns[5][i].as_buffer(), np.uint64) for i in range(low, high)]
                beyond = linked_rows(own, copies[low:high], None if same[low] else asks[low:high])
                some = np.flatnonzero(beyond)
                if len(some):
                    yield pa.RecordBatch.from_arrays([pa.array(node[low:high][some]), pa.array(beyond[some])], names=["node", "beyond"])

    with batches_of(texts.sparkSession, VERIFIED_ROWS):
        found = stored(rows.repartition(partitions(texts), "key").sortWithinPartitions("key").mapInArrow(task, "node long, beyond long"), "beyond")
    return found.groupBy("node").agg(F.sum("beyond").alias("beyond"))


def linked_rows(sets: list[np.ndarray], copies: np.ndarray, asks: np.ndarray | None) -> np.ndarray:
    """For each set the copies of all sets that it is linked with; ``asks`` marks the sets of the first of two blocks."""
    n = np.array([len(s) for s in sets], np.int64)
    counts = [count_vector(s) for s in sets]
    groups = np.array([2 * len(c) for c in counts])
    places = {int(g): np.flatnonzero(groups == g) for g in np.unique(groups)}
    matrices = {g: unpacked(b"".join(counts[p].tobytes() for p in at.tolist()), len(at)) for g, at in places.items()}
    trees: dict[tuple[int, int], Tree] = {}
    out = np.zeros(len(sets), np.int64)
    for mine, at in places.items():
        ask = np.arange(len(at)) if asks is None else np.flatnonzero(asks[at])
        for other in {mine // 2, mine, mine * 2} & places.keys() if len(ask) else ():
            low, there = min(mine, other), places[other]
            if (other, low) not in trees:
                trees[other, low] = Tree(folded(matrices[other], low), n[there], there)
            vectors = folded(matrices[mine][ask], low)
            for q, vector in zip(at[ask].tolist(), vectors):
                near = there[trees[other, low].near(vector, int(n[q]), q)]
                near = near[near > q] if asks is None else near[~asks[near]]
                for part in np.array_split(near, int(n[near].sum()) // HELD + 1):
                    if not len(part):
                        continue
                    all_ = np.concatenate([sets[p] for p in part.tolist()])
                    hits = sets[q][np.minimum(np.searchsorted(sets[q], all_), len(sets[q]) - 1)] == all_
                    shared = np.add.reduceat(hits, np.concatenate([[0], np.cumsum(n[part])[:-1]]), dtype=np.int64)
                    linked = part[shared >= least_shared(n[q], n[part])]
                    out[q] += copies[linked].sum()
                    out[linked] += copies[q]
    return out


def named_nodes(rows: DataFrame, links: DataFrame) -> DataFrame:
    """``node, root, n, copies, first``: the nodes with their component and the first row of each, smallest id first."""
    roots = stored(components(links), "roots")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    found = rows.filter("node is not null").groupBy("node").agg(F.first("n").alias("n"), F.count("*").alias("copies"), F.min(first).alias("first"))
    return stored(found.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "n", "copies", "first"), "nodes")


def membership(rows: DataFrame, named: DataFrame) -> DataFrame:
    """``doc_id, key, n_shingles, component_id, first, node`` of every row; without words the node is null."""
    firsts = named.groupBy("root").agg(F.min("first").alias("first"))
    by_node = named.select("node", "root").join(firsts, "root").select("node", "first")
    linked = rows.filter("node is not null").join(by_node, "node").select(
        "doc_id", "key", F.col("n").alias("n_shingles"), F.col("first.doc_id").alias("component_id"), "first", "node")
    alone = rows.filter("node is null").select(
        "doc_id", "key", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"),
        F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key").alias("first"), "node")
    return linked.unionByName(alone)


def classes(docs: DataFrame, block: int = BLOCK, inner: int = INNER) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` of every row.

    ``n_links`` is the number of other rows that the row is linked with, those of equal sets
    included.
    """
    rows, texts, *parts = prepared(docs)
    named = named_nodes(rows, spanning(texts, *parts, block))
    several = named.groupBy("root").count().filter("count > 1").select("root")
    free_shuffles(docs.sparkSession)
    beyond = inner_links(texts, stored(named.join(several, "root", "left_semi"), "inner"), inner)
    counts = named.join(beyond, "node", "left").select("node", (F.col("copies") - 1 + F.coalesce("beyond", F.lit(0))).alias("n_links"))
    return membership(rows, named).join(counts, "node", "left").select(
        "doc_id", "n_shingles", "component_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def groups(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """``doc_id, key, n_shingles, component_id, first, node`` of every row, without counting links."""
    rows, texts, *parts = prepared(docs)
    return membership(rows, named_nodes(rows, spanning(texts, *parts, block)))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, that of the smallest id, with all its columns.

    A row is known by its id and its text, so repeated and null ids make no difference: a
    null id comes after all others. Rows equal in id and text are one document.
    """
    here = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    gone = groups(docs).filter(here != F.col("first")).select(F.col("doc_id").alias("_gone_id"), F.col("key").alias("_gone_key")).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_gone_id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("_gone_key"))
    return docs.join(gone, same, "left_anti").select(*docs.columns).dropDuplicates(["doc_id", "text"])
