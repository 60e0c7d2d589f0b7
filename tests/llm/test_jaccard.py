import random

import numpy as np
import pytest

from tests.llm.cases import empty, frame, prose, rows, shingles
from tidemark.llm import jaccard


def brute(items):
    """Smallest id of each component, over rows; null is larger than all."""
    sets = [shingles(t) for _, t in items]
    parent = list(range(len(items)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(items):
        if doc_id is not None:
            root = find(i)
            least[root] = min(doc_id, least.get(root, doc_id))
    return sorted(((d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(items, sets))), key=str)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


@pytest.mark.parametrize("block", [jaccard.BLOCK, 7])
def test_near_copies_equal_brute_force(spark, block):
    rng = random.Random(5)
    items, ids = [], iter(random.Random(6).sample(range(10_000), 400))
    for size, copies, edits in ((120, 60, 4), (120, 40, 2), (60, 12, 1), (40, 6, 1), (300, 10, 3)):
        base = prose(rng, size)
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randrange(edits + 1)):
                text[rng.randrange(size)] = f"x{rng.randrange(50)}"
            items.append((next(ids), " ".join(text)))
    passage = prose(rng, 60)
    for _ in range(60):
        items.append((next(ids), " ".join(prose(rng, rng.randrange(1, 40)) + passage)))
    # A chain: each text is close to the next one only.
    chain = prose(rng, 200, 10_000)
    for i in range(0, 60, 12):
        items.append((next(ids), " ".join(chain[i:i + 120])))
    df = spark.createDataFrame(items, "doc_id long, text string").repartition(5)
    assert got(jaccard.classes(df, block)) == brute(items)


def test_awkward_rows(spark):
    items = [(r[0], r[1]) for r in rows()]
    assert got(jaccard.classes(frame(spark))) == brute(items)
    kept = [r.doc_id for r in jaccard.keep_one(frame(spark)).collect()]
    assert 5 not in kept and kept.count(4) == 1 and kept.count(None) == 2
    assert jaccard.keep_one(frame(spark)).columns == frame(spark).columns


def test_empty_table(spark):
    assert got(jaccard.classes(empty(spark))) == []


def test_tree_finds_all_that_the_bound_allows():
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 9, (20, 128))
    counts = np.maximum(0, centre[rng.integers(0, 20, 700)] + rng.integers(-1, 2, (700, 128))).astype(np.uint16)
    n = counts.sum(axis=1, dtype=np.int64) + rng.integers(0, 3, 700)
    label = rng.integers(0, 5, 700)
    tree = jaccard.Tree(counts, n, label)
    slack = n - counts.sum(axis=1, dtype=np.int64)
    for q in range(0, 700, 23):
        shared = np.minimum(counts, counts[q]).sum(axis=1, dtype=np.int64) + np.minimum(slack, slack[q])
        want = (5 * n >= 4 * n[q]) & (5 * n[q] >= 4 * n) & (shared >= jaccard.least_shared(n, n[q])) & (label != label[q])
        found = tree.near(counts[q], int(n[q]), int(label[q]))
        assert set(found[label[found] != label[q]]) == set(np.flatnonzero(want))


def test_vectors_of_different_length_bound_what_is_shared():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 64, 9000, dtype=np.uint64)
    sets = [np.unique(rng.choice(base, k)) for k in (100, 600, 700, 1000, 1100, 4000, 8000)] + [np.arange(2000, dtype=np.uint64)] * 2
    import pyarrow as pa

    counts = pa.array([jaccard.count_vector(s).tobytes() for s in sets], pa.binary())
    n = np.array([len(s) for s in sets])
    a, b = np.triu_indices(len(sets), 1)
    most = jaccard.bounds(counts, n, a, b)
    assert all(m >= len(np.intersect1d(sets[i], sets[j])) for m, i, j in zip(most, a, b))
    assert most[-1] == 2000  # one group holds all of both, more than its byte can


def brute_links(items):
    sets = [shingles(t) for _, t in items]
    return sorted(((d, sum(1 for j, b in enumerate(sets) if j != i and a and b and 100 * len(a & b) >= 80 * len(a | b)))
                   for i, ((d, _), a) in enumerate(zip(items, sets))), key=str)


@pytest.mark.parametrize("block", [jaccard.BLOCK, 7])
def test_every_link_is_counted(spark, block):
    rng = random.Random(9)
    items = []
    for size, copies, edits in ((120, 40, 4), (60, 12, 2), (300, 8, 3)):
        base = prose(rng, size)
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randrange(edits + 1)):
                text[rng.randrange(size)] = f"x{rng.randrange(50)}"
            items.append((len(items), " ".join(text)))
    items += [(100, None), (101, ""), (102, "alone in the world it stands"), (None, items[0][1]), (3, items[50][1])]
    df = spark.createDataFrame(items, "doc_id long, text string").repartition(5)
    found = jaccard.classes(df, block, jaccard.INNER if block > 7 else 9).collect()
    assert sorted(((r.doc_id, r.n_links) for r in found), key=str) == brute_links(items)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str) == brute(items)


def test_sets_of_all_lengths_are_held_against_each_other():
    rng = np.random.default_rng(8)
    sets = []
    for size in (5, 60, 250, 300, 1100, 5000):
        base = rng.integers(0, 1 << 64, size, dtype=np.uint64)
        sets += [np.unique(np.concatenate([rng.choice(base, int(size * share), replace=False), rng.integers(0, 1 << 64, size // 20, dtype=np.uint64)]))
                 for share in rng.uniform(0.9, 1, 9)]
    copies = rng.integers(1, 5, len(sets))
    linked = np.array([[i != j and 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b)) for j, b in enumerate(sets)] for i, a in enumerate(sets)])
    assert linked.sum() > 50
    assert (jaccard.linked_rows(sets, copies, None) == linked @ copies).all()
    asks = rng.random(len(sets)) < 0.5
    apart = linked & (asks[:, None] != asks[None, :])
    assert (jaccard.linked_rows(sets, copies, asks) == apart @ copies).all()


def test_one_document_stays_whatever_its_id(spark):
    """Rows are known by id and text: unrelated texts under one id, and texts without an id."""
    rng = random.Random(2)
    a, b = " ".join(prose(rng, 50)), " ".join(prose(rng, 50))
    near = a + " x"
    rows_ = [(1, a), (2, near), (2, b), (None, a), (None, near), (None, "alone without any other text here"), (3, b), (3, b), (None, None), (None, None), (4, None), (4, "")]
    df = spark.createDataFrame(rows_, "doc_id long, text string").repartition(3)
    kept = sorted(((r.doc_id, r.text) for r in jaccard.keep_one(df).collect()), key=str)
    assert kept == sorted([(1, a), (2, b), (None, "alone without any other text here"), (None, None), (4, None), (4, "")], key=str)
    names = spark.createDataFrame([(1, a, 5, 6, "n"), (2, a, 7, 8, "m")], "doc_id int, text string, key long, node long, first string")
    assert [tuple(r) for r in jaccard.keep_one(names).collect()] == [(1, a, 5, 6, "n")]


def test_text_key_is_the_hash_of_the_column(spark):
    from pyspark.sql import functions as F

    texts = ["", "a", "é中😀", "x" * 999, None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(F.xxhash64("t").alias("h")).collect()
    assert [r.h for r in got][:4] == [jaccard.text_key(t) for t in texts[:4]] and jaccard.text_key(None) is None
