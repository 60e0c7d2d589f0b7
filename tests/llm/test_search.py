import random

import pytest

from tests.llm.cases import empty, frame, prose, shingles
from tidemark.llm import decontaminate, hamming


def test_containment_equals_brute_force(spark):
    rng = random.Random(4)
    items = [(i, " ".join(prose(rng, rng.randrange(1, 60)))) for i in range(60)] + [(60, None), (61, ""), (62, "Two Words")]
    docs = []
    for d in range(200):
        text = prose(rng, rng.randrange(0, 300))
        for _ in range(rng.randrange(3)):
            part = rng.choice(items[:60])[1].split()
            part = part[:max(1, int(len(part) * rng.choice([1, 1, 0.9, 0.8, 0.5])))]
            at = rng.randrange(len(text) + 1)
            text[at:at] = part
        docs.append((d, " ".join(text).upper() if d % 3 == 0 else " ".join(text)))
    docs += [(200, "two words"), (201, None), (202, ""), (5, docs[5][1]), (None, docs[5][1]), (200, "clean words under the same id"), (None, None),
             (None, items[59][1]), (None, "clean words without an id")]
    want = set()
    for d, text in docs:
        have = shingles(text)
        for i, item in items:
            s = shingles(item)
            if s and 10 * len(s & have) >= 8 * len(s):
                want.add((d, i, len(s), len(s & have)))
    docs_df = spark.createDataFrame(docs, "doc_id long, text string")
    items_df = spark.createDataFrame(items, "item_id long, text string")
    for block in (decontaminate.BLOCK_SHINGLES, 300):
        found = decontaminate.matches(docs_df, items_df, block=block).collect()
        assert len(found) == len(want) and set(map(tuple, found)) == want
    assert any(d == 200 for d, *_ in want)
    for block in (decontaminate.BLOCK_SHINGLES, 300):
        kept = decontaminate.clean(docs_df, items_df, block=block)
        assert kept.columns == docs_df.columns
        # Every row by its own text: ids repeat, with the same and with other texts, and are null.
        assert sorted(map(str, map(tuple, kept.collect()))) == sorted(
            str(row) for row in docs if not any(s and 10 * len(s & shingles(row[1])) >= 8 * len(s) for s in (shingles(t) for _, t in items)))


def test_empty_sides(spark):
    items = spark.createDataFrame([(1, "the cat sat on the mat and ran")], "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.matches(empty(spark), items).collect() == []
    assert decontaminate.matches(frame(spark), none).collect() == []
    assert [tuple(r) for r in decontaminate.matches(frame(spark), items).collect()] == [(10, 1, 4, 4)]


@pytest.mark.parametrize("bits", [64, 100, 5])
def test_nearest_codes_equal_brute_force(spark, bits):
    rng = random.Random(bits)
    centres = [[rng.gauss(0, 1) for _ in range(bits)] for _ in range(5)]
    rows = []
    for i in range(400):
        kind = i % 4
        v = [x + rng.gauss(0, 0.3) for x in rng.choice(centres)] if kind < 2 else list(centres[0]) if kind == 2 else [rng.gauss(0, 1) for _ in range(bits)]
        rows.append((i, v))
    rows += [(400, None), (500, None), (7, rows[3][1]), (100, rows[2][1])]
    codes = hamming.sign_codes(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), "vec_id", "embedding")
    found = hamming.top_k(codes, codes.filter("id % 100 = 0"), 10).collect()
    signs = [(i, [x > 0 for x in v]) for i, v in rows if v]
    want = []
    for q, a in {(q, tuple(a)) for q, a in signs if q % 100 == 0}:
        near = sorted((sum(x != y for x, y in zip(a, b)), i) for i, b in signs if i != q)[:10]
        want += [(q, d) for d, _ in near]
    assert sorted((r.query_id, r.distance) for r in found if r.query_id != 100) == sorted((q, d) for q, d in want if q != 100)
    best = sorted((sum(x != y for x, y in zip(signs[0][1], b)), i) for i, b in signs if i != 0)[:10]
    assert [(r.distance, r.id) for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == 0] == best


def test_no_vectors(spark):
    codes = hamming.sign_codes(spark.createDataFrame([], "id long, v array<float>"), "id", "v")
    assert hamming.top_k(codes, codes).collect() == []
    few = hamming.sign_codes(spark.createDataFrame([(0, [1.0, -1.0]), (1, [1.0, 1.0])], "id long, v array<float>"), "id", "v")
    assert [tuple(r) for r in hamming.top_k(few, few.filter("id = 0")).collect()] == [(0, 1, 1, 1)]
