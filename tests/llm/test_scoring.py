import collections
import math
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from tests.llm.cases import empty, frame, rows, words
from tidemark.llm import lm_score

RANKS = P.path("byte_bpe_multi_50k.tiktoken")


def trains(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 != 0


def test_base_equals_brute_force(spark):
    items = [(i, [*words(t), None]) for i, t, *_ in rows()]
    c = collections.Counter(w for i, ws in items if trains(i) for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), i is not None and not trains(i), len(ws), sum(c[w] > 0 for w in ws), n,
                   round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 5)) for i, ws in items)
    for most in (1 << 18, 2):
        found = lm_score.score(frame(spark), RANKS, P.PATTERN, most=most).collect()
        assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in found) == want
        assert all(-math.inf < r.score < 0 for r in found)
    assert lm_score.score(empty(spark), RANKS, P.PATTERN).collect() == []


def test_nothing_to_learn_from(spark):
    held = next(i for i in range(1000) if not trains(i))
    r = lm_score.score(spark.createDataFrame([(held, "a b")], "doc_id long, text string"), RANKS, P.PATTERN).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (True, 3, 0, 0) and -math.inf < r.score < 0


def test_recursion_sums_all_segmentations():
    rng = np.random.default_rng(1)
    size = len(lm_score.coder(RANKS, P.PATTERN).token_bytes)
    lattice = lm_score.Lattice(RANKS, P.PATTERN, np.log10(rng.random((4, size)) / size))
    for word in (b"a", b"thing", "über".encode(), b"tokens"):
        total = 0.0
        for cuts in range(1 << (len(word) - 1)):
            at = [0, *(i + 1 for i in range(len(word) - 1) if cuts >> i & 1), len(word)]
            parts = [word[a:b] for a, b in zip(at, at[1:])]
            terms = [lattice.tables[2 * (k > 0) + (k == len(parts) - 1)].get(p) for k, p in enumerate(parts)]
            if None not in terms:
                total += 10 ** sum(terms)
        assert lattice.word(word) == pytest.approx(math.log10(total))


def test_places_are_distributions(spark):
    counts = lm_score.piece_counts(spark.createDataFrame([("thing", 3), ("things", 0), ("of", 9)], "term string, n long"), RANKS, P.PATTERN).collect()
    table = lm_score.weights(counts, RANKS, P.PATTERN)
    assert (10 ** table[:2]).sum() == pytest.approx(1) and (10 ** table[2:]).sum() == pytest.approx(1)
