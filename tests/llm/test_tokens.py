import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import tiktoken
from tokenizers import Tokenizer

from tests.llm.cases import empty, frame, rows
from tidemark.llm import bpe, packing, terms, token_counts

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_multi_50k.tiktoken")


def reference():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_counts_equal_the_library(spark):
    lib = Tokenizer.from_file(JSON)
    want = sorted((
        (i, len((t or "").encode()), k := len(lib.encode(t or "", add_special_tokens=False).ids), k > 1024) for i, t, *_ in rows()), key=str)
    for most in (terms.COMMON_TERMS, 2):  # with common terms, and nearly all by the join
        found = token_counts.count_tokens(frame(spark), JSON, P.PATTERN, most=most).collect()
        assert sorted(map(tuple, found), key=str) == want
    assert token_counts.count_tokens(empty(spark), JSON, P.PATTERN).collect() == []


def test_ids_and_round_trip(spark):
    lib = reference()
    coded = bpe.decode(bpe.encode(frame(spark), RANKS, P.PATTERN), RANKS, P.PATTERN).collect()
    found = sorted(((r.doc_id, r.n_tokens, hashlib.sha256(r.ids).hexdigest(), bytes(r.decoded)) for r in coded), key=str)
    want = sorted(((i, len(x := lib.encode_ordinary(t or "")), hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest(), (t or "").encode())
                   for i, t, *_ in rows()), key=str)
    assert found == want
    assert bpe.encode(empty(spark), RANKS, P.PATTERN).collect() == []


def test_random_texts_equal_the_library():
    lib, own, rng = reference(), bpe.Coder(RANKS, P.PATTERN), random.Random(9)
    bits = ["a", "ab", "aaa", " ", "  ", "\n", "\t", "é", "中", "\U0001f600", "'s", "'", "12", "!!", "\xa0", " ", "the", "\x00", "\x1c", "###"]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(20)))
        assert own.encode(text) == np.array(lib.encode_ordinary(text), "<u4").tobytes(), text
    for n in range(1, 80):
        for text in ("a" * n, "=" * n, " " * n, "ab" * n, "é" * n):
            assert own.encode(text) == np.array(lib.encode_ordinary(text), "<u4").tobytes(), text


def test_offsets_of_split_characters():
    own = bpe.Coder(RANKS, P.PATTERN)
    text = "a \U0001f9ff\U0001f9ff é"
    ids = own.encode(text)
    at = own.offsets(ids)
    assert b"".join(text.encode()[a:b] for a, b in zip(at[:-1], at[1:])) == own.decode(ids) == text.encode()
    for (a, b), x, y in zip(own.char_offsets(text, ids), at[:-1], at[1:]):
        assert len(text[:a].encode()) <= x and len(text[:b].encode()) >= y
    # A lone part of a character is bytes, not text.
    part = np.frombuffer(own.encode("\U0001f9ff"), "<u4")[:1].tobytes()
    assert own.decode(part) == "\U0001f9ff".encode()[:len(own.decode(part))]


def test_offsets_of_every_row(spark):
    lib = reference()
    found = bpe.encode_with_offsets(frame(spark), RANKS, P.PATTERN).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(i) for i, *_ in rows())
    texts = {}
    for i, t, *_ in rows():
        texts.setdefault(i, []).append(t or "")
    for r in found:
        raw = [t for t in texts[r.doc_id] if np.array(lib.encode_ordinary(t), "<u4").tobytes() == bytes(r.ids)]
        text, at = raw[0], r.byte_offsets
        assert len(at) == r.n_tokens + 1 and at[0] == 0 and at[-1] == len(text.encode())
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert [text.encode()[a:b] for a, b in zip(at[:-1], at[1:])] == [lib.decode_single_token_bytes(i) for i in ids]
        for low, high, a, b in zip(r.char_starts, r.char_ends, at[:-1], at[1:]):
            # The least run of characters that holds the token's bytes.
            assert len(text[:low].encode()) <= a < len(text[:low + 1].encode()) and len(text[:high - 1].encode()) < b <= len(text[:high].encode())
    assert bpe.encode_with_offsets(empty(spark), RANKS, P.PATTERN).collect() == []


def test_best_fit_by_tree_equals_search():
    rng = random.Random(2)
    sizes = [rng.randrange(1, 65) for _ in range(500)]
    packs = packing.best_fit(sizes, 64)
    free, want = [], []
    for i in sorted(range(500), key=lambda i: (-sizes[i], i)):
        fits = [r for r in range(len(free)) if free[r] >= sizes[i]]
        if fits:
            least = min(free[r] for r in fits)
            free[next(r for r in fits if free[r] == least)] -= sizes[i]
        else:
            free.append(64 - sizes[i])
    assert sorted(i for p in packs for i in p) == list(range(500))
    assert all(sum(sizes[i] for i in p) <= 64 for p in packs)
    assert len(packs) == len(free) and want == []


def test_packs_hold_every_token(spark, tmp_path):
    lib = reference()
    packs = packing.write(packing.pack(frame(spark).coalesce(2), RANKS, P.PATTERN, length=64, pad=7), str(tmp_path / "packs")).collect()
    docs = {}
    for p in packs:
        ids, positions = np.frombuffer(p.ids, "<u4"), np.frombuffer(p.positions, "<u4")
        assert len(ids) == len(positions) == 64 and p.lengths[0] == 0 and p.lengths[-1] == p.n_tokens
        assert (ids[p.n_tokens:] == 7).all()
        for k, (a, b) in enumerate(zip(p.lengths[:-1], p.lengths[1:])):
            assert (positions[a:b] == np.arange(b - a)).all()
            docs.setdefault((p.doc_ids[k], p.doc_rows[k]), []).append((p.doc_offsets[k], ids[a:b].tolist()))
    found = sorted((str(d), sum((ids for _, ids in sorted(pieces)), [])) for (d, _), pieces in docs.items())
    assert found == sorted((str(i), x) for i, t, *_ in rows() if (x := lib.encode_ordinary(t or "")))
    assert len({p.pack_id for p in packs}) == len(packs)
    assert packing.pack(empty(spark), RANKS, P.PATTERN).collect() == []
