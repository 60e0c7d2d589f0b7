import hashlib
import random

import pytest

from tests.llm.cases import empty, frame, rows
from tidemark.llm import repeats


def brute(items, match):
    docs = [((1 << 63) - 1 if d is None else d, (t or "").encode()) for d, t in items]
    first = {}
    for d, b in docs:
        for i in range(len(b) - match + 1):
            w = b[i:i + match]
            first[w] = min(d, first.get(w, d))
    out = []
    for (d, _), (key, b) in zip(items, docs):
        gone = bytearray(len(b))
        for i in range(len(b) - match + 1):
            if first[b[i:i + match]] < key:
                gone[i:i + match] = b"\1" * match
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.text_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in df.collect()), key=str)


@pytest.mark.parametrize("letters", ["ab", "abcdéfgh ", "a\x00\x01\U0001f600"])
def test_removed_bytes_equal_brute_force(spark, letters):
    rng = random.Random(len(letters))
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(120))) for _ in range(60)]
    texts += ["".join(rng.choice(texts)[:rng.randrange(60)] for _ in range(3)) for _ in range(60)]
    items = list(enumerate(texts))
    rng.shuffle(items)
    df = spark.createDataFrame(items, "doc_id long, text string").repartition(3)
    assert got(repeats.remove_repeats(df, 12, 5)) == brute(items, 12)


def test_awkward_rows(spark):
    items = [(r[0], r[1]) for r in rows()] + [(1000, "z" * 300), (1001, "z" * 49), (1002, "y" + "z" * 50), (1003, rows()[-1][1][:5000])]
    df = spark.createDataFrame(items, "doc_id long, text string")
    assert got(repeats.remove_repeats(df)) == brute(items, 50)
    assert got(repeats.remove_repeats(frame(spark))) == brute([(r[0], r[1]) for r in rows()], 50)
    assert got(repeats.remove_repeats(empty(spark))) == []


def test_groups_hold_all_occurrences(spark):
    rng = random.Random(8)
    shared = "".join(rng.choice("abcdefgh") for _ in range(40))
    items = [(i, "".join(rng.choice("ijkl") for _ in range(30)) + shared + str(i) * 20) for i in range(6)]
    df = spark.createDataFrame(items, "doc_id long, text string")
    found = repeats.repeat_groups(df, 12, 5).collect()
    covered = set()
    for r in found:
        part = bytes(r.bytes)
        for d, at in zip(r.doc_ids, r.starts):
            assert items[d][1].encode()[at:at + len(part)] == part
        if part.decode() in shared:
            assert set(range(6)) <= set(r.doc_ids)
            covered |= {i for at in [shared.index(part.decode())] for i in range(at, at + len(part))}
    assert covered == set(range(40))


def test_intervals_are_maximal():
    text = [b"xabcabcd", b"yabcabce", b"zabcq"]
    array = repeats.SuffixArray(text, __import__("numpy").zeros(3, int), 2)
    seen = {text[array.part[a]][array.offset[a]:array.offset[a] + n] for n, a, b in zip(*array.intervals(2))}
    # "bc" is preceded by "a" wherever it stands.
    assert seen == {b"abcabc", b"abc"}


def whole_repeats(items, match):
    """Every maximal repeat and its occurrences: all substrings, by brute force."""
    docs = [(d, (t or "").encode()) for d, t in items]
    at = {}
    for row, (_, b) in enumerate(docs):
        for i in range(len(b) - match + 1):
            for j in range(i + match, len(b) + 1):
                at.setdefault(b[i:j], []).append((row, i))
    out = []
    for part, places in at.items():
        before = {docs[r][1][i - 1] if i else ("start", r) for r, i in places}
        after = {docs[r][1][i + len(part)] if i + len(part) < len(docs[r][1]) else ("end", r) for r, i in places}
        if len(places) > 1 and len(before) > 1 and len(after) > 1:
            out.append((part, sorted(((docs[r][0], i) for r, i in places), key=str)))
    return sorted(out)


def group_rows(df):
    return sorted((bytes(r.bytes), sorted(zip(r.doc_ids, r.starts), key=str)) for r in df.collect())


def test_groups_are_whole_maximal_repeats(spark):
    rng = random.Random(21)
    passage = "".join(rng.choice("abcdefgh") for _ in range(150))  # longer than the windows of one anchor
    items = [(i, "xyzu"[i] * 5 + passage + "klmn"[i] * 5) for i in range(4)]
    items += [(4, "v" + passage[:90] + "w"), (5, "r" + passage[40:] + "s")]  # held longer by some of the others
    alone = "".join(rng.choice("opqrst") for _ in range(40))
    items += [(6, alone + "-" + alone + "+")]  # twice in one text only
    items += [(7, "only copies hold this text"), (8, "only copies hold this text"), (None, "only copies hold this text"), (8, "only copies hold this text")]
    items += [(9, "1" + passage + "2"), (9, "1" + passage + "2"), (10, passage[:60]), (10, passage[:60]), (11, "short"), (11, "short"), (12, None), (13, "é" * 20)]
    df = spark.createDataFrame(items, "doc_id long, text string").repartition(3)
    found = group_rows(repeats.repeat_groups(df, 12, 5))
    assert found == whole_repeats(items, 12)
    assert passage.encode() in [part for part, _ in found]


def test_random_groups_equal_brute_force(spark):
    rng = random.Random(22)
    items = [(i, "".join(rng.choice("ab") for _ in range(rng.randrange(70)))) for i in range(25)]
    items += [(40 + i, rng.choice(items)[1] + rng.choice(items)[1][:20]) for i in range(10)] + [(90, items[3][1]), (None, items[5][1])]
    df = spark.createDataFrame(items, "doc_id long, text string").repartition(3)
    assert group_rows(repeats.repeat_groups(df, 8, 4)) == whole_repeats(items, 8)
    assert group_rows(repeats.repeat_groups(empty(spark))) == []


def test_segments_of_a_hot_anchor_are_parted(spark):
    rng = random.Random(23)
    template = "template##"  # shorter than a window, with other text around it everywhere
    items = [(i, "".join(rng.choice("abcdefgh") for _ in range(20)) + template + "".join(rng.choice("ijklmnop") for _ in range(20))) for i in range(400)]
    items += [(400 + i, rng.choice(items)[1][rng.randrange(10):] + str(i)) for i in range(60)]
    rng.shuffle(items)
    df = spark.createDataFrame(items, "doc_id long, text string").repartition(3)
    texts = repeats.distinct_texts(df)
    found = repeats.segments(texts, repeats.stored(repeats.shared_anchors(texts, 12, 5, hot=50), "anchors"), 12, 5)
    assert max(r["count"] for r in found.filter("length(bytes) > 0").groupBy("hash").count().collect()) <= 50
    assert got(repeats.remove_repeats(df, 12, 5, hot=50)) == brute(items, 12)
