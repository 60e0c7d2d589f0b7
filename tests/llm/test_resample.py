import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from tests.llm.cases import empty, frame, lower, prose, rows
from tidemark.llm import resample


def plain_runs(text, longest):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    return w, [" ".join(w[i:i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def plain(docs, target, percent, least, longest, buckets):
    """The result as the definition has it, one document after the other."""
    def bucket(run):
        return zlib.crc32(run.encode()) % buckets

    s, t = Counter(), Counter()
    for table, out in ((docs, s), (target, t)):
        for _, text in table:
            out.update(map(bucket, plain_runs(text, longest)[1]))
    big_s, big_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets))))

    out = []
    for doc_id, text in docs:
        words, runs = plain_runs(text, longest)
        weight = sum(gain(bucket(r)) for r in runs)
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append((doc_id, len(runs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)))
    fit = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = Counter()
    drawn = {}
    for place, r in enumerate(fit[:len(fit) * percent // 100], 1):
        drawn.setdefault(r, []).append(place)
    result = []
    for r in out:
        left = drawn.get(r, [])
        result.append((*r[:4], left.pop(0) if left else None))
    del ranks
    return sorted(result, key=str)


def table(rng, n):
    out = []
    for i in range(n):
        words = [w.upper() if rng.random() < 0.2 else w for w in prose(rng, rng.randrange(0, 60), 30)]
        out.append((i, "".join(w + rng.choice([" ", ", ", "-", "\n", "é ", "  "]) for w in words)))
    return out


@pytest.mark.parametrize("longest, most", [(1, 0), (2, 1 << 17), (3, 20)])
def test_equals_the_plain_version(spark, longest, most):
    rng = random.Random(longest)
    docs, target = table(rng, 120) + rows_of_cases(), table(rng, 9) + [(99, None), (98, "")]
    a, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(target, "item_id long, text string")
    got = resample.resample(a, b, 30, 7, longest, 97, most=most).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(docs, target, 30, 7, longest, 97)


def rows_of_cases():
    return [r[:2] for r in rows()]


def test_extra_columns_and_empty_tables(spark):
    wanted = spark.createDataFrame([("some words",)], "text string")
    got = resample.resample(frame(spark), wanted, 50, 1)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows_of_cases(), [(0, "some words")], 50, 1, 1, 10_000)
    assert resample.resample(empty(spark), wanted).count() == 0
    none = resample.resample(frame(spark), wanted.limit(0), 50, 1)
    assert sorted((tuple(r) for r in none.collect()), key=str) == plain(rows_of_cases(), [], 50, 1, 1, 10_000)


def test_frequent_and_tail_features_share_buckets():
    head = resample.Head([b"a"], [(b"a", b"b")], 1000)
    for run, text in ((b"a", b"a"), (b"z", b"z"), ((b"a", b"b"), b"a b"), ((b"a", b"z"), b"a z"), ((b"z", b"a", b"b"), b"z a b")):
        assert head.bucket(run) == zlib.crc32(text) % 1000
