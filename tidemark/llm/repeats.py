"""Repeated byte strings across documents, by common-prefix intervals of suffix arrays.

Every window of ``MATCH`` bytes has one least ``GRAM``-byte string in it, its anchor: equal
windows have equal anchors, wherever they stand. The windows of one anchor are one segment
of a few dozen bytes. Anchors that only one document holds are dropped; the segments of the
others meet by anchor, where the suffixes of the distinct ones are sorted. A stack scan over
their common-prefix lengths yields the intervals, each a set of occurrences of one string;
one whose occurrences are all preceded by the same byte is part of a longer one and is
skipped. So no suffix is moved for a text that nothing repeats.

A byte goes if a window over it also starts in a document with a smaller id, judged on the
input. Windows end with their document. A null or empty text has no bytes. A null id counts
as larger than all others. Rows with equal ids do not erase each other; equal texts are
searched once, with a result for each row. An empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow import documents, free_shuffles, row_ids, stored
from tidemark.llm.shingles import gram_hashes
from tidemark.session import work_dir

MATCH, GRAM = 50, 20
LATE = (1 << 63) - 1
# Text of one chunk, segments that a task remembers, and bytes of segments that are sorted at once.
CHUNK, REMEMBERED, SORTED = 4_000_000, 200_000, 1_500_000
CODE_BITS = 7
# Occurrences of an anchor above which its segments are parted into single windows, and the code
# that names such an anchor.
HOT, HOT_CODE = 8192, -1


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, from running minima of blocks."""
    n, blocks = len(values) - width + 1, -(-len(values) // width)
    padded = np.full(blocks * width, values[-1], values.dtype)
    padded[:len(values)] = values
    table = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def anchors(data: np.ndarray, match: int = MATCH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash and position of each anchor, and the first and last window that it stands for.

    The order of grams is the upper half of their hash, then their place: both follow from
    the bytes of the window alone.
    """
    if len(data) < match:
        none = np.empty(0, np.int64)
        return none.astype(np.uint64), none, none, none
    h = gram_hashes(data, gram)
    low = np.uint64(0xFFFFFFFF)
    least = sliding_least((h & ~low) | np.arange(len(h), dtype=np.uint64), match - gram + 1)
    at = (least & low).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
    last = np.concatenate([first[1:] - 1, [len(at) - 1]])
    return h[at[first]], at[first], first, last


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def named(docs: DataFrame) -> DataFrame:
    """``key, check, doc_id, text``: two hashes name a text. A null id is the largest one."""
    return documents(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        F.xxhash64("text").alias("key"), F.xxhash64(F.lit("check"), "text").alias("check"),
        F.coalesce("doc_id", F.lit(LATE)).alias("doc_id"), "text")


def distinct_texts(docs: DataFrame) -> DataFrame:
    """``key, check, doc_id, text``: every text once, with its smallest id, in buckets of the key.

    Written once, so that later steps move no text. Texts whose keys collide only share
    candidates.
    """
    spark, name = docs.sparkSession, f"texts_{uuid.uuid4().hex}"
    rows = named(docs).groupBy("key", "check").agg(F.min("doc_id").alias("doc_id"), F.first("text").alias("text"))
    rows.write.bucketBy(partitions(docs), "key").option("path", work_dir(spark, "texts")).saveAsTable(name)
    del rows
    free_shuffles(spark)
    return spark.table(name)


def shared_anchors(texts: DataFrame, match: int = MATCH, gram: int = GRAM, within: bool = False, hot: int = HOT) -> DataFrame:
    """``key, codes``: per document the windows of anchors that other documents hold too.

    A code is the first window, then the number of windows beyond it. A chunk sends the
    documents that first hold a hash; what its other documents add is known to be shared.
    ``within`` keeps anchors that stand twice in one document, too. An anchor that may stand
    more than ``hot`` times comes as a key with the code ``HOT_CODE``.
    """
    n = partitions(texts)

    def spread(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            found, at, size = [], 0, 0
            column = batch.column(1)
            for i in range(batch.num_rows):
                data = np.frombuffer(column[i].as_buffer(), np.uint8)
                h, _, first, last = anchors(data, match, gram)
                found.append((h, (first << CODE_BITS) | (last - first)))
                size += len(data)
                if size > CHUNK or i == batch.num_rows - 1:
                    yield from _entries(keys[at:i + 1], found, n, within)
                    found, at, size = [], i + 1, 0

    def settle(batches):
        held = [[], [], [], []]
        for batch in batches:
            for row in batch.to_pylist():
                key, code = np.frombuffer(row["keys"], np.int64), np.frombuffer(row["codes"], np.int64)
                key = key[np.frombuffer(row["owners"], np.uint32)]
                if row["hashes"] is None:
                    yield _codes(key, code)
                else:
                    for to, what in zip(held, (np.frombuffer(row["hashes"], np.uint64), key, code, np.frombuffer(row["shared"], np.uint8))):
                        to.append(what)
        if held[0]:
            h, key, code, shared = (np.concatenate(x) for x in held)
            order = np.argsort(h, kind="stable")
            h, key = h[order], key[order]
            starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            sizes = np.diff(np.append(starts, len(h)))
            shared = shared[order]
            more = (np.maximum.reduceat(key, starts) != np.minimum.reduceat(key, starts)) | (np.maximum.reduceat(shared, starts) > 0)
            if within:
                more |= sizes > 1
            kept = np.repeat(more, sizes)
            key, code = key[kept], code[order][kept]
            for i in range(0, len(key), 100_000):
                yield _codes(key[i:i + 100_000], code[i:i + 100_000])
            # An entry stands for itself and for what the rest of its chunk holds, by bit length: never too few.
            often = h[starts][np.add.reduceat(1 << shared.astype(np.int64), starts) > hot].astype(np.int64)
            if len(often):
                yield _codes(often, np.full(len(often), HOT_CODE))

    sent = texts.select("key", F.encode("text", "utf-8").alias("bytes")).mapInArrow(
        spread, "bucket int, hashes binary, keys binary, owners binary, codes binary, shared binary")
    codes = sent.repartition(n, "bucket").mapInArrow(settle, "key long, code long")
    return codes.groupBy("key").agg(F.collect_list("code").alias("codes"))


def _codes(key: np.ndarray, code: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(code, pa.int64())], names=["key", "code"])


def _entries(keys: np.ndarray, found: list[tuple], n: int, within: bool) -> Iterator[pa.RecordBatch]:
    h, code = (np.concatenate([f[k] for f in found]) for k in (0, 1))
    if not len(h):
        return
    owner = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
    order = np.argsort(h, kind="stable")  # owners of a hash stay in their order
    starts = np.concatenate([[True], h[order][1:] != h[order][:-1]])
    group = np.cumsum(starts) - 1
    opener = owner[order][starts][group]
    first = np.empty(len(h), bool)
    first[order] = owner[order] == opener
    others = np.bincount(group[owner[order] != opener], minlength=group[-1] + 1)
    if within:
        others = np.bincount(group) - 1
    shared = np.empty(len(h), np.uint8)
    shared[order] = np.frexp(others)[1][group]  # the bit length tells the number within a factor of two
    bucket = (h % np.uint64(2 * n)).astype(np.int64)
    rows = []
    for kept, b in [*((np.flatnonzero(first & (bucket == b)), b) for b in range(2 * n)), (np.flatnonzero(~first), int(keys[0]) % (2 * n))]:
        if len(kept):
            own, at = np.unique(owner[kept], return_inverse=True)
            direct = b != bucket[kept[0]] or not first[kept[0]]
            rows.append((b, None if direct else h[kept].tobytes(), keys[own].tobytes(), at.astype(np.uint32).tobytes(),
                         code[kept].tobytes(), shared[kept].tobytes()))
    names = ["bucket", "hashes", "keys", "owners", "codes", "shared"]
    kinds = [pa.int32(), *[pa.binary()] * 5]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def hot_anchors(codes: DataFrame) -> np.ndarray:
    """The hashes of the anchors that are parted, sorted: at most the number of all anchors by the bound."""
    rows = codes.filter(F.array_contains("codes", F.lit(HOT_CODE).cast("long"))).select("key").toArrow()
    return np.sort(rows.column(0).to_numpy())


def segments(texts: DataFrame, codes: DataFrame, match: int = MATCH, gram: int = GRAM) -> DataFrame:
    """``hash, doc_id, key, starts, bytes`` of the segments of shared anchors, once per document.

    A segment that its task has seen in a smaller document is settled: all of it goes. The
    settled runs of a document come in one row without bytes, as packed codes. Segments of
    hot anchors come as their windows, under the hash of each: equal windows still meet, and
    no group is as large as the anchor's.
    """
    names = ["hash", "doc_id", "key", "starts", "bytes"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    sent = texts.sparkSession.sparkContext.broadcast(hot_anchors(codes))

    def cut(batches):
        often = sent.value
        seen: dict[bytes, int] = {}
        for batch in batches:
            rows: list[tuple] = []
            for key, doc_id, raw, found in zip(*(batch.column(i).to_pylist() for i in range(4))):
                h, _, first, last = anchors(np.frombuffer(raw, np.uint8), match, gram)
                # Collided keys may bring windows of another text; what is no anchor here is left out.
                kept = np.isin((first << CODE_BITS) | (last - first), np.array(found, np.int64))
                settled: list[tuple[int, int]] = []
                own: dict[bytes, list[int]] = {}  # a segment may stand many times in one text
                h, first, last = h[kept].astype(np.int64), first[kept], last[kept]
                hot = np.isin(h, often) if len(often) else np.zeros(len(h), bool)

                def send(hash_: int, a: int, part: bytes) -> None:
                    if part in own:
                        own[part].append(a)
                    elif doc_id > seen.get(part, LATE):
                        settled.append((a, a + len(part)))
                    else:
                        own[part] = [hash_, a]

                for hash_, a, end in zip(h[~hot].tolist(), first[~hot].tolist(), (last[~hot] + match).tolist()):
                    send(hash_, a, raw[a:end])
                if hot.any():
                    windows = gram_hashes(np.frombuffer(raw, np.uint8), match).astype(np.int64)
                    for a, end in zip(first[hot].tolist(), (last[hot] + 1).tolist()):
                        for i, hash_ in enumerate(windows[a:end].tolist(), a):
                            send(hash_, i, raw[i:i + match])
                for part, (hash_, *starts) in own.items():
                    seen[part] = doc_id
                    rows.append((hash_, doc_id, key, np.array(starts, np.int64).tobytes(), part))
                if settled:
                    rows.append((key, doc_id, key, np.array([(a << 32) | (b - a) for a, b in runs(settled)], np.int64).tobytes(), b""))
                if len(seen) > REMEMBERED:
                    seen.clear()
                if len(rows) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    joined = texts.join(codes, "key").select("key", "doc_id", F.encode("text", "utf-8").alias("raw"), "codes")
    return joined.mapInArrow(cut, "hash long, doc_id long, key long, starts binary, bytes binary")


def runs(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans, those that touch or overlap as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


class SuffixArray:
    """The suffixes of at least ``match`` bytes of many byte strings, sorted within their groups."""

    def __init__(self, parts: list[bytes], group: np.ndarray, match: int = MATCH):
        sizes = np.array([len(p) for p in parts])
        words = -(-int(sizes.max()) // 8)
        pitch = 16 * words
        # No byte of UTF-8 is 255: all shift up by one, and 0 is the end that sorts first.
        flat = np.frombuffer(b"".join(p.ljust(pitch, b"\xff") for p in parts), np.uint8) + np.uint8(1)
        count = sizes - match + 1
        self.part = np.repeat(np.arange(len(parts)), count)
        self.offset = np.arange(len(self.part)) - np.repeat(np.cumsum(count) - count, count)
        at = self.part * pitch + self.offset
        wide = np.zeros(len(flat), np.uint64)
        for k in range(8):
            wide[:len(flat) - k] |= flat[k:].astype(np.uint64) << np.uint64(56 - 8 * k)
        keys = [wide[at + 8 * k] for k in range(words)]
        owner = group[self.part]
        order = np.lexsort([*reversed(keys), owner])
        self.part, self.offset, at = self.part[order], self.offset[order], at[order]
        self.before = np.where(self.offset > 0, flat[np.maximum(at - 1, 0)].astype(np.int64), -1)
        self.common = self._common([k[order] for k in keys], owner[order], sizes[self.part] - self.offset)

    def _common(self, keys: list[np.ndarray], owner: np.ndarray, left: np.ndarray) -> np.ndarray:
        """Common prefix length of each suffix with the one before it; 0 between groups."""
        n = len(owner)
        out = np.zeros(n, np.int64)
        open_ = np.flatnonzero(owner[1:] == owner[:-1]) + 1
        for key in keys:
            differ = key[open_] ^ key[open_ - 1]
            same = differ == 0
            for k in range(8):
                out[open_[~same]] += ((differ[~same] >> np.uint64(56 - 8 * k)) == 0)
            out[open_[same]] += 8
            open_ = open_[same]
        out[1:] = np.minimum(out[1:], np.minimum(left[1:], left[:-1]))
        return out

    def intervals(self, match: int = MATCH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Common length, first and past-the-last suffix of every interval with different bytes before it."""
        lengths, lows, highs = [], [], []
        common, before = self.common.tolist(), self.before.tolist()
        stack: list[list] = []  # common length, first suffix, byte before all of them or None
        for i in range(1, len(common) + 1):
            here = common[i] if i < len(common) else 0
            low, byte = i - 1, before[i - 1]
            if byte < 0:
                byte = None
            while stack and stack[-1][0] > here:
                length, low, own = stack.pop()
                byte = own if own == byte else None
                if byte is None:
                    lengths.append(length)
                    lows.append(low)
                    highs.append(i)
            if here >= match:
                if stack and stack[-1][0] == here:
                    if stack[-1][2] != byte:
                        stack[-1][2] = None
                else:
                    stack.append([here, low, byte])
            elif stack:
                stack.clear()
        return np.array(lengths, np.int64), np.array(lows, np.int64), np.array(highs, np.int64)


def covered(parts: list[bytes], group: np.ndarray, doc: np.ndarray, match: int = MATCH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which bytes of each part a smaller document of its group repeats: part, start, end of the runs."""
    none = np.empty(0, np.int64)
    if not parts:
        return none, none, none
    array = SuffixArray(parts, group, match)
    length, low, high = array.intervals(match)
    if not len(length):
        return none, none, none
    size = high - low
    which = np.repeat(np.arange(len(size)), size)
    member = np.repeat(low, size) + np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
    docs = doc[array.part[member]]
    least = np.minimum.reduceat(docs, np.cumsum(size) - size)
    hit = docs > least[which]
    part, start = array.part[member[hit]], array.offset[member[hit]]
    width = max(map(len, parts)) + 1
    change = np.zeros(len(parts) * width, np.int64)
    np.add.at(change, part * width + start, 1)
    np.add.at(change, part * width + start + length[which[hit]], -1)
    inside = np.concatenate([[False], np.cumsum(change) > 0])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2] // width, edges[::2] % width, edges[1::2] % width


def repeated(found: DataFrame, match: int = MATCH) -> DataFrame:
    """``key, code``: runs of bytes that a smaller document repeats; a code is start and length."""

    def task(batches):
        for rows in whole_groups(batches):
            h, doc, key = (rows[i].to_numpy(zero_copy_only=False) for i in range(3))
            times_ = pc.binary_length(rows[3]).to_numpy(zero_copy_only=False) // 8
            starts = np.frombuffer(b"".join(rows[3].to_pylist()), np.int64)
            begin = np.cumsum(times_) - times_
            settled = pc.binary_length(rows[4]).to_numpy(zero_copy_only=False) == 0

            def codes(which: np.ndarray, low, size) -> pa.RecordBatch:
                """A run for each place of the rows named: where it begins in the segment, and its size."""
                each = np.repeat(np.arange(len(which)), times_[which])
                at = starts[np.repeat(begin[which], times_[which]) + np.arange(len(each)) - np.repeat(
                    np.cumsum(times_[which]) - times_[which], times_[which])]
                return _codes(key[which][each], ((at + low[each]) << 32) | size[each] if low is not None else at)

            if settled.any():
                yield codes(np.flatnonzero(settled), None, None)
            live = np.flatnonzero(~settled)
            if len(live) < 2:
                continue
            parts = rows[4].take(pa.array(live)).to_pylist()
            # Equal segments are one part; only its smallest document is in question.
            index: dict[tuple[int, bytes], int] = {}
            part = np.array([index.setdefault(x, len(index)) for x in zip(h[live].tolist(), parts)])
            least = np.full(len(index), LATE)
            np.minimum.at(least, part, doc[live])
            late = doc[live] > least[part]
            size = np.array([len(p) for p in parts])
            yield codes(live[late], np.zeros(int(late.sum()), np.int64), size[late])
            group = np.array([k for k, _ in index], np.int64)
            _, inverse, times = np.unique(group, return_inverse=True, return_counts=True)
            multi = np.flatnonzero(times[inverse] > 1)
            names = list(index)
            p, a, b = covered([names[i][1] for i in multi], inverse[multi], least[multi], match)
            if len(p):
                # Back to the rows: all that are their part's smallest document.
                p = multi[p]
                owners = np.flatnonzero(~late)
                owners = owners[np.argsort(part[owners], kind="stable")]
                left, right = (np.searchsorted(part[owners], p, side) for side in ("left", "right"))
                each = np.repeat(np.arange(len(p)), right - left)
                row = owners[np.repeat(left, right - left) + np.arange(len(each)) - np.repeat(np.cumsum(right - left) - (right - left), right - left)]
                yield codes(live[row], a[each], (b - a)[each])

    return found.repartition(partitions(found), "hash").sortWithinPartitions("hash").mapInArrow(task, "key long, code long")


def whole_groups(batches, most: int = SORTED) -> Iterator[list]:
    """Columns of consecutive rows sorted by their first column, about ``most`` bytes at a time, groups whole."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size < most:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        h = table.column(0).to_numpy()
        cut = int(np.searchsorted(h, h[-1], "left"))
        if cut:
            yield [c.combine_chunks() for c in table.slice(0, cut).columns]
        held = table.slice(cut).to_batches()
        size = sum(b.nbytes for b in held)
    if held:
        yield [c.combine_chunks() for c in pa.Table.from_batches(held).columns]


def remove_repeats(docs: DataFrame, match: int = MATCH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """``doc_id, text_bytes, kept, n_removed, n_spans``: the bytes of every document and what stays of them."""
    texts = distinct_texts(docs)
    codes = stored(shared_anchors(texts, match, gram, hot=hot), "anchors")
    free_shuffles(docs.sparkSession)
    spans = stored(repeated(segments(texts, codes, match, gram), match).groupBy("key").agg(F.collect_list("code").alias("codes")), "repeats")
    free_shuffles(docs.sparkSession)

    size = F.octet_length("text")
    rows = named(docs).select("key", "check", "doc_id", size.alias("size"), F.when(size < match, F.col("text")).alias("short"))
    rows = stored(rows.join(texts.select("key", "check", F.col("doc_id").alias("least")), ["key", "check"]), "rows")
    first = rows.filter("doc_id = least").select("key", F.col("check").alias("own_check"), F.col("doc_id").alias("own_id"))
    # By the key alone, which the texts are laid out by; the check is compared after.
    joined = texts.join(first, "key").filter(F.col("check") == F.col("own_check")).join(spans, "key", "left").select(
        F.col("own_id").alias("doc_id"), F.encode("text", "utf-8").alias("raw"), "codes")

    def task(batches):
        names = ["doc_id", "text_bytes", "kept", "n_removed", "n_spans"]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
        for batch in batches:
            out = [(doc_id, len(raw), *without(raw, codes)) for doc_id, raw, codes in zip(*(batch.column(i).to_pylist() for i in range(3)))]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    done = joined.mapInArrow(task, "doc_id long, text_bytes long, kept binary, n_removed long, n_spans long")
    # A copy of a smaller document goes whole, unless it is too short for any window.
    long = F.col("size") >= match
    copies = rows.filter("doc_id > least").select(
        "doc_id", F.col("size").cast("long").alias("text_bytes"), F.when(long, F.unhex(F.lit(""))).otherwise(F.encode("short", "utf-8")).alias("kept"),
        F.when(long, F.col("size")).otherwise(0).cast("long").alias("n_removed"), long.cast("long").alias("n_spans"))
    return done.unionByName(copies).withColumn("doc_id", F.nullif("doc_id", F.lit(LATE)))


def without(raw: bytes, codes: list[int] | None) -> tuple[bytes, int, int]:
    """The bytes outside all spans, the number of bytes inside, and of their maximal runs."""
    if not codes:
        return raw, 0, 0
    gone = runs([(c >> 32, (c >> 32) + (c & 0xFFFFFFFF)) for c in codes])
    out, at = [], 0
    for a, b in gone:
        out.append(raw[at:a])
        at = b
    out.append(raw[at:])
    kept = b"".join(out)
    return kept, len(raw) - len(kept), len(gone)


def window_rows(joined: DataFrame, match: int, gram: int) -> DataFrame:
    """``window, before, key, check, start, reach``: the windows of shared anchors, by their hash.

    ``before`` is the byte ahead of the window, -1 at the start of a text; ``reach`` is where
    the unbroken run of such windows ends, so no repeat from here goes beyond it. The first
    window of a text with copies is always there, and reaches to the text's end.
    """
    names = ["window", "before", "key", "check", "start", "reach"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]

    def task(batches):
        for batch in batches:
            for key, check, raw, found, copies in zip(*(batch.column(i).to_pylist() for i in range(5))):
                data = np.frombuffer(raw, np.uint8)
                if len(data) < match:
                    continue
                _, _, first, last = anchors(data, match, gram)
                kept = np.isin((first << CODE_BITS) | (last - first), np.array(found or [], np.int64))
                inside = np.zeros(len(data) - match + 2, np.int64)
                np.add.at(inside, first[kept], 1)
                np.add.at(inside, last[kept] + 1, -1)
                inside = np.cumsum(inside)[:-1] > 0
                # The next window that is not inside ends the run.
                gap = np.where(inside, len(inside), np.arange(len(inside)))
                reach = np.minimum.accumulate(gap[::-1])[::-1] + match - 1
                if copies > 1:
                    inside[0], reach[0] = True, len(data)
                start = np.flatnonzero(inside)
                window = gram_hashes(data, match).astype(np.int64)
                before = np.where(start > 0, data[np.maximum(start - 1, 0)].astype(np.int64), -1)
                for at in range(0, len(start), 100_000):
                    some = start[at:at + 100_000]
                    columns = window[some], before[at:at + 100_000], np.full(len(some), key), np.full(len(some), check), some, reach[some]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return joined.mapInArrow(task, "window long, before int, key long, check long, start long, reach long")


def suffixes(joined: DataFrame) -> DataFrame:
    """``window, suffix, before, key, check, start, whole`` of the places named, as far as they reach."""
    names = ["window", "suffix", "before", "key", "check", "start", "whole"]
    kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]

    def task(batches):
        for batch in batches:
            rows, size = [], 0
            for key, check, raw, copies, places in zip(*(batch.column(i).to_pylist() for i in range(5))):
                for place in places:
                    start, reach = place["start"], place["reach"]
                    rows.append((place["window"], raw[start:reach], place["before"], key, check, start, copies > 1 and start == 0))
                    size += reach - start
                    if size > CHUNK:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                        rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return joined.mapInArrow(task, "window long, suffix binary, before int, key long, check long, start long, whole boolean")


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    differ = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return int(differ.argmax())


def maximal(rows: Iterator[tuple], match: int) -> Iterator[tuple[bytes, list[tuple[int, int, int]]]]:
    """Every maximal repeat and its places, from suffixes sorted within windows.

    A stack holds the open intervals; a group is not held but for its places. A text with
    copies repeats as a whole, also where no interval is as long.
    """
    places: list[tuple[int, int, int]] = []
    stack: list[list] = []  # common length, first place, byte before all of them or None
    last: tuple | None = None
    shared = 0  # of the last suffix with the one before it

    def close(here: int):
        """The intervals that end with the last suffix, when the next one shares ``here`` bytes with it."""
        window, suffix, before, _, whole = last
        byte, low = before if before >= 0 else None, len(places) - 1
        if whole and max(shared, here) < len(suffix):
            yield suffix, places[-1:]
        while stack and stack[-1][0] > here:
            length, low, own = stack.pop()
            byte = own if own == byte else None
            if byte is None:
                yield suffix[:length], places[low:]
        if here >= match:
            if stack and stack[-1][0] == here:
                if stack[-1][2] != byte:
                    stack[-1][2] = None
            else:
                stack.append([here, low, byte])

    for row in rows:
        if last is not None:
            here = common_prefix(last[1], row[1]) if last[0] == row[0] else 0
            here = here if here >= match else 0
            yield from close(here)
            if last[0] != row[0]:
                places.clear()
            shared = here
        last = row
        places.append(row[3])
    if last is not None:
        yield from close(0)


def repeat_groups(docs: DataFrame, match: int = MATCH, gram: int = GRAM) -> DataFrame:
    """``bytes, doc_ids, starts``: every maximal repeat of at least ``match`` bytes, with all of its occurrences.

    A string is maximal if its occurrences are not all preceded, nor all followed, by one
    byte; the ends of a text differ from every byte and from each other. Occurrences may be
    in one document, or in rows with equal texts. The places of one window meet in one task
    only if bytes before them differ, since else no maximal repeat begins there; Spark sorts
    their suffixes.
    """
    texts = distinct_texts(docs)
    members = stored(named(docs).select("key", "check", "doc_id"), "rows")
    copies = members.groupBy("key", "check").agg(F.count("*").alias("copies"))
    codes = stored(shared_anchors(texts, match, gram, within=True), "anchors")
    held = texts.join(copies, ["key", "check"]).select("key", "check", F.encode("text", "utf-8").alias("raw"), "copies")
    joined = held.join(codes, "key", "left").filter("codes IS NOT NULL OR copies > 1").select("key", "check", "raw", "codes", "copies")
    windows = stored(window_rows(joined, match, gram), "windows")
    # Copies count as occurrences, but at the start of a text only they differ in what is before.
    begins = windows.groupBy("window").agg(F.count("*").alias("n"), F.min("before").alias("least"), F.max("before").alias("most")) \
        .filter("least < 0 OR (n > 1 AND least <> most)").select("window")
    places = windows.join(begins, "window").groupBy("key", "check").agg(
        F.collect_list(F.struct("window", "before", "start", "reach")).alias("places"))
    found = suffixes(held.join(places, ["key", "check"]).select("key", "check", "raw", "copies", "places"))

    def task(batches):
        def rows():
            for batch in batches:
                for window, suffix, before, key, check, start, whole in zip(*(batch.column(i).to_pylist() for i in range(7))):
                    yield window, suffix, before, (key, check, start), whole

        ids = row_ids()
        for part, at in maximal(rows(), match):
            yield pa.RecordBatch.from_arrays(
                [pa.array([next(ids)], pa.int64()), pa.array([part], pa.binary()), *(pa.array([list(c)], pa.list_(pa.int64())) for c in zip(*at))],
                names=["id", "bytes", "keys", "checks", "starts"])

    groups = stored(found.repartition(partitions(docs), "window").sortWithinPartitions("window", "suffix", "key", "check", "start").mapInArrow(
        task, "id long, bytes binary, keys array<long>, checks array<long>, starts array<long>"), "groups")
    each = groups.select("id", F.explode(F.arrays_zip("keys", "checks", "starts")).alias("at")).select(
        "id", F.col("at.keys").alias("key"), F.col("at.checks").alias("check"), F.col("at.starts").alias("start"))
    each = each.join(members, ["key", "check"]).groupBy("id").agg(F.sort_array(F.collect_list(F.struct("doc_id", "start"))).alias("at"))
    return groups.join(each, "id").select(
        "bytes", F.transform("at", lambda x: F.nullif(x["doc_id"], F.lit(LATE))).alias("doc_ids"), F.col("at.start").alias("starts"))
