"""Pages written as WARC records, and archives read back in parallel by chains of record boundaries.

``write`` makes one record per page. Of pages with equal payloads one is a response, the
others are revisits that refer to it and hold no payload. Records go out as they are
through Spark's text writer, whose line end is the blank line that closes a record.

``read`` takes archives of any size in the byte ranges that Spark cuts them into. A task
looks for the magic after a blank line and gives, for every candidate with a readable
header, the place of its successor. A payload may hold the magic, too; such candidates are
records only to the eye. What counts is what the chain from the start of its file reaches.
Within a range a task follows the chains itself, so each candidate points to a place beyond
its range. Pointer jumping over these, doubled in each round, finds the places where the
chain enters a range; so there are about as many rounds as the logarithm of a file's
ranges. Then the ranges are read again from those places on, and no payload is shuffled.

A null payload is an empty one. A null page id gives a record without one, and is smaller
than any other; rows with the largest id of equal payloads are all responses, if the id
repeats. A null url is left out. An empty table gives an empty archive; an empty folder, no
records. A chain that breaks, as in a damaged file, ends there: the records before stay.
Columns other than those named are left out, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.arrow import stored

# The format's magic, its blank line, and the alphabets of base 32.
MAGIC = b"WARC/1."
BLANK = b"\r\n\r\n"
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = "file string, offset long, headers map<string,string>, http map<string,string>, payload binary"
_FIELDS = [pa.string(), pa.int64(), pa.map_(pa.string(), pa.string()), pa.map_(pa.string(), pa.string()), pa.binary()]
_NAMES = ["file", "offset", "headers", "http", "payload"]
# Payload of one outgoing batch.
OUT_BYTES = 8_000_000


# -- write


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of bytes in upper-case base 32: eight digits for every ten of the hex form."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), DIGITS, BASE32)


def _lines(*lines: Column) -> Column:
    """Header lines; null ones are left out."""
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"))


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value)


def record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def page_of(record: Column) -> Column:
    """The page id in a record id; null if there is none."""
    return F.nullif(F.regexp_extract(record, "^<urn:x-page:(-?[0-9]*)>$", 1), F.lit("")).cast("long")


def originals(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``digest, n_bytes, original``: the largest page id of each payload that several rows hold."""
    return pages.filter(F.col("n_bytes") >= least_bytes).groupBy("digest", "n_bytes").agg(
        F.max("page_id").alias("original"), F.count("*").alias("n")).filter("n > 1").drop("n")


def records(pages: DataFrame, least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """``value``: each page as the bytes of its record, without the closing blank line.

    Repeated payloads are found on their digests; that table is written first, so that
    Spark knows its size when it chooses how to join it to the pages.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    named = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    named = named.withColumns({"digest": base32_sha1(F.col("payload")), "n_bytes": F.octet_length("payload").cast("long")})
    repeated = stored(originals(named.drop("payload"), least_bytes), "originals")
    rows = named.join(repeated, ["digest", "n_bytes"], "left")
    again = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    http = _lines(F.lit("HTTP/1.1 200 OK"), F.lit("Content-Type: text/html; charset=utf-8"), _line("Content-Length", F.col("n_bytes").cast("string")))
    block = F.concat(F.encode(http, "UTF-8"), F.when(again, F.lit(b"")).otherwise(F.col("payload")))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    head = _lines(
        F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.when(again, "revisit").otherwise("response")),
        _line("WARC-Record-ID", record_id(F.col("page_id"))), _line("WARC-Date", F.lit(date)), _line("WARC-Target-URI", url),
        F.when(again, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.when(again, _line("WARC-Refers-To", record_id(F.col("original")))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.lit("Content-Type: application/http; msgtype=response"), _line("Content-Length", F.octet_length("block").cast("string")))
    # A cast between binary and string keeps the bytes, whatever they are.
    return rows.withColumn("block", block).select(F.concat(F.encode(head, "UTF-8"), F.col("block")).cast("string").alias("value"))


def write(pages: DataFrame, folder: str, least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write ``page_id, url, html`` rows as archives, one file per task."""
    records(pages, least_bytes, date).write.option("lineSep", BLANK.decode()).text(folder)


# -- read


def parsed(head: bytes) -> dict[str, str]:
    """Header lines by lower-case name; a line that starts with a blank goes on with the one before."""
    out: dict[str, str] = {}
    last = None
    for line in head.split(b"\r\n"):
        if line[:1] in (b" ", b"\t") and last:
            out[last] += " " + line.strip().decode("utf-8", "replace")
            continue
        name, colon, value = line.partition(b":")
        if colon:
            last = name.strip().lower().decode("utf-8", "replace")
            out[last] = value.strip().decode("utf-8", "replace")
    return out


def block_length(record: bytes) -> tuple[int, int] | None:
    """Where the block of a record starts, and its length; null if the header cannot be read."""
    if record[:7] != MAGIC or record[7:10] not in (b"0\r\n", b"1\r\n"):
        return None
    end = record.find(BLANK)
    if end < 0:
        return None
    length = parsed(record[:end]).get("content-length", "")
    return (end + len(BLANK), int(length)) if length.isascii() and length.isdigit() else None


def pieces(spark: SparkSession, folder: str) -> DataFrame:
    """``file, part, turn, value``: what lies between the magics of each byte range, in turn."""
    rows = spark.read.option("lineSep", (BLANK + MAGIC).decode()).text(folder)
    return rows.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("part"),
        F.monotonically_increasing_id().alias("turn"), F.col("value").cast("binary").alias("value"))


def runs(batches, columns: int) -> Iterator[tuple[bool, list, bytes]]:
    """Rows as ``first of its range, keys, bytes``; the bytes are the last column."""
    last = None
    for batch in batches:
        keys = list(zip(*(batch.column(i).to_pylist() for i in range(columns - 1))))
        for key, value in zip(keys, batch.column(columns - 1)):
            yield key[:2] != last, list(key), value.as_py() or b""
            last = key[:2]


def whole_piece(value: bytes, at_start: bool) -> bytes:
    """The bytes of the file from one magic to the next, which the reader took for line ends."""
    return (value if at_start else MAGIC + value) + BLANK


def candidates(rows: DataFrame) -> DataFrame:
    """``file, part, at, next, exit, total``: places relative to the range, one row per candidate and one per range.

    ``next`` is the successor, ``exit`` the first place beyond the range that its chain
    comes to; null if it breaks before. ``total`` is the length of the range as read.
    """
    names = ["file", "part", "at", "next", "exit", "total"]

    def closed(key, found: dict[int, int], size: int):
        edge = size - len(MAGIC)
        exits: dict[int, int | None] = {}
        for at in sorted(found, reverse=True):
            exits[at] = found[at] if found[at] >= edge else exits.get(found[at])
        rows = [(*key, at, found[at], out, None) for at, out in exits.items()] + [(*key, None, None, None, size)]
        kinds = [pa.string(), *[pa.int64()] * 5]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def task(batches):
        key, found, size = None, {}, 0
        for first, (file, part), value in runs(batches, 3):
            if first:
                if key:
                    yield closed(key, found, size)
                key, found, size = (file, part), {}, 0
            start = part == 0 and size == 0
            at = 0 if start else size - len(MAGIC)
            length = block_length(whole_piece(value, start))
            if length:
                found[at] = at + sum(length) + len(BLANK)
            size += len(value) + len(BLANK) + len(MAGIC)
        if key:
            yield closed(key, found, size)

    # A range is read by one task, in order.
    return rows.select("file", "part", "value").mapInArrow(task, "file string, part long, at long, next long, exit long, total long")


def reached(starts: DataFrame, jumps: DataFrame) -> DataFrame:
    """``file, at``: all places on the chains from the starts of files; ``jumps`` are ``file, at, to``.

    Each round doubles the length of the jumps and takes every place reached so far one jump on.
    """
    found = starts
    while True:
        on = found.join(jumps, ["file", "at"]).select("file", F.col("to").alias("at"))
        found = stored(found.unionByName(on).distinct(), "reached")
        then = jumps.select("file", F.col("at").alias("to"), F.col("to").alias("then"))
        jumps = stored(jumps.join(then, ["file", "to"]).select("file", "at", F.col("then").alias("to")), "jumps")
        if jumps.isEmpty():
            return found


def ranges(found: DataFrame) -> DataFrame:
    """``file, part, base, entry``: where each range starts, and the first record at or after its start.

    ``found`` are the candidates. Nulls in ``entry`` mean that the chain does not come so far.
    """
    before = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = stored(found.filter("total IS NOT NULL").select(
        "file", "part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base")), "bases")
    placed = found.filter("total IS NULL AND exit IS NOT NULL").join(bases, ["file", "part"]).select(
        "file", (F.col("base") + F.col("at")).alias("at"), (F.col("base") + F.col("exit")).alias("to"))
    # Only places that something leads to matter: the starts, and what lies beyond a range.
    led = placed.select("file", F.col("to").alias("at")).distinct()
    jumps = stored(placed.filter("at = 0").unionByName(placed.filter("at > 0").join(led, ["file", "at"], "left_semi")), "jumps")
    marks = bases.select("file", "part", "base", F.greatest(F.col("base") - len(MAGIC), F.lit(0)).alias("at"), F.lit(None).cast("long").alias("entry"))
    starts = bases.filter("part = 0").select("file", F.lit(0).cast("long").alias("at"))
    none = F.lit(None).cast("long")
    entries = reached(starts, jumps).select("file", none.alias("part"), none.alias("base"), "at", F.col("at").alias("entry"))
    onward = Window.partitionBy("file").orderBy(F.col("at").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return marks.unionByName(entries).withColumn("entry", F.min("entry").over(onward)).filter("part IS NOT NULL").drop("at")


def _record(file: str, offset: int, raw: bytes) -> tuple:
    start, length = block_length(raw)
    block = raw[start:start + length]
    head, blank, payload = block.partition(BLANK)
    return file, offset, list(parsed(raw[:start]).items()), list(parsed(head).items()), payload if blank else b""


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _FIELDS)], names=_NAMES)


def walk(batches) -> Iterator[tuple[str, str, int, int, bytes]]:
    """Follows the chain through sorted ranges; gives ``kind, file, offset, end, bytes``.

    A ``whole`` record comes at once. A record whose pieces lie in several ranges comes as
    ``part`` rows of one ``end``.
    """
    held: tuple | None = None  # the record that is open: file, offset, end, its pieces

    def close():
        file, offset, end, parts = held
        raw = b"".join(parts)
        if sum(block_length(raw)) <= len(raw):
            yield "whole", file, offset, end, raw
        else:
            yield "part", file, offset, end, raw

    size = 0
    for first, (file, part, base, entry, _), value in runs(batches, 6):
        if first:
            if held:
                yield from close()
            held, size, due = None, 0, entry
        start = part == 0 and size == 0
        at = 0 if start else base + size - len(MAGIC)
        raw = whole_piece(value, start)
        size += len(value) + len(BLANK) + len(MAGIC)
        if entry is None:
            continue
        if at < entry:
            yield "part", file, at, entry, raw
        elif at == due:
            if held:
                yield from close()
            length = block_length(raw)
            due = at + sum(length) + len(BLANK) if length else None
            held = (file, at, due, [raw]) if length else None
        elif held and due is not None and at < due:
            held[3].append(raw)
    if held:
        yield from close()


def read(spark: SparkSession, folder: str) -> DataFrame:
    """``file, offset, headers, http, payload`` of every record on the chain of its file.

    ``headers`` and ``http`` map lower-case names to values; the payload is the block
    without the head of its HTTP message.
    """
    rows = pieces(spark, folder)
    found = stored(candidates(rows), "candidates")
    spans = stored(ranges(found), "ranges")
    # The ranges' table has one row per range; how it is joined is Spark's choice, so the order is made anew.
    sorted_rows = rows.join(spans, ["file", "part"]).select("file", "part", "base", "entry", "turn", "value").sortWithinPartitions("file", "part", "turn")

    def whole(batches):
        out, size = [], 0
        for kind, file, offset, _, raw in walk(batches):
            if kind == "whole":
                out.append(_record(file, offset, raw))
                size += len(raw)
                if size > OUT_BYTES:
                    yield _batch(out)
                    out, size = [], 0
        if out:
            yield _batch(out)

    records_ = sorted_rows.mapInArrow(whole, RECORD)
    # Records with the magic inside may lie in several ranges; their pieces are put together.
    split = spans.filter(F.col("entry") > F.greatest(F.col("base") - len(MAGIC), F.lit(0))).select("file").distinct()
    if split.isEmpty():
        return records_

    def parts(batches):
        for kind, *row in walk(batches):
            if kind == "part":
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], k) for v, k in zip(row, (pa.string(), pa.int64(), pa.int64(), pa.binary()))], names=["file", "offset", "end", "raw"])

    def assembled(batches):
        for batch in batches:
            out = []
            for file, found_ in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = b"".join(p["raw"] for p in found_)
                length = block_length(raw)
                if length and sum(length) <= len(raw):
                    out.append(_record(file, found_[0]["offset"], raw))
            if out:
                yield _batch(out)

    torn = sorted_rows.join(split, "file", "left_semi").sortWithinPartitions("file", "part", "turn").mapInArrow(
        parts, "file string, offset long, end long, raw binary")
    joined = torn.groupBy("file", "end").agg(F.sort_array(F.collect_list(F.struct("offset", "raw"))).alias("parts"))
    return records_.unionByName(joined.select("file", "parts").mapInArrow(assembled, RECORD))


def summary(read_back: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of records that ``read`` gives.

    Size and digest of a response come from its payload, those of a revisit from its headers.
    """
    head = F.col("headers")
    full = head["warc-type"] != "revisit"
    return read_back.select(
        page_of(head["warc-record-id"]).alias("page_id"),
        F.when(full, F.octet_length("payload").cast("long")).otherwise(F.col("http")["content-length"].cast("long")).alias("payload_bytes"),
        F.when(full, base32_sha1(F.col("payload"))).otherwise(F.substring_index(head["warc-payload-digest"], ":", -1)).alias("payload_digest"),
        head["warc-type"].alias("record_type"), page_of(head["warc-refers-to"]).alias("refers_to"))
