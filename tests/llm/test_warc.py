import base64
import hashlib
import random
from pathlib import Path

import pytest

from tidemark.llm import warc

FAKE = ("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:666>\r\nContent-Type: application/http\r\nContent-Length: 40\r\n\r\n"
        "HTTP/1.1 200 OK\r\nContent-Length: 0\r\n\r\nxx\r\n\r\n")


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def plain(pages):
    payloads = [(i, (h or "").encode()) for i, _, h in pages]
    top = {}
    for i, p in payloads:
        top[p] = max(top.get(p, -10**9), -10**9 if i is None else i)
    many = {p for p in top if sum(q == p for _, q in payloads) > 1 and top[p] > -10**9}
    return sorted(((i, len(p), digest(p), "revisit" if p in many and i != top[p] else "response",
                    top[p] if p in many and i != top[p] else None) for i, p in payloads), key=str)


def sequential(raw):
    """The records of one file, read from its start."""
    at, out = 0, []
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        head = dict(line.split(b": ", 1) for line in raw[at:end].split(b"\r\n")[1:])
        stop = end + 4 + int(head[b"Content-Length"])
        assert raw[stop:stop + 4] == b"\r\n\r\n"
        out.append((at, head[b"WARC-Record-ID"].decode(), raw[end + 4:stop].split(b"\r\n\r\n", 1)[1]))
        at = stop + 4
    return out


def awkward():
    rng = random.Random(5)
    some = [(i, f"http://h/{i}", f"<p>{rng.randrange(40)} {'é' * rng.randrange(300)}") for i in range(150)]
    return some + [
        (1000, None, None), (1001, "http://a/\r\nWARC/1.1", ""), (1002, "u", FAKE), (1003, "u", "\r\n\r\n" + FAKE * 40 + "tail"), (1004, "u", "WARC/1.1\r\n"),
        (1005, "u", "ends\r\n"), (1006, "u", "ends\r\n\r\n"), (1007, "u", "\r\n\r\n\r\nWARC/1.0\r\nContent-Length: 5\r\n\r\n" * 200), (None, "u", "no id"), (None, "u", "no id"),
        (None, "u", "<p>copy"), (1008, "u", "<p>copy"), (1009, "u", "<p>copy"), (1009, "u", "<p>copy"), (-4, "u", "x" * 50_000), (1010, "u", FAKE[:60])]


SCHEMA = "page_id long, url string, html string, payload string, digest long, original long, file long, value long"


@pytest.mark.parametrize("range_bytes", [1 << 20, 700])
def test_round_trip(spark, tmp_path, range_bytes):
    pages = awkward()
    df = spark.createDataFrame([(*p, "x", 1, 1, 1, 1) for p in pages], SCHEMA)
    folder = str(tmp_path / "archive")
    warc.write(df.coalesce(3), folder)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(range_bytes))
    try:
        back = warc.read(spark, folder)
        found = back.select("file", "offset", "headers", "payload").collect()
        got = warc.summary(back).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((tuple(r) for r in got), key=str) == plain(pages)
    want = {(f.name, *r) for f in Path(folder).glob("part-*") for r in sequential(f.read_bytes())}
    assert {(r.file.rsplit("/", 1)[1], r.offset, r.headers["warc-record-id"], bytes(r.payload)) for r in found} == want and len(found) == len(pages)


def test_empty_table_and_other_types(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write(none, str(tmp_path / "none"))
    assert warc.read(spark, str(tmp_path / "none")).count() == 0
    raw = spark.createDataFrame([(1, "u", bytearray(b"\xff\x00\xfe")), (2, "u", None)], "page_id int, url string, html binary")
    warc.write(raw, str(tmp_path / "raw"))
    assert sorted(bytes(r.payload) for r in warc.read(spark, str(tmp_path / "raw")).collect()) == [b"", b"\xff\x00\xfe"]


def test_least_bytes_leaves_small_payloads_alone(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    warc.write(df, str(tmp_path / "w"), least_bytes=3)
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.summary(warc.read(spark, str(tmp_path / "w"))).collect()}
    assert got == {1: ("response", None), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None)}


def test_broken_chain_ends_there(spark, tmp_path):
    df = spark.createDataFrame([(i, "u", f"page {i}") for i in range(5)], "page_id long, url string, html string").coalesce(1)
    warc.write(df, str(tmp_path / "w"))
    raw = next((tmp_path / "w").glob("part-*")).read_bytes()
    cut = raw.replace(b"page 2", b"page 2 is longer than its header says")
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "a.warc").write_bytes(cut)
    (tmp_path / "broken" / "b.warc").write_bytes(raw[:-20])
    (tmp_path / "broken" / "c.txt").write_bytes(b"not an archive\r\n\r\nWARC/1.1\r\nContent-Length: 0\r\n\r\n\r\n\r\n")
    got = [(r.file.rsplit("/", 1)[1], warc_id) for r in warc.read(spark, str(tmp_path / "broken")).collect() for warc_id in [r.headers["warc-record-id"]]]
    assert sorted(got) == [("a.warc", f"<urn:x-page:{i}>") for i in range(3)] + [("b.warc", f"<urn:x-page:{i}>") for i in range(4)]


def test_headers_with_folded_lines():
    assert warc.parsed(b"WARC/1.0\r\nA: b\r\n c\r\nD:e") == {"a": "b c", "d": "e"}
    assert warc.block_length(b"WARC/1.0\r\nContent-Length: x\r\n\r\n") is None
    assert warc.block_length(b"WARC/2.0\r\nContent-Length: 1\r\n\r\n") is None
