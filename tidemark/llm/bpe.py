"""Byte-level BPE from a rank file, over Arrow batches.

Every byte is shown to the ``tokenizers`` library as one printable character, so its
character offsets are byte offsets; decoding reverses the table. A token may hold a part
of a character only: ``char_offsets`` then covers the whole character, and ``decode``
joins the bytes before it reads them as text.

A null or empty text has no ids and decodes to the empty text. Rows with equal or null
ids are coded each on its own. An empty table gives an empty result. Columns other than
``doc_id`` and ``text`` are left out, whatever they are called.
"""

from __future__ import annotations

import base64
import re
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer, models

from tidemark.llm.arrow import per_document

# Distinct words, and pre-tokens, that a worker has newly met before it forgets those that it
# has not met since the last time; changes no result.
REMEMBERED = 100_000
# White space before a space: there the pre-tokens depend on more than one word.
SPACES = re.compile(r"\s ")


def byte_characters() -> list[str]:
    """One printable character per byte: itself if printable Latin-1, else the next one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in shown}
    for b in range(256):
        table.setdefault(b, chr(256 + len(table) - len(shown)))
    return [table[b] for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def token_table(path: str) -> list[bytes]:
    """The bytes of every id: all that decoding needs."""
    ranks = read_ranks(path)
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def joined(table: list[bytes], ids: bytes) -> bytes:
    return b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()])


class Coder:
    """The ids of pre-tokens, by the tokenizers library, and the bytes of ids."""

    def __init__(self, path: str, pattern: str):
        ranks = read_ranks(path)
        chars = byte_characters()
        self.pattern = regex.compile(pattern)
        self.shown = {b: chars[b] for b in range(256)}
        self.token_bytes = token_table(path)
        text = {}
        for token in ranks:
            text[token] = "".join(chars[b] for b in token)
        # Any two tokens that make up a third may merge; the third one's rank is the order.
        merges = [
            (text[token[:cut]], text[token[cut:]])
            for token in self.token_bytes if len(token) > 1
            for cut in range(1, len(token)) if token[:cut] in ranks and token[cut:] in ranks
        ]
        self.model = Tokenizer(models.BPE({t: ranks[b] for b, t in text.items()}, merges))
        self.widths = np.array([len(t) for t in self.token_bytes], np.int64)
        self.space = chars[0x20]
        self.known, self.known_before = {}, {}
        self.spaced, self.spaced_before = {}, {}

    @staticmethod
    def write(*ids: int) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode_piece(self, token: str) -> bytes:
        """The ids of one pre-token as little-endian unsigned 32-bit integers."""
        if token.isascii() and token.isprintable():
            shown = token.replace(" ", self.space)  # all other characters show themselves
        else:
            shown = token.encode().decode("latin-1").translate(self.shown)
        return self.write(*self.model.encode(shown, None, False, False).ids)

    def piece(self, token: str) -> bytes:
        ids = self.known_before.get(token) or self.encode_piece(token)
        if len(self.known) >= REMEMBERED // 2:
            self.known, self.known_before = {}, self.known
        self.known[token] = ids
        return ids

    def pieces(self, text: str) -> bytes:
        known, piece = self.known, self.piece
        return b"".join([known.get(t) or piece(t) for t in self.pattern.findall(text)])

    def spaced_word(self, word: str) -> bytes:
        ids = self.spaced_before.get(word) or self.pieces(" " + word)
        if len(self.spaced) >= REMEMBERED:
            self.spaced, self.spaced_before = {}, self.spaced
        self.spaced[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The ids of a text. A space after another character than white space always begins
        a pre-token, and none reaches across it: each word stands for itself with its space.
        """
        if SPACES.search(text) or not text or text[0] == " ":
            return self.pieces(text)
        first, *rest = text.split(" ")
        known, word = self.spaced, self.spaced_word
        return self.pieces(first) + b"".join([known.get(w) or word(w) for w in rest])

    def decode(self, ids: bytes) -> bytes:
        return joined(self.token_bytes, ids)

    def offsets(self, ids: bytes) -> np.ndarray:
        """Start byte of each token and, last, the end of the text."""
        return np.concatenate([[0], np.cumsum(self.widths[np.frombuffer(ids, "<u4")])])

    def char_spans(self, text: str, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last code point (exclusive) of each token, given its byte offsets; parts of one character share its span."""
        raw = np.frombuffer(text.encode(), np.uint8)
        starts = np.cumsum((raw & 0xC0) != 0x80)
        return starts[at[:-1]] - 1, starts[at[1:] - 1]

    def char_offsets(self, text: str, ids: bytes) -> list[tuple[int, int]]:
        """Code-point span of each token."""
        low, high = self.char_spans(text, self.offsets(ids))
        return list(zip(low.tolist(), high.tolist()))


@lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> Coder:
    return Coder(path, pattern)


@lru_cache(maxsize=2)
def decoder(path: str) -> list[bytes]:
    return token_table(path)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids``: ids as little-endian unsigned 32-bit integers in one binary."""

    def work(ids, texts):
        bpe = coder(path, pattern)
        out = [bpe.encode(t or "") for t in texts]
        return ids, [len(x) // 4 for x in out], out

    return per_document(docs, work, "doc_id long, n_tokens long, ids binary")


def encode_with_offsets(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``encode`` with the place of every token: ``doc_id, n_tokens, ids, byte_offsets, char_starts, char_ends``.

    ``byte_offsets`` are the first byte of each token and, last, the length of the text; the
    spans count code points, and a token that holds a part of a character covers all of it.
    """

    def work(ids, texts):
        bpe = coder(path, pattern)
        out = [bpe.encode(t or "") for t in texts]
        at = [bpe.offsets(x) for x in out]
        spans = [bpe.char_spans(t or "", a) for t, a in zip(texts, at)]
        return ids, [len(x) // 4 for x in out], out, at, [low for low, _ in spans], [high for _, high in spans]

    return per_document(
        docs, work, "doc_id long, n_tokens long, ids binary, byte_offsets array<long>, char_starts array<long>, char_ends array<long>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded``: the bytes of the ids.

    The workers that decode hold the bytes of the tokens only, not the model that encodes.
    """

    def task(batches):
        for batch in batches:
            table = decoder(path)
            plain = pa.array([joined(table, x or b"") for x in batch.column(2).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, plain], names=["doc_id", "n_tokens", "ids", "decoded"])

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(
        task, "doc_id long, n_tokens long, ids binary, decoded binary")
