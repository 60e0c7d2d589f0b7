"""Sets of word shingles as sorted 64-bit hashes, computed over the bytes of many texts at once.

A-Z count as lower case; words are runs of bytes other than ASCII white space. A text with
fewer words than a shingle takes has its whole sequence as its only one; a text without
words has the empty set.
"""

from __future__ import annotations

import numpy as np

WIDTH = 5
# Bytes whose powers are held at once.
SPAN = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240607))
LETTER = _rng.integers(0, 1 << 64, 256, dtype=np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)
STEP = np.uint64(0xD6E8FEB86659FD93)


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * STEP
    h = h ^ (h >> np.uint64(29))
    h = h * BASE
    return h ^ (h >> np.uint64(32))


def _powers(of: int, count: int) -> np.ndarray:
    out = np.full(count, of, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_inverse = pow(int(BASE), -1, 1 << 64)
_cache: dict[str, np.ndarray] = {}


def _tables(count: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_cache.get("up", ())) < count:
        size = max(count, SPAN)
        _cache["up"], _cache["down"] = _powers(int(BASE), size), _powers(_inverse, size)
    return _cache["up"][:count], _cache["down"][:count]


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word of lower-cased bytes."""
    data = np.frombuffer(raw, np.uint8)
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    inside = np.empty(len(data) + 2, bool)
    inside[0] = inside[-1] = False
    inside[1:-1] = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = starts[at]
        last = max(at + 1, int(np.searchsorted(ends, base + SPAN, "right")))
        part = data[base:ends[last - 1]]
        up, down = _tables(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(LETTER[part] * up[:-1], out=sums[1:])
        s, e = starts[at:last] - base, ends[at:last] - base
        out[at:last] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)
        at = last
    return starts, mixed(out)


def shingle_sets(texts: list[str | None], width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    raws = [(t or "").encode().lower() for t in texts]
    starts, h = word_hashes(b"\n".join(raws))
    bounds = np.cumsum([0] + [len(r) + 1 for r in raws])
    cuts = np.searchsorted(starts, bounds)
    joined = h[:max(0, len(h) - width + 1)].copy()
    for k in range(1, width):
        joined = mixed(joined * STEP + h[k:k + len(joined)])
    out = []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(joined[a:b - width + 1]))
        elif b > a:
            whole = np.array([b - a], np.uint64)
            for k in range(a, b):
                whole = mixed(whole * STEP + h[k])
            out.append(whole)
        else:
            out.append(np.empty(0, np.uint64))
    return out


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive bytes."""
    n = len(data) - size + 1
    out = np.empty(n, np.uint64)
    for at in range(0, n, SPAN):
        part = data[at:at + SPAN + size - 1]
        up, down = _tables(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(LETTER[part] * up[:-1], out=sums[1:])
        some = len(part) - size + 1
        out[at:at + some] = (sums[size:] - sums[:some]) * down[:some]
    return mixed(out)
