"""Words of Arrow text columns as 64-bit hashes, computed on the bytes without a Python object per word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
_random = np.random.default_rng(0x5EED)
BYTES = _random.integers(0, 1 << 64, 256, np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes that end a word of letters and digits; bytes of longer characters count as letters.
MARKS = np.ones(256, bool)
MARKS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
_powers: dict[str, np.ndarray] = {}


def powers(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        have = np.full(n, base, np.uint64)
        have[0] = 1
        _powers[name] = have = np.multiply.accumulate(have)
    return have


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the bounds of its rows in them; null rows are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        import pyarrow.compute as pc

        texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    if len(texts) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def spans(data: np.ndarray, bounds: np.ndarray, separators: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word, and the bounds of each row's words among them."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    out = separators[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = out[:-1]
    edge[bounds] = True
    begins = np.flatnonzero(~out & edge[:-1])
    edge[1:-1] = out[1:]
    edge[bounds] = True
    ends = np.flatnonzero(~out & edge[1:]) + 1
    return begins, ends, np.searchsorted(begins, bounds)


def span_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
    """A hash of the lower-cased (A-Z) bytes of every span; spans may overlap but begin in order."""
    out = np.empty(len(begins), np.uint64)
    values = BYTES[LOWER]
    i = 0
    while i < len(begins):
        j = max(i + 1, int(np.searchsorted(begins, begins[i] + BLOCK)))
        first, last = int(begins[i]), int(ends[i:j].max())
        n = last - first
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values[data[first:last]] * powers("base", BASE, max(n, BLOCK))[:n], out=sums[1:])
        b, e = begins[i:j] - first, ends[i:j] - first
        out[i:j] = (sums[e] - sums[b]) * powers("inverse", INVERSE, max(n, BLOCK))[b] + (e - b).astype(np.uint64)
        i = j
    return mix(out ^ np.uint64(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))


def word_hashes(texts: pa.Array, separators: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a column and the bounds of each row's words."""
    data, bounds = flat(texts)
    begins, ends, rows = spans(data, bounds, separators)
    return span_hashes(data, begins, ends), rows


def chained(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` neighbours."""
    length = max(0, len(hashes) - n + 1)
    acc = hashes[:length].copy()
    for k in range(1, n):
        acc ^= acc >> np.uint64(29)
        acc *= np.uint64(0xBF58476D1CE4E5B9)
        acc += hashes[k : k + length]
    return mix(acc)


def shingles(texts: pa.Array, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-word shingles of every row, ascending, and their bounds; shorter rows are one shingle."""
    hashes, rows = word_hashes(texts)
    runs = chained(hashes, n)
    parts, bounds = [], np.zeros(len(rows), np.int64)
    for d in range(len(rows) - 1):
        a, b = rows[d], rows[d + 1]
        if b - a >= n:
            part = np.unique(runs[a : b - n + 1])
        elif b > a:
            part = chained(hashes[a:b], int(b - a)) + np.uint64(b - a)
        else:
            part = hashes[:0]
        parts.append(part)
        bounds[d + 1] = bounds[d] + len(part)
    return (np.concatenate(parts) if parts else hashes[:0]), bounds
