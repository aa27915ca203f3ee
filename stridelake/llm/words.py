"""Whitespace-separated words of many texts at once, in numpy.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D, which equals the
pattern [^\\x20\\x09-\\x0D]+ on code points because these bytes never occur inside
a longer UTF-8 sequence.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

LONG = 256
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: tuple[np.ndarray, np.ndarray] | None = None


def buffers(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the len+1 offsets between them; null counts as empty."""
    values = values.cast(pa.large_binary()).fill_null(b"")
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    data = values.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and how many words each text has."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    inside = ~SPACES[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] |= inside[edges]
    last[edges - 1] |= inside[edges - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.diff(np.searchsorted(starts, offsets))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (finaliser of a public shift-multiply generator)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if _powers is None or len(_powers[0]) < n:
        n = max(n, 1 << 20)
        inverse = pow(_BASE, -1, 1 << 64)
        both = []
        for base in (_BASE, inverse):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        _powers = (both[0], both[1])
    return _powers


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums whose differences give the hash of any substring (see substring_hash)."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def substring_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes that depend on the bytes of [start, end) only."""
    _, down = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, sums: np.ndarray | None = None) -> np.ndarray:
    """64-bit hashes of words; sums are the prefix sums of data, if known.

    Polynomials modulo 2^64 agree on certain long words by construction, so words
    of more than LONG bytes are hashed one by one.
    """
    out = substring_hash(prefix_sums(data) if sums is None else sums, starts, ends)
    long = np.flatnonzero(ends - starts > LONG)
    if len(long):
        raw = memoryview(np.ascontiguousarray(data))
        out[long] = [xxhash.xxh64_intdigest(raw[a:b]) for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True)]
    return out


def shingle_hashes(hashes: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of `width` words inside a text (all its words, if fewer), and how many a text has."""
    n = len(hashes)
    out = np.zeros(n, np.uint64)
    begin = np.cumsum(counts) - counts
    text = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(n) - begin[text]
    with np.errstate(over="ignore"):
        for k in range(width):
            part = np.zeros(n, np.uint64)
            part[: n - k] = hashes[k:] if k else hashes
            part[place + k >= counts[text]] = 0
            out = mix(out * np.uint64(0xD6E8FEB86659FD93) + part)
    keep = (place + width <= counts[text]) | (place == 0)
    return out[keep], np.maximum(counts - width + 1, np.minimum(counts, 1))
