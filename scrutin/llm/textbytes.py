"""Word and shingle hashes of Arrow text columns, vectorised over the bytes.

A text column is seen as one run of UTF-8 bytes with offsets.  A word's hash
is a polynomial over its bytes modulo 2**64 (a difference of two prefix sums,
shifted back by the inverse power), finished by a bit mixer; a shingle's hash
is a polynomial over its words' hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SHINGLE_WORDS = 5
CHUNK_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_LOWER += 1

#: True at bytes that part words: white space, or all ASCII but letters and digits.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.zeros(256, dtype=bool)
NOT_ALNUM[:128] = True
NOT_ALNUM[48:58] = NOT_ALNUM[65:91] = NOT_ALNUM[97:123] = False

_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse, modulo 2**64."""
    global _powers
    if len(_powers[0]) <= n:
        size = max(n + 1, CHUNK_BYTES * 2)
        up = np.full(size, _BASE, np.uint64)
        down = np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _powers = (np.cumprod(up), np.cumprod(down))
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def times(n: int, seed: np.uint64) -> np.uint64:
    """n times a seed, modulo 2**64."""
    return np.uint64(n * int(seed) & 0xFFFFFFFFFFFFFFFF)


def unit(h: np.ndarray) -> np.ndarray:
    """Hashes as numbers in (0, 1)."""
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))


def text_column(col: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A text column without nulls (null is the empty text), 64-bit offsets."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string())
    return pc.fill_null(col, "") if col.null_count else col


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a ``text_column``."""
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset: col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    raw = col.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[off[0]: off[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def chunks(batch: pa.RecordBatch, text: str = "text", size: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of a batch of about ``size`` bytes of text; a longer text makes a slice alone."""
    col = text_column(batch.column(batch.schema.get_field_index(text)))
    _, off = buffers(col)
    at, n = 0, len(col)
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + size, side="right")) - 1)
        yield batch.slice(at, to - at), col.slice(at, to - at)
        at = to


@dataclass
class Words:
    hashes: np.ndarray   # of each word
    offsets: np.ndarray  # first word of each text, and the end
    starts: np.ndarray   # bytes
    ends: np.ndarray


def words(col: pa.Array, parts: np.ndarray = NOT_ALNUM) -> Words:
    """Hashes of the words of each text, A-Z lower-cased."""
    data, off = buffers(col)
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), np.zeros(len(off), np.int64), none, none)
    inside = ~parts[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[off] = True
    before = np.empty(n, dtype=bool)
    before[0] = True
    before[1:] = ~inside[:-1]
    starts = np.flatnonzero(inside & (before | edge[:-1]))
    before[:-1] = ~inside[1:]
    before[-1] = True
    ends = np.flatnonzero(inside & (before | edge[1:])) + 1
    up, down = powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_LOWER[data] * up[:n], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    h += (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return Words(mix(h), np.searchsorted(starts, off), starts, ends)


def shingles(w: Words, k: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of k words of each text and their offsets by text.  A
    text of fewer than k words, but not none, is one shingle."""
    n = np.diff(w.offsets)
    count = np.where(n >= k, n - (k - 1), np.minimum(n, 1))
    off = np.concatenate([[0], np.cumsum(count)])
    total = int(off[-1])
    at = np.arange(total) + np.repeat(w.offsets[:-1] - off[:-1], count)
    h = np.concatenate([w.hashes, np.zeros(k, np.uint64)])
    scale = [np.uint64(pow(0xC2B2AE3D27D4EB4F, j + 1, 1 << 64)) for j in range(k)]
    out = np.zeros(total, np.uint64)
    for j in range(k):
        out += h[at + j] * scale[j]
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        first, s = w.offsets[short], np.zeros(len(short), np.uint64)
        for j in range(k - 1):
            s += np.where(j < n[short], h[first + j], np.uint64(0)) * scale[j]
        out[off[short]] = s + n[short].astype(np.uint64)
    return mix(out), off
