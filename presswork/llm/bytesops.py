"""Vectorised text kernels on Arrow string buffers (numpy, no per-word Python).

A batch of texts is one byte buffer with document offsets. Words, hashes of
words and rolling hashes of word windows are computed with prefix sums of a
polynomial modulo 2**64: ``H(a..b) = sum(x_i * R**i) * R**-a``. All kernels
work on chunks of a few MB so that a task's memory does not follow the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Separators of the word pattern ``[^\x20\x09-\x0D]+``.
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
SEPARATOR = np.zeros(256, bool)
SEPARATOR[list(SPACE_BYTES)] = True
#: Bytes outside ASCII letters and digits and below 0x80 separate plain words.
PLAIN_SEPARATOR = np.array([not (chr(b).isalnum() or b >= 0x80) for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

CHUNK_BYTES = 3 << 20
#: For tasks that hold much beside a chunk.
SMALL_CHUNK_BYTES = 1 << 20
_R_BYTE = 0x9E3779B97F4A7C15
_R_WORD = 0xD1342543DE82EF95
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(r: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``r**i`` and ``r**-i`` modulo 2**64 for i < n (kept by the process)."""
    have = _powers.get(r)
    if have is None or len(have[0]) < n:
        size = max(n, (SMALL_CHUNK_BYTES if n <= SMALL_CHUNK_BYTES + 1 else CHUNK_BYTES) + 1)
        out = []
        for base in (r, pow(r, -1, 1 << 64)):
            p = np.full(size, base, U64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        have = _powers[r] = (out[0], out[1])
        if size > 8 * CHUNK_BYTES:  # one very long text: do not keep its table
            _powers.pop(r)
    return have[0][:n], have[1][:n]


def mix64(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), in place on a new array."""
    h = h ^ (h >> U64(33))
    h *= U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h *= U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(33)
    return h


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of a string column; a null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    if col.null_count:
        col = pc.fill_null(col, "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = col.buffers()
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offs[0]:offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offs - offs[0]


def chunks(data: np.ndarray, offs: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of at most ``size`` bytes (or one longer text):
    ``(first, end, bytes, offsets)``."""
    n, a = len(offs) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + size, "right")) - 1)
        yield a, b, data[offs[a]:offs[b]], offs[a:b + 1] - offs[a]
        a = b


@dataclass
class Words:
    """Words of a chunk: byte ranges, 64-bit hashes and each text's range."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # word offsets per text, one more than texts

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def word_spans(data: np.ndarray, offs: np.ndarray, separator: np.ndarray = SEPARATOR):
    """Start and end of each maximal run of non-separators; runs never cross texts."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z
    inside = ~separator[data]
    edges = offs[:-1][offs[:-1] < offs[1:]]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[edges] = False
    start = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[edges[1:] - 1] = False
    return start, np.flatnonzero(inside & ~after) + 1


def words(data: np.ndarray, offs: np.ndarray, separator: np.ndarray = SEPARATOR, lower: bool = False) -> Words:
    start, end = word_spans(data, offs, separator)
    body = LOWER[data] if lower else data
    r, inv = powers(_R_BYTE, len(data) + 1)
    total = np.empty(len(data) + 1, U64)
    total[0] = 0
    np.cumsum((body.astype(U64) + U64(1)) * r[:len(data)], out=total[1:])
    h = mix64((total[end] - total[start]) * inv[start])
    return Words(start, end, h, np.searchsorted(start, offs).astype(np.int64))


def window_hashes(hashes: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of ``hashes[i:i+k]`` for each i; length ``max(0, n-k+1)``. Windows
    that cross texts are included: mask them with ``window_mask``."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, U64)
    x = hashes if not seed else mix64(hashes ^ U64(seed))
    r, inv = powers(_R_WORD, n + 1)
    total = np.empty(n + 1, U64)
    total[0] = 0
    np.cumsum(x * r[:n], out=total[1:])
    return mix64((total[k:] - total[:-k]) * inv[:n - k + 1] + U64(k))


def window_starts(first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (word indexes of the chunk) where a window of ``k`` words of
    one text starts, and the text of each."""
    n = np.maximum(np.diff(first) - k + 1, 0)
    doc = np.repeat(np.arange(len(n)), n)
    base = np.cumsum(n) - n
    return (np.arange(n.sum()) - base[doc] + first[:-1][doc]).astype(np.int64), doc


def sort_within(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sorts the values of each text (direct sorts of short runs are many times
    faster than one indirect sort); in place."""
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a > 1:
            h[a:b].sort()
    return h


def run_starts(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where runs of equal values of a text start; sorted within texts."""
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    new[first[:-1][first[:-1] < first[1:]]] = True
    return np.flatnonzero(new)


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Concatenated ``start[i] .. start[i]+length[i]-1``."""
    length = np.asarray(length, np.int64)
    total = int(length.sum())
    if not total:
        return np.zeros(0, np.int64)
    base = np.cumsum(length) - length
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(start, np.int64) - base, length)


def covered(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mask of the n places that lie in one of the half-open ranges."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, start, 1)
    np.add.at(d, end, -1)
    return np.cumsum(d[:-1]) > 0
