"""Vectorised text helpers for Arrow tasks: word segmentation and hashing over
the raw UTF-8 bytes of whole texts.

A chunk holds whole texts (never a prefix of one), at most ``max_bytes`` unless a
single text is larger.  Working memory is about 60 bytes per byte of the chunk.
Nulls count as empty texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1_000_000

_B = np.uint64(0x9E3779B97F4A7C15 | 1)
_B_INV = np.uint64(pow(int(_B), -1, 1 << 64))
_C = np.uint64(0xC2B2AE3D27D4EB4F)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: word bytes: digits, a-z (after lower-casing) and every byte of a non-ASCII character
IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[48:58] = IS_WORD[65:91] = IS_WORD[97:123] = True
IS_WORD[128:] = True
#: token bytes: everything but ASCII white space and control characters
IS_TOKEN = np.zeros(256, dtype=bool)
IS_TOKEN[33:127] = True
IS_TOKEN[128:] = True


def mix(h: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser on uint64 (wrapping)."""
    h = np.asarray(h, dtype=np.uint64)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
_POW = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    have = _POW.get(int(base))
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        arr = np.full(size, base, dtype=np.uint64)
        arr[0] = 1
        have = np.multiply.accumulate(arr)
        if size <= 4 * CHUNK_BYTES:
            _POW[int(base)] = have
    return have[:n]


def buffers(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; nulls become empty texts."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    if not (pa.types.is_string(col.type) or pa.types.is_large_string(col.type)):
        col = col.cast(pa.string())
    odt = np.int64 if pa.types.is_large_string(col.type) else np.int32
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offs = np.frombuffer(off, dtype=odt)[col.offset: col.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[offs[0]: offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offs - offs[0]


def chunks(col, max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts."""
    raw, offs = buffers(col)
    n, lo = len(offs) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + max_bytes, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, raw[offs[lo]: offs[hi]], offs[lo: hi + 1] - offs[lo]
        lo = hi


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span."""
    n = len(data)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUE[data] * _powers(_B, n), out=total[1:])
    raw = (total[end] - total[start]) * _powers(_B_INV, n + 1)[start]
    return mix(raw ^ (end - start).astype(np.uint64))


class Words:
    """Words of a chunk: byte spans, text index, 64-bit hashes."""

    __slots__ = ("data", "offsets", "start", "end", "doc", "first", "count", "hash")

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = IS_WORD, lower: bool = True):
        low = LOWER[data] if lower else data
        self.data, self.offsets = low, offsets
        n = len(low)
        inside = is_word[low]
        edge = np.zeros(n + 1, dtype=bool)
        edge[offsets] = True
        before = np.empty(n, dtype=bool)
        before[:1] = False
        before[1:] = inside[:-1]
        before &= ~edge[:n]
        after = np.empty(n, dtype=bool)
        after[-1:] = False
        after[:-1] = inside[1:]
        after &= ~edge[1:]
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        cut = np.searchsorted(self.start, offsets)
        self.first, self.count = cut[:-1], np.diff(cut)
        self.doc = np.repeat(np.arange(len(offsets) - 1), self.count)
        self.hash = span_hashes(low, self.start, self.end)

    def __len__(self) -> int:
        return len(self.start)

    def word(self, i: int) -> str:
        return self.data[self.start[i]: self.end[i]].tobytes().decode("utf-8", "replace")

    def words(self, lo: int, hi: int) -> list[str]:
        return [self.word(i) for i in range(lo, hi)]

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(doc, first word, hash) of every run of k words; a text of 1 to k-1
        words has one shingle, the whole of it.  Sorted by (doc, first word)."""
        n = len(self)
        if n == 0:
            z = np.zeros(0, np.int64)
            return z, z, np.zeros(0, np.uint64)
        short = (self.count > 0) & (self.count < k)
        m = max(n - k + 1, 0)
        full = self.doc[:m] == self.doc[k - 1: k - 1 + m] if m else np.zeros(0, bool)
        at = np.flatnonzero(full)
        h = np.zeros(len(at), dtype=np.uint64)
        for j in range(k):
            h = h * _C + self.hash[at + j]
        h = mix(h ^ np.uint64(k))
        if short.any():
            docs = np.flatnonzero(short)
            hs = np.zeros(len(docs), dtype=np.uint64)
            for j in range(k - 1):
                live = self.count[docs] > j
                hs[live] = hs[live] * _C + self.hash[self.first[docs[live]] + j]
            hs = mix(hs ^ self.count[docs].astype(np.uint64))
            at = np.concatenate([at, self.first[docs]])
            h = np.concatenate([h, hs])
            order = np.argsort(at, kind="stable")
            at, h = at[order], h[order]
        return self.doc[at], at, h

    def text_hash(self) -> np.ndarray:
        """64-bit hash of each text's word sequence (0 words: 0)."""
        n = len(self)
        out = np.zeros(len(self.count), dtype=np.uint64)
        if n == 0:
            return out
        pos = np.arange(n) - np.repeat(self.first, self.count)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(mix(self.hash + pos.astype(np.uint64) * _B), out=total[1:])
        some = self.count > 0
        f = self.first[some]
        out[some] = mix((total[f + self.count[some]] - total[f]) ^ self.count[some].astype(np.uint64))
        return out


def signed(h: np.ndarray) -> np.ndarray:
    """uint64 -> int64 with the same bits (Spark's long)."""
    return np.ascontiguousarray(h, dtype=np.uint64).view(np.int64)


def unsigned(h: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(h, dtype=np.int64).view(np.uint64)


def list_array(values: np.ndarray, lengths: np.ndarray, kind=pa.int64()) -> pa.Array:
    """Arrow list column from flat values and the length of each row."""
    off = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(values, type=kind))
