"""Vectorised text helpers shared by the operators: Arrow string buffers -> numpy word arrays.

A batch of texts is one byte buffer plus offsets; words are found with byte-class masks and
hashed together (a polynomial hash from one prefix sum), so no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes of text handled at once inside a task (a longer text is a chunk of its own).
CHUNK_BYTES = 1 << 20
#: The same where a pipeline's other workers need the room.
SMALL_CHUNK = 1 << 18

U64 = np.uint64

# Byte classes fixed by the query contracts.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, dtype=bool)  # digits, lower-case a-z, every non-ASCII byte
ALNUM[0x30:0x3A] = True
ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_BASE_INV = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n (kept per process, grown on demand)."""
    if not _POWERS or len(_POWERS[0]) < n:
        m = next((size + 1 for size in (SMALL_CHUNK, CHUNK_BYTES) if n <= size + 1), n)
        out = []
        for base in (_BASE, _BASE_INV):
            step = np.full(m, base & 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
            step[0] = 1
            out.append(np.multiply.accumulate(step))
        _POWERS[:] = out
    return _POWERS[0], _POWERS[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalising bit mixer on uint64 arrays (bijective)."""
    h = h ^ (h >> U64(31))
    h = h * U64(0x7FB5D329728EA185)
    h = h ^ (h >> U64(27))
    h = h * U64(0x81DADEF4BC2DD44D)
    return h ^ (h >> U64(33))


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null texts are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    if col.null_count:
        col = pc.fill_null(col, "")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets


def chunks(col: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(lo, hi, bytes, offsets from 0) over consecutive rows of about ``limit`` bytes."""
    raw, off = text_buffer(col)
    n, lo = len(off) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


class Words:
    """Words of a chunk: byte ``start`` / ``end``, ``doc`` index, ``count`` per document."""

    __slots__ = ("start", "end", "doc", "count", "first", "data")

    def __init__(self, data: np.ndarray, offsets: np.ndarray, word: np.ndarray):
        is_word = word[data]
        n = len(data)
        before = np.empty(n, dtype=bool)
        if n:
            before[0] = False
            before[1:] = is_word[:-1]
        heads = offsets[:-1][offsets[:-1] < n]
        before[heads] = False
        self.start = np.flatnonzero(is_word & ~before)
        after = np.empty(n, dtype=bool)
        if n:
            after[-1] = False
            after[:-1] = is_word[1:]
        tails = offsets[1:] - 1
        after[tails[(tails >= 0)]] = False
        self.end = np.flatnonzero(is_word & ~after) + 1
        at = np.searchsorted(self.start, offsets)
        self.first = at[:-1]
        self.count = np.diff(at)
        self.doc = np.repeat(np.arange(len(offsets) - 1), self.count)
        self.data = data

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word's bytes."""
        power, inverse = _powers(len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[self.data] * power[:len(self.data)], out=total[1:])
        return mix((total[self.end] - total[self.start]) * inverse[self.start])


def spaced_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Lower-cased (A-Z) runs of non-space bytes."""
    return Words(LOWER[data], offsets, NOT_SPACE)


def alnum_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Lower-cased (A-Z) runs of digits, letters and non-ASCII bytes."""
    return Words(LOWER[data], offsets, ALNUM)


def shingle_hashes(h: np.ndarray, w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(doc, hash) of every k consecutive words; a shorter text is one shingle, no words none."""
    n = len(h) - k + 1
    short = np.flatnonzero((w.count > 0) & (w.count < k))
    doc = w.doc[:max(n, 0)]
    if n > 0:
        acc = np.zeros(n, dtype=np.uint64)
        for j in range(k):
            acc = acc * U64(_BASE) + h[j:j + n]
        same = doc == w.doc[k - 1:]
        doc, acc = doc[same], mix(acc)[same]
    else:
        doc, acc = doc[:0], np.zeros(0, dtype=np.uint64)
    if len(short):
        extra = np.zeros(len(short), dtype=np.uint64)
        for i, d in enumerate(short):
            a = 0
            for x in h[w.first[d]:w.first[d] + w.count[d]].tolist():
                a = (a * _BASE + x) & 0xFFFFFFFFFFFFFFFF
            extra[i] = (a + int(w.count[d])) & 0xFFFFFFFFFFFFFFFF
        doc, acc = np.concatenate([doc, short]), np.concatenate([acc, mix(extra)])
        order = np.argsort(doc, kind="stable")
        doc, acc = doc[order], acc[order]
    return doc, acc


def held_out(doc_id: str = "doc_id", folds: int = 3) -> Column:
    """True for the fold kept out of learning (crc32 of the id's text, remainder 1); null id: false."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 1, F.lit(False))

