"""Periodic runs in word sequences, by constant-time longest common extensions (LCE).

A run is a maximal stretch of words with smallest period q and length >= max(24, 3 * q). For every
period p the grid 0, p, 2p, ... is walked: a run of at least 3 * p words covers three neighbouring
grid points, so only grid points whose words agree thrice are extended, one LCE forwards and one
backwards. The grids of all periods have n * (1 + 1/2 + 1/3 + ...) points together. A stretch found
under several periods keeps the smallest (by Fine and Wilf the others are its multiples).

LCE of two positions: a difference cover modulo 13 puts both, after at most 12 common steps, on
sampled positions. Only suffixes at sampled positions are sorted (first by 13 words, then by
doubling, which stays inside the sample); neighbouring common prefixes and a sparse table of their
minima answer the rest. Backwards the same over the reversed sequence.

Documents are handled whole, about a megabyte of text at a time in one task (a longer text alone);
memory is linear in that text, times the levels of the sparse table. No shuffle is needed.
Defined cases: null and empty texts have no words and no runs; rows are independent, so repeated
rows give repeated results; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizlake.llm.store import ship, table

MIN_LENGTH, MIN_EXPONENT = 24, 3
COVER, STEP = (0, 1, 3, 9), 13  # every difference modulo 13 is one of two members of the cover
GRID_SLICE = 1 << 20  # grid points handled at once
CHUNK_CHARS = 1 << 20

_IN_COVER = np.zeros(STEP, bool)
_IN_COVER[list(COVER)] = True
#: Steps after which two positions with these remainders are both sampled.
MEET = np.array([[min(d for d in range(STEP) if _IN_COVER[(a + d) % STEP] and _IN_COVER[(b + d) % STEP])
                  for b in range(STEP)] for a in range(STEP)])


class Extension:
    """Longest common extensions to the right within one sequence of numbers >= 0."""

    def __init__(self, seq: np.ndarray):
        n = self.n = len(seq)
        self.seq = s = np.concatenate([seq.astype(np.int64), np.full(2 * STEP, -1)])
        at = np.flatnonzero(np.tile(_IN_COVER, n // STEP + 1)[:n])
        m = len(at)
        self.index = np.full(n + STEP + 1, m, np.int32)  # m: not sampled or past the end
        self.index[at] = np.arange(m)
        bits = max(int(seq.max(initial=0)) + 1, 1).bit_length()
        per = 63 // bits
        columns = []
        for c in range(0, STEP, per):
            packed = np.zeros(m, np.int64)
            for k in range(c, min(c + per, STEP)):
                packed = (packed << bits) | (s[at + k] + 1)
            columns.append(packed)
        order = np.lexsort(columns[::-1])
        new = np.ones(m, bool)
        if m:
            new[1:] = np.any([col[order[1:]] != col[order[:-1]] for col in columns], axis=0)
        rank = np.empty(m, np.int64)
        rank[order] = np.cumsum(new) - 1
        ranks, step = [rank], STEP  # ranks[k] tells apart stretches of STEP * 2^k words
        while m and int(ranks[-1].max()) < m - 1:
            last = np.append(ranks[-1], -1)
            after = last[self.index[np.minimum(at + step, n)]]
            _, rank = np.unique(ranks[-1] * (m + 1) + after + 1, return_inverse=True)
            ranks.append(rank)
            step *= 2
        self.rank = np.append(ranks[-1], -1)
        sa = np.empty(m, np.int64)
        sa[ranks[-1]] = at
        self.minima = self._table(self._neighbours(sa, ranks))

    def _neighbours(self, sa: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
        """Common prefix of each two sampled suffixes next to each other in order."""
        a, b = sa[:-1].copy(), sa[1:].copy()
        start = a.copy()
        for k in range(len(ranks) - 1, -1, -1):
            r = np.append(ranks[k], -1)
            ra, rb = r[self.index[np.minimum(a, self.n)]], r[self.index[np.minimum(b, self.n)]]
            move = np.where((ra == rb) & (ra >= 0), STEP << k, 0)
            a += move
            b += move
        live = np.arange(len(a))
        for _ in range(STEP):
            live = live[self.seq[a[live]] == self.seq[b[live]]]
            a[live] += 1
            b[live] += 1
        return a - start

    @staticmethod
    def _table(lcp: np.ndarray) -> list[np.ndarray]:
        out, span = [lcp.astype(np.int32)], 1
        while 2 * span <= len(lcp):
            out.append(np.minimum(out[-1][:-span], out[-1][span:]))
            span *= 2
        return out

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words from ``i`` and from ``j`` on that agree (i != j; the end agrees with nothing)."""
        meet = MEET[i % STEP, j % STEP]
        out = meet.astype(np.int64)
        live = np.arange(len(i))
        for t in range(STEP - 1):
            live = live[meet[live] > t]
            differ = self.seq[i[live] + t] != self.seq[j[live] + t]
            out[live[differ]] = t
            live = live[~differ]
            if not len(live):
                break
        live = np.flatnonzero(out == meet)
        a, b = i[live] + meet[live], j[live] + meet[live]
        inside = (a < self.n) & (b < self.n)
        live, a, b = live[inside], a[inside], b[inside]
        a, b = self.rank[self.index[a]], self.rank[self.index[b]]
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        for k in np.unique(level):
            own = level == k
            m = self.minima[k]
            out[live[own]] += np.minimum(m[lo[own]], m[hi[own] - (1 << k)])
        return out


def _grids(n: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(sequence, period, grid point) wherever three neighbouring grid points fit, in slices."""
    periods = n // MIN_EXPONENT
    doc = np.repeat(np.arange(len(n)), periods)
    p = np.arange(len(doc)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    count = np.maximum((n[doc] - 1) // p - 1, 0)
    upto = np.cumsum(count)
    lo = 0
    while lo < len(doc):
        hi = max(int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + GRID_SLICE, side="right")), lo + 1)
        c = count[lo:hi]
        which = np.repeat(np.arange(lo, hi), c)
        k = np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c)
        yield doc[which], p[which], k * p[which]
        lo = hi


def runs_of(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, start, length, period) of all runs, ordered by sequence, start, period."""
    n = np.array([len(s) for s in sequences], np.int64)
    long = np.flatnonzero(n >= MIN_LENGTH)
    if not len(long):
        return (np.zeros(0, np.int64),) * 4
    top = max(int(sequences[d].max()) for d in long) + 1
    # one sequence; a number of its own after each part, so nothing extends across
    joined = np.concatenate([x for k, d in enumerate(long) for x in (sequences[d], [top + k])])
    size = n[long]
    base = np.cumsum(size + 1) - size - 1
    found = []
    for doc, p, grid in _grids(size):
        i = base[doc] + grid
        same = joined[i] == joined[i + p]
        doc, p, i = doc[same], p[same], i[same]
        same = joined[i + p] == joined[i + 2 * p]
        found.append(np.stack([doc[same], p[same], i[same]]))
    doc, p, i = np.concatenate(found, axis=1)
    if not len(doc):
        return (np.zeros(0, np.int64),) * 4
    last = len(joined)
    ahead = Extension(joined)(i, i + p)
    back = Extension(joined[::-1])(last - i, last - i - p)
    start, length = i - back - base[doc], back + p + ahead
    good = length >= np.maximum(MIN_LENGTH, MIN_EXPONENT * p)
    doc, start, length, p = long[doc[good]], start[good], length[good], p[good]
    order = np.lexsort((p, length, start, doc))
    doc, start, length, p = doc[order], start[order], length[order], p[order]
    first = np.ones(len(doc), bool)
    first[1:] = (np.diff(doc) != 0) | (np.diff(start) != 0) | (np.diff(length) != 0)
    doc, start, length, p = doc[first], start[first], length[first], p[first]
    order = np.lexsort((p, start, doc))
    return doc[order], start[order], length[order], p[order]


RESULT = ("doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, "
          "best struct<start: bigint, length: bigint, period: bigint>, collapsed string")
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _best(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest exact length / period; ties: smallest start, then period."""
    best = None
    for run in runs:  # in order of start, period: only a greater exponent replaces
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _chunk(ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
    number: dict[bytes, int] = {}
    words = [t.encode().split() for t in texts]  # bytes.split cuts at 0x20 and 0x09 to 0x0D
    seqs = [np.array([number.setdefault(w, len(number)) for w in ws], np.int64) for ws in words]
    doc, start, length, period = runs_of(seqs)
    first = np.searchsorted(doc, np.arange(len(words) + 1))
    best, collapsed = [], []
    for d, ws in enumerate(words):
        own = slice(first[d], first[d + 1])
        runs = list(zip(start[own].tolist(), length[own].tolist(), period[own].tolist()))
        b = _best(runs)
        best.append(b and dict(zip(("start", "length", "period"), b)))
        if runs:
            keep = np.ones(len(ws), bool)
            for s, n, q in runs:
                keep[s + q:s + n] = False
            ws = [ws[k] for k in np.flatnonzero(keep)]
        collapsed.append(b" ".join(ws))
    parts = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], fields=list(_RUN))
    return pa.RecordBatch.from_arrays(
        [ids, pa.array([len(w) for w in words], pa.int64()), pa.ListArray.from_arrays(pa.array(first, pa.int32()), parts),
         pa.array(best, _RUN), pa.array(collapsed, pa.binary()).cast(pa.string())],
        ["doc_id", "n_words", "runs", "best", "collapsed"])


def find_runs(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): its runs by start and period, the one with the greatest
    exponent, and the text without repeats (of each run the first period stays; words are joined
    by one space)."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            texts = batch.column("text").fill_null("").to_pylist()
            lo = 0
            while lo < len(texts):
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= CHUNK_CHARS):
                    size += len(texts[hi])
                    hi += 1
                yield _chunk(batch.column("doc_id").slice(lo, hi - lo), texts[lo:hi])
                lo = hi

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, RESULT)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The contract's texts: every tenth document (by CRC32 of its id) is made periodic from a word on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    planted = docs.select("doc_id", "text", h.alias("h")).withColumns({
        "g": F.floor(F.col("h") / 10),
        "w": F.when(F.col("h") % 10 == 0, F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda x: x != ""))})
    planted = planted.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    planted = planted.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    periodic = F.expr("array_join(concat(slice(w, 1, int(a)), transform(sequence(a, n - 1L),"
                      " i -> element_at(w, int(1 + a + (i - a) % p)))), ' ')")
    return planted.select("doc_id", F.when(F.col("n") > 0, periodic).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all documents (every tenth one made periodic first), as digests."""
    found = find_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
