"""Benchmark decontamination with a generalised suffix automaton of normalised test items.

The items' words (lower-cased A-Z; runs of digits, letters and non-ASCII characters) become one
automaton per block of items, built once and broadcast; a block holds ``BLOCK_WORDS`` words at
most (one longer item is a block of its own), which bounds the broadcast, and several blocks are
applied one after another, each merging its hits into those found so far. Tasks
stream the words of whole texts and track, word by word, the longest suffix that occurs in any
item (the matching length). Streams are entered only in runs whose neighbouring words are
neighbours in some item too: outside such runs no window of two words or more can match, so
nothing is lost.

A window is ``n`` consecutive item words (a shorter item is one window). A document word inside
any occurrence of a window is hit. Cases: a null or empty text has no words and no hits; items
without words never match; equal items are all reported; an empty benchmark leaves every text
as it is; every row of a repeated document is handled alike; other columns are ignored by
``match`` and kept by ``decontaminate``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizlake.llm.store import table
from quizlake.llm.tokens import alnum_words, chunks

BLOCK_WORDS = 200_000
WINDOW = 10
#: Documents with a larger share of hit words go; from others the hit spans are cut out.
MAX_COVERAGE = 0.8


class SuffixAutomaton:
    """All substrings of the items of one block, over word numbers."""

    def __init__(self, items: list[tuple[str, np.ndarray]], window: int):
        self.window = window
        words = [h for _, h in items]
        self.vocab = np.unique(np.concatenate(words)) if words else np.zeros(0, np.uint64)
        coded = [np.searchsorted(self.vocab, h) for h in words]
        n_vocab = max(1, len(self.vocab))
        pairs = [c[:-1].astype(np.int64) * n_vocab + c[1:] for c in coded if len(c) > 1]
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for c in coded:
            last = 0
            for x in c.tolist():
                last = self._extend(last, x)
        self.shortest = min((min(len(c), window) for c in coded), default=window)
        self._index([i for i, _ in items], coded)

    def _state(self, length: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, p: int, x: int, q: int) -> int:
        """The state of the longest string of p followed by x, cut out of q."""
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(x) == q:
            self.next[p][x] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, x: int) -> int:
        seen = self.next[last].get(x)
        if seen is not None:
            return seen if self.length[seen] == self.length[last] + 1 else self._split(last, x, seen)
        new = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and x not in self.next[p]:
            self.next[p][x] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][x]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, x, q)
        return new

    def _index(self, ids: list[str], coded: list[np.ndarray]) -> None:
        """Items whose windows end in each state, and each state's nearest such suffix states."""
        self.items: dict[int, set[str]] = {}   # state of an n-word window -> items
        self.whole: dict[int, list[tuple[int, str]]] = {}  # state of a short item -> (length, item)
        for item, c in zip(ids, coded):
            state = 0
            for i, x in enumerate(c.tolist()):
                state = self.next[state][x]
                top = state
                while self.length[self.link[top]] >= self.window:
                    top = self.link[top]
                if i + 1 >= self.window:
                    self.items.setdefault(top, set()).add(item)
                state = top if i + 1 >= self.window else state
            if 0 < len(c) < self.window:
                self.whole.setdefault(state, []).append((len(c), item))
        n = len(self.length)
        self.top = list(range(n))
        self.short = [-1] * n  # nearest state on the suffix chain (itself included) with a whole item
        for s in sorted(range(1, n), key=self.length.__getitem__):
            p = self.link[s]
            if self.length[p] >= self.window:
                self.top[s] = self.top[p]
            self.short[s] = s if s in self.whole else (self.short[p] if p > 0 else -1)

    def stream(self, words: list[int]) -> Iterator[tuple[int, int, int]]:
        """(position, state, matching length) after each word."""
        state = length = 0
        for i, x in enumerate(words):
            while state and x not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            to = self.next[state].get(x)
            if to is None:
                state = length = 0
            else:
                state, length = to, length + 1
            yield i, state, length

    def hits(self, words: list[int]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word spans [from, to) of the windows found, and the items they come from."""
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        for i, state, length in self.stream(words):
            longest = 0
            if length >= self.window:
                longest = self.window
                found |= self.items[self.top[state]]
            s = self.short[state]
            while s > 0:
                for n, item in self.whole[s]:
                    if n <= length:
                        longest = max(longest, n)
                        found.add(item)
                up = self.link[s]
                s = self.short[up] if up > 0 else -1
            if longest:
                spans.append((i + 1 - longest, i + 1))
        return spans, found

    def runs(self, h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word numbers, and the starts and ends of the runs that the automaton must read."""
        if not len(h) or not len(self.vocab):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.vocab, h), len(self.vocab) - 1)
        known = self.vocab[at] == h
        linked = np.zeros(len(h), dtype=bool)  # this word and the next are neighbours in an item
        near = np.flatnonzero(known[:-1] & known[1:] & (doc[:-1] == doc[1:]))
        if len(near) and len(self.pairs):
            code = at[near].astype(np.int64) * len(self.vocab) + at[near + 1]
            p = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
            linked[near[self.pairs[p] == code]] = True
        before = np.zeros(len(h), dtype=bool)
        before[1:] = linked[:-1]
        start = np.flatnonzero(known & ~before)
        end = np.flatnonzero(known & ~linked) + 1
        long = end - start >= self.shortest
        return at, start[long], end[long]


def _blocks(benchmark: DataFrame, window: int, block_words: int) -> Iterator[SuffixAutomaton]:
    items: list[tuple[str, np.ndarray]] = []
    size = 0
    for row in benchmark.select(F.col("item_id").cast("string").alias("i"), F.col("text").alias("t")).toLocalIterator():
        data = np.frombuffer((row["t"] or "").encode(), dtype=np.uint8)
        h = alnum_words(data, np.array([0, len(data)])).hashes()
        if not len(h):
            continue
        if items and size + len(h) > block_words:
            yield SuffixAutomaton(items, window)
            items, size = [], 0
        items.append((row["i"] if row["i"] is not None else "null", h))
        size += len(h)
    if items:
        yield SuffixAutomaton(items, window)


def _hits(a: SuffixAutomaton, batch: pa.RecordBatch, column: str) -> pa.RecordBatch:
    """The batch with one block's hits merged into __spans (flat word spans) and __items."""
    spans = [np.asarray(x, dtype=np.int32).reshape(-1, 2) for x in batch.column("__spans").to_pylist()]
    items = [set(x) for x in batch.column("__items").to_pylist()]
    n_words = np.zeros(batch.num_rows, dtype=np.int64)
    for lo, hi, data, off in chunks(batch.column(column)):
        w = alnum_words(data, off)
        n_words[lo:hi] = w.count
        at, start, end = a.runs(w.hashes(), w.doc)
        for s, e in zip(start.tolist(), end.tolist()):
            got, found = a.hits(at[s:e].tolist())
            if got:
                d = int(w.doc[s])
                spans[lo + d] = np.concatenate([spans[lo + d], np.array(got, np.int32) + (s - w.first[d])])
                items[lo + d] |= found
    merged = [_union(x) for x in spans]
    cols = {n: batch.column(n) for n in batch.schema.names}
    cols["__spans"] = pa.array([x.ravel() for x in merged], pa.list_(pa.int32()))
    cols["__items"] = pa.array([sorted(x) for x in items], pa.list_(pa.string()))
    cols["__n_words"] = pa.array(n_words, pa.int64())
    return pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))


def _scan(automata, column: str):
    """mapInArrow function: all blocks' hits, block after block, in one Python worker a task."""
    def run(batches):
        for batch in batches:
            for automaton in automata:
                batch = _hits(automaton.value, batch, column)
            yield batch
    return run


def _union(spans: np.ndarray) -> np.ndarray:
    """Overlapping or touching spans joined, in order."""
    if len(spans) < 2:
        return np.asarray(spans, dtype=np.int32).reshape(-1, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.ones(len(spans), dtype=bool)
    new[1:] = spans[1:, 0] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(spans)) - 1
    return np.stack([spans[first, 0], reach[last]], axis=1).astype(np.int32)


def _unmarked(docs: DataFrame) -> DataFrame:
    """``docs`` plus __spans, __items and __n_words, with no hits yet."""
    return docs.select("*", F.expr("cast(array() as array<int>)").alias("__spans"),
                       F.expr("cast(array() as array<string>)").alias("__items"),
                       F.lit(0).cast("bigint").alias("__n_words"))


def _shared_blocks(benchmark: DataFrame, window: int, block_words: int) -> list:
    """The broadcast automata of all blocks, one without items for an empty benchmark."""
    sc = benchmark.sparkSession.sparkContext
    return ([sc.broadcast(a) for a in _blocks(benchmark, window, block_words)]
            or [sc.broadcast(SuffixAutomaton([], window))])


def find_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW,
               block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` plus __spans (hit word spans, flat pairs, merged), __items and __n_words."""
    df = _unmarked(docs)
    return df.mapInArrow(_scan(_shared_blocks(benchmark, window, block_words), text), df.schema)


def match(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: words, hit words, items found (see module)."""
    found = find_spans(docs.select("doc_id", "text"), benchmark, window=window)
    n_hit = F.expr("aggregate(__spans, 0L, (a, x) -> x - a)")  # alternating sum: ends minus starts

    digest = F.sha2(F.array_join(F.array_sort("__items"), ",").cast("binary"), 256)
    return found.select("doc_id", F.col("__n_words").alias("n_words"), n_hit.alias("n_hit"),
                        F.size("__items").cast("bigint").alias("n_items"), digest.alias("items_sha256"),
                        (F.size("__spans") > 0).alias("contaminated"))


def _cut(data: bytes, spans: list[int]) -> str:
    """The text without the bytes from the first to the last word of each span."""
    raw = np.frombuffer(data, dtype=np.uint8)
    w = alnum_words(raw, np.array([0, len(raw)]))
    out, at = [], 0
    for a, b in zip(spans[::2], spans[1::2]):
        out.append(data[at:w.start[a]])
        at = int(w.end[b - 1])
    out.append(data[at:])
    return b"".join(out).decode("utf-8", errors="replace")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  max_coverage: float = MAX_COVERAGE) -> DataFrame:
    """``docs`` with hit spans cut out of ``text``; documents over ``max_coverage`` hit words go.

    Texts without hits stay byte for byte. ``n_chars``, where present, follows a changed text.
    Cutting repeats until no window is left (the words around a cut can form a new one).
    Hits are found and cut in one pass: chained passes hold a Python worker each in every task.
    """
    columns = docs.columns
    shared = _shared_blocks(benchmark, window, BLOCK_WORDS)
    scan = _scan(shared, "text")

    def run(batches):
        for batch in scan(batches):
            texts = batch.column("text").to_pylist()
            keep = np.ones(batch.num_rows, dtype=bool)
            changed = {}
            n_words = batch.column("__n_words").to_pylist()
            for i, spans in enumerate(batch.column("__spans").to_pylist()):
                if not spans:
                    continue
                hit = sum(spans[1::2]) - sum(spans[::2])
                if hit > max_coverage * n_words[i]:
                    keep[i] = False
                    continue
                text = texts[i]
                while spans:
                    text = _cut(text.encode(), spans)
                    spans = _spans_of(text, [b.value for b in shared])
                changed[i] = text
            cols = {n: batch.column(n) for n in columns}
            if changed:
                for i, t in changed.items():
                    texts[i] = t
                cols["text"] = pa.array(texts, batch.schema.field("text").type)
                if "n_chars" in cols:
                    n = cols["n_chars"].to_pylist()
                    for i, t in changed.items():
                        n[i] = len(t)
                    cols["n_chars"] = pa.array(n, batch.schema.field("n_chars").type)
            out = pa.RecordBatch.from_arrays([cols[n] for n in columns], names=columns)
            yield out if keep.all() else out.filter(pa.array(keep))

    return _unmarked(docs).mapInArrow(run, docs.schema)


def _spans_of(text: str, automata: list[SuffixAutomaton]) -> list[int]:
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    w = alnum_words(data, np.array([0, len(data)]))
    h, spans = w.hashes(), []
    for a in automata:
        at, start, end = a.runs(h, w.doc)
        for s, e in zip(start.tolist(), end.tolist()):
            spans += [(x + s, y + s) for x, y in a.hits(at[s:e].tolist())[0]]
    return _union(np.array(spans, np.int32).reshape(-1, 2)).ravel().tolist()


def op7_decontamination(spark, sf_dir: str) -> DataFrame:
    return match(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
