"""Phrase collocations per language, by best-first growth of prefixes with admissible bounds.

A phrase of 2 to 5 words inside a piece scores ``floor(1000 * a * n / (l * r))`` at its lowest cut.
As ``a <= r`` and ``a <= l``, no phrase scores above ``1000 * n / f`` for the count ``f`` of its first
or of its last word: the bound of every prefix that starts with that word. The frontier therefore
opens words in order of falling bound (rising count). A wave opens a language's words up to a
count; its phrases are grown from their prefixes and counted over all documents:

1. pairs that start with an open word (both words frequent);
2. phrases of 3 to 5 words whose first pair is frequent and whose first and last words are open;
3. for the frequent ones: neighbours on both sides, keys of their parts;
4. counts of the parts that are not known yet.

The words are counted once; then the frequent ones are written as numbers, and the waves read only
those. The text is looked up for the result alone.

After a wave each language has its 2000th surviving score (or fewer survivors). Words whose bound
is below it cannot matter; if any word with a bound as high (ties included) is still closed, the
next wave opens exactly those, or all where there are fewer than 2000 survivors. What was grown
once is not grown again. Nothing is sampled or capped: ``FIRST_SHARE`` decides only how much the
first wave opens.

Dropping needs no other phrase: if a longer candidate around a phrase is as frequent, then so is the
one that is one word longer, i.e. all occurrences have the same left or the same right neighbour.

Phrases are told apart by 64-bit hashes of (language, words). A task adds up its own counts before
the shuffle, so a very frequent phrase is one row a task. Set tests in tasks use a bit filter of at
most ``MAX_BITS`` bits; a false positive costs work, never a result. One row per language, and per
language and octave step of a count, reaches the driver; words, phrases and scores do not.

Defined cases: a null text is empty; a null language is ``und`` (and joins documents of that name);
documents are independent rows, so repeated rows count again; an empty table gives no rows; other
columns are not looked at. Very long texts are handled whole in one task.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quizlake.llm.store import saved, ship, table
from quizlake.llm.tokens import LOWER, U64, Words, chunks, mix

MIN_COUNT, TOP, LONGEST = 100, 2000, 5
FIRST_SHARE = 0.25  # of a language's word occurrences: what the first wave opens
MAX_BITS = 1 << 28
HELD = 1 << 21  # counted phrases a task holds before it hands them on
HELD_DETAILS = 1 << 19  # phrases whose details a task holds
STEPS = 4  # histogram steps per octave of counts, scores

_WORD = np.ones(256, bool)
_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D, *b".,;:!?"]] = False
_CUT = np.zeros(256, np.int64)
_CUT[[0x0A, 0x0B, 0x0C, 0x0D, *b".,;:!?"]] = 1

_BASE = U64(0x9E3779B97F4A7C15)


# --------------------------------------------------------------------------- phrases of a chunk

class Phrases:
    """Word hashes in order, and how many further words each word's piece has."""

    def __init__(self, hashes: np.ndarray, linked: np.ndarray, salt):
        n = self.n = len(hashes)
        self.hash, self.linked, self.salt = hashes, linked, salt  # linked: the next word is in the same piece
        ends = np.flatnonzero(~linked)
        self.room = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n) if n else np.zeros(0, np.int64)

    def keys(self, size: int, at: np.ndarray | None = None) -> np.ndarray:
        """Keys of the phrases of ``size`` words that start at ``at`` (all positions if None; only
        those inside pieces mean something)."""
        at = np.arange(self.n) if at is None else at
        acc = np.zeros(len(at), np.uint64)
        for k in range(size):
            acc = acc * _BASE + self.hash[np.minimum(at + k, self.n - 1)]
        salt = self.salt if np.isscalar(self.salt) else self.salt[at]
        return mix(acc ^ salt ^ U64(size))


class Chunk(Phrases):
    """Words of some texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, salt: np.ndarray):
        w = self.words = Words(LOWER[data], offsets, _WORD)
        cuts = np.concatenate([[0], np.cumsum(_CUT[w.data])])
        linked = np.zeros(len(w), bool)
        if len(w) > 1:
            linked[:-1] = (w.doc[1:] == w.doc[:-1]) & (cuts[w.start[1:]] == cuts[w.end[:-1]])
        super().__init__(w.hashes(), linked, salt[w.doc])

    def spans(self, at: np.ndarray, size: np.ndarray) -> list[str]:
        """Texts of phrases, their words joined by one space."""
        w = self.words
        raw = w.data.tobytes()
        return [b" ".join(raw[a:b] for a, b in zip(w.start[i:i + k].tolist(), w.end[i:i + k].tolist())).decode()
                for i, k in zip(at.tolist(), size.tolist())]


class Sequence(Phrases):
    """Frequent words of one language, stored: distinct hashes, their numbers in order, links."""

    def __init__(self, lang: str, distinct, numbers, linked):
        self.lang, self.distinct = lang, np.frombuffer(distinct, "<u8")
        self.numbers = np.frombuffer(numbers, _number_type(len(self.distinct)))
        bits = np.unpackbits(np.frombuffer(linked, np.uint8), count=len(self.numbers)).astype(bool)
        super().__init__(self.distinct[self.numbers], bits, U64(_salt(lang)))

    def having(self, wanted: "Filter") -> np.ndarray:
        """Which words are in a filter of word keys (each distinct word tested once)."""
        return wanted(mix(self.distinct ^ self.salt ^ U64(1)))[self.numbers]


def _number_type(distinct: int) -> str:
    return "<u2" if distinct <= 1 << 16 else "<u4"


def _salt(lang: str) -> int:
    raw = lang.encode()
    return zlib.crc32(raw) | zlib.crc32(b"#" + raw) << 32


def _chunks(batch):
    """(languages, language number per word, chunk) of a batch of texts."""
    langs = batch.column("lang").dictionary_encode()
    names = langs.dictionary.to_pylist()
    number = langs.indices.to_numpy(zero_copy_only=False)
    salts = np.array([_salt(x) for x in names], np.uint64)
    for lo, hi, data, offsets in chunks(batch.column("text")):
        own = number[lo:hi]
        chunk = Chunk(data, offsets, salts[own])
        yield names, own[chunk.words.doc], chunk


def _sequences(batch):
    """Stored sequences of a batch, one after another (read in place: a batch holds many of them)."""
    columns = [batch.column(c) for c in ("distinct", "numbers", "linked")]
    for i, lang in enumerate(batch.column("lang").to_pylist()):
        yield Sequence(lang, *(c[i].as_buffer() for c in columns))


class Filter:
    """A set of keys as a bit array (false positives possible)."""

    def __init__(self, words: np.ndarray):
        self.words, self.bits = words, U64(len(words) * 64 - 1)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        hit = np.ones(len(keys), bool)
        for probe in (keys, (keys >> U64(29)) ^ (keys << U64(17))):
            b = probe & self.bits
            hit &= (self.words[b >> U64(6)] >> (b & U64(63))) & U64(1) != 0
        return hit


def key_filter(keys: DataFrame) -> np.ndarray:
    """Bits of ``keys`` (column ``key``), set in tasks; at most ``MAX_BITS`` (32 MB) reach the driver."""
    size = 1 << 16
    n = keys.count()
    while size < 16 * n and size < MAX_BITS:
        size *= 2
    k = F.col("key")
    second = F.shiftrightunsigned(k, 29).bitwiseXOR(F.shiftleft(k, 17))
    bit = keys.select(F.explode(F.array(k.bitwiseAND(size - 1), second.bitwiseAND(size - 1))).alias("b"))
    rows = bit.groupBy(F.shiftright("b", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(b & 63))")).alias("v")).toPandas()
    words = np.zeros(size // 64, np.uint64)
    words[rows["w"].to_numpy(np.int64)] = rows["v"].to_numpy(np.int64).view(np.uint64)
    return words


class Counter:
    """Adds up (key, language) counts of a task; hands on what it holds when that grows large."""

    def __init__(self):
        self.parts, self.held, self.names = [], 0, {}

    def add(self, keys: np.ndarray, langs: np.ndarray, names: list[str]):
        if not len(keys):
            return
        known = np.array([self.names.setdefault(x, len(self.names)) for x in names], np.int64)
        key, first, n = np.unique(keys, return_index=True, return_counts=True)
        self.parts.append((key, known[langs[first]], n.astype(np.int64)))
        self.held += len(key)
        if self.held > HELD:
            self._merge()
            if self.held > HELD // 2:
                yield from self.flush()

    def _merge(self):
        if len(self.parts) > 1:
            key, lang, n = (np.concatenate(x) for x in zip(*self.parts))
            order = np.argsort(key, kind="stable")
            key = key[order]
            heads = np.flatnonzero(np.diff(key, prepend=~key[:1]))
            self.parts = [(key[heads], lang[order][heads], np.add.reduceat(n[order], heads))]
            self.held = len(heads)

    def flush(self):
        self._merge()
        names = np.array(list(self.names), object)
        for key, lang, n in self.parts:
            for lo in range(0, len(key), 1 << 16):
                s = slice(lo, lo + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[s].view(np.int64)), pa.array(names[lang[s]], pa.string()), pa.array(n[s])],
                    ["key", "lang", "n"])
        self.parts, self.held = [], 0


def _counted(rows: DataFrame, emit) -> DataFrame:
    """(key, lang, n) over all rows; ``emit(batch)`` gives (keys, language numbers, languages)."""
    def run(batches):
        counter = Counter()
        for batch in batches:
            for keys, langs, names in emit(batch):
                yield from counter.add(keys, langs, names)
        yield from counter.flush()

    found = rows.mapInArrow(run, "key bigint, lang string, n bigint")
    return found.groupBy("key", "lang").agg(F.sum("n").alias("n"))


def _in_sequences(rows: DataFrame, emit) -> DataFrame:
    """(key, lang, n) of the keys that ``emit(sequence)`` gives."""
    def each(batch):
        for seq in _sequences(batch):
            for keys in emit(seq):
                yield keys, np.zeros(len(keys), np.int64), [seq.lang]

    return _counted(rows, each)


# --------------------------------------------------------------------------- passes

def word_counts(docs: DataFrame) -> DataFrame:
    def emit(batch):
        for names, lang, chunk in _chunks(batch):
            yield chunk.keys(1), lang, names

    return _counted(docs, emit)


def _shared(spark, **sets):
    return spark.sparkContext.broadcast(sets)


SEQUENCES = "lang string, distinct binary, numbers binary, linked binary"


def sequences(docs: DataFrame, shared) -> DataFrame:
    """The frequent words of all texts as numbers, by language and chunk. No phrase reaches over an
    infrequent word, and no infrequent word can be the same neighbour of all occurrences, so such a
    word is a break like the end of a piece."""
    def run(batches):
        frequent = Filter(shared.value["frequent"])
        for batch in batches:
            for names, lang, chunk in _chunks(batch):
                keep = frequent(chunk.keys(1))
                linked = chunk.linked & keep
                linked[:-1] &= keep[1:]
                out = []
                for number, name in enumerate(names):
                    own = np.flatnonzero(keep & (lang == number))
                    if len(own):
                        distinct, numbers = np.unique(chunk.hash[own], return_inverse=True)
                        out.append((name, distinct.astype("<u8").tobytes(), numbers.astype(_number_type(len(distinct))).tobytes(),
                                    np.packbits(linked[own]).tobytes()))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), *[pa.binary()] * 3))],
                        ["lang", "distinct", "numbers", "linked"])

    return docs.mapInArrow(run, SEQUENCES)


def pairs(rows: DataFrame, shared) -> DataFrame:
    """Pairs of frequent words whose first word is opened by this wave."""
    def emit(seq):
        s = shared.value
        new = seq.having(Filter(s["open"]))
        if "before" in s:
            new &= ~seq.having(Filter(s["before"]))
        yield seq.keys(2, np.flatnonzero(seq.linked & new))

    return _in_sequences(rows, emit)


def longer(rows: DataFrame, shared) -> DataFrame:
    """Phrases of 3 to 5 words grown from frequent pairs; both end words open, not both before."""
    def emit(seq):
        s = shared.value
        opened = seq.having(Filter(s["open"]))
        before = seq.having(Filter(s["before"])) if "before" in s else np.zeros(seq.n, bool)
        at = np.flatnonzero((seq.room >= 2) & opened)
        at = at[Filter(s["pairs"])(seq.keys(2, at))]
        for size in range(3, LONGEST + 1):
            at = at[seq.room[at] >= size - 1]
            end = at + size - 1
            yield seq.keys(size, at[opened[end] & ~(before[at] & before[end])])

    return _in_sequences(rows, emit)


PARTS = [f"{side}{k}" for side in ("left", "right") for k in range(1, LONGEST)]  # keys of both parts of cut k
SIDES = ["before_lo", "before_hi", "after_lo", "after_hi"]
DETAILS = f"key bigint, lang string, size int, {', '.join(f'{c} bigint' for c in [*PARTS, *SIDES])}"


class Details:
    """What a task knows of the wanted phrases: sizes, keys of parts, the range of their neighbours."""

    def __init__(self):
        self.parts, self.held, self.names = [], 0, {}

    def add(self, chunk: Sequence, key, at, size):
        order = np.argsort(key, kind="stable")
        key, at, size = key[order], at[order], size[order]
        heads = np.flatnonzero(np.diff(key, prepend=~key[:1]))
        h = chunk.hash.view(np.int64)
        left = np.where((at > 0) & chunk.linked[at - 1], h[at - 1], 0)
        right = np.where(chunk.linked[at + size - 1], h[np.minimum(at + size, chunk.n - 1)], 0)
        sides = [f.reduceat(x, heads) for x in (left, right) for f in (np.minimum, np.maximum)]
        key, at, size = key[heads], at[heads], size[heads]
        by = np.stack([chunk.keys(k).view(np.int64) for k in range(1, LONGEST)])
        cuts = range(1, LONGEST)
        lefts = [np.where(size > k, by[k - 1, at], 0) for k in cuts]
        rights = [np.where(size > k, by[np.maximum(size - k - 1, 0), np.minimum(at + k, chunk.n - 1)], 0) for k in cuts]
        lang = np.full(len(key), self.names.setdefault(chunk.lang, len(self.names)))
        self.parts.append(np.stack([key.view(np.int64), lang, size, *lefts, *rights, *sides]))
        self.held += len(key)
        if self.held > HELD_DETAILS:
            self._merge()

    def _merge(self):
        if not self.parts:
            return
        rows = np.concatenate(self.parts, axis=1)
        rows = rows[:, np.argsort(rows[0], kind="stable")]
        heads = np.flatnonzero(np.concatenate([[True], rows[0, 1:] != rows[0, :-1]]))
        out = rows[:, heads]
        for k, f in enumerate((np.minimum, np.maximum, np.minimum, np.maximum)):
            out[len(rows) - 4 + k] = f.reduceat(rows[len(rows) - 4 + k], heads)
        self.parts, self.held = [out], out.shape[1]

    def flush(self):
        self._merge()
        names = np.array(list(self.names), object)
        for rows in self.parts:
            for lo in range(0, rows.shape[1], 1 << 16):
                r = rows[:, lo:lo + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r[0]), pa.array(names[r[1]], pa.string()), pa.array(r[2].astype(np.int32)),
                     *[pa.array(x) for x in r[3:]]], ["key", "lang", "size", *PARTS, *SIDES])
        self.parts, self.held = [], 0


def _wanted(chunk: Phrases, wanted: Filter):
    """(key, position, size) of all phrases of 2 to 5 words in a filter."""
    keys, at, size = [], [], []
    for k in range(2, LONGEST + 1):
        p = np.flatnonzero(chunk.room >= k - 1)
        key = chunk.keys(k, p)
        own = wanted(key)
        keys.append(key[own])
        at.append(p[own])
        size.append(np.full(int(own.sum()), k))
    return tuple(np.concatenate(x) for x in (keys, at, size))


def details(rows: DataFrame, shared) -> DataFrame:
    """Size, part keys and neighbours of the phrases in the filter ``wanted`` (0: none)."""
    def run(batches):
        wanted, held = Filter(shared.value["wanted"]), Details()
        for batch in batches:
            for seq in _sequences(batch):
                key, at, size = _wanted(seq, wanted)
                if len(key):
                    held.add(seq, key, at, size)
                if held.held > HELD_DETAILS:
                    yield from held.flush()
        yield from held.flush()

    same = [F.max(c).alias(c) for c in ("size", *PARTS)]  # the same in all rows of a key
    return rows.mapInArrow(run, DETAILS).groupBy("key", "lang").agg(
        *same, *[(F.min if c.endswith("lo") else F.max)(c).alias(c) for c in SIDES])


def texts(docs: DataFrame, shared) -> DataFrame:
    """(key, lang, phrase) of the phrases in the filter ``wanted``, each once a task."""
    def run(batches):
        wanted, seen = Filter(shared.value["wanted"]), np.zeros(0, np.uint64)
        for batch in batches:
            for names, lang, chunk in _chunks(batch):
                key, at, size = _wanted(chunk, wanted)
                key, first = np.unique(key, return_index=True)
                new = ~np.isin(key, seen)
                if not new.any():
                    continue
                key, at, size = key[new], at[first[new]], size[first[new]]
                seen = np.concatenate([seen, key]) if len(seen) < HELD_DETAILS else key
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array([names[x] for x in lang[at].tolist()], pa.string()),
                     pa.array(chunk.spans(at, size), pa.string())], ["key", "lang", "phrase"])

    return docs.mapInArrow(run, "key bigint, lang string, phrase string").dropDuplicates(["key", "lang"])


def parts(rows: DataFrame, shared) -> DataFrame:
    """Counts of the phrases of 2 to 4 words in the filter ``parts``."""
    def emit(seq):
        wanted = Filter(shared.value["parts"])
        for k in range(2, LONGEST):
            key = seq.keys(k, np.flatnonzero(seq.room >= k - 1))
            yield key[wanted(key)]

    return _in_sequences(rows, emit)


# --------------------------------------------------------------------------- scores

def scored(candidates: DataFrame, counts: DataFrame, totals: DataFrame) -> DataFrame:
    """Candidates (key, lang, size, a, part keys) with their lowest cut: l, r, n, score."""
    cut = [F.struct(F.lit(k).alias("k"), F.col(f"left{k}").alias("lk"), F.col(f"right{k}").alias("rk")) for k in range(1, LONGEST)]
    cuts = candidates.select("key", "lang", "size", "a", F.explode(F.array(*cut)).alias("cut")).where("cut.k < size")
    known = counts.select("key", "n")
    cuts = (cuts.select("key", "lang", "a", "cut.*")
            .join(known.toDF("lk", "l"), "lk").join(known.toDF("rk", "r"), "rk")
            .join(totals, "lang"))

    def wide(c: str, digits: int) -> Column:
        return F.col(c).cast(f"decimal({digits},0)")

    product = F.lit(1000).cast("decimal(4,0)") * (wide("a", 14) * wide("n", 18))  # at most 38 digits
    cuts = cuts.withColumns({"top": product, "bottom": wide("l", 16) * wide("r", 16)})
    cuts = cuts.withColumn("score", F.expr("top div bottom"))
    best = F.min(F.struct("score", "k", "l", "r", "n"))
    return (cuts.groupBy("key", "lang", "a").agg(best.alias("cut"))
            .select("key", "lang", "a", "cut.l", "cut.r", "cut.n", "cut.score"))


def survives() -> Column:
    """No phrase one word longer is as frequent (only phrases that can grow are asked)."""
    def constant(side: str) -> Column:
        return (F.col(f"{side}_lo") == F.col(f"{side}_hi")) & (F.col(f"{side}_lo") != 0)

    return ~((F.col("size") < LONGEST) & (constant("before") | constant("after")))


def best_rows(rows: DataFrame, top: int) -> DataFrame:
    """Each language's rows that can be among its first ``top`` by score, a and phrase: all rows that
    equal the ``top``-th in score and a are in.

    Scores are first counted by octave steps, so that only rows that can be among the first are
    gathered per language: the steps down to the one that holds the ``top``-th score."""
    step = F.floor(F.log2(F.col("score").cast("double") + 1) * 64)
    rows = rows.withColumn("step", step)
    n = rows.groupBy("lang", "step").agg(F.count(F.lit(1)).alias("c"))
    above = Window.partitionBy("lang").orderBy(F.col("step").desc()).rowsBetween(Window.unboundedPreceding, -1)
    needed = n.withColumn("above", F.coalesce(F.sum("c").over(above), F.lit(0))).where(F.col("above") < top)
    rows = rows.join(needed.select("lang", "step"), ["lang", "step"], "left_semi").drop("step")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc())
    return rows.withColumn("place", F.rank().over(order)).where(F.col("place") <= top).drop("place")


def ranked(rows: DataFrame, top: int) -> DataFrame:
    """The first ``top`` rows of each language, with their rank."""
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


# --------------------------------------------------------------------------- waves

def _open_to(words: DataFrame, share: float) -> dict[str, int]:
    """Per language the count up to which words are opened first: by octave steps, until they make
    up ``share`` of all its word occurrences."""
    step = F.floor(F.log2(F.col("n").cast("double")) * STEPS)
    rows = words.groupBy("lang", step.alias("s")).agg(F.sum("n").alias("mass"), F.max("n").alias("most")).collect()
    out = {}
    for lang in {r["lang"] for r in rows}:
        own = sorted((r for r in rows if r["lang"] == lang), key=lambda r: r["s"])
        total, below, limit = sum(r["mass"] for r in own), 0, 0
        for r in own:
            below += r["mass"]
            if limit and below > share * total:
                break
            limit = r["most"]
        out[lang] = limit
    return out


def _limits(spark: SparkSession, limits: dict[str, int]) -> DataFrame:
    return spark.createDataFrame(sorted(limits.items()), "lang string, limit bigint")


def collocations(docs: DataFrame, top: int = TOP, min_count: int = MIN_COUNT, share: float = FIRST_SHARE) -> DataFrame:
    """Each language's ``top`` phrases of ``docs`` (text, lang): lang, rank, phrase, a, l, r, n, score."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col("text").cast("string").alias("text"),
                       F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    words = saved(word_counts(docs), "phrase-words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = words.where(F.col("n") >= min_count)
    rows = saved(sequences(docs, _shared(spark, frequent=key_filter(frequent.select("key")))), "phrase-sequences")
    sets = {}
    grand = {r["lang"]: r["n"] for r in totals.collect()}  # one row a language
    most = {r["lang"]: r["m"] for r in frequent.groupBy("lang").agg(F.max("n").alias("m")).collect()}
    limits = _open_to(frequent, share)
    known = frequent.select("key", "n")  # counts of parts
    grown, all_pairs = None, None  # of all waves
    while True:
        opened = frequent.join(F.broadcast(_limits(spark, limits)), "lang").where("n <= limit").select("key")
        sets["open"] = key_filter(opened)
        shared = _shared(spark, **sets)
        new_pairs = saved(pairs(rows, shared).where(F.col("n") >= min_count), "phrase-pairs")
        all_pairs = new_pairs if all_pairs is None else all_pairs.unionByName(new_pairs)
        shared = _shared(spark, **sets, pairs=key_filter(all_pairs.select("key")))
        new_longer = saved(longer(rows, shared).where(F.col("n") >= min_count), "phrase-longer")
        new = new_pairs.unionByName(new_longer).withColumnRenamed("n", "a")
        wanted = _shared(spark, wanted=key_filter(new.select("key")))
        new = saved(new.join(details(rows, wanted), ["key", "lang"]), "phrase-details")
        grown = new if grown is None else grown.unionByName(new)
        known = known.unionByName(new.select("key", F.col("a").alias("n")))
        asked = new.select(F.explode(F.array(*PARTS)).alias("key")).where("key <> 0").distinct()
        asked = saved(asked.join(known, "key", "left_anti"), "phrase-parts-asked")
        found = parts(rows, _shared(spark, parts=key_filter(asked))).join(asked, "key", "left_semi")
        known = known.unionByName(saved(found.select("key", "n"), "phrase-parts"))
        valued = scored(grown.where(survives()), known.dropDuplicates(["key"]), totals)
        result = saved(best_rows(valued, top), "phrase-best")
        last = {r["lang"]: (r["c"], r["s"]) for r in result.groupBy("lang").agg(
            F.count(F.lit(1)).alias("c"), F.min("score").alias("s")).collect()}
        wider = {}
        for lang, m in most.items():
            c, s = last.get(lang, (0, 0))
            # a closed word with count f matters if floor(1000 * n / f) >= s, i.e. f <= 1000 * n / s
            wider[lang] = min(m, 1000 * grand[lang] // s) if c >= top and s > 0 else m
        if all(wider[x] <= limits.get(x, 0) for x in most):
            named = texts(docs, _shared(spark, wanted=key_filter(result.select("key"))))
            result = ranked(result.join(named, ["key", "lang"]), top)
            return result.select("lang", F.col("rank").cast("int").alias("rank"), "phrase", "a", "l", "r", "n", "score")
        limits = {x: max(wider[x], limits.get(x, 0)) for x in most}
        sets["before"] = sets["open"]


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best collocations of each language over all documents."""
    return collocations(table(spark, sf_dir, "documents"))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: The same table in DuckDB SQL (all phrases of 2 to 5 words counted plainly).
OP11_SQL = f"""WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
p AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
g AS (SELECT lang, k, list_slice(w, i, i + k - 1) AS ws FROM
  (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p CROSS JOIN (SELECT unnest([1, 2, 3, 4, 5]) AS k)
   WHERE len(w) >= k)),
f AS (SELECT lang, k, ws, count(*) AS f FROM g GROUP BY ALL),
t AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, ws, f AS a FROM f WHERE k >= 2 AND f >= {MIN_COUNT}),
inner_phrases AS (SELECT DISTINCT lang, a, list_slice(ws, i, i + m - 1) AS ws FROM
  (SELECT lang, a, ws, m, unnest(range(1, k - m + 2)) AS i FROM c CROSS JOIN (SELECT unnest([2, 3, 4]) AS m) WHERE m < k)),
kept AS (SELECT c.* FROM c WHERE NOT EXISTS (SELECT 1 FROM inner_phrases s
  WHERE s.lang = c.lang AND s.ws = c.ws AND 100 * s.a >= 100 * c.a)),
cuts AS (SELECT kept.*, j FROM kept, (SELECT unnest([1, 2, 3, 4]) AS j) WHERE j < k),
s AS (SELECT cuts.lang, cuts.ws, a, j, x.f AS l, y.f AS r, n,
    CAST((CAST(1000 AS HUGEINT) * a * n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.ws = list_slice(cuts.ws, 1, j)
  JOIN f y ON y.lang = cuts.lang AND y.ws = list_slice(cuts.ws, j + 1, cuts.k) JOIN t ON t.lang = cuts.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, j) = 1),
o AS (SELECT lang, array_to_string(ws, ' ') AS phrase, a, l, r, n, score FROM b)
SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS INTEGER) AS rank,
  phrase, a, l, r, n, score FROM o
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= {TOP}"""
