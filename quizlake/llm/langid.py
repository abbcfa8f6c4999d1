"""Language identification: interpolated Kneser-Ney character models, one per language.

Texts become streams of 64 symbols: the letters a-z (lower-cased), 36 hashed classes for every
other letter or combining mark, and one for runs of anything else. Four symbols pack into a
24-bit hash, so a model holds at most 2^24 entries a language whatever the corpus, which bounds
what is collected and broadcast. Tasks count the hashes of all training texts, Spark adds them
up, and the driver derives the discounted, interpolated probabilities into sorted hash arrays.
Scoring looks every position up in the sorted union of the hashes (positions in none of the
models back off order by order) and gives the language of the lowest cross-entropy a symbol.

Rejection is calibrated: cross-entropies of the training documents give, for each language, the
mean and the spread for one symbol; a document is rejected when it lies more than ``REJECT_Z``
spreads (shrinking with the length) and ``REJECT_SLACK`` of the mean above it.

Cases: a text that is null or has no letter gets ``und``, score 0, and is rejected; rows without
a language or with null text teach nothing; ties go to the language that sorts first; copies
get the same result; with nothing to learn from, everything is ``und``; other columns are
ignored by ``predict`` and kept by ``accepted``; an empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quizlake.llm.store import saved, table
from quizlake.llm.tokens import held_out

ORDER, SYMBOL_BITS = 4, 6
SYMBOLS = 1 << SYMBOL_BITS
REJECT_Z, REJECT_SLACK = 6.0, 0.25
#: Symbols after which the posterior no longer sharpens (neighbouring symbols are not independent).
POSTERIOR_SYMBOLS = 40
BATCH_CHARS = 1 << 19
FLUSH_GRAMS = 1 << 20
UND = "und"

_GAP, _NOT_LETTER = 0, 255
_SYMBOL = np.zeros(0, np.uint8)


def _symbol(cp: int) -> int:
    kind = unicodedata.category(chr(cp))[0]
    if 97 <= cp <= 122:
        return cp - 96
    return 27 + (cp * 2654435761 >> 7) % 37 if kind in "LM" else _GAP


def _symbols(points: np.ndarray) -> np.ndarray:
    """Symbol of each code point (the table of the basic plane is built once per process)."""
    global _SYMBOL
    if not len(_SYMBOL):
        _SYMBOL = np.array([_symbol(c) for c in range(0x10000)], dtype=np.uint8)
    out = _SYMBOL[np.minimum(points, 0xFFFF)]
    for cp in np.unique(points[points > 0xFFFF]).tolist():
        out[points == cp] = _symbol(cp)
    return out


def streams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, gram) of every predicted symbol, and which documents have a letter.

    A stream starts after a gap and ends with one; gaps are single."""
    lowered = [" " + (t or "").lower() + " " for t in texts]
    size = np.array([len(t) for t in lowered], dtype=np.int64)
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    doc = np.repeat(np.arange(len(texts)), size)
    s = _symbols(points)
    keep = np.ones(len(s), dtype=bool)
    keep[1:] = (s[1:] != _GAP) | (s[:-1] != _GAP) | (doc[1:] != doc[:-1])
    s, doc = s[keep], doc[keep]
    letters = np.bincount(doc[s != _GAP], minlength=len(texts)) > 0
    first = np.searchsorted(doc, np.arange(len(texts)))
    at = np.arange(len(s)) - first[doc]
    gram = np.zeros(len(s), dtype=np.uint32)
    for back in range(ORDER - 1, -1, -1):
        part = np.zeros(len(s), dtype=np.uint32)
        part[back:] = s[:len(s) - back]
        part[at < back] = _GAP
        gram = (gram << np.uint32(SYMBOL_BITS)) | part
    use = (at > 0) & letters[doc]
    return doc[use], gram[use], letters


def _text_parts(batch, column: str = "text"):
    """(lo, hi, texts) of a batch in parts of about BATCH_CHARS characters."""
    texts = batch.column(column).to_pylist()
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= BATCH_CHARS:
            yield lo, i + 1, texts[lo:i + 1]
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts), texts[lo:]


def _count(batches):
    """mapInArrow: (lang, gram, n), added up within the task."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def merged(parts):
        gram, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        found, at = np.unique(gram, return_inverse=True)
        return found, np.bincount(at, weights=n).astype(np.int64)

    def rows():
        for lang, parts in held.items():
            gram, n = merged(parts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()),
                                              pa.array(gram.astype(np.int32)), pa.array(n)], names=["lang", "gram", "n"])

    size = 0
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        for lo, hi, texts in _text_parts(batch):
            doc, gram, _ = streams(texts)
            for lang in sorted(set(langs[lo:hi])):
                mine = (langs[lo:hi] == lang)[doc]
                if mine.any():
                    held.setdefault(lang, []).append(np.unique(gram[mine], return_counts=True))
                    size += len(held[lang][-1][0])
            if size >= FLUSH_GRAMS:
                held = {k: [merged(v)] for k, v in held.items()}
                size = sum(len(v[0][0]) for v in held.values())
                if size >= FLUSH_GRAMS // 2:
                    yield from rows()
                    held, size = {}, 0
    yield from rows()


class KneserNey:
    """One language's interpolated model over packed symbols, in sorted hash arrays by order."""

    def __init__(self, gram: np.ndarray, n: np.ndarray):
        order = np.argsort(gram)
        gram, n = gram[order].astype(np.int64), n[order].astype(np.float64)
        levels = []
        for k in range(ORDER, 0, -1):  # below the highest order, counts are of distinct continuations
            levels.append((gram, n))
            gram, n = np.unique(gram & ((1 << (SYMBOL_BITS * (k - 1))) - 1), return_counts=True)
            n = n.astype(np.float64)
        self.grams, self.probs, self.contexts, self.backoff = [], [], [], []
        for gram, n in reversed(levels):
            once, twice = float((n == 1).sum()), float((n == 2).sum())
            discount = once / (once + 2 * twice) if once and twice else 0.5
            context, at = np.unique(gram >> SYMBOL_BITS, return_inverse=True)
            total = np.bincount(at, weights=n)
            rest = discount * np.bincount(at) / total
            lower = self.prob(gram & self._mask(len(self.grams)), len(self.grams))
            self.grams.append(gram)
            self.probs.append((n - discount) / total[at] + rest[at] * lower)
            self.contexts.append(context)
            self.backoff.append(rest)

    @staticmethod
    def _mask(symbols: int) -> int:
        return (1 << (SYMBOL_BITS * symbols)) - 1

    def prob(self, gram: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Probability of each gram's last symbol after the ones before it."""
        if order == 0:
            return np.full(len(gram), 1.0 / SYMBOLS)
        keys = self.grams[order - 1]
        at = np.minimum(np.searchsorted(keys, gram), len(keys) - 1)
        out = self.probs[order - 1][at].copy()
        miss = keys[at] != gram
        if miss.any():
            unseen = gram[miss]
            lower = self.prob(unseen & self._mask(order - 1), order - 1)
            contexts = self.contexts[order - 1]
            c = np.minimum(np.searchsorted(contexts, unseen >> SYMBOL_BITS), len(contexts) - 1)
            rest = np.where(contexts[c] == unseen >> SYMBOL_BITS, self.backoff[order - 1][c], 1.0)
            out[miss] = rest * lower
        return out


class LanguageModels:
    """All languages' models and the log probabilities of the union of their grams."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.langs = sorted(counts)
        self.models = [KneserNey(*counts[lang]) for lang in self.langs]
        grams = [m.grams[-1] for m in self.models]
        self.union = np.unique(np.concatenate(grams)) if grams else np.zeros(0, np.int64)
        self.logs = [np.log(m.prob(self.union)).astype(np.float32) for m in self.models]

    def cross_entropy(self, doc: np.ndarray, gram: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
        """(nats a symbol [language, document], symbols of each document)."""
        n = np.bincount(doc, minlength=n_docs)
        total = np.zeros((len(self.langs), n_docs))
        if len(gram) and len(self.union):
            at = np.minimum(np.searchsorted(self.union, gram), len(self.union) - 1)
            miss = np.flatnonzero(self.union[at] != gram)
            kinds, where = np.unique(gram[miss], return_inverse=True)
            for i, model in enumerate(self.models):
                logs = self.logs[i][at]
                if len(miss):
                    logs[miss] = np.log(model.prob(kinds.astype(np.int64)))[where]
                total[i] = np.bincount(doc, weights=logs, minlength=n_docs)
        return -total / np.maximum(n, 1), n


def train(docs: DataFrame) -> LanguageModels:
    """Models of the non-null languages in the learning folds, from every training text."""
    rows = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    counts = rows.mapInArrow(_count, "lang string, gram int, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    got = counts.toArrow()
    lang = got.column("lang").combine_chunks().dictionary_encode() if got.num_rows else None
    found = {}
    if lang is not None:
        code, gram, n = lang.indices.to_numpy(), got.column("gram").to_numpy(), got.column("n").to_numpy()
        for i, name in enumerate(lang.dictionary.to_pylist()):
            mine = code == i
            found[name] = (gram[mine], n[mine])
    return LanguageModels(found)


def _predict(models):
    """mapInArrow: the batch's columns plus __lang_pred, __score, __nats, __size."""
    def run(batches):
        m = models.value
        for batch in batches:
            lang, score, nats, size = [], [], [], []
            for lo, hi, texts in _text_parts(batch):
                doc, gram, letters = streams(texts)
                ce, n = m.cross_entropy(doc, gram, hi - lo)
                size += n.tolist()
                if not m.langs:
                    lang += [UND] * (hi - lo)
                    score += [0.0] * (hi - lo)
                    nats += [None] * (hi - lo)
                    continue
                best = np.argmin(ce, axis=0)
                low = ce[best, np.arange(hi - lo)]
                share = 1.0 / np.exp(-(ce - low) * np.minimum(n, POSTERIOR_SYMBOLS)).sum(axis=0)
                lang += [m.langs[b] if ok else UND for b, ok in zip(best.tolist(), letters.tolist())]
                score += np.where(letters, share, 0.0).tolist()
                nats += [x if ok else None for x, ok in zip(low.tolist(), letters.tolist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(nats, pa.float64()), pa.array(size, pa.int64())],
                names=[*batch.schema.names, "__lang_pred", "__score", "__nats", "__size"])
    return run


def _scored(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """``docs`` (the text only if ``keep_text``) plus the prediction and ``__rejected``, from the spread of the training texts' cross-entropies."""
    models = docs.sparkSession.sparkContext.broadcast(train(docs))
    schema = T.StructType([*docs.schema.fields, T.StructField("__lang_pred", T.StringType()),
                           T.StructField("__score", T.DoubleType()), T.StructField("__nats", T.DoubleType()),
                           T.StructField("__size", T.LongType())])
    scored = docs.mapInArrow(_predict(models), schema)
    scored = saved(scored if keep_text else scored.drop("text"), "languages")
    known = scored.where(~held_out() & (F.col("lang") == F.col("__lang_pred")) & (F.col("__size") > 0))
    mean = known.groupBy("__lang_pred").agg((F.sum(F.expr("__nats * __size")) / F.sum("__size")).alias("__mean"))
    spread = (known.join(F.broadcast(mean), "__lang_pred")  # one row a language
              .groupBy("__lang_pred").agg(F.first("__mean").alias("__mean"),
                                          F.sqrt(F.avg(F.expr("pow(__nats - __mean, 2) * __size"))).alias("__spread")))
    limit = F.expr(f"__mean * {1 + REJECT_SLACK} + {REJECT_Z} * __spread / sqrt(__size)")
    far = F.coalesce(F.col("__nats") > limit, F.lit(False))
    return (scored.join(F.broadcast(spread), "__lang_pred", "left")
            .withColumn("__rejected", (F.col("__lang_pred") == UND) | far))


def predict(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, cross_entropy, n_symbols, rejected."""
    return _scored(docs.select("doc_id", "lang", "text"), keep_text=False).select(
        "doc_id", held_out().alias("held_out"), F.col("__lang_pred").alias("lang_pred"), F.col("__score").alias("score"),
        F.col("__nats").alias("cross_entropy"), F.col("__size").alias("n_symbols"), F.col("__rejected").alias("rejected"))


def accepted(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that are rejected (no letters, or no model fits)."""
    return _scored(docs).where("not __rejected").select(*docs.columns)


def op3_language_id(spark, sf_dir: str) -> DataFrame:
    return predict(table(spark, sf_dir, "documents"))
