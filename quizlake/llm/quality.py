"""Quality classifier: naive-Bayes support vectors.

Features are indicators of hashed n-grams over the whole text: bytes in threes, words singly and
in pairs, runs of character classes in fours (letters by case, digits, signs), and which of the
last words a word repeats. Each indicator is scaled by its log-count ratio between the classes
(smoothed counts of documents), and a linear hinge-loss model is fitted on the scaled indicators
by dual coordinate descent. Margins become scores by a logistic fit on a part of the sample that
the descent does not see. Learning uses at most ``MAX_ROWS`` labelled documents (smallest hash of
the id); scoring runs over every document.

Cases: null and empty texts have no indicators and get the score of the bias; ids with
conflicting labels, null labels and labels other than 0 and 1 teach nothing; copies score
alike; with one class or none in the sample every score is that class's smoothed share; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizlake.llm.labelled import platt, sample_ids, sampled_docs, sigmoid
from quizlake.llm.store import table
from quizlake.llm.tokens import U64, chunks, held_out, mix, spaced_words

BITS = 18
#: Most labelled rows that the model is fitted on, the share kept for the logistic fit (one in).
MAX_ROWS, CALIBRATE = 12_000, 5
ALPHA, COST, EPOCHS = 1.0, 1.0, 12

_CLASS = np.arange(256, dtype=np.uint8)  # signs stand for themselves
_CLASS[0x30:0x3A] = 0x30
_CLASS[0x41:0x5B] = 0x41
_CLASS[0x61:0x7B] = 0x61
_CLASS[0x80:] = 0x61
_CLASS[[0x09, 0x0B, 0x0C, 0x0D]] = 0x20


def indicators(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, hashed feature), distinct and sorted, of a chunk of texts."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    doc = np.repeat(np.arange(n, dtype=np.int64), size)
    found = []

    def add(d, code, kind):
        found.append((d << BITS) | (mix(code + U64(kind << 56)) >> U64(64 - BITS)).astype(np.int64))

    def runs(d, x, k, kind):
        m = len(x) - k + 1
        if m <= 0:
            return
        code = np.zeros(m, dtype=np.uint64)
        for j in range(k):
            code = (code << U64(8)) | x[j:j + m]
        same = d[:m] == d[k - 1:]
        add(d[:m][same], code[same], kind)

    runs(doc, data.astype(np.uint64), 3, 1)
    shape = _CLASS[data]
    if len(shape):
        head = np.ones(len(shape), dtype=bool)
        head[1:] = (shape[1:] != shape[:-1]) | (doc[1:] != doc[:-1])
        runs(doc[head], shape[head].astype(np.uint64), 4, 2)
    w = spaced_words(data, offsets)
    h, d = w.hashes(), w.doc
    if len(h):
        add(d, h, 3)
        near = d[1:] == d[:-1]
        add(d[1:][near], (h[1:] * U64(0x9E3779B97F4A7C15) + h[:-1])[near], 4)
        repeats = np.zeros(len(h), dtype=np.uint64)
        for back in (1, 2, 3):
            repeats[back:] |= ((h[back:] == h[:-back]) & (d[back:] == d[:-back])).astype(np.uint64) << U64(back)
        add(d, repeats, 5)
    key = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return key >> BITS, key & ((1 << BITS) - 1)


def _features(batches):
    """mapInArrow: (doc_id, y, packed feature numbers) of the sampled documents."""
    for batch in batches:
        packed = []
        for lo, hi, data, off in chunks(batch.column("text")):
            d, f = indicators(data, off)
            at = np.searchsorted(d, np.arange(hi - lo + 1)).tolist()
            f = f.astype(np.uint32)
            packed += [f[a:b].tobytes() for a, b in zip(at, at[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array(packed, pa.binary())],
                                         names=["doc_id", "y", "features"])


def fit(rows: list[tuple[int, np.ndarray]]) -> dict:
    """The model of (label, feature numbers) rows: weights, bias and the logistic's a, b."""
    size = 1 << BITS
    y = np.array([r[0] for r in rows], dtype=np.int64)
    if len(set(y.tolist())) < 2:
        share = (float(y.sum()) + 0.5) / (len(y) + 1.0)
        return {"w": np.zeros(size, np.float32), "bias": 0.0, "a": 1.0, "b": float(np.log(share / (1 - share)))}
    fold = np.arange(len(rows)) % CALIBRATE == CALIBRATE - 1
    if len(set(y[~fold].tolist())) < 2 or len(set(y[fold].tolist())) < 2:
        fold[:] = False
    counts = np.full((2, size), ALPHA)
    for i in np.flatnonzero(~fold):
        counts[y[i], rows[i][1]] += 1
    share = counts / counts.sum(axis=1, keepdims=True)
    ratio = np.log(share[1] / share[0])

    x = [ratio[f] / np.sqrt(max(len(f), 1)) for _, f in rows]
    norm = np.array([float(v @ v) + 1.0 for v in x])
    sign = np.where(y == 1, 1.0, -1.0)
    train = np.flatnonzero(~fold)
    part = np.bincount(y[train], minlength=2)
    cost = COST * len(train) / (2.0 * part[y])  # both classes weigh the same
    alpha, w, bias = np.zeros(len(rows)), np.zeros(size), 0.0
    rng = np.random.default_rng(1)
    for _ in range(EPOCHS):
        moved = 0.0
        for i in rng.permutation(train):
            f = rows[i][1]
            g = sign[i] * (float(w[f] @ x[i]) + bias) - 1.0
            new = min(max(alpha[i] - g / norm[i], 0.0), cost[i])
            step = (new - alpha[i]) * sign[i]
            if step:
                alpha[i] = new
                w[f] += step * x[i]
                bias += step
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    check = np.flatnonzero(fold) if fold.any() else train
    margin = np.array([float(w[rows[i][1]] @ x[i]) + bias for i in check])
    a, b = platt(margin, y[check])
    return {"w": (w * ratio).astype(np.float32), "bias": float(bias), "a": a, "b": b}


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> dict:
    ids = sample_ids(labels, "quality", max_rows)
    found = sampled_docs(docs, ids)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = (found.mapInArrow(_features, f"doc_id {kind}, y int, features binary")
            .dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").select("y", "features").toLocalIterator())
    return fit([(r["y"], np.frombuffer(r["features"], np.uint32)) for r in rows])


def _score(model):
    def run(batches):
        m = model.value
        for batch in batches:
            margin = np.zeros(batch.num_rows)
            for lo, hi, data, off in chunks(batch.column("text")):
                d, f = indicators(data, off)
                count = np.bincount(d, minlength=hi - lo)
                total = np.bincount(d, weights=m["w"][f], minlength=hi - lo)
                margin[lo:hi] = total / np.sqrt(np.maximum(count, 1)) + m["bias"]
            score = sigmoid(m["a"] * margin + m["b"])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score)],
                                             names=["doc_id", "held_out", "score"])
    return run


def score_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, score (quality 1 likelier when higher), predicted."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, max_rows))
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
        _score(model), f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op1_quality_classifier(spark, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
