"""LM scoring: a hashed maximum-entropy model with a class-factored softmax.

P(word | history) = P(class | history) * P(word | class). Classes are groups of word endings
with alike left neighbours; the end of a text is a class of its own. P(class | history) is a
softmax over hashed features of the last three classes: single classes, n-grams and skips (first,
second, third, 1+2, 1+3, 2+3, 1+2+3). P(word | class) is a softmax over the class's words with one
indicator each, whose smoothed optimum has closed form; words never seen in training share one
further place in their class.

On top stand hashed word features of the history: the word before the last (skip), the last word,
and both together (bigram). In this order each multiplies P(word | history) by
exp(weight(feature, word)), the weight being its closed-form optimum under a prior of
``PRIORS[j]`` words drawn from the model without the feature:
P_j = (n(feature, word) + prior P_{j-1}) / (n(feature) + prior), which stays normalised for every
history. Only the class softmax is fitted by gradients.

Everything learned comes from all training texts. Texts are read once into blocks (word numbers
plus the block's dictionary of word hashes), which are written; word counts are added up by
hash bucket and handed back to the blocks that hold the word, so no task and no broadcast ever
holds the vocabulary. Word features are counted the same way over all training tokens: a block
adds up its own (feature, word) pairs first, buckets grow in number with the tokens, and a pair
is told apart by its bucket and 32 further bits. Class histories are counted over all training tokens (32^3 histories at
most, whatever the corpus) and the weights follow by gradient updates: tasks compute the
gradients of their histories, the driver adds them up and steps. Blocks are scored as arrays.

Words are told apart by 64-bit hashes. Cases: null and empty texts are one end token; a row with
null doc_id is trained on; repeated rows count and score as often as they occur; without training
texts the counts are 0 and all classes equally likely; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import gc

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizlake.llm.store import saved, table
from quizlake.llm.tokens import U64, chunks, held_out, mix, spaced_words

FOLDS = 5
BLOCK_BYTES = 1 << 20
CLASS_BITS, ENDING_BITS, LEFT_BITS = 5, 11, 6
CLASSES, ENDINGS, LEFTS = 1 << CLASS_BITS, 1 << ENDING_BITS, 1 << LEFT_BITS
HISTORIES = CLASSES ** 3
FEATURE_BITS = 13
#: Gradient updates; their rate (a gradient over expected plus observed counts moves a weight by
#: about half its error, and seven features share each error); the prior's strength; the share of
#: a uniform choice mixed into the softmax.
UPDATES, RATE, PRIOR, UNIFORM = 8, 2 / 7, 1.0, 1e-4
BUCKET_WORDS = 500_000
#: Pairs of a bucket at most (on average); strengths of the priors of skip, last word and bigram.
BUCKET_PAIRS, PRIORS = 2_000_000, (100_000.0, 5_000.0, 20.0)
#: Kinds of pairs (rows of ``_pairs``) counted together; each round's shuffle ends before the next.
ROUNDS = ((0, 3), (1,), (2,))
#: Parts of the blocks that are scored one after another; each part's shuffle ends before the next.
SCORED_IN = 6
#: Hashes that stand before and after a text.
START, END = U64(0x5851F42D4C957F2D), U64(0x14057B7EF767814F)
END_CLASS = 0


def endings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashed last three bytes of words (a shorter word is marked by its length)."""
    code = np.zeros(len(start), dtype=np.uint64)
    for back in (1, 2, 3):
        at = end - back
        code = (code << U64(9)) | np.where(at >= start, data[np.maximum(at, 0)].astype(np.uint64) + U64(1), U64(0))
    return (mix(code) >> U64(64 - ENDING_BITS)).astype(np.uint16)


def _blocks(batches):
    """mapInArrow: one row a block of documents."""
    part, number = TaskContext.get().partitionId(), 0
    for batch in batches:
        held = np.array(batch.column("held_out").to_pylist(), dtype=bool)
        for lo, hi, data, off in chunks(batch.column("text"), BLOCK_BYTES):
            w = spaced_words(data, off)
            words, first, at = np.unique(w.hashes(), return_index=True, return_inverse=True)
            train = np.bincount(at, weights=~held[lo:hi][w.doc], minlength=len(words)).astype(np.int64)
            ending = endings(w.data, w.start[first], w.end[first])
            yield pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) | number], pa.int64()),
                 pa.array([batch.column("doc_id").slice(lo, hi - lo).to_pylist()], pa.list_(batch.schema.field("doc_id").type)),
                 *(pa.array([x.tobytes()], pa.binary()) for x in (
                     held[lo:hi], w.count.astype(np.int32), at.astype(np.uint16 if len(words) <= 1 << 16 else np.uint32),
                     words, train.astype(np.int32), ending))],
                names=["block", "doc_ids", "held", "counts", "tokens", "words", "train", "endings"])
            number += 1


def _bytes(col, i: int, kind) -> np.ndarray:
    return np.frombuffer(col[i].as_buffer(), dtype=kind)


def _tokens(col, i: int, count: np.ndarray) -> np.ndarray:
    """Word numbers of a block: two bytes each where its dictionary is small, else four."""
    return _bytes(col, i, np.uint16 if len(col[i].as_buffer()) == 2 * int(count.sum()) else np.uint32)


def _training_tokens(batch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(dictionary number, position in its text, text) of a block's training tokens."""
    held, count = _bytes(batch.column("held"), i, bool), _bytes(batch.column("counts"), i, np.int32)
    token = _tokens(batch.column("tokens"), i, count)
    doc = np.repeat(np.arange(len(count)), count)
    at = np.arange(len(token)) - np.repeat(np.cumsum(count) - count, count)
    use = ~held[doc]
    return token[use], at[use], doc[use]


def _cells(counts: np.ndarray):
    found = np.flatnonzero(counts)
    return pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found].astype(np.int64))], names=["cell", "n"])


def _left_neighbours(batches):
    """mapInArrow: (cell, n), cell = ending * LEFTS + hashed ending of the word before."""
    total = np.zeros(ENDINGS * LEFTS, dtype=np.int64)
    for batch in batches:
        for i in range(batch.num_rows):
            token, at, _ = _training_tokens(batch, i)
            e = _bytes(batch.column("endings"), i, np.uint16)[token].astype(np.int64)
            if len(e):
                left = np.concatenate([[0], e[:-1] & (LEFTS - 1)])
                left[at == 0] = 0
                total += np.bincount(e * LEFTS + left, minlength=len(total))
    yield _cells(total)


def word_classes(cells: np.ndarray) -> np.ndarray:
    """Class of each ending: weighted k-means over the (square-rooted) shares of left neighbours."""
    counts = cells.reshape(ENDINGS, LEFTS).astype(np.float64)
    mass = counts.sum(axis=1)
    x = np.sqrt((counts + 0.05 * counts.sum(axis=0) / max(counts.sum(), 1) * LEFTS) /
                (mass[:, None] + 0.05 * LEFTS)) if mass.sum() else np.zeros((ENDINGS, LEFTS))
    k = CLASSES - 1
    centre = [int(np.argmax(mass))]
    near = ((x - x[centre[0]]) ** 2).sum(axis=1)
    for _ in range(k - 1):  # the next centre: the heaviest misfit
        centre.append(int(np.argmax(near * np.sqrt(mass))))
        near = np.minimum(near, ((x - x[centre[-1]]) ** 2).sum(axis=1))
    c = x[centre]
    for _ in range(20):
        own = np.argmin(((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2), axis=1)
        for j in range(k):
            mine = own == j
            if mass[mine].sum():
                c[j] = np.average(x[mine], axis=0, weights=mass[mine])
    return (own + 1).astype(np.uint8)


def _histories(classes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Number of the three classes before each token (``at``: position in its text)."""
    out = np.zeros(len(classes), dtype=np.int64)
    for back in (3, 2, 1):
        before = np.zeros(len(classes), dtype=np.int64)
        before[back:] = classes[:len(classes) - back]
        before[at < back] = END_CLASS
        out = out * CLASSES + before
    return out


def _with_ends(classes: np.ndarray, at: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes and positions with the end token after every text."""
    where = np.cumsum(count)
    return np.insert(classes, where, END_CLASS), np.insert(at, where, count)


def _class_histories(class_of):
    """mapInArrow: (cell, n), cell = history * CLASSES + class, over all training tokens."""
    def run(batches):
        classes = class_of.value
        total = np.zeros(HISTORIES * CLASSES, dtype=np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                held, count = _bytes(batch.column("held"), i, bool), _bytes(batch.column("counts"), i, np.int32)
                token, at, _ = _training_tokens(batch, i)
                c = classes[_bytes(batch.column("endings"), i, np.uint16)][token].astype(np.int64)
                c, at = _with_ends(c, at, count[~held])
                total += np.bincount(_histories(c, at) * CLASSES + c, minlength=len(total))
        yield _cells(total)
    return run


def features(history: np.ndarray) -> np.ndarray:
    """Hashed features [history, 7] of history numbers."""
    c1, c2, c3 = history % CLASSES, history // CLASSES % CLASSES, history // CLASSES ** 2
    seen = [c1, c2, c3, c1 * CLASSES + c2, c1 * CLASSES + c3, c2 * CLASSES + c3, history]
    return np.stack([(mix(v.astype(np.uint64) + U64((j + 1) << 40)) >> U64(64 - FEATURE_BITS)).astype(np.int64)
                     for j, v in enumerate(seen)], axis=1)


def _softmax(w: np.ndarray, bias: np.ndarray, f: np.ndarray) -> np.ndarray:
    s = w[f].sum(axis=1) + bias
    s = np.exp(s - s.max(axis=1, keepdims=True))
    return s / s.sum(axis=1, keepdims=True)


def _gradients(model):
    """mapInArrow: one row with this part's gradient (expected less observed counts) and their sum."""
    def run(batches):
        w, bias = model.value
        g, h = np.zeros_like(w), np.zeros_like(w)
        for batch in batches:
            n = np.stack([np.asarray(x, dtype=np.float64) for x in batch.column("n").to_pylist()])
            f = features(batch.column("history").to_numpy().astype(np.int64))
            p = _softmax(w, bias, f)
            total = n.sum(axis=1, keepdims=True)
            error, both = total * p - n, total * p + n
            for j in range(f.shape[1]):
                order = np.argsort(f[:, j], kind="stable")
                key = f[order, j]
                start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                g[key[start]] += np.add.reduceat(error[order], start, axis=0)
                h[key[start]] += np.add.reduceat(both[order], start, axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([x.astype(np.float32).tobytes()], pa.binary()) for x in (g, h)],
                                         names=["g", "h"])
    return run


def train_classes(cells: DataFrame, updates: int = UPDATES) -> np.ndarray:
    """log10 P(class | history) [history, class] by distributed gradient updates."""
    sc = cells.sparkSession.sparkContext
    counted = cells.select(F.expr(f"cell div {CLASSES}").alias("history"), F.expr(f"cast(cell % {CLASSES} as int)").alias("c"), "n")
    rows = counted.groupBy("history").agg(*[F.sum(F.when(F.col("c") == c, F.col("n")).otherwise(0)).alias(f"n{c}")
                                            for c in range(CLASSES)])
    rows = saved(rows.select("history", F.array(*[f"n{c}" for c in range(CLASSES)]).alias("n")), "class-histories")
    total = np.array(rows.agg(*[F.sum(F.get("n", F.lit(c))) for c in range(CLASSES)]).first(), dtype=object)
    total = np.array([float(x or 0) for x in total])
    w, bias = np.zeros((1 << FEATURE_BITS, CLASSES)), np.log((total + 0.5) / (total.sum() + 0.5 * CLASSES))
    if total.sum():
        for _ in range(updates):
            model = sc.broadcast((w, bias))
            parts = rows.mapInArrow(_gradients(model), "g binary, h binary").collect()  # at most one a scan task
            g = sum(np.frombuffer(r["g"], np.float32).astype(np.float64) for r in parts).reshape(w.shape) + PRIOR * w
            h = sum(np.frombuffer(r["h"], np.float32).astype(np.float64) for r in parts).reshape(w.shape) + PRIOR
            w = w - RATE * g / h
            model.unpersist()
    out = np.empty((HISTORIES, CLASSES), dtype=np.float32)
    for i in range(0, HISTORIES, 4096):
        p = _softmax(w, bias, features(np.arange(i, i + 4096)))
        out[i:i + 4096] = np.log10((1 - UNIFORM) * p + UNIFORM / CLASSES)
    return out


def _ask(buckets: int):
    """mapInArrow: a block's dictionary, cut by hash bucket (words are sorted by hash)."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                words = _bytes(batch.column("words"), i, np.uint64)
                bucket = ((words >> U64(32)) * U64(buckets)) >> U64(32)
                cut = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
                full = np.flatnonzero(np.diff(cut))
                n, e = _bytes(batch.column("train"), i, np.int32), _bytes(batch.column("endings"), i, np.uint16)
                parts = [[x[cut[b]:cut[b + 1]].tobytes() for b in full] for x in (words, n, e)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full), pa.array([batch.column("block")[i].as_py()] * len(full), pa.int64()),
                     *(pa.array(p, pa.binary()) for p in parts)], names=["bucket", "block", "words", "train", "endings"])
    return run


def _answer(asked: pa.Table) -> pa.Table:
    """Counts of one bucket's words for every block that asked, and the bucket's sums by ending."""
    words = [np.frombuffer(x.as_buffer(), np.uint64) for x in asked.column("words")]
    train = [np.frombuffer(x.as_buffer(), np.int32) for x in asked.column("train")]
    ends = np.concatenate([np.frombuffer(x.as_buffer(), np.uint16) for x in asked.column("endings")])
    known, first, at = np.unique(np.concatenate(words), return_index=True, return_inverse=True)
    count = np.bincount(at, weights=np.concatenate(train)).astype(np.int64)
    at = count[at]
    cut = np.concatenate([[0], np.cumsum([len(x) for x in words])])
    sums = np.stack([np.bincount(ends[first], weights=w, minlength=ENDINGS) for w in (count, count > 0)]).astype(np.int64)
    bucket = asked.column("bucket")[0].as_py()
    return pa.table({
        "block": pa.array([*asked.column("block").to_pylist(), None], pa.int64()),
        "bucket": pa.array([bucket] * (len(words) + 1), pa.int64()),
        "counts": pa.array([at[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])] + [sums.tobytes()], pa.binary())})


def _pairs(words: np.ndarray, token: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Hashes [4, tokens with ends]: (skip, word), (last, word), (skip, last, word), (skip)."""
    ends = np.cumsum(count)
    w = np.insert(words[token], ends, END)
    at = np.arange(len(w)) - np.repeat(ends - count + np.arange(len(count)), count + 1)
    last, skip = np.full(len(w), START), np.full(len(w), START)
    last[1:], skip[2:] = w[:-1], w[:-2]
    last[at < 1], skip[at < 2] = START, START
    a, b = mix(skip + U64(1)), mix(last + U64(2))
    return np.stack([mix(a + w), mix(b + w), mix(mix(a ^ (b * U64(3))) + w), mix(a + U64(5))])


def _pack(x: np.ndarray) -> bytes:
    """Numbers as compressed byte planes of the width that the largest needs, after width and count."""
    width = next(k for k in (1, 2, 4, 8) if k == 8 or int(x.max(initial=0)) < 1 << 8 * k)
    planes = np.ascontiguousarray(x.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T)
    return bytes([width]) + len(x).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpack(data) -> np.ndarray:
    head = bytes(data[:9])
    width, n = head[0], int.from_bytes(head[1:], "little")
    raw = np.frombuffer(pa.decompress(data[9:], decompressed_size=width * n, codec="zstd"), np.uint8)
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(f"<u{width}").ravel().astype(np.int64)


def _ask_pairs(kinds: tuple[int, ...], buckets: int):
    """mapInArrow: a block's distinct pairs of ``kinds`` with their training counts, cut by hash bucket."""
    wide = U64((1 << 64) // buckets + 1) if buckets > 1 else U64((1 << 64) - 1)
    drop = U64(max(int(wide).bit_length() - 32, 0))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                held, count = _bytes(batch.column("held"), i, bool), _bytes(batch.column("counts"), i, np.int32)
                token = _tokens(batch.column("tokens"), i, count)
                pairs = _pairs(_bytes(batch.column("words"), i, np.uint64), token, count)[list(kinds)].ravel()
                known, at = np.unique(pairs, return_inverse=True)
                use = np.tile(np.repeat(~held, count + 1), len(kinds))
                n = np.bincount(at, weights=use, minlength=len(known)).astype(np.int64)
                bucket = known // wide
                slot = ((known - bucket * wide) >> drop).astype(np.int64)  # ascending inside a bucket
                cut = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
                full = np.flatnonzero(np.diff(cut))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full), pa.array([batch.column("block")[i].as_py()] * len(full), pa.int64()),
                     pa.array([_pack(np.diff(slot[cut[b]:cut[b + 1]], prepend=0)) for b in full], pa.binary()),
                     pa.array([_pack(n[cut[b]:cut[b + 1]]) for b in full], pa.binary())],
                    names=["bucket", "block", "slots", "train"])
    return run


def _answer_pairs(asked: pa.Table) -> pa.Table:
    """Training counts of one bucket's pairs for every block that asked."""
    slots = [np.cumsum(_unpack(x.as_buffer())).astype(np.uint32) for x in asked.column("slots")]
    _, at = np.unique(np.concatenate(slots), return_inverse=True)
    count = np.bincount(at, weights=np.concatenate([_unpack(x.as_buffer()) for x in asked.column("train")])).astype(np.int64)[at]
    cut = np.concatenate([[0], np.cumsum([len(x) for x in slots])])
    return pa.table({"block": asked.column("block"), "bucket": asked.column("bucket"),
                     "counts": pa.array([_pack(count[a:b]) for a, b in zip(cut[:-1], cut[1:])], pa.binary())})


def _score(model, kind: str):
    """cogroup function: the documents of one block, with the counts of its dictionary."""
    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        m = model.value
        block, answers = block.combine_chunks(), answers.sort_by("bucket")
        paired = [answers.filter(pc.equal(answers.column("round"), r)) for r in range(len(ROUNDS))]
        answers = answers.filter(pc.equal(answers.column("round"), -1))
        held, count = _bytes(block.column("held"), 0, bool), _bytes(block.column("counts"), 0, np.int32)
        token = _tokens(block.column("tokens"), 0, count)
        ending = _bytes(block.column("endings"), 0, np.uint16)
        c = (np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in answers.column("counts")])
             if answers.num_rows else np.zeros(0, np.int64))
        cls = m["class_of"][ending].astype(np.int64)
        base = np.log10((c + 0.5) / m["base_total"])
        inside = np.log10((c + 0.5) / m["class_total"][cls])
        doc = np.repeat(np.arange(len(count)), count)
        at = np.arange(len(token)) - np.repeat(np.cumsum(count) - count, count)
        seq, pos = _with_ends(cls[token], at, count)
        owner = np.repeat(np.arange(len(count)), count + 1)
        path = m["log_class"][_histories(seq, pos), seq].astype(np.float64)
        ends = np.cumsum(count)
        p = 10.0 ** (path + np.insert(inside[token], ends, 0.0))  # the end is alone in its class
        pairs = _pairs(_bytes(block.column("words"), 0, np.uint64), token, count)
        found = np.empty(pairs.shape, dtype=np.int64)
        for kinds, part in zip(ROUNDS, paired):
            n = np.concatenate([_unpack(x.as_buffer()) for x in part.column("counts")])
            at = np.unique(pairs[list(kinds)].ravel(), return_inverse=True)[1]
            found[list(kinds)] = n[at].reshape(len(kinds), -1)
        skipped, followed, both, skips = found
        last = np.empty(len(p), dtype=np.int64)  # how often the last word is followed by anything
        last[pos > 0], last[pos == 0] = c[token], m["ends"]
        bigrams = np.empty(len(p), dtype=np.int64)
        bigrams[1:] = followed[:-1]
        bigrams[pos == 0] = m["ends"]
        for prior, (seen, of) in zip(PRIORS, ((skipped, skips), (followed, last), (both, bigrams))):
            p = (seen + prior * p) / (of + prior)
        path = np.log10(p)
        size = len(count)
        known = np.bincount(doc, weights=(c > 0)[token], minlength=size).astype(np.int64) + (m["ends"] > 0)
        score = np.bincount(owner, weights=path, minlength=size)
        plain = np.bincount(doc, weights=base[token], minlength=size) + np.log10((m["ends"] + 0.5) / m["base_total"])
        return pa.table({"doc_id": block.column("doc_ids").combine_chunks().flatten(), "held_out": pa.array(held),
                         "n_tokens": pa.array(count.astype(np.int64) + 1), "n_known": pa.array(known),
                         "train_tokens": pa.array(np.full(size, m["tokens"], np.int64)),
                         "base_score": pa.array(plain), "score": pa.array(score)})
    return run


def _free_shuffles(spark) -> None:
    """Let Spark delete the shuffle files of finished steps now, whose results are saved."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def score_texts(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", held_out(folds=FOLDS).alias("held_out"), "text")
    blocks = saved(rows.mapInArrow(_blocks, f"block bigint, doc_ids array<{kind}>, held binary, counts binary, "
                                            "tokens binary, words binary, train binary, endings binary"), "token-blocks", "zstd")
    learning = rows.where("not held_out").count()

    def added(function) -> np.ndarray:
        return blocks.mapInArrow(function, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))

    cells = np.zeros(ENDINGS * LEFTS, dtype=np.int64)
    found = added(_left_neighbours).toArrow()
    cells[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    class_of = word_classes(cells)
    log_class = train_classes(added(_class_histories(sc.broadcast(class_of))))

    size = blocks.agg(F.sum(F.length("words"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // (8 * BUCKET_WORDS)))
    asked = (blocks.select("block", "words", "train", "endings")
             .mapInArrow(_ask(buckets), "bucket bigint, block bigint, words binary, train binary, endings binary"))
    answers = saved(asked.groupBy("bucket").applyInArrow(_answer, "block bigint, bucket bigint, counts binary"),
                    "word-counts", "zstd")

    by_class = np.zeros((2, CLASSES), dtype=np.int64)
    for row in answers.where("block is null").select("counts").toLocalIterator():  # a fixed size each, one bucket at a time
        sums = np.frombuffer(row["counts"], np.int64).reshape(2, ENDINGS)
        by_class += np.stack([np.bincount(class_of, weights=s, minlength=CLASSES).astype(np.int64) for s in sums])
    tokens = int(by_class[0].sum()) + learning
    distinct = int(by_class[1].sum()) + (learning > 0)
    model = sc.broadcast({
        "class_of": class_of, "log_class": log_class, "ends": learning, "tokens": tokens,
        "base_total": tokens + 0.5 * (distinct + 1), "class_total": by_class[0] + 0.5 * (by_class[1] + 1)})
    tokens_at_most = blocks.agg(F.sum(F.length("tokens")) + F.sum(F.length("counts"))).first()[0] or 0
    answers = answers.where("block is not null").withColumn("round", F.lit(-1))
    for r, kinds in enumerate(ROUNDS):
        _free_shuffles(spark)
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-len(kinds) * tokens_at_most // (2 * BUCKET_PAIRS)))
        counted = saved(blocks.select("block", "held", "counts", "tokens", "words")
                        .mapInArrow(_ask_pairs(kinds, buckets), "bucket bigint, block bigint, slots binary, train binary")
                        .groupBy("bucket").applyInArrow(_answer_pairs, "block bigint, bucket bigint, counts binary"), "pair-counts")
        answers = answers.unionByName(counted.withColumn("round", F.lit(r)))
    schema = (f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
              "base_score double, score double")
    out = None
    for part in range(SCORED_IN):
        _free_shuffles(spark)
        mine = F.expr(f"pmod(xxhash64(block), {SCORED_IN}) = {part}")
        scored = saved(blocks.where(mine).groupBy("block").cogroup(answers.where(mine).groupBy("block"))
                       .applyInArrow(_score(model, kind), schema), "scored-blocks")
        out = scored if out is None else out.unionByName(scored)
    _free_shuffles(spark)
    return out


def op2_maxent_lm(spark, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))
