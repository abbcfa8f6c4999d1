"""Classifiers and models: held-out results on the given tables, parts against brute force, awkward rows."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quizlake.llm import labelled, langid, lm, quality, toxicity
from quizlake.llm.store import table
from quizlake.llm.tokens import chunks
from tests.llm.helpers import AWKWARD, SF01, awkward, spaced

SF1 = "/root/testdata/sf0.1"


def fold(doc_id, folds):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds == 1


def held_out_rows(spark, scored, column, sf=SF1):
    return scored.where("held_out").join(table(spark, sf, "labels"), "doc_id").select(F.col(column).alias("y"), "predicted", "score").collect()


def test_quality_on_held_out_documents(spark):
    docs, labels = table(spark, SF1, "documents"), table(spark, SF1, "labels")
    scored = quality.score_quality(docs, labels).cache()
    rows = held_out_rows(spark, scored, "quality")
    assert np.mean([r["y"] == r["predicted"] for r in rows]) > 0.97
    assert scored.count() == docs.count()
    assert all(r["held_out"] == fold(r["doc_id"], 3) for r in scored.collect())


def test_dual_coordinate_descent_reaches_the_margin():
    rng = np.random.default_rng(0)
    rows = []
    for i in range(200):
        y = i % 2
        noise = rng.choice(np.arange(100, 400), 15, replace=False)
        rows.append((y, np.sort(np.concatenate([[y * 7 + 3], noise])).astype(np.uint32)))
    m = quality.fit(rows)
    margin = np.array([m["w"][f].sum() / math.sqrt(len(f)) + m["bias"] for _, f in rows])
    y = np.array([r[0] for r in rows])
    assert ((margin > 0) == (y == 1)).all()
    assert ((labelled.sigmoid(m["a"] * margin + m["b"]) > 0.5) == (y == 1)).all()


def test_indicators_are_distinct_and_sorted():
    (_, _, data, off), = chunks(pa.array(["aaa aaa aaa", "", None, "aaa aaa aaa", "B!! C!!"]))
    doc, f = quality.indicators(data, off)
    sets = [f[doc == i].tolist() for i in range(5)]
    assert sets[0] == sets[3] and not sets[1] and not sets[2] and sets[4]
    assert all(s == sorted(set(s)) for s in sets)


@pytest.mark.parametrize("score", [quality.score_quality, toxicity.score_toxicity])
def test_classifiers_on_awkward_rows(spark, score):
    docs = awkward(spark)
    labels = spark.createDataFrame([(1, 1, 1), (1, 0, 0), (2, 1, 1), (6, 0, 0), (9, None, None), (None, 1, 1), (10, 7, 7),
                                    (11, 0, 0), (12, 1, 1)], "doc_id long, quality int, toxic int")
    for some in (labels, labels.where("doc_id = 2"), labels.where("false")):
        rows = score(docs, some).collect()
        assert len(rows) == len(AWKWARD)
        assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in rows)
        by = {}
        for r, text in zip(rows, (a[1] for a in AWKWARD)):
            assert by.setdefault(text or "", r["score"]) == pytest.approx(r["score"])
    assert score(docs.where("false"), labels).count() == 0


def test_toxicity_on_held_out_documents(spark):
    docs, labels = table(spark, SF1, "documents"), table(spark, SF1, "labels")
    scored = toxicity.score_toxicity(docs, labels).cache()
    rows = held_out_rows(spark, scored, "toxic")
    assert np.mean([r["predicted"] for r in rows if r["y"] == 0]) < 0.02
    # in this table other languages' toxic labels fall on texts like all others
    english = docs.where("lang = 'en'").select("doc_id")
    rows = held_out_rows(spark, scored.join(english, "doc_id", "left_semi"), "toxic")
    assert np.mean([r["predicted"] for r in rows if r["y"] == 1]) > 0.85


def test_network_gradients():
    rng = np.random.default_rng(1)
    net = toxicity.Network(rng.normal(size=32).astype(np.float32), rng.normal(size=32).astype(np.float32))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    kind, starts, piece = np.array([3, 5, 9, 3]), np.array([0, 2, 3, 6]), rng.integers(0, 32, 8)
    at = rng.integers(0, 4, (3, toxicity.WINDOW))
    mask = np.arange(toxicity.WINDOW) < np.array([[32], [5], [1]])
    y, weight = np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])

    def loss():
        p = labelled.sigmoid(net.forward(net.inputs(kind, starts, piece), at, mask).astype(np.float64))
        return -np.sum(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))) / weight.sum()

    g = net.gradients(kind, starts, piece, at, mask, y, weight)
    for name, v in net.p.items():
        flat = v.reshape(-1)
        for i in rng.choice(len(flat), min(4, len(flat)), replace=False):
            old = flat[i]
            flat[i] = old + 1e-2
            up = loss()
            flat[i] = old - 1e-2
            down = loss()
            flat[i] = old
            assert g[name].reshape(-1)[i] == pytest.approx((up - down) / 2e-2, abs=3e-3), name


def test_windows_cover_every_word():
    count = np.array([0, 1, 31, 32, 33, 48, 49, 500])
    first = np.cumsum(count) - count
    doc, start, size = toxicity.windows_of(count, first)
    for i, n in enumerate(count):
        mine = doc == i
        seen = set()
        for s, k in zip(start[mine], size[mine]):
            assert first[i] <= s and s + k <= first[i] + n
            seen.update(range(s, s + k))
        assert len(seen) == n and mine.any()


def test_language_on_held_out_documents(spark):
    docs = table(spark, SF01, "documents")
    found = langid.predict(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert found.where("lang = lang_pred").count() / found.count() > 0.97
    assert langid.predict(docs).where("rejected").count() == 0


def test_kneser_ney_is_a_distribution():
    doc, gram, letters = langid.streams(["the cat sat on the mat", "", None, "12 3", "über"])
    assert letters.tolist() == [True, False, False, False, True] and set(doc.tolist()) == {0, 4}
    kinds, n = np.unique(gram, return_counts=True)
    model = langid.KneserNey(kinds, n)
    for context in (0, int(gram[5]) >> 6, 12345):
        total = model.prob((context << 6) + np.arange(langid.SYMBOLS)).sum()
        assert total == pytest.approx(1.0)
    assert model.prob(kinds.astype(np.int64)).min() > 0


def test_language_counts_agree_with_whole_text_counting(spark, monkeypatch):
    monkeypatch.setattr(langid, "BATCH_CHARS", 50)
    monkeypatch.setattr(langid, "FLUSH_GRAMS", 100)
    rows = [(i, f"words number {i} and {i * 7 % 13} letters abc", "en" if i % 2 else "de") for i in range(60)] + [(None, "xyz", "en"), (70, None, "en"), (71, "q", None)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    for lang in ("de", "en"):
        texts = [t for i, t, x in rows if x == lang and t is not None and not fold(i, 3)]
        kinds, n = np.unique(langid.streams(texts)[1], return_counts=True)
        own = model.models[model.langs.index(lang)]
        want = langid.KneserNey(kinds, n)
        assert (own.grams[-1] == want.grams[-1]).all() and np.allclose(own.probs[-1], want.probs[-1])


def test_language_on_awkward_rows(spark):
    docs = awkward(spark)
    rows = {(r["doc_id"], r["lang_pred"]): r for r in langid.predict(docs).collect()}
    assert {k for k in rows if k[1] == "und"} == {(3, "und"), (4, "und"), (5, "und"), (11, "und"), (12, "und")}
    assert all(r["rejected"] and r["score"] == 0 for k, r in rows.items() if k[1] == "und")
    out = langid.accepted(docs)
    assert out.columns == docs.columns and {3, 4, 5, 11, 12}.isdisjoint(r["doc_id"] for r in out.collect())
    assert langid.predict(docs.where("false")).count() == 0
    assert {r["lang_pred"] for r in langid.predict(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_lm_base_counts_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_BYTES", 2000)
    rows = [r[:2] for r in AWKWARD] + [(100 + i, f"the word {i % 7} and the {i % 3} others") for i in range(80)]
    got = lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    count = Counter()
    for d, text in rows:
        if not fold(d, 5):
            count.update([*spaced(text), None])
    total, distinct = sum(count.values()), len(count)

    def base(text):
        tokens = [*spaced(text), None]
        return (len(tokens), sum(count[w] > 0 for w in tokens), total,
                round(sum(math.log10((count[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in tokens), 4))

    want = sorted(((d, fold(d, 5), *base(t)) for d, t in rows), key=repr)
    have = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4))
                   for r in got), key=repr)
    assert have == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)


def test_lm_beats_its_base_on_held_out_texts(spark):
    held = lm.score_texts(table(spark, SF01, "documents")).where("held_out")
    row = held.agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert (row[0] - row[1]) / row[2] > 0.1


def test_lm_class_softmax(spark):
    cells = spark.createDataFrame([(5 * 32 + 3, 40), (5 * 32 + 4, 10), (7 * 32 + 1, 5), (0 * 32 + 1, 30)], "cell long, n long")
    log_class = lm.train_classes(cells, updates=25)
    assert np.allclose((10.0 ** log_class).sum(axis=1), 1, atol=1e-3)
    assert log_class[5, 3] > log_class[5, 4] > log_class[5, 9]
    assert lm.score_texts(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def lm_scores(spark, rows):
    got = lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return {r["doc_id"]: r["score"] for r in got}


def test_lm_word_features_follow_the_history(spark, monkeypatch):
    # every noun has the ending, class and count of the others: only the words before tell them apart
    monkeypatch.setattr(lm, "BLOCK_BYTES", 2000)
    train = [i for i in range(2000) if not fold(i, 5)]
    test = [i for i in range(2000) if fold(i, 5)]
    verbs, nouns = [f"v{k}ing" for k in range(10)], [f"n{k}ess" for k in range(10)]
    rows = [(d, f"{verbs[i % 10]} xx {nouns[i % 10]} {verbs[(i + 3) % 10]} {nouns[(i + 3) % 10]}") for i, d in enumerate(train)]
    seen, skip, last = test[:3]
    rows += [(seen, "v4ing xx n4ess v7ing n7ess"), (skip, "v4ing xx n5ess v7ing n7ess"), (last, "v4ing xx n4ess v7ing n6ess")]
    score = lm_scores(spark, rows)
    assert score[seen] > score[skip] + 1 and score[seen] > score[last] + 1


def test_lm_word_features_against_counts(spark, monkeypatch):
    # a prior near 0 leaves the counted share of one feature, a huge one leaves the feature out
    monkeypatch.setattr(lm, "BLOCK_BYTES", 500)
    monkeypatch.setattr(lm, "BUCKET_PAIRS", 50)
    rows = [(d, " ".join(f"w{(d * k + k) % 7}" for k in range(d % 6))) for d in range(300) if not fold(d, 5)]
    count = Counter()
    for _, text in rows:
        words = ["<", "<", *text.split(), ">"]
        for a, b, w in zip(words, words[1:], words[2:]):
            count.update([("skip", a, w), ("skip", a), ("last", b, w), ("last", b), ("both", a, b, w), ("both", a, b)])
    for j, name in enumerate(("skip", "last", "both")):
        monkeypatch.setattr(lm, "PRIORS", tuple(1e-9 if i == j else 1e15 for i in range(3)))
        got = lm_scores(spark, rows)
        for d, text in rows:
            words = ["<", "<", *text.split(), ">"]
            want = 0.0
            for a, b, w in zip(words, words[1:], words[2:]):
                key = {"skip": (a,), "last": (b,), "both": (a, b)}[name]
                want += math.log10(count[(name, *key, w)] / count[(name, *key)])
            assert got[d] == pytest.approx(want, abs=1e-6)


def test_blocks_are_scored_in_parts_of_their_own(spark, monkeypatch):
    sizes, codecs, whole = [], {}, lm.saved

    def noted(df, name, *codec):
        out = whole(df, name, *codec)
        codecs[name] = codec
        if name == "scored-blocks":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(lm, "BLOCK_BYTES", 300)  # many blocks
    monkeypatch.setattr(lm, "saved", noted)
    rows = [(i, f"word{i % 7} and word{i % 5} are here " * (i % 9)) for i in range(200)]
    got = lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(200))
    assert len(sizes) == lm.SCORED_IN and sum(sizes) == 200 and max(sizes) < 150
    assert codecs["token-blocks"] == codecs["word-counts"] == ("zstd",)
