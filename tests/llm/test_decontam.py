import hashlib
import random

import pytest
from pyspark.sql import functions as F

from quizlake.llm import decontam as D
from tests.llm.helpers import AWKWARD, alnum, awkward


def brute(docs, items, window=10):
    windows = {}
    for item, text in items:
        w = alnum(text)
        n = min(window, len(w))
        for j in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[j:j + n]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = alnum(text), set(), set()
        for n in {len(k) for k in windows}:
            for j in range(len(w) - n + 1):
                if tuple(w[j:j + n]) in windows:
                    found |= windows[tuple(w[j:j + n])]
                    hit.update(range(j, j + n))
        out.append((doc, len(w), len(hit), len(found),
                    hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def random_case(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "Ab", "c1", "é", "dd", "e"]

    def some(n):
        return rng.choice([" ", ", ", "-"]).join(rng.choice(vocabulary) for _ in range(n))

    items = [(i, some(rng.choice([0, 1, 2, 3, 9, 10, 11, 25]))) for i in range(12)]
    items += [(99, items[-1][1]), (100, None), (101, "a a a a a a a a a a a a a")]
    docs = [(i, some(rng.randint(0, 60))) for i in range(60)]
    docs += [(200 + i, some(4) + " " + (t or "") + " " + some(5)) for i, t in items]
    return docs, items


@pytest.mark.parametrize("seed,block_words", [(1, 10), (2, 40), (3, D.BLOCK_WORDS)])
def test_match_equals_brute_force(spark, monkeypatch, seed, block_words):
    docs, items = random_case(seed)
    if seed != 3:  # without single-word items most runs are short
        items = [(i, t) for i, t in items if len(alnum(t)) != 1]
    docs += [r[:2] for r in AWKWARD]
    monkeypatch.setattr(D, "find_spans", lambda d, b, window: FIND(d, b, window=window, block_words=block_words))
    got = D.match(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, items)


FIND = D.find_spans


def test_automaton_tracks_the_longest_match():
    import numpy as np

    rng = random.Random(4)
    for _ in range(50):
        items = [[rng.randrange(4) for _ in range(rng.randint(1, 14))] for _ in range(4)]
        a = D.SuffixAutomaton([(str(i), np.array(x, np.uint64)) for i, x in enumerate(items)], 5)
        code = {int(v): i for i, v in enumerate(a.vocab)}
        text = [rng.randrange(4) for _ in range(40)]
        found = {tuple(x[i:j]) for x in items for i in range(len(x)) for j in range(i + 1, len(x) + 1)}
        for i, _, length in a.stream([code.get(x, -1) for x in text]):
            want = max([n for n in range(1, i + 2) if tuple(text[i + 1 - n:i + 1]) in found], default=0)
            assert length == want


def test_decontaminate_cuts_spans_and_keeps_clean_texts(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    rows = AWKWARD + [(20, f"Before this, {item.upper()}! After that some more words stand", "en", "a"),
                      (21, item, "en", "a"), (22, "alpha beta gamma only", "en", "a")]
    docs = awkward(spark, rows)
    out = D.decontaminate(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert out.columns == docs.columns
    got = {(r["doc_id"], r["text"]): r for r in out.collect()}
    assert (21, item) not in got
    assert all((d, t) in got for d, t, *_ in AWKWARD) and (22, "alpha beta gamma only") in got
    cut = next(r for r in got.values() if r["doc_id"] == 20)
    assert cut["text"] == "Before this, ! After that some more words stand" and cut["n_chars"] == len(cut["text"])
    again = D.match(out, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert again.where("contaminated").count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_all_blocks_in_one_python_worker_a_task(spark, monkeypatch, seed):
    docs, items = random_case(seed)
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(items, "item_id long, text string")

    def rows(block_words):
        monkeypatch.setattr(D, "BLOCK_WORDS", block_words)
        out = D.decontaminate(docs, items)
        found = D.find_spans(docs, items, block_words=block_words)
        for df in (out, found):  # a second pass in the same task would hold a second worker
            assert df._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
        return sorted(map(repr, out.collect())), sorted(map(repr, found.collect()))

    assert rows(15) == rows(200_000)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, n_chars long")
    items = spark.createDataFrame([], "item_id long, text string")
    assert D.match(none, items).count() == 0 and D.decontaminate(none, items).count() == 0
    got = D.match(awkward(spark), items)
    assert got.count() == len(AWKWARD) and got.where(F.col("n_hit") > 0).count() == 0
