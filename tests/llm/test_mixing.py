import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quizlake.llm import mixing as M
from quizlake.llm.store import table
from tests.llm.helpers import AWKWARD, SF01, awkward, spaced


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=1, max_size=12))
def test_targets(sizes):
    t = M.targets(sizes)
    assert sum(t) == pytest.approx(sum(sizes))
    assert all(x <= 3 * n + 1e-6 for x, n in zip(t, sizes))
    free = [(x / (5, 2, 1)[i % 3]) for i, (x, n) in enumerate(zip(t, sizes)) if x < 3 * n - 1e-6]
    assert all(x == pytest.approx(free[0]) for x in free)


def test_sainte_lague_equals_seat_by_seat():
    rng = random.Random(2)
    for _ in range(300):
        claims = [rng.choice([0.0, rng.random() * 100, float(rng.randint(1, 5))]) for _ in range(rng.randint(1, 9))]
        seats = rng.randint(0, 60)
        want = [0] * len(claims)
        for _ in range(seats if sum(claims) else 0):
            i = max(range(len(claims)), key=lambda i: (claims[i] / (2 * want[i] + 1), -i))
            want[i] += 1
        assert M.sainte_lague(claims, seats) == want


def test_mix_of_the_documents(spark):
    docs = table(spark, SF01, "documents")
    got = M.mix_sources(docs).cache()
    rows = got.join(docs.select("doc_id", "source", "text"), "doc_id").collect()
    assert len(rows) == docs.count() and all(r["size"] == len(spaced(r["text"])) for r in rows)
    sums = {}
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        s = sums.setdefault(r["source"], [0, 0, r["source_size"], r["target"]])
        s[0] += r["size"]
        s[1] += r["taken"]
    assert [s[0] for s in sums.values()] == [s[2] for s in sums.values()]
    want = M.targets([sums[k][0] for k in sorted(sums)])
    assert [sums[k][3] for k in sorted(sums)] == pytest.approx(want)
    assert all(abs(s[1] - s[3]) <= 0.02 * s[3] for s in sums.values())
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, M.mix_sources(docs.repartition(5)).collect()))


def test_several_shards(spark, monkeypatch):
    monkeypatch.setattr(M, "SHARD_DOCS", 50)
    got = M.mix_sources(table(spark, SF01, "documents")).agg(F.sum("taken"), F.sum("size")).first()
    assert abs(got[0] - got[1]) < 0.02 * got[1]


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = M.mix_sources(docs).collect()
    assert len(rows) == len(AWKWARD)
    assert sorted(r["size"] for r in rows) == sorted(len(spaced(a[1])) for a in AWKWARD)
    assert all(r["taken"] == 0 for r in rows if r["size"] == 0)
    out = M.mixed(docs)
    assert out.columns == [c for c in docs.columns if c not in ("size", "taken")] + ["size", "source_size", "target", "taken"]
    assert out.agg(F.sum("taken")).first()[0] == sum(r["taken"] for r in rows)
    assert out.count() == sum(r["taken"] > 0 for r in rows)
    assert M.mix_sources(docs.where("false")).count() == 0 and M.mixed(docs.where("false")).count() == 0
    blank = docs.withColumn("text", F.lit(" "))
    assert {(r["target"], r["taken"]) for r in M.mix_sources(blank).collect()} == {(0.0, 0)}


def test_targets_need_no_python_workers(spark):
    sized = spark.createDataFrame([("b", 5), (None, 7), ("a", 2), ("b", 1)], "source string, size long")
    plan = M.source_targets(sized)
    assert [(r["source"], r["rank"], r["source_size"], r["quota"]) for r in plan.orderBy("rank").collect()] == [
        ("a", 0, 2, 6), ("b", 1, 6, 6), (None, 2, 7, 3)]
    assert "ExistingRDD" not in plan._jdf.queryExecution().executedPlan().toString()
    for empty in (M.source_targets(sized.where("false")), M.source_targets(sized.where("source is null"))):
        assert empty.columns == plan.columns and empty.schema == plan.schema
        assert empty.where("source is not null").count() == 0


def test_rare_source_of_short_documents_reaches_its_target(spark, monkeypatch):
    # about one five-word document of the rare source a shard, claimed three times over
    monkeypatch.setattr(M, "SHARD_DOCS", 20)
    monkeypatch.setattr(M, "RUN", 16)
    rows = [(i, "a" if i % 20 == 0 else "b" if i % 2 else "c", " ".join(["w"] * (5 if i % 20 == 0 else 40))) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = M.mix_sources(docs).cache()
    sums = got.join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target"), F.first("source_size").alias("size")).collect()
    assert {r["source"]: (r["size"], r["target"]) for r in sums}["a"] == (1000, 3000.0)
    assert all(abs(r["taken"] - r["target"]) <= 1 for r in sums)
    assert got.where("taken < 0 or taken > 3 * size").count() == 0
    assert M.mixed(docs).where("source = 'a'").agg(F.sum("taken")).first()[0] == 3000


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 10 ** 13), min_size=1, max_size=12))
def test_quotas_are_whole_words_within_the_repeats(sizes):
    goal = M.targets(sizes)
    q = M.quotas(goal, sizes)
    assert sum(q) == sum(sizes) and all(0 <= x <= 3 * n for x, n in zip(q, sizes))
    assert all(abs(x - g) <= len(sizes) + 1e-9 * g for x, g in zip(q, goal))
