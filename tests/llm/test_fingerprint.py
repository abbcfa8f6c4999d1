import hashlib

import numpy as np
from pyspark.sql import functions as F

from quizlake.llm import fingerprint as P
from quizlake.llm.store import table
from tests.llm.helpers import AWKWARD, SF01, awkward


def exact(a, b):
    def s(t):
        w = t.lower().split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    a, b = s(a), s(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_given_documents(spark):
    docs = sorted(map(tuple, table(spark, SF01, "documents").select("doc_id", "text").collect()))
    got = {r["doc_id"]: r for r in P.op8_bottom_k_fingerprints(spark, SF01).collect()}
    assert len(got) == len(docs)
    off = []
    for i, (d, text) in enumerate(docs):
        after = docs[(i + 1) % len(docs)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        r = got[d]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        off += [r["near_edited"] - exact(text, edited), r["near_next"] - exact(text, after)]
    assert np.std(off) < 0.05 and np.abs(off).max() < 0.25
    prints = {}
    for d, text in docs:
        assert prints.setdefault(text, got[d]["fingerprint"]) == got[d]["fingerprint"]


def test_awkward_rows(spark):
    rows = P.compare_edited(awkward(spark)).collect()
    assert len(rows) == len(AWKWARD)
    order = sorted(AWKWARD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    texts = [r[1] or "" for r in order]
    want = []
    for i, t in enumerate(texts):
        half = len(t) // 2
        want.append((order[i][0], len(t), hashlib.sha256((t[:len(t) - half] + texts[(i + 1) % len(texts)][:half]).encode()).hexdigest()))
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows), key=repr) == sorted(want, key=repr)
    assert all(r["fingerprint"] == "" for r in rows if r["doc_id"] in (3, 4, 5))
    assert P.compare_edited(awkward(spark).where("false")).count() == 0
    one = P.compare_edited(awkward(spark).where("doc_id = 9")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


def test_many_small_buckets_find_the_same_successors(spark, monkeypatch):
    docs = table(spark, SF01, "documents").where("doc_id < 300").withColumn("doc_id", F.expr("cast(pow(doc_id, 3) as bigint) - 1000"))
    whole = sorted(map(tuple, P.compare_edited(docs).collect()))
    monkeypatch.setattr(P, "BUCKET_DOCS", 7)
    assert sorted(map(tuple, P.compare_edited(docs).collect())) == whole


def test_sketches_merge_and_estimate(spark):
    words = [f"t{i}" for i in range(6000)]
    rows = [(1, " ".join(words[:3000]), "a"), (2, " ".join(words[2000:6000]), "a"), (3, " ".join(words), "b"), (4, "", "c")]
    df = spark.createDataFrame(rows, "id long, text string, g string").withColumn("s", P.sketch(F.col("text")))
    got = {r["id"]: r["s"] for r in df.collect()}
    assert got[4] == [] and len(got[1]) == P.K
    est = df.alias("x").join(df.alias("y"), F.expr("x.id = 1 and y.id in (2, 3)")).select(
        F.col("y.id"), P.resemblance(F.col("x.s"), F.col("y.s")).alias("j"), P.containment(F.col("x.s"), F.col("y.s")).alias("c"),
        P.distinct_count(F.col("y.s")).alias("n")).collect()
    est = {r["id"]: r for r in est}
    assert abs(est[2]["j"] - 996 / 5992) < 0.12 and abs(est[3]["j"] - 2996 / 5996) < 0.15
    assert est[3]["c"] > 0.75 and abs(est[3]["n"] / 5996 - 1) < 0.35
    groups = {r["g"]: r["sketch"] for r in P.merge_groups(df, "g", "s").collect()}
    union = spark.createDataFrame([(got[1], got[2])], "a array<long>, b array<long>").select(P.merge(F.col("a"), F.col("b"))).first()[0]
    assert groups["a"] == union and groups["b"] == got[3]
    back = df.select(P.from_text(P.as_text(F.col("s"))).alias("t"), "s").collect()
    assert all(r["t"] == r["s"] for r in back)


def test_only_dataframe_functions(spark):
    plan = P.compare_edited(table(spark, SF01, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
