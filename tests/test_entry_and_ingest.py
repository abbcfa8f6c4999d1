"""Driver contract, ingest payloads, streaming replay."""


import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from quizlake.plans import fixtures as fx
from quizlake.sources import payloads
from quizlake.streaming.incremental import read_sink, start_incremental_scoring
from quizlake.operators.clean import clean_items
from quizlake.session import fresh_dir
from tests.conftest import SF001


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["category", "difficulty", "total_questions", "correct_answers", "accuracy_pct",
                          "avg_response_time_sec"]


def test_every_query_has_an_oracle():
    from quizlake.plans.catalog import QUERIES

    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and set(QUERIES) <= set(o) and len(QUERIES) >= 60


def test_large_page_plan(spark):
    counts = spark.createDataFrame([("huge", 10 ** 11), ("none", 0)], "category string, total long")
    plan = payloads.page_plan(counts)
    assert plan.filter("page < 3").orderBy("page").collect() == [("huge", 10 ** 11, p, 50) for p in range(3)]


def test_ordinals_stay_apart(spark):
    df = spark.createDataFrame([(1, 0, 0), (0, 1_000_000, 0), (0, 10 ** 11, 49), (1, 0, 1)], "c long, p long, i long")
    got = [r.o for r in df.select(payloads.page_ordinal(F.col("c"), F.col("p"), F.col("i")).alias("o")).collect()]
    assert len(set(got)) == 4 and got[1] < got[2] < got[0] < got[3]
    with pytest.raises(Exception, match="out of range"):
        df.select(payloads.page_ordinal(F.col("c"), F.col("p"), F.lit(64))).collect()


def test_policies(spark):
    page = '{"response_code": %s, "results": [{"question": "%s", "incorrect_answers": ["x"]}]}'
    rows = [(1, 0, page % (0, "a")), (1, 1, page % (5, "b")), (1, 2, page % (0, "c")), (1, 3, page % (4, "d")), (1, 4, page % (0, "e")),
            (2, 0, "<html>busy</html>"), (2, 1, page % (0, "f")), (3, 0, page % (0, "g"))]
    pages = spark.createDataFrame(rows, "category_id long, page_no long, payload string")
    path = fresh_dir(spark, "policy-pages")
    payloads.write_payload_files(pages, path)
    pages = payloads.read_payload_files(spark, path)
    loose = payloads.ingest_pages(pages, "t", "s")
    assert [r.question for r in loose.orderBy("ordinal").collect()] == ["a", "c", "g"]
    told = {(r.category_id, r.page_no): r.loose_action for r in payloads.payload_disposition(pages).collect()}
    assert told == {(1, 0): "accept", (1, 1): "retry", (1, 2): "accept", (1, 3): "stop", (1, 4): "skipped", (2, 0): "stop",
                    (2, 1): "skipped", (3, 0): "accept"}
    with pytest.raises(Exception, match="item bank error"):
        payloads.ingest_pages(pages, "t", "s", strict=True).collect()
    good = pages.filter("category_id = 3 or page_no < 3 and category_id = 1")
    assert payloads.ingest_pages(good, "t", "s", strict=True).count() == 3


def test_shared_folder_is_needed_on_a_cluster():
    from types import SimpleNamespace

    from quizlake.session import shared_dir

    context = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=context))


def test_stream_keys_hold_the_parameters(spark):
    from quizlake.operators.grade import echo_scorer

    base = fresh_dir(spark, "stream-keys")
    src, sink = f"{base}/src", f"{base}/sink"
    fx.bronze(spark, SF001, with_duplicates=False).write.parquet(src)
    n = clean_items(fx.bronze(spark, SF001)).count()
    for i, version in enumerate(("v1", "v2", "v2")):
        start_incremental_scoring(spark, src, None, "m", "t", sink, f"{base}/ckpt{i}", scorer=echo_scorer,
                                  prompt_version=version).awaitTermination()
        by = {r.prompt_version: r["count"] for r in read_sink(spark, sink).groupBy("prompt_version").count().collect()}
        assert by == ({"v1": n} if i == 0 else {"v1": n, "v2": n})


def test_page_plan_and_disposition(spark):
    counts = spark.createDataFrame([("a", 120), ("b", 0), ("c", 50)], "category string, total long")
    plan = {(r.category, r.page, r.amount) for r in payloads.page_plan(counts).collect()}
    assert plan == {("a", 0, 50), ("a", 1, 50), ("a", 2, 20), ("c", 0, 50)}
    pages = spark.createDataFrame([(1, 0, '{"response_code": 0}'), (1, 1, '{"response_code": 4}'),
                                   (1, 2, '{"response_code": 0}'), (2, 0, '{"response_code": 5}')],
                                  "category_id long, page_no long, payload string")
    d = {(r.category_id, r.page_no): (r.strict_action, r.loose_action)
         for r in payloads.payload_disposition(pages).collect()}
    assert d[(1, 1)] == ("fail", "stop") and d[(1, 2)] == ("accept", "skipped") and d[(2, 0)] == ("retry", "retry")


def test_ingest_keeps_json_dumps_dialect(spark):
    pages = spark.createDataFrame([(3, 0, '{"response_code": 0, "results": [{"category": "Art", "type": "multiple",'
                                          ' "difficulty": "easy", "question": "Q?", "correct_answer": "A",'
                                          ' "incorrect_answers": ["B \\"x\\"", "C"]}]}')],
                                  "category_id long, page_no long, payload string")
    r = payloads.ingest_pages(pages, "t", "recorded-api").first()
    assert r.incorrect_answers == '["B \\"x\\"", "C"]' and r.category_id == "3"


def test_stream_replay_scores_nothing_twice(spark):
    base = fresh_dir(spark, "stream-test")
    src, sink, ckpt = f"{base}/src", f"{base}/sink", f"{base}/ckpt"
    bronze = fx.bronze(spark, SF001)
    items = clean_items(bronze)
    resp = fx.responses(items)
    bronze.filter(F.col("ordinal") < fx.DUPLICATE_OFFSET).write.parquet(src)
    start_incremental_scoring(spark, src, resp, "fixture-model", "t", sink, ckpt).awaitTermination()
    n1 = read_sink(spark, sink).count()
    # second run with nothing new: no batch, same rows
    start_incremental_scoring(spark, src, resp, "fixture-model", "t", sink, ckpt).awaitTermination()
    assert read_sink(spark, sink).count() == n1
    # copies arrive later: already scored, nothing added
    bronze.filter(F.col("ordinal") >= fx.DUPLICATE_OFFSET).write.mode("append").parquet(src)
    start_incremental_scoring(spark, src, resp, "fixture-model", "t", sink, ckpt).awaitTermination()
    out = read_sink(spark, sink)
    assert out.count() == n1 == items.count()
    assert out.select("question_id").distinct().count() == n1
