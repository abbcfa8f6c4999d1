"""Page queue: attempts, giving up, ends of categories, runs that die and go on."""

import json
import tempfile

import pytest
from pyspark.sql import functions as F

from quizlake.sources import payloads
from quizlake.sources.queue import PageQueue, recorded_transport

ITEM = {"category": "c", "type": "multiple", "difficulty": "easy", "question": "q", "correct_answer": "a",
        "incorrect_answers": ["b"]}


def _page(code, n=1):
    return json.dumps({"response_code": code, "results": [ITEM] * (n if code == 0 else 0)})


def _answers(spark, rows):
    """(category, page, [answers by attempt]); None: no answer."""
    flat = [(c, p, a, x) for c, p, xs in rows for a, x in enumerate(xs) if x is not None]
    return spark.createDataFrame(flat, "category_id long, page_no long, attempt int, payload string")


def _plan(spark, rows):
    return spark.createDataFrame([(c, p) for c, p, _ in rows], "category_id long, page_no long")


ROWS = [(1, 0, [_page(0, 2)]), (1, 1, [_page(5), _page(5), _page(0, 3)]), (1, 2, [None, _page(0)]),
        (2, 0, [_page(0)]), (2, 1, [_page(5), _page(4)]), (2, 2, [_page(0)]), (2, 3, [_page(5), _page(0)]),
        (3, 0, [_page(5)] * 9), (3, 1, [_page(0)]), (4, 0, ["<html>"]), (4, 1, [_page(0)]), (5, 0, [])]


def test_pages_are_asked_until_answered(spark):
    asked = []

    def transport(queue):
        asked.append(sorted((r.category_id, r.page_no, r.attempt) for r in queue.collect()))
        return recorded_transport(_answers(spark, ROWS))(queue)

    run = PageQueue(spark, tempfile.mkdtemp(prefix="queue-"), 4)
    assert run.run(_plan(spark, ROWS), transport) == 4
    assert len(asked[0]) == len(ROWS)
    assert asked[1] == [(1, 1, 1), (1, 2, 1), (2, 1, 1), (2, 3, 1), (3, 0, 1), (5, 0, 1)]
    assert asked[2] == [(1, 1, 2), (3, 0, 2), (5, 0, 2)]  # page 3 of category 2 lies behind the end found
    got = {(r.category_id, r.page_no): (r.attempts, r.response_code, r.action) for r in run.status().collect()}
    assert got == {(1, 0): (1, 0, "accept"), (1, 1): (3, 0, "accept"), (1, 2): (2, 0, "accept"),
                   (2, 0): (1, 0, "accept"), (2, 1): (2, 4, "stop"), (2, 2): (1, 0, "skipped"), (2, 3): (2, 0, "skipped"),
                   (3, 0): (4, 5, "gave_up"), (3, 1): (1, 0, "accept"), (4, 0): (1, None, "stop"), (4, 1): (1, 0, "skipped"),
                   (5, 0): (4, None, "gave_up")}
    rows = run.ingest("t", "s")
    assert {(int(r[0]), r[1]) for r in rows.groupBy("category_id").count().collect()} == {(1, 6), (2, 1), (3, 1)}
    assert rows.select("ordinal").distinct().count() == rows.count()
    with pytest.raises(Exception, match="response_code=|after 4 attempts"):
        run.ingest("t", "s", strict=True).collect()


def test_completeness_closes_after_retries(spark):
    rows = [(c, p, [_page(5)] * (p % 3) + [_page(0, 10)]) for c in (1, 2) for p in range(6)]
    declared = spark.createDataFrame([(1, 60), (2, 60)], "category_id long, total_question_count long")
    plan = payloads.page_plan(declared, "total_question_count", 10).select("category_id", F.col("page").alias("page_no"))
    run = PageQueue(spark, tempfile.mkdtemp(prefix="queue-"))
    run.run(plan, recorded_transport(_answers(spark, rows)))
    found = payloads.bronze_completeness(declared, run.ingest("t", "s", strict=True)).collect()
    assert [(r.category_id, r.missing) for r in sorted(found)] == [("1", 0), ("2", 0)]


def test_a_dead_run_asks_only_for_its_last_round_again(spark):
    path, asked = tempfile.mkdtemp(prefix="queue-"), []
    good = recorded_transport(_answers(spark, ROWS))

    def transport(queue):
        asked.append(queue.count())
        if len(asked) == 2:
            raise ConnectionError("lost")
        return good(queue)

    with pytest.raises(ConnectionError):
        PageQueue(spark, path, 4).run(_plan(spark, ROWS), transport)
    again = PageQueue(spark, path, 4)
    again.run(_plan(spark, ROWS), transport)
    assert asked[:3] == [12, 6, 6]
    whole = PageQueue(spark, tempfile.mkdtemp(prefix="queue-"), 4)
    whole.run(_plan(spark, ROWS), good)
    assert sorted(map(str, again.status().collect())) == sorted(map(str, whole.status().collect()))


def test_empty_plan(spark):
    run = PageQueue(spark, tempfile.mkdtemp(prefix="queue-"))
    assert run.run(_plan(spark, []), recorded_transport(_answers(spark, ROWS))) == 0
    assert run.status().count() == 0 and run.ingest("t", "s").count() == 0


def test_queries_derive_pages_and_answers_once_without_broadcasts(spark, monkeypatch):
    from quizlake.plans import catalog, fixtures

    sf = tempfile.mkdtemp(prefix="queue-sf-")
    pages = [(i, f"u{i}", f"<p>{i}</p>") for i in range(140)] + [(3, "u3", "again"), (None, "u", "no key")]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{sf}/pages.parquet")
    parts = [(i, f"part {i}", "b") for i in range(20)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string").write.parquet(f"{sf}/part.parquet")
    plan = fixtures.bronze(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    got = {}
    real = PageQueue.run

    def run(self, plan, transport):
        asked = transport(plan.withColumn("attempt", F.lit(0)))
        got["files"] = [f for df in (plan, asked) for f in df.inputFiles()]
        return real(self, plan, transport)

    monkeypatch.setattr(PageQueue, "run", run)
    assert catalog.q_retry_pages(spark, sf).count() == 16  # category 3 has an item more, one page has no category
    assert got["files"] and not any(sf in f for f in got["files"])
