"""Grading: success path, failure classification, scorer hook."""

import json


from quizlake.operators.clean import clean_items
from quizlake.operators.grade import echo_scorer, grade_responses, score_batch
from quizlake.schemas import RESPONSE_SCHEMA

ROW = {"ordinal": 1, "question": "Highest &amp; snowiest peak?", "correct_answer": "Mount Fuji",
       "incorrect_answers": '["Mount Aso"]', "category": "Geo", "type": "multiple", "difficulty": "hard"}
GOOD = '{"choices": [{"message": {"content": "x"}, "finish_reason": "stop"}]}'

#: Payloads and the errors they give.
MALFORMED = [
    ('{"choices": [', "JSONDecodeError"), (GOOD + " trailing", "JSONDecodeError"), (GOOD + "]", "JSONDecodeError"),
    (GOOD + ", {}", "JSONDecodeError"), (None, "JSONDecodeError"), ("[1, 2]", "inattendu"), ('"text"', "inattendu"),
    ('{"choices": []}', "IndexError"), ('{"error": 1}', "KeyError: 'choices'"), ('{"choices": null}', "TypeError: 'NoneType'"),
    ('{"choices": {}}', "KeyError: 0"), ('{"choices": "s"}', "TypeError: string indices"), ('{"choices": [3]}', "TypeError: 'int'"),
    ('{"choices": [{}]}', "KeyError: 'message'"), ('{"choices": [{"message": []}]}', "TypeError: list indices"),
    ('{"choices": [{"message": {}}]}', "KeyError: 'content'"), ('{"choices": [{"message": {"content": 42}}]}', "non textuelle"),
    ('{"choices": [{"message": {"content": {"a": 1}}}]}', "non textuelle"), ('{"choices": [{"message": {"content": " "}}]}', "non textuelle"),
]


def _items(spark, **over):
    return clean_items(spark.createDataFrame([{**ROW, **over}]))


def _reply(content, finish="stop"):
    return json.dumps({"choices": [{"message": {"content": content}, "finish_reason": finish}]})


def _grade(spark, items, payload, transport=None, rt=0.5):
    qid = items.first().question_id
    resp = spark.createDataFrame([("m", qid, payload, rt, transport)], RESPONSE_SCHEMA)
    return grade_responses(items, resp, "m", "2024-01-01T00:00:00+00:00").first()


def test_right_answer(spark):
    items = _items(spark)
    rows = [_grade(spark, items, _reply(text)) for text in ("Mount Fuji.", " MOUNT FUJI", "It is Mount Fuji.")]
    assert [r.ai_correct for r in rows] == [True, True, False] and {r.status for r in rows} == {"success"}
    assert len({r.choices for r in rows}) == 1 and rows[0].question_clean == "Highest & snowiest peak?"


def test_malformed_replies(spark):
    items = _items(spark)
    for payload, error in MALFORMED:
        r = _grade(spark, items, payload)
        assert r.status == "error" and r.ai_correct is None and error in r.error, (payload, r.error)
        assert r.response_time == 0.5
    r = _grade(spark, items, None, "Timeout: timeout")
    assert r.error == "Timeout: timeout" and r.ai_answer is None


def test_truncated_answer_is_error_but_kept(spark):
    r = _grade(spark, _items(spark), _reply("Mount", "length"))
    assert r.status == "error" and r.ai_answer == "Mount" and r.ai_correct is None
    assert "tronquée" in r.error


def test_equal_replies_take_the_shorter_time(spark):
    items = _items(spark)
    qid = items.first().question_id
    resp = spark.createDataFrame([("m", qid, GOOD, t, None) for t in (3.0, 1.0, 2.0)], RESPONSE_SCHEMA)
    assert grade_responses(items, resp, "m", "t").first().response_time == 1.0


def test_scorer_rows_are_isolated(spark):
    items = clean_items(spark.createDataFrame([{**ROW, "ordinal": i, "question": f"Question {i}"} for i in range(6)]))
    bad = items.orderBy("ordinal").first().question_id

    def one_fails(pdf):
        if bad in set(pdf["question_id"]):
            raise ConnectionError("offline")
        return echo_scorer(pdf)

    def loses_two(pdf):
        return echo_scorer(pdf).assign(question_id=pdf["question_id"]).iloc[2:]

    def wrong_length(pdf):
        return echo_scorer(pdf).iloc[1:] if len(pdf) > 1 else echo_scorer(pdf)

    replies = score_batch(items, one_fails, "m").collect()
    assert len(replies) == 6 and [r.question_id for r in replies if r.transport_error] == [bad]
    replies = score_batch(items.coalesce(1), loses_two, "m").collect()
    assert len(replies) == 6 and sum("no reply" in (r.transport_error or "") for r in replies) == 2
    replies = score_batch(items.coalesce(1), wrong_length, "m").collect()
    assert len(replies) == 6 and not any(r.transport_error for r in replies)


def test_item_errors_are_never_sent(spark):
    items = _items(spark, incorrect_answers="{not a list")
    seen = []

    def scorer(pdf):
        seen.append(len(pdf))
        return echo_scorer(pdf)

    resp = score_batch(items, scorer, "m")
    assert resp.count() == 0
    r = grade_responses(items, resp, "m", "t").first()
    assert r.status == "error" and r.ai_correct is None and r.response_time is None
    assert "liste JSON invalide" in r.error


def test_scorer_failure_gives_error_rows(spark):
    items = _items(spark)

    def broken(pdf):
        raise ConnectionError("offline")

    resp = score_batch(items, broken, "m")
    r = grade_responses(items, resp, "m", "t").first()
    assert r.status == "error" and r.error == "ConnectionError: offline"


def test_echo_scorer_end_to_end(spark):
    items = _items(spark)
    resp = score_batch(items, echo_scorer, "m", partitions=2)
    r = grade_responses(items, resp, "m", "t").first()
    assert r.status == "success" and r.ai_answer in json.loads(r.choices)
