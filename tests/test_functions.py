"""Scalar expressions against the Python semantics they reproduce."""

import hashlib
import html
import json
import random

from pyspark.sql import functions as F

from quizlake.functions import (html_decode, json_quote, keyed_shuffle, make_prompt, normalize_answer,
                                parse_distractors, question_id, strip_ws)
from quizlake.functions.htmlref import html_decode_array, html_decode_general


def _one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr(F.col("s")).alias("x")).first().x


def test_html_decode_matches_stdlib(spark):
    random.seed(3)
    toks = ["&amp;", "&lt;", "&#039;", "&quot;", "&eacute;", "&amp;lt;", "&#38;", "&#x26;", "&ampx",
            "&notin;", "&notit;", "&#112;", "&am", "&", ";", "a", " ", "&#0;", "&#xD800;", "&#128;",
            "&#99999999999;", "&AElig", "&lt", " ", "é"]
    cases = ["".join(random.choice(toks) for _ in range(random.randint(0, 7))) for _ in range(1500)]
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    rows = df.select("s", html_decode(F.col("s")).alias("d"), html_decode_general(F.col("s")).alias("g"),
                     html_decode_array(F.array("s", F.lit("&lt;"))).alias("a")).collect()
    for r in rows:
        assert r.d == html.unescape(r.s), r.s
        assert r.g == html.unescape(r.s), r.s
        assert list(r.a) == [html.unescape(r.s), "<"], r.s


def test_strip_is_unicode_whitespace(spark):
    for v in ["  x  ", "\x1c x\x1f", "\t\n x \r", "x"]:
        assert _one(spark, strip_ws, v) == v.strip()


INVALID, EMPTY, BAD = "JSON invalide", "non vide", "non textuelle"

#: Distractor lists and what they give: the answers, or a part of the error text.
LISTS = [
    ('["North"]', ["North"]), ("['Salt &amp; Pepper']", ["Salt & Pepper"]), ('  [ "x" , "y" ]  ', ["x", "y"]),
    ('["\\u00e9\\n"]', ["é"]), ("[\"It's\", 'b']", ["It's", "b"]), ("['It\\'s']", ["It's"]), ('["a",]', ["a"]),
    ("[\"say 'hi'\", 'say \"yo\"']", ["say 'hi'", 'say "yo"']), ("['caf\\xa0']", ["caf"]), ("['x\\u200b y']", ["x\u200b y"]),
    ("['a' 'b']", ["ab"]), ("['\\U0001F600', '\\101\\t.']", ["\U0001F600", "A\t."]), ("[u'x', 'a\\qb']", ["x", "a\\qb"]),
    ("plain words", INVALID), ("", INVALID), ("[1, 2", INVALID), ("['a'] x", INVALID), ('["a"] x', INVALID), ("[a]", INVALID),
    ("['a\nb']", INVALID),
    ("{}", EMPTY), ("[]", EMPTY), ("[ ]", EMPTY), ("()", EMPTY), ('{"a": 1}', EMPTY), ('"text"', EMPTY), ("'text'", EMPTY),
    ("('a','b')", EMPTY), ("{'a': 1}", EMPTY), ("{'a', 'b'}", EMPTY), ("None", EMPTY), ("12", EMPTY), ("'a', 'b'", EMPTY),
    ("{'k': ['v', {'w': (1, 2)}]}", EMPTY),
    ("[7]", BAD), ('["a",1]', BAD), ('["a",null]', BAD), ('["a"," "]', BAD), ('[["a"]]', BAD), ("['ok', None]", BAD),
    ("['a', 1.5, -2]", BAD), ("[['a'], ('b',)]", BAD), ("[True]", BAD), ("['']", BAD), ("['\\n']", BAD),
]


def test_distractor_lists(spark):
    df = spark.createDataFrame([(c,) for c, _ in LISTS], "s string")
    got = {r.s: r.p for r in df.select("s", parse_distractors(F.col("s")).alias("p")).collect()}
    for text, want in LISTS:
        p = got[text]
        if isinstance(want, list):
            assert p.error is None and list(p.answers) == want, (text, p)
            assert (p.warning is not None) == (p.dialect == "literal"), text
        else:
            assert p.answers is None and want in p.error and p.warning is None, (text, p)


def test_question_id_matches_python_json_dumps(spark):
    items = [("Art", "Who &amp; when?", "Leonardo da Vinci", '["Other"]'),
             ("Scié", 'q"\\\x1f\t ', "c\x0b\x7f", "[]"), ("", "", "", "")]
    df = spark.createDataFrame(items, "a string, b string, c string, d string")
    got = df.select(question_id(*[F.col(x) for x in "abcd"]).alias("h"), "a", "b", "c", "d").collect()
    for r in got:
        exp = hashlib.sha256(json.dumps([r.a, r.b, r.c, r.d], ensure_ascii=False).encode()).hexdigest()
        assert r.h == exp


def test_json_quote_matches_python(spark):
    vals = ["plain", 'q"', "b\\s", "".join(chr(i) for i in range(32)), "é "]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    for r in df.select("s", json_quote(F.col("s")).alias("q")).collect():
        assert r.q == json.dumps(r.s, ensure_ascii=False)


def test_deterministic_choices_and_prompt(spark):
    df = spark.createDataFrame([("a" * 64, ["Leonardo da Vinci", "Other", "Third"])], "k string, c array<string>")
    one = df.select(keyed_shuffle(F.col("c"), F.col("k")).alias("x")).first().x
    two = df.select(keyed_shuffle(F.col("c"), F.col("k")).alias("x")).first().x
    assert one == two and sorted(one) == sorted(["Leonardo da Vinci", "Other", "Third"])
    p = df.select(make_prompt(F.lit("Who?"), F.col("c")).alias("p")).first().p
    assert "Question :\nWho?\n\n" in p and "- Leonardo da Vinci\n- Other\n- Third" in p
    assert p.endswith("\n\nRéponse :")


def test_iso_utc_matches_isoformat(spark):
    from datetime import datetime, timezone

    from quizlake.functions.timefmt import iso_utc

    vals = [datetime(2024, 1, 2, 3, 4, 5, tzinfo=timezone.utc),
            datetime(2024, 1, 2, 3, 4, 5, 120, tzinfo=timezone.utc)]
    df = spark.createDataFrame([(v,) for v in vals], "t timestamp")
    got = [r.x for r in df.select(iso_utc(F.col("t")).alias("x")).collect()]
    assert got == [v.isoformat() for v in vals]


def test_iso_timestamps_query_matches_isoformat(spark):
    from datetime import timezone

    import __spark_entry__ as E
    from tests.conftest import SF001

    got = {r.event_id: r.fetched_at for r in E.queries()["iso_timestamps"](spark, SF001).collect()}
    src = spark.read.parquet(f"{SF001}/events.parquet").select("event_id", "ts").collect()
    assert len(got) == len(src) > 0
    assert all(got[r.event_id] == r.ts.replace(tzinfo=timezone.utc).isoformat() for r in src)
