"""Property-based checks of the byte-exact text functions against Python."""

import hashlib
import html
import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quizlake.functions import html_decode, json_quote, normalize_answer, question_id

PIECES = list("ab &;#x0123456789lgtampquoé\t\n\x1f\\\"'") + ["&amp;", "&#39;", "&lt", "&notin;", " . "]
TEXT = st.lists(st.sampled_from(PIECES), max_size=12).map("".join)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.tuples(TEXT, TEXT, TEXT, TEXT), min_size=40, max_size=40))
def test_text_functions_match_python(spark, rows):
    df = spark.createDataFrame(rows, "a string, b string, c string, d string")
    out = df.select("a", "b", "c", "d",
                    question_id(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("qid"),
                    json_quote(F.col("a")).alias("jq"), html_decode(F.col("b")).alias("dec"),
).collect()
    for r in out:
        assert r.qid == hashlib.sha256(json.dumps([r.a, r.b, r.c, r.d], ensure_ascii=False).encode()).hexdigest()
        assert r.jq == json.dumps(r.a, ensure_ascii=False)
        assert r.dec == html.unescape(r.b)



#: Answers and their comparison keys.
KEYS = [(" Mount Fuji. ", "mount fuji"), ("MOUNT FUJI", "mount fuji"), ("mount fuji..", "mount fuji."), ("Mount Fuji .", "mount fuji"),
        ("R &amp; D", "r & d"), ("&lt;B&gt;.", "<b>"), ("", ""), (" . ", ""), ("\u00c9T\u00c9\u00a0", "\u00e9t\u00e9"), ("It is Mount Fuji.", "it is mount fuji")]


def test_answer_keys(spark):
    df = spark.createDataFrame(KEYS, "a string, k string")
    assert all(r.n == r.k for r in df.select("k", normalize_answer(F.col("a")).alias("n")).collect())
