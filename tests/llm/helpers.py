"""Small awkward tables shared by the operator tests."""

import re

from pyspark.sql import functions as F

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
CLASHES = ["n", "sid", "size", "score", "key", "bucket", "taken", "held_out", "y"]


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s or "")


def spaced(s):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(s))


def alnum(s):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(s))


def shingles(s, k=5):
    w = spaced(s)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
AWKWARD = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a"),
    (3, None, "en", "b"), (4, "", "fr", None), (5, " \t\n\r\x0b\x0c ", None, None),
    (6, LONG, "en", "a"), (7, LONG + " tail", "en", "a"), (8, "one", "en", "c"), (8, "one", "en", "c"),
    (9, "one two three", None, "é"), (None, "no identifier here but some words", "en", "a"),
    (10, "Ünïcödé wörds ärè fïné ŝo many of them in a row łike this one", "xx", "\U0001F600"),
    (11, "1234 5678 -- ++ !!", "en", "a"), (12, "\U0001F600 \U0001F600​", "en", "a"),
    (-5, "negative id", "en", "b"), (9_000_000_000, "A very large identifier", "de", "b"),
]


def awkward(spark, rows=AWKWARD):
    """documents with nulls, empty and very long texts, repeated rows and clashing extra columns."""
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    df = df.withColumn("n_chars", F.length("text").cast("bigint"))
    for c in CLASHES:
        df = df.withColumn(c, F.lit("clash"))
    return df
