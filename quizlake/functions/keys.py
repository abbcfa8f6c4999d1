"""Stable keys: JSON string quoting, the item hash and a per-item keyed shuffle."""

from __future__ import annotations

import json.encoder

from pyspark.sql import Column
from pyspark.sql import functions as F

# Control-character escapes of Python's JSON encoder (ensure_ascii=False keeps every
# other character as is), taken from the standard library.
_CONTROL_ESCAPES = {ch: esc for ch, esc in json.encoder.ESCAPE_DCT.items()
                    if ord(ch) < 0x20}


def json_quote(c: Column) -> Column:
    """JSON string literal of ``c`` exactly as ``json.dumps(s, ensure_ascii=False)``."""
    s = F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    escaped = s
    for ch, esc in _CONTROL_ESCAPES.items():
        escaped = F.replace(escaped, F.lit(ch), F.lit(esc))
    body = F.when(s.rlike("[\\x00-\\x1f]"), escaped).otherwise(s)
    return F.concat(F.lit('"'), body, F.lit('"'))


def json_string_list(*cols: Column) -> Column:
    """``json.dumps([...])`` of string columns (``", "`` separator, like Python)."""
    return F.concat(F.lit("["), F.concat_ws(", ", *[json_quote(c) for c in cols]), F.lit("]"))


def json_array_text(arr: Column) -> Column:
    """``json.dumps(list)`` of an array<string> column."""
    return F.concat(F.lit("["), F.array_join(F.transform(arr, json_quote), ", "), F.lit("]"))


def question_id(category: Column, question: Column, correct: Column, incorrect: Column) -> Column:
    """SHA-256 hex of the JSON list of the four identifying texts.

    Only these four define an item: rows differing in type, difficulty, source or
    fetch time are duplicates.
    """
    return F.sha2(json_string_list(category, question, correct, incorrect), 256)


def keyed_shuffle(arr: Column, key: Column) -> Column:
    """Reproducible per-row permutation of ``arr``: element i sorts by sha256(key:i)."""
    tagged = F.transform(arr, lambda c, i: F.struct(
        F.sha2(F.concat(key, F.lit(":"), i.cast("string")), 256).alias("k"), c.alias("c")))
    return F.transform(F.array_sort(tagged), lambda s: s["c"])
