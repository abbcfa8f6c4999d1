"""Distractor lists stored as text, in two dialects.

Bronze files hold ``incorrect_answers`` either as a JSON list (``["a", "b"]``) or as a
Python literal list (``['a', "b",]``). The JSON dialect is accepted silently, the
literal one with a warning, anything else is an error row. Anchored regular
expressions decide the dialect first, because Spark's JSON reader on its own is too
lenient (it turns ``[1]`` into ``["1"]`` and accepts single quotes). The gates use
possessive quantifiers so a very long element cannot exhaust the regex stack.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quizlake import constants as K
from quizlake.functions.text import html_decode_array, is_blank, strip_ws

_JSON_WS = "[ \\t\\n\\r]"
_JSON_STR = '"[^"\\\\\\x00-\\x1f]*+(?:\\\\(?:["\\\\/bfnrt]|u[0-9A-Fa-f]{4})[^"\\\\\\x00-\\x1f]*+)*+"'
JSON_LIST_GATE = (
    f"\\A{_JSON_WS}*\\[{_JSON_WS}*(?:{_JSON_STR}{_JSON_WS}*(?:,{_JSON_WS}*{_JSON_STR}{_JSON_WS}*)*+)?\\]{_JSON_WS}*\\z"
)

# Python literals. Strings: either quote, any escape (an unknown one keeps its backslash, \N{..} is
# not admitted), an optional u prefix; neighbouring strings join.
_PY_WS = "[ \\t\\n\\r\\f]"
_PY_ESCAPE = "\\\\(?:x[0-9A-Fa-f]{2}|u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|[^xuUN])"
_PY_STR = (f"[uU]?(?:\"(?:[^\"\\\\\\n\\r\\x00]++|{_PY_ESCAPE})*+\"|'(?:[^'\\\\\\n\\r\\x00]++|{_PY_ESCAPE})*+')")
_PY_TEXT = f"{_PY_STR}(?:{_PY_WS}*{_PY_STR})*+"
LITERAL_LIST_GATE = (
    f"\\A[ \\t]*\\[{_PY_WS}*(?:{_PY_TEXT}{_PY_WS}*(?:,{_PY_WS}*{_PY_TEXT}{_PY_WS}*)*+,?{_PY_WS}*)?\\]{_PY_WS}*\\z"
)
# Any literal, by reduction: texts, other scalars and finally containers become marks.
_TEXT_MARK, _SCALAR_MARK, _CONTAINER_MARK = "\ue001", "\ue002", "\ue003"
_MARK = "[\ue001-\ue003]"
_SCALAR = "(?<![\\w.])(?:None|True|False|[+-]?(?:\\d[\\d_]*+\\.?\\d*+|\\.\\d++)(?:[eE][+-]?\\d++)?j?)(?![\\w.])"
_SERIES = f"(?:{_MARK}{_PY_WS}*(?:,{_PY_WS}*{_MARK}{_PY_WS}*)*+,?{_PY_WS}*)?"
_ENTRY = f"{_MARK}{_PY_WS}*:{_PY_WS}*{_MARK}{_PY_WS}*"
_CONTAINER = (f"\\[{_PY_WS}*{_SERIES}\\]|\\({_PY_WS}*{_SERIES}\\)|\\{{{_PY_WS}*{_SERIES}\\}}"
              f"|\\{{{_PY_WS}*{_ENTRY}(?:,{_PY_WS}*{_ENTRY})*+,?{_PY_WS}*\\}}")
NESTING = 8  # levels of containers that are told from garbage

# What Python's single-letter escapes stand for.
_ESCAPES = {"a": "\a", "b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "v": "\v",
            "\\": "\\", "'": "'", '"': '"', "\n": ""}


def _code_point(digits: Column) -> Column:
    return F.decode(F.unhex(F.lpad(digits, 8, "0")), "UTF-32")


def _piece(p: Column) -> Column:
    """Text of one escape or one stretch without escapes."""
    kind = F.substring(p, 2, 1)
    out = F.when(~p.startswith("\\"), p)
    out = out.when(kind.isin("x", "u", "U"), _code_point(F.substr(p, F.lit(3))))
    out = out.when(kind.rlike("[0-7]"), _code_point(F.conv(F.substr(p, F.lit(2)), 8, 16)))
    for letter, text in _ESCAPES.items():
        out = out.when(kind == letter, F.lit(text))
    return out.otherwise(p)


def _literal_text(c: Column) -> Column:
    """The text of one or more neighbouring string literals."""
    def body(s: Column) -> Column:
        s = F.regexp_replace(s, "\\A[uU]", "")
        pieces = F.regexp_extract_all(F.substr(s, F.lit(2), F.length(s) - 2),
                                      F.lit("\\\\(?:[0-7]{1,3}|x..|u.{4}|U.{8}|[\\s\\S])|[^\\\\]++"), 0)
        return F.array_join(F.transform(pieces, _piece), "")

    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(_PY_STR), 0), body), "")


def _is_literal(c: Column) -> Column:
    """Whether the text is a Python literal of any kind (containers up to ``NESTING`` deep)."""
    t = F.regexp_replace(F.regexp_replace(c, _PY_TEXT, _TEXT_MARK), _SCALAR, _SCALAR_MARK)
    for _ in range(NESTING):
        t = F.regexp_replace(t, _CONTAINER, _CONTAINER_MARK)
    return ~c.rlike(_MARK) & t.rlike(f"\\A[ \\t]*{_MARK}{_PY_WS}*(?:,{_PY_WS}*{_MARK}{_PY_WS}*)*+,?{_PY_WS}*\\z")


def parse_distractors(c: Column) -> Column:
    """Parse a distractor list.

    Returns ``struct<answers: array<string>, dialect: string, error: string,
    warning: string>``: ``answers`` are decoded and stripped, ``dialect`` is
    ``json``/``literal``/``invalid``; ``error`` is set (and ``answers`` null) when the
    list is rejected.
    """
    is_json = c.rlike(JSON_LIST_GATE)
    is_literal = ~is_json & c.rlike(LITERAL_LIST_GATE)
    parsed = (
        F.when(is_json, F.from_json(c, "array<string>"))
        .when(is_literal, F.transform(F.regexp_extract_all(c, F.lit(_PY_TEXT), 0), _literal_text))
    )
    dialect = F.when(is_json, F.lit("json")).when(is_literal, F.lit("literal")).otherwise(F.lit("invalid"))
    # Other valid values, JSON or literal: a list with elements has a non-text one; anything else
    # (object, scalar, tuple, empty) is "not a non-empty list". The JSON value is read inside an
    # array with one further element, where trailing text cannot be overlooked.
    wrapped = F.concat(F.lit("["), c, F.lit(",0]"))
    other_json = F.try_parse_json(wrapped).isNotNull() & (F.json_array_length(wrapped) == 2)
    full_list = c.rlike(f"\\A[ \\t\\n\\r]*\\[(?!{_PY_WS}*\\])")
    error = (
        F.when(is_json | is_literal,
               F.when(F.size(parsed) == 0, F.lit(K.MSG_LIST_EMPTY))
               .when(~F.forall(parsed, lambda e: e.isNotNull() & ~is_blank(e)), F.lit(K.MSG_LIST_BAD_ELEMENT)))
        .when(F.coalesce(other_json, F.lit(False)) | _is_literal(c),
              F.when(full_list, F.lit(K.MSG_LIST_BAD_ELEMENT)).otherwise(F.lit(K.MSG_LIST_EMPTY)))
        .otherwise(F.lit(K.MSG_LIST_INVALID))
    )
    answers = F.when(error.isNull(), F.transform(html_decode_array(parsed), strip_ws))
    warning = F.when(is_literal & error.isNull(), F.lit(K.MSG_LITERAL_WARNING))
    return F.struct(answers.alias("answers"), dialect.alias("dialect"),
                    error.alias("error"), warning.alias("warning"))
