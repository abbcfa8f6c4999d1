"""HTML character-reference decoding (``html.unescape``) as SQL-bodied functions.

The decoder is one pass over the text: the text is split on character references,
each reference is decoded on its own and the pieces are re-joined, so ``&amp;amp;``
becomes ``&amp;`` and nothing is decoded twice. Named references use the HTML5 table
(exact name, else the longest semicolon-less legacy prefix); numeric references use the
standard library's replacement rules. All tables come from Python's standard library at
import time.

The expression is defined once per session as temporary SQL functions; the analyzer
inlines their bodies, so query plans hold only built-in expressions (no Python at run
time) while building a query costs one call instead of hundreds of Column calls.
Texts whose references are all common ones take a plain replace chain (codegen).
"""

from __future__ import annotations

import functools
import html
import html.entities
import json

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Regular expression for one character reference, as used by the standard library.
CHARREF_PATTERN = html._charref.pattern  # type: ignore[attr-defined]

# Common references decoded by the fast path (names of the HTML5 table, plus the
# numeric apostrophe and quote forms). Their outputs contain no '&', so when every
# '&' of a text starts one of them, replacing them one after another -- '&amp;' last --
# gives exactly the single-pass result.
FAST_NAMES = ["quot;", "apos;", "lt;", "gt;", "nbsp;", "copy;", "reg;", "trade;", "middot;",
              "hellip;", "ndash;", "mdash;", "lsquo;", "rsquo;", "ldquo;", "rdquo;", "laquo;",
              "raquo;", "deg;", "eacute;", "egrave;", "ecirc;", "agrave;", "aacute;", "acirc;",
              "ccedil;", "ouml;", "uuml;", "auml;", "iacute;", "oacute;", "uacute;", "ntilde;",
              "szlig;", "Eacute;", "shy;", "pi;", "times;"]
FAST_NUMERIC = {"#039;": "'", "#39;": "'", "#034;": '"', "#34;": '"'}

REPLACEMENT = "�"


def _sql(s: str) -> str:
    """A Spark SQL string literal (backslashes and quotes escaped)."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sql_map(d: dict, value_type: str = "string") -> str:
    """A map constant as one JSON text literal (constant-folded to one map literal)."""
    return f"from_json({_sql(json.dumps(d, ensure_ascii=False))}, 'map<string,{value_type}>')"


def _let(value: str, var: str, body: str) -> str:
    """Bind ``var`` to ``value`` once inside ``body``."""
    return f"get(transform(array({value}), {var} -> {body}), 0)"


@functools.lru_cache(maxsize=1)
def _tables():
    named = html.entities.html5
    legacy = {k: v for k, v in named.items() if not k.endswith(";")}
    by_letter: dict = {}
    for k, v in named.items():
        by_letter.setdefault(k[0], {})[k] = v
    charrefs = {str(k): v for k, v in html._invalid_charrefs.items()}  # type: ignore[attr-defined]
    dropped = sorted(html._invalid_codepoints)  # type: ignore[attr-defined]
    return by_letter, legacy, max(len(k) for k in legacy), charrefs, dropped


def _numeric_sql(r: str) -> str:
    """Decode a numeric reference body ``#123`` / ``#x7B`` (optional ';')."""
    _, _, _, charrefs, dropped = _tables()
    hexp = f"{r} RLIKE '^#[xX]'"
    digits = f"regexp_replace(regexp_extract({r}, '^#[xX]?([0-9a-fA-F]+)', 1), '^0+', '')"
    codepoint = _let(digits, "qz_d",
                     f"CASE WHEN length(qz_d) > CASE WHEN {hexp} THEN 8 ELSE 10 END THEN -1 "
                     f"WHEN length(qz_d) = 0 THEN 0 "
                     f"WHEN {hexp} THEN CAST(conv(qz_d, 16, 10) AS BIGINT) ELSE CAST(qz_d AS BIGINT) END")
    charref = f"try_element_at({_sql_map(charrefs)}, CAST(qz_n AS STRING))"
    body = (f"CASE WHEN qz_n < 0 THEN {_sql(REPLACEMENT)} "
            f"WHEN {charref} IS NOT NULL THEN {charref} "
            f"WHEN (qz_n >= 55296 AND qz_n <= 57343) OR qz_n > 1114111 THEN {_sql(REPLACEMENT)} "
            f"WHEN array_contains(from_json({_sql(json.dumps(dropped))}, 'array<int>'), CAST(qz_n AS INT)) THEN '' "
            f"ELSE decode(unhex(lpad(hex(qz_n), 8, '0')), 'UTF-32') END")
    return _let(codepoint, "qz_n", body)


def _named_sql(r: str) -> str:
    """Decode a named reference body: exact name, else longest legacy prefix + rest."""
    by_letter, legacy, legacy_max, _, _ = _tables()
    exact = f"try_element_at(try_element_at({_sql_map(by_letter, 'map<string,string>')}, substring({r}, 1, 1)), {r})"
    lookup = f"try_element_at({_sql_map(legacy)}, substring({r}, 1, qz_k))"
    lengths = ", ".join(str(k) for k in range(legacy_max, 1, -1))
    prefix = (f"get(filter(transform(array({lengths}), qz_k -> CASE WHEN {lookup} IS NOT NULL "
              f"THEN concat({lookup}, substring({r}, qz_k + 1)) END), qz_v -> qz_v IS NOT NULL), 0)")
    return f"coalesce({exact}, {prefix}, concat('&', {r}))"


def _general_sql(s: str) -> str:
    rx = _sql(CHARREF_PATTERN)
    ref = _let("substring(qz_x, 2)", "qz_r",
               f"CASE WHEN startswith(qz_r, '#') THEN {_numeric_sql('qz_r')} ELSE {_named_sql('qz_r')} END")
    return (f"array_join(zip_with(split({s}, {rx}, -1), transform(regexp_extract_all({s}, {rx}, 0), qz_x -> {ref}), "
            f"(qz_p, qz_q) -> concat(qz_p, coalesce(qz_q, ''))), '')")


def _decode_sql(s: str) -> str:
    named = html.entities.html5
    fast = [(f"&{k}", named[k]) for k in FAST_NAMES] + [(f"&{k}", v) for k, v in FAST_NUMERIC.items()]
    fast.append(("&amp;", "&"))
    alternation = "&(?:" + "|".join(ref[1:] for ref, _ in fast) + ")"
    chain = s
    for ref, val in fast:
        chain = f"replace({chain}, {_sql(ref)}, {_sql(val)})"
    return (f"CASE WHEN instr({s}, '&') = 0 THEN {s} "
            f"WHEN instr(regexp_replace({s}, {_sql(alternation)}, ''), '&') = 0 THEN {chain} "
            f"ELSE {_general_sql(s)} END")


@functools.lru_cache(maxsize=1)
def _definitions() -> tuple:
    return (
        ("quizlake_html_decode", "s STRING", "STRING", _decode_sql("s")),
        ("quizlake_html_decode_general", "s STRING", "STRING", _general_sql("s")),
        ("quizlake_html_decode_array", "a ARRAY<STRING>", "ARRAY<STRING>",
         f"transform(a, qz_e -> {_decode_sql('qz_e')})"),
    )


_REGISTERED: set = set()


def register_functions(spark: SparkSession | None = None) -> None:
    """Define the decoder's SQL functions in ``spark`` (once per session)."""
    spark = spark or SparkSession.getActiveSession()
    if spark is None:
        raise RuntimeError("html_decode needs an active SparkSession")
    key = id(spark._jsparkSession)
    if key in _REGISTERED and spark.catalog.functionExists("quizlake_html_decode"):
        return
    for name, args, ret, body in _definitions():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {ret} RETURN {body}")
    _REGISTERED.add(key)


def html_decode(c: Column) -> Column:
    """``html.unescape`` of a string column (not usable on lambda variables: use
    ``html_decode_array`` for array elements)."""
    register_functions()
    return F.call_function("quizlake_html_decode", c)


def html_decode_array(c: Column) -> Column:
    """``[html.unescape(e) for e in a]`` of an array<string> column."""
    register_functions()
    return F.call_function("quizlake_html_decode_array", c)


def html_decode_general(c: Column) -> Column:
    """The general decoder alone (no fast path); for tests."""
    register_functions()
    return F.call_function("quizlake_html_decode_general", c)
