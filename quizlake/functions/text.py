"""Text cleaning: Unicode whitespace, answer normalisation (HTML decoding lives in
``htmlref``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quizlake.functions.htmlref import html_decode, html_decode_array  # noqa: F401


def _char_class(chars) -> str:
    """Java regex character class listing ``chars`` (as \\x{..} escapes, merged ranges)."""
    cps = sorted(ord(c) for c in chars)
    out, i = [], 0
    while i < len(cps):
        j = i
        while j + 1 < len(cps) and cps[j + 1] == cps[j] + 1:
            j += 1
        out.append(f"\\x{{{cps[i]:X}}}" if i == j else f"\\x{{{cps[i]:X}}}-\\x{{{cps[j]:X}}}")
        i = j + 1
    return "[" + "".join(out) + "]"


# Python's notion of whitespace (str.strip / str.isspace), derived from the Unicode
# database; Java's \s and Spark's trim() cover different sets.
WS_CLASS = _char_class(chr(c) for c in range(0x110000) if chr(c).isspace())
_STRIP_RX = f"\\A{WS_CLASS}+|{WS_CLASS}+\\z"
_RSTRIP_RX = f"{WS_CLASS}+\\z"
_NON_WS_RX = WS_CLASS.replace("[", "[^", 1)


def strip_ws(c: Column) -> Column:
    """``str.strip()``: remove Unicode whitespace at both ends."""
    return F.regexp_replace(c, _STRIP_RX, "")


def rstrip_ws(c: Column) -> Column:
    return F.regexp_replace(c, _RSTRIP_RX, "")


def is_blank(c: Column) -> Column:
    """True when the text is empty or whitespace only (``not s.strip()``)."""
    return ~c.rlike(_NON_WS_RX)


def normalize_answer(c: Column) -> Column:
    """Strict comparison key: decode, strip, lower-case, drop one final '.', rstrip.

    Nothing fuzzy: a sentence that contains the answer stays different.
    """
    s = F.lower(strip_ws(html_decode(c)))
    return rstrip_ws(F.regexp_replace(s, "\\.\\z", ""))
