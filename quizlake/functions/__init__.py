"""Column -> Column building blocks (all JVM-side built-in expressions)."""

from quizlake.functions.htmlref import html_decode, html_decode_array, register_functions
from quizlake.functions.text import normalize_answer, rstrip_ws, strip_ws, is_blank
from quizlake.functions.lists import parse_distractors
from quizlake.functions.keys import json_quote, json_string_list, keyed_shuffle, question_id
from quizlake.functions.prompt import build_choices, make_prompt

__all__ = [
    "html_decode", "html_decode_array", "register_functions", "normalize_answer", "rstrip_ws", "strip_ws", "is_blank",
    "parse_distractors", "json_quote", "json_string_list", "keyed_shuffle", "question_id",
    "build_choices", "make_prompt",
]
