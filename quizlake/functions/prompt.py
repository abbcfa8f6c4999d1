"""Answer choices and the benchmark prompt."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quizlake import constants as K
from quizlake.functions.keys import keyed_shuffle


def build_choices(correct: Column, incorrect: Column, key: Column) -> Column:
    """[correct, *incorrect] in a reproducible order keyed by the item id."""
    return keyed_shuffle(F.concat(F.array(correct), incorrect), key)


def make_prompt(question: Column, choices: Column) -> Column:
    lines = F.array_join(F.transform(choices, lambda c: F.concat(F.lit(K.PROMPT_CHOICE_BULLET), c)), "\n")
    return F.concat(F.lit(K.PROMPT_HEADER), question, F.lit(K.PROMPT_CHOICES_HEADER), lines,
                    F.lit(K.PROMPT_FOOTER))
