"""Silver cleaning: item keys, keep-first dedupe, cleaned texts, choices and prompt."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quizlake import constants as K
from quizlake.functions import (build_choices, html_decode, make_prompt, parse_distractors,
                                question_id, strip_ws)
from quizlake.functions.keys import json_array_text
from quizlake.operators.selection import first_rows
from quizlake.schemas import BRONZE_COLUMNS, require_columns


def prepare_bronze(df: DataFrame) -> DataFrame:
    """Bronze as read from text: required columns checked, missing labels defaulted to
    ``''``, empty fields read as ``''`` (never null), plus the item key."""
    require_columns(df, K.BRONZE_REQUIRED_COLUMNS, "bronze")
    for c in K.BRONZE_DEFAULTED_COLUMNS:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(""))
    text_cols = [c for c in BRONZE_COLUMNS if c in df.columns]
    df = df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in text_cols})
    return df.withColumn("question_id", question_id(F.col("category"), F.col("question"),
                                                    F.col("correct_answer"), F.col("incorrect_answers")))


def keep_first(df: DataFrame, keys, order: str = "ordinal") -> DataFrame:
    """Keep the first row per key in ``order`` (file order), like pandas keep-first.

    ``row_number() == 1`` lets Spark insert a partial per-task group limit before the
    shuffle, so a key with a huge number of copies is reduced to one row per map task
    before anything moves.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(F.col(order).asc_nulls_last())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def duplicate_count(df: DataFrame, key: str = "question_id") -> DataFrame:
    """Rows that keep-first dedupe drops: ``count(*) - count(distinct key)``."""
    return df.agg((F.count(F.lit(1)) - F.count_distinct(key)).alias("duplicates"),
                  F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("distinct_items"))


def clean_items(bronze: DataFrame, dedupe: bool = True) -> DataFrame:
    """Keyed, deduplicated, cleaned items ready to be scored.

    Adds ``question_clean``, ``correct_answer_clean``, ``incorrect_answers_clean``
    (JSON text), ``choices`` (JSON text, order keyed by the item id), ``prompt``,
    ``cleaning_warning``, ``list_dialect`` and ``item_error`` (error rows are never
    sent to a model).
    """
    items = prepare_bronze(bronze)
    if dedupe:
        items = keep_first(items, "question_id")
    qc = strip_ws(html_decode(F.col("question")))
    cc = strip_ws(html_decode(F.col("correct_answer")))
    items = items.withColumns({"question_clean": qc, "correct_answer_clean": cc,
                               "_p": parse_distractors(F.col("incorrect_answers"))})
    empty = (F.length("question_clean") == 0) | (F.length("correct_answer_clean") == 0)
    item_error = (F.when(empty, F.lit(f"ValueError: {K.MSG_EMPTY_ITEM}"))
                  .when(F.col("_p.error").isNotNull(), F.concat(F.lit("ValueError: "), F.col("_p.error"))))
    ok = item_error.isNull()
    choices = build_choices(F.col("correct_answer_clean"), F.col("_p.answers"), F.col("question_id"))
    return (
        items.withColumn("item_error", item_error)
        .withColumn("_choices", F.when(ok, choices))
        .withColumns({
            "incorrect_answers_clean": F.when(ok, json_array_text(F.col("_p.answers"))),
            "choices": json_array_text(F.col("_choices")),
            "prompt": make_prompt(F.col("question_clean"), F.col("_choices")),
            "cleaning_warning": F.when(~empty, F.col("_p.warning")),
            "list_dialect": F.col("_p.dialect"),
        })
        .drop("_p", "_choices")
    )


def limit_items(items: DataFrame, n: int) -> DataFrame:
    """``--limit n``: the first n deduplicated items in file order (done ones included).

    Found by selection on ``ordinal`` and kept by a filter (``operators.selection``),
    so no single task gathers the rows, whatever n and the number of tasks are.
    """
    return first_rows(items, "ordinal", n)
