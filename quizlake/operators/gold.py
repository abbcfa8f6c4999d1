"""Gold metrics over Silver attempts (each takes the Silver DataFrame).

Accuracy here is SQL-style: ``correct / count(*)`` over ``success`` rows, so a null
grade counts as wrong (the report's accuracy skips nulls instead; see ``report``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizlake import constants as K


def pct(num: Column, den: Column, digits: int = 2) -> Column:
    """``round(100.0 * num / den, digits)`` as double; null on an empty group."""
    return F.round(F.try_divide(F.lit(100.0) * num, den), digits)


def _success(df: DataFrame) -> DataFrame:
    return df.filter(F.col("status") == K.STATUS_SUCCESS)


def _accuracy_aggs():
    n = F.count(F.lit(1))
    c = F.count_if(F.col("ai_correct"))
    return [n.alias("total_questions"), c.alias("correct_answers"),
            pct(c, n).alias("accuracy_pct"),
            F.round(F.avg("response_time"), 3).alias("avg_response_time_sec")]


def accuracy_overall(silver: DataFrame) -> DataFrame:
    return _success(silver).agg(*_accuracy_aggs())


def accuracy_by_category(silver: DataFrame) -> DataFrame:
    return (_success(silver).groupBy("category", "difficulty").agg(*_accuracy_aggs())
            .orderBy(F.col("category").asc_nulls_last(), F.col("difficulty").asc_nulls_last()))


def accuracy_by_difficulty(silver: DataFrame) -> DataFrame:
    return (_success(silver).groupBy("difficulty").agg(*_accuracy_aggs())
            .orderBy(F.col("difficulty").asc_nulls_last()))


def error_rate(silver: DataFrame) -> DataFrame:
    """Technical errors per category over all rows (``status = 'error'`` only)."""
    n = F.count(F.lit(1))
    e = F.count_if(F.col("status") == K.STATUS_ERROR)
    return (silver.groupBy("category")
            .agg(n.alias("total_questions"), e.alias("technical_errors"), pct(e, n).alias("error_rate_pct"))
            .orderBy(F.col("error_rate_pct").desc_nulls_last()))


HARDEST_KEYS = ["question_id", "category", "difficulty", "question_clean", "correct_answer_clean", "ai_answer"]


def hardest_questions(silver: DataFrame) -> DataFrame:
    """Groups (item, answer) with at least one non-correct success attempt.

    Ordered by accuracy, then category (the stated order), then the remaining group
    keys: accuracy is 0 in nearly every group and categories are few, so without the
    tie-breakers the range partitioning of this (large) result could only use as many
    sort tasks as there are categories.
    """
    n = F.count(F.lit(1))
    c = F.count_if(F.col("ai_correct"))
    ties = [F.col(k).asc_nulls_last() for k in ("question_id", "ai_answer")]
    return (_success(silver).groupBy(*HARDEST_KEYS)
            .agg(n.alias("total_attempts"), c.alias("correct_attempts"), pct(c, n).alias("accuracy_pct"))
            .filter(F.col("correct_attempts") < F.col("total_attempts"))
            .orderBy(F.col("accuracy_pct").asc_nulls_last(), F.col("category").asc_nulls_last(), *ties))


def hardest_items(silver: DataFrame) -> DataFrame:
    """Per item and model (answers pooled): attempts, correct, accuracy; hardest first."""
    n = F.count(F.lit(1))
    c = F.count_if(F.col("ai_correct"))
    return (_success(silver).groupBy("model", "question_id", "category", "difficulty")
            .agg(n.alias("total_attempts"), c.alias("correct_attempts"), pct(c, n).alias("accuracy_pct"))
            .filter(F.col("correct_attempts") < F.col("total_attempts"))
            .orderBy(F.col("accuracy_pct").asc_nulls_last(), "category", "question_id"))


GOLD_VIEWS = {"accuracy_overall": accuracy_overall, "accuracy_by_category": accuracy_by_category,
              "accuracy_by_difficulty": accuracy_by_difficulty, "error_rate": error_rate,
              "hardest_questions": hardest_questions}


def create_views(staging: DataFrame, prefix: str = "gold_") -> list[str]:
    """The metrics as temporary views over the staging view, by name."""
    for name, metric in GOLD_VIEWS.items():
        metric(staging).createOrReplaceTempView(prefix + name)
    return [prefix + name for name in GOLD_VIEWS]
