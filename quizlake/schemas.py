"""Explicit schemas for every layer (no schema inference anywhere)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Column names of the layers.
BRONZE_COLUMNS = ["category", "type", "difficulty", "question", "correct_answer",
                  "incorrect_answers", "source", "category_id", "fetched_at"]

# Bronze CSV is read back as text only: no type or null inference.
BRONZE_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in BRONZE_COLUMNS])

SILVER_STRING_COLUMNS = [
    "question_id", "model", "prompt_version", "benchmark_timestamp", "question_clean",
    "correct_answer_clean", "incorrect_answers_clean", "choices", "prompt", "ai_answer",
    "status", "error", "cleaning_warning",
]

# Silver: Bronze columns + ordinal (explicit file order) + the attempt columns.
SILVER_SCHEMA = T.StructType(
    [T.StructField("ordinal", T.LongType(), True)]
    + [T.StructField(c, T.StringType(), True) for c in BRONZE_COLUMNS]
    + [
        T.StructField("question_id", T.StringType(), True),
        T.StructField("model", T.StringType(), True),
        T.StructField("prompt_version", T.StringType(), True),
        T.StructField("temperature", T.LongType(), True),
        T.StructField("max_tokens", T.LongType(), True),
        T.StructField("benchmark_timestamp", T.StringType(), True),
        T.StructField("question_clean", T.StringType(), True),
        T.StructField("correct_answer_clean", T.StringType(), True),
        T.StructField("incorrect_answers_clean", T.StringType(), True),
        T.StructField("choices", T.StringType(), True),
        T.StructField("prompt", T.StringType(), True),
        T.StructField("ai_answer", T.StringType(), True),
        T.StructField("ai_correct", T.BooleanType(), True),
        T.StructField("response_time", T.DoubleType(), True),
        T.StructField("status", T.StringType(), True),
        T.StructField("error", T.StringType(), True),
        T.StructField("cleaning_warning", T.StringType(), True),
    ]
)

RESPONSE_SCHEMA = T.StructType([
    T.StructField("model", T.StringType(), True),
    T.StructField("question_id", T.StringType(), True),
    T.StructField("payload", T.StringType(), True),
    T.StructField("response_time", T.DoubleType(), True),
    T.StructField("transport_error", T.StringType(), True),
])

# Item-bank API payloads.
PAGE_PAYLOAD_SCHEMA = T.StructType([
    T.StructField("response_code", T.IntegerType(), True),
    T.StructField("results", T.ArrayType(T.StructType([
        T.StructField("category", T.StringType(), True),
        T.StructField("type", T.StringType(), True),
        T.StructField("difficulty", T.StringType(), True),
        T.StructField("question", T.StringType(), True),
        T.StructField("correct_answer", T.StringType(), True),
        T.StructField("incorrect_answers", T.ArrayType(T.StringType()), True),
    ])), True),
])
CATEGORIES_PAYLOAD_SCHEMA = T.StructType([
    T.StructField("trivia_categories", T.ArrayType(T.StructType([
        T.StructField("id", T.LongType(), True),
        T.StructField("name", T.StringType(), True),
    ])), True),
])
COUNT_PAYLOAD_SCHEMA = T.StructType([
    T.StructField("category_id", T.LongType(), True),
    T.StructField("category_question_count", T.StructType([
        T.StructField("total_question_count", T.LongType(), True),
    ]), True),
])


def require_columns(df: DataFrame, required, what: str = "input") -> None:
    """Fail with a sorted list of missing columns (metadata only, no job)."""
    missing = set(required) - set(df.columns)
    if missing:
        raise ValueError(f"{what}: missing required columns: {', '.join(sorted(missing))}")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project and cast ``df`` to ``schema`` (absent columns become typed nulls)."""
    from pyspark.sql import functions as F

    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)
