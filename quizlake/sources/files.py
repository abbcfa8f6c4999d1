"""Bronze CSV and Silver Parquet IO, staging views and checkpoint reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from quizlake import constants as K
from quizlake.operators.selection import dense_numbers
from quizlake.schemas import BRONZE_COLUMNS, SILVER_SCHEMA, conform, require_columns
from quizlake.sources import csvlines

# Text is kept byte for byte: no whitespace trimming (Spark trims by default), fields
# quoted with '"' and quotes doubled, multi-line values allowed.
CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "encoding": "UTF-8",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def missing_path(exc: AnalysisException) -> bool:
    """The path does not exist. A folder that exists without readable files (a write that did not end)
    is not missing: reading it stays an error."""
    return exc.getCondition() == "PATH_NOT_FOUND"


def write_bronze_csv(df: DataFrame, path: str) -> None:
    """Bronze sink: header, UTF-8, quoted multi-line fields, overwrite (atomic commit)."""
    cols = (["ordinal"] if "ordinal" in df.columns else []) + [c for c in BRONZE_COLUMNS if c in df.columns]
    df.select(*cols).write.mode("overwrite").options(**CSV_OPTIONS).option("emptyValue", "").csv(path)


def read_bronze_csv(spark: SparkSession, path: str) -> DataFrame:
    """Bronze scan: all columns as text, empty fields as ``''`` (never null).

    The header decides which columns exist (every file has the same one); required ones are checked,
    missing label columns are defaulted to ``''`` later (``prepare_bronze``). Files are read by byte
    ranges (``csvlines``), so one large file is read by many tasks although values may span lines.
    Without an ``ordinal`` column rows are numbered by file path and position in the file.
    """
    try:
        header = spark.read.options(**CSV_OPTIONS).csv(path).columns
    except AnalysisException as exc:
        if not missing_path(exc):
            raise
        raise ValueError(f"Bronze not found: {path}") from exc
    records, splits = csvlines.records(spark, path)
    df = csvlines.parsed(records, header, {k: v for k, v in CSV_OPTIONS.items() if k != "header"})
    require_columns(df, K.BRONZE_REQUIRED_COLUMNS, "bronze")
    df = df.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in header if c != "ordinal"})
    if "ordinal" in header:
        df = df.withColumn("ordinal", F.col("ordinal").cast("bigint"))
    else:
        df = _numbered(df, splits)
    return df.select(*(header if "ordinal" in header else [*header, "ordinal"]))


FILE_BITS = 40  # bytes of one file that an ordinal can tell apart


def _numbered(df: DataFrame, splits: DataFrame) -> DataFrame:
    """Adds ``ordinal``: files by path, records by position (their split's first byte and line)."""
    files = dense_numbers(splits.select("file").distinct(), "file", "_no")
    return df.join(files, "file").withColumn("ordinal", F.col("_no") * (1 << FILE_BITS) + F.col("block") + F.col("line"))


def write_silver(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Silver sink: stable schema, one folder per model.

    With dynamic partition overwrite a run replaces only its own model's partition,
    so several models' results live side by side in one table.
    """
    (conform(df, SILVER_SCHEMA).write.mode(mode)
     .option("partitionOverwriteMode", "dynamic").partitionBy("model").parquet(path))


def _own_schema(spark: SparkSession, path: str, required, what: str) -> DataFrame | None:
    """The table at ``path`` with its own columns checked; None where there is none."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as exc:
        if not missing_path(exc):
            raise
        return None
    require_columns(df, required, what)
    return df


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """Staging scan of Silver: the files' own columns are checked, then read as the fixed schema."""
    if _own_schema(spark, path, [f.name for f in SILVER_SCHEMA.fields], "silver") is None:
        raise ValueError(f"Silver not found: {path}")
    df = spark.read.schema(SILVER_SCHEMA).parquet(path)
    return df.select(*[f.name for f in SILVER_SCHEMA.fields])


def stage_view(spark: SparkSession, path: str, name: str = "stg_questions_enriched") -> DataFrame:
    """``select * from read_parquet(path)`` as a temp view; Gold and report read it."""
    df = read_silver(spark, path)
    df.createOrReplaceTempView(name)
    return spark.table(name)


def load_checkpoint(spark: SparkSession, path: str | None, restart: bool = False) -> DataFrame | None:
    """Saved results of earlier runs with their own columns checked, or None on restart / first run."""
    if restart or not path:
        return None
    return _own_schema(spark, path, K.CHECKPOINT_REQUIRED_COLUMNS, "checkpoint")


def write_detail_csv(listing: DataFrame, path: str) -> None:
    """The detail listing as CSV, in its order (files are numbered in order of their rows)."""
    listing.write.mode("overwrite").options(**CSV_OPTIONS).option("emptyValue", '""').csv(path)
