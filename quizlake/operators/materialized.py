"""Gold kept up to date from mergeable partial aggregates, one set per Silver partition.

Silver has one partition per model. For each partition the store holds one small row per (category,
difficulty): counts, latency sum and latency sketch. All Gold metrics are merges of these rows, so they
never read Silver. ``refresh`` compares each partition's files with what the rows were made from and
recomputes only partitions that are new or were replaced; rows of partitions that are gone are left out.

A refresh writes one folder with the rows of the changed partitions and a table that says for every
partition which build counts and from which files; both become current in one commit
(``sources.versions``). ``compact`` gathers the current rows in one folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizlake import constants as K
from quizlake.operators.gold import pct
from quizlake.operators.sketches import merged, quantiles_from, sketch_of
from quizlake.schemas import SILVER_SCHEMA
from quizlake.sources.versions import VersionLog

PARTITION = "model"
PARTS, CURRENT = "parts", "current"


def partials(silver: DataFrame) -> DataFrame:
    """One row per (model, category, difficulty): everything the Gold metrics add up."""
    ok = F.col("status") == K.STATUS_SUCCESS
    time = F.when(ok, F.col("response_time"))
    return silver.groupBy(PARTITION, "category", "difficulty").agg(
        F.count(F.lit(1)).alias("attempts"), F.count_if(ok).alias("successes"),
        F.count_if(ok & F.col("ai_correct")).alias("correct"),
        F.count_if(F.col("status") == K.STATUS_ERROR).alias("errors"),
        F.sum(time).alias("time_sum"), F.count(time).alias("time_rows"),
        F.count(F.when(~F.isnan(time), time)).alias("rows"), sketch_of(time).alias("sketch"))


def files_of(silver: DataFrame) -> DataFrame:
    """(model, files): a fingerprint of each partition's files (names, sizes, times), from metadata."""
    m = F.col("_metadata")
    each = silver.select(PARTITION, m["file_path"].alias("p"), m["file_size"].alias("s"),
                         m["file_modification_time"].alias("t")).distinct()
    return each.groupBy(PARTITION).agg(F.concat_ws(":", F.count(F.lit(1)), F.bit_xor(F.xxhash64("p", "s", "t"))).alias("files"))


class GoldStore:
    """Partial aggregates of a Silver table below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.log = spark, VersionLog(spark, path)

    def refresh(self, silver_path: str) -> list[str | None]:
        """Bring the rows up to date; the partitions that were recomputed (one name each)."""
        silver = self.spark.read.schema(SILVER_SCHEMA).parquet(silver_path)
        now = files_of(silver)
        build = self.log.version() + 1
        held = self.log.read(CURRENT)
        if held is None:
            held = self.spark.createDataFrame([], f"{PARTITION} string, files string, build bigint")
        old = held.select(F.col(PARTITION).alias("_m"), F.col("files").alias("_f"), F.col("build").alias("_b"))
        both = now.join(old, F.col(PARTITION).eqNullSafe(F.col("_m")), "left")
        current = both.select(PARTITION, "files", F.when(F.col("files") == F.col("_f"), F.col("_b")).otherwise(
            F.lit(build)).cast("bigint").alias("build")).checkpoint()
        changed = [r[0] for r in current.where(F.col("build") == build).select(PARTITION).collect()]
        if not changed and current.count() == held.count():
            return []
        names = [c for c in changed if c is not None]
        touched = F.col(PARTITION).isin(names) if names else F.lit(False)
        if len(names) < len(changed):
            touched = touched | F.col(PARTITION).isNull()
        rows = partials(silver.where(touched)).withColumn("build", F.lit(build).cast("bigint"))
        self.log.commit(replace={CURRENT: current}, append={PARTS: rows} if changed else None)
        return changed

    def parts(self) -> DataFrame:
        """The current rows of all partitions."""
        rows, current = self.log.read(PARTS), self.log.read(CURRENT)
        if rows is None or current is None:
            raise ValueError("no refresh yet")
        current = current.select(F.col(PARTITION).alias("_m"), F.col("build").alias("_b"))
        return rows.join(current, F.col(PARTITION).eqNullSafe(F.col("_m")) & (F.col("build") == F.col("_b"))).drop("_m", "_b")

    def compact(self) -> None:
        """Current rows in one folder (earlier builds of replaced partitions go)."""
        self.log.commit(replace={PARTS: self.parts()})


def _accuracy(parts: DataFrame, keys) -> DataFrame:
    n, c = F.sum("successes"), F.sum("correct")
    out = parts.groupBy(*keys).agg(
        n.alias("total_questions"), c.alias("correct_answers"), pct(c, n).alias("accuracy_pct"),
        F.round(F.try_divide(F.sum("time_sum"), F.sum("time_rows")), 3).alias("avg_response_time_sec"))
    return out.where("total_questions > 0") if keys else out


def accuracy_overall(parts: DataFrame) -> DataFrame:
    out = _accuracy(parts, [])
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("total_questions", "correct_answers")})


def accuracy_by_category(parts: DataFrame) -> DataFrame:
    return _accuracy(parts, ["category", "difficulty"])


def accuracy_by_difficulty(parts: DataFrame) -> DataFrame:
    return _accuracy(parts, ["difficulty"])


def error_rate(parts: DataFrame) -> DataFrame:
    n, e = F.sum("attempts"), F.sum("errors")
    return parts.groupBy("category").agg(n.alias("total_questions"), e.alias("technical_errors"),
                                         pct(e, n).alias("error_rate_pct"))


def latency(parts: DataFrame, keys, probs: dict[str, float]) -> DataFrame:
    """Approximate latency quantiles of successful attempts (rank error: ``sketches.rank_error``)."""
    return quantiles_from(merged(parts, keys), probs).select(*keys, "rows", *probs)
