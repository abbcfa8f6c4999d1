"""Exact quantiles (linear interpolation) per group, one path at every size and skew.

1. One pass over the input adds up each (group, value): row counts and any further sums the
   caller needs (partial aggregation, so a value or group with a third of the rows is one row a
   task before anything moves).
2. These value counts are range-partitioned by (group, value): a group of any size spreads over
   as many partitions as it needs, and a partition holds one stretch of its values in order. The
   table is checkpointed, so every later step (and every retry) sees the same partitions.
3. Rows per (group, partition) give each partition's first rank; the partitions that hold a
   wanted rank are ranked on their own, and the two neighbouring values are interpolated.

Counts, means and quantiles of a report come from the same table: the input is read once.
Nulls and NaN are no values; infinities are. A group without values has null quantiles.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GLOBAL = "_g"  # stands for the one group of a table without group columns


def _keys(keys) -> list[str]:
    return list(keys) or [GLOBAL]


def null_safe(keys, prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


def prefixed(df: DataFrame, keys, prefix: str) -> DataFrame:
    """``df`` with its key columns renamed, for a null-safe join on them."""
    return df.select(*[F.col(k).alias(f"{prefix}{k}") for k in keys], *[c for c in df.columns if c not in keys])


def value_counts(df: DataFrame, keys, value: Column, sums: dict[str, Column] | None = None) -> DataFrame:
    """Range-partitioned, checkpointed rows (group, ``_x``, ``_n``, sums..., ``_p``).

    ``_x`` is the value (null for null and NaN), ``_n`` the rows that have it, ``_p`` the range
    partition. ``sums`` are further aggregates of the same rows, by name."""
    from quizlake.session import shared_dir

    spark = df.sparkSession
    shared_dir(spark)  # checkpoints go to the shared location
    x = value.cast("double")
    rows = df.withColumn("_x", F.when(~F.isnan(x), x))
    if not list(keys):
        rows = rows.withColumn(GLOBAL, F.lit(0))
    counts = rows.groupBy(*_keys(keys), "_x").agg(
        F.count(F.lit(1)).alias("_n"), *[c.alias(n) for n, c in (sums or {}).items()])
    return ranged(counts, keys)


def ranged(counts: DataFrame, keys) -> DataFrame:
    """Value counts spread by (group, value) and written, with their range partition ``_p``."""
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (counts.repartitionByRange(parts, *_keys(keys), "_x")
            .withColumn("_p", F.spark_partition_id()).checkpoint())


def quantiles_of(counts: DataFrame, keys, probs: dict[str, float]) -> DataFrame:
    """One row per group with a value: the keys and a column per ``probs`` entry."""
    kc = _keys(keys)
    values = counts.filter(F.col("_x").isNotNull()).select(*kc, "_p", "_x", "_n")
    parts = values.groupBy(*kc, "_p").agg(F.sum("_n").alias("_m"))
    group = Window.partitionBy(*kc)
    before = group.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumns({"_below": F.coalesce(F.sum("_m").over(before), F.lit(0)),
                               "_total": F.sum("_m").over(group)})
    wanted = F.array(*[F.struct(F.lit(q).alias("q"), ((F.col("_total") - 1) * F.lit(float(p))).alias("h"))
                       for q, p in probs.items()])
    ranks = (parts.select(*kc, "_p", "_below", "_m", F.explode(wanted).alias("_w"))
             .select(*kc, "_p", "_below", "_m", F.col("_w.q").alias("_q"), F.col("_w.h").alias("_h"),
                     F.explode(F.array_distinct(F.array(F.floor("_w.h"), F.ceil("_w.h")))).alias("_r"))
             .filter("_below <= _r and _r < _below + _m").drop("_m"))
    near = values.join(prefixed(ranks, [*kc, "_p"], "_w_"), null_safe([*kc, "_p"], "_w_"))
    upto = Window.partitionBy(*kc, "_p", "_q", "_r").orderBy("_x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reach = F.col("_below") + F.sum("_n").over(upto)
    hit = near.withColumn("_reach", reach).filter("_reach - _n <= _r and _r < _reach")
    ends = hit.groupBy(*kc, "_q", "_h").agg(F.min_by("_x", "_r").alias("_lo"), F.max_by("_x", "_r").alias("_hi"))
    between = F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(
        F.col("_lo") + (F.col("_h") - F.floor("_h")) * (F.col("_hi") - F.col("_lo")))
    return ends.groupBy(*kc).agg(*[F.max(F.when(F.col("_q") == q, between)).alias(q) for q in probs])


def attach_quantiles(base: DataFrame, counts: DataFrame, keys, probs: dict[str, float]) -> DataFrame:
    """``base`` (one row per group, with the group columns) plus the quantile columns."""
    kc = _keys(keys)
    found = prefixed(quantiles_of(counts, keys, probs), kc, "_q_")
    return base.join(found, null_safe(kc, "_q_"), "left").drop(*[f"_q_{k}" for k in kc])


def group_quantiles(df: DataFrame, keys, value: str, probs: dict[str, float]) -> DataFrame:
    """One row per group of ``keys`` (null keys kept, groups without values too) with a column
    per ``probs`` entry; without keys one row."""
    counts = value_counts(df, keys, F.col(value))
    if list(keys):
        return attach_quantiles(counts.select(*keys).distinct(), counts, keys, probs)
    found = quantiles_of(counts, keys, probs)
    return counts.agg(F.count(F.lit(1)).alias("_n")).select(*[found.select(q).scalar().alias(q) for q in probs])
