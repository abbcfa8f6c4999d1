"""Mergeable quantile sketches: approximate quantiles with a stated rank error.

The exact quantiles (``operators.quantiles``) move every distinct value once. Where a small error in
rank is enough, a sketch of bounded size per group answers from partial aggregates alone: rows are
sketched where they are, sketches are merged, and sketches of parts (a Silver partition, a day) can be
stored and merged again without reading the rows. Spark's KLL sketch functions do the work on the JVM.

A sketch of parameter ``k`` returns a value whose rank differs from the wanted one by at most
``rank_error(k)`` of the rows (with 99 % confidence; KLL's published bound for single quantiles). A
group of up to ``k`` values is kept whole. Nulls and NaN are no values; a group without values has
null quantiles.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K = 400  # sketch parameter: about 0.7 % of rank


def rank_error(k: int = K) -> float:
    """Largest difference of ranks, as a share of the rows, at 99 % confidence."""
    return 2.296 / k ** 0.9723


def sketch_of(value: Column, k: int = K) -> Column:
    """Aggregate: the sketch of a column's values (nulls and NaN left out)."""
    x = value.cast("double")
    return F.kll_sketch_agg_double(F.when(~F.isnan(x), x), F.lit(k))


def sketches(df: DataFrame, keys, value: str, k: int = K) -> DataFrame:
    """One row per group: the keys, ``rows`` (values sketched) and ``sketch``."""
    x = F.col(value).cast("double")
    return df.groupBy(*keys).agg(F.count(F.when(~F.isnan(x), x)).alias("rows"), sketch_of(F.col(value), k).alias("sketch"))


def merged(parts: DataFrame, keys) -> DataFrame:
    """Sketches of parts merged by ``keys``."""
    return parts.groupBy(*keys).agg(F.sum("rows").alias("rows"), F.kll_merge_agg_double("sketch").alias("sketch"))


def quantiles_from(found: DataFrame, probs: dict[str, float]) -> DataFrame:
    """A column per ``probs`` entry read from ``sketch``; null where nothing was sketched."""
    return found.withColumns({name: F.when(F.col("rows") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))))
                              for name, p in probs.items()})


def rank_errors(df: DataFrame, keys, value: str, approximate: DataFrame, probs: dict[str, float]) -> DataFrame:
    """How far each approximate quantile's rank lies from the wanted one, by the exact ranks.

    The rank of a value is any share between the rows below it and the rows up to it. One row per
    group and quantile: the keys, ``quantile``, ``error`` (0 where the rank is met)."""
    x = F.col(value).cast("double")
    rows = df.withColumn("_x", F.when(~F.isnan(x), x)).where("_x is not null").withColumn("_all", F.lit(0))
    wide = approximate.select(F.lit(0).alias("_k__all"), *[F.col(c).alias(f"_k_{c}") for c in keys],
                              *[F.col(q).alias(f"_q_{q}") for q in probs])
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in ["_all", *keys]])
    counted = rows.join(wide, on).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col("_x") < F.col(f"_q_{q}")).alias(f"_b_{q}") for q in probs],
        *[F.count_if(F.col("_x") <= F.col(f"_q_{q}")).alias(f"_u_{q}") for q in probs])
    each = F.explode(F.array(*[F.struct(F.lit(q).alias("quantile"), F.lit(float(p)).alias("p"),
                                        (F.col(f"_b_{q}") / F.col("_n")).alias("b"), (F.col(f"_u_{q}") / F.col("_n")).alias("u"))
                               for q, p in probs.items()]))
    return counted.select(*keys, each.alias("e")).select(
        *keys, "e.quantile", F.greatest(F.col("e.b") - F.col("e.p"), F.col("e.p") - F.col("e.u"), F.lit(0.0)).alias("error"))
