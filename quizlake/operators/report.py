"""Report tables: filters, per-level aggregates, KPIs, pivot, histogram, error listing.

Report accuracy is pandas-style: the mean of ``ai_correct`` with nulls skipped (the
Gold SQL metrics count a null grade as wrong instead). Every result is a small
aggregate; nothing is pulled to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizlake import constants as K
from quizlake.operators.selection import first_sorted
from quizlake.operators.quantiles import (attach_quantiles, group_quantiles, quantiles_of, ranged,
                                          value_counts)
from quizlake.schemas import require_columns

LATENCY_DIGITS = 6  # means and quantiles are rounded to 6 decimals (float noise)
ROUND_UP_FROM = 1e-9  # a mean this close below a tie counts as the tie (sums differ in their last bits)


#: Texts that are numbers: decimal notation with an optional exponent, or an infinity.
NUMBER = r"(?i)\A\s*[+-]?(?:(?:\d++\.?\d*+|\.\d++)(?:e[+-]?\d++)?|inf(?:inity)?)\s*\z"


def coerce_number(c: Column) -> Column:
    """Text to double; anything that is not a number (``nan``, ``12f``, hexadecimal) is missing."""
    return F.when(c.rlike(NUMBER), F.trim(c).try_cast("double"))


def prepare_report_input(df: DataFrame) -> DataFrame:
    """Required columns checked; grade cast to boolean, latency coerced (bad or NaN -> null)."""
    require_columns(df, K.REPORT_REQUIRED_COLUMNS, "benchmark")
    time = F.col("response_time")
    if dict(df.dtypes)["response_time"] == "string":
        time = coerce_number(time)
    time = time.cast("double")
    return df.withColumns({"ai_correct": F.col("ai_correct").cast("boolean"),
                           "response_time": F.when(~F.isnan(time), time)})


def filter_options(df: DataFrame) -> DataFrame:
    """Selectable values per filter: distinct non-null models and categories, sorted;
    difficulties restricted to the fixed order. Columns: filter, value, position."""
    pairs = F.array(*[F.struct(F.lit(c).alias("filter"), F.col(c).cast("string").alias("value"))
                      for c in ("model", "category", "difficulty")])
    out = (df.select(F.explode(pairs).alias("_p")).select("_p.*")  # one scan, one distinct
           .filter(F.col("value").isNotNull()
                   & ((F.col("filter") != "difficulty") | F.col("value").isin(K.DIFFICULTY_ORDER)))
           .distinct())
    pos = F.when(F.col("filter") == "difficulty",
                 F.array_position(F.array(*[F.lit(d) for d in K.DIFFICULTY_ORDER]), F.col("value")) - 1)
    return out.withColumn("position", pos.cast("bigint")).orderBy("filter", "position", "value")


def apply_filters(df: DataFrame, models=None, difficulties=None, categories=None) -> DataFrame:
    """Conjunctive membership filters; ``None`` selects the default (every non-null
    value, difficulties limited to the fixed order). A null never matches."""
    model_pred = F.col("model").isNotNull() if models is None else F.col("model").isin(list(models))
    diff_pred = F.col("difficulty").isin(list(difficulties if difficulties is not None else K.DIFFICULTY_ORDER))
    cat_pred = F.col("category").isNotNull() if categories is None else F.col("category").isin(list(categories))
    return df.filter(model_pred & diff_pred & cat_pred)


def successful(df: DataFrame) -> DataFrame:
    return df.filter(F.col("status") == K.STATUS_SUCCESS)


def failed(df: DataFrame) -> DataFrame:
    """Not ``success``: errors, unknown and null statuses."""
    return df.filter(~F.col("status").eqNullSafe(K.STATUS_SUCCESS))


def _graded_sums() -> dict[str, Column]:
    """Sums kept beside the value counts: right answers and graded rows."""
    correct = F.col("ai_correct").cast("int")
    return {"_c": F.sum(correct), "_k": F.count(correct)}


def mean_value() -> Column:
    """Rounded mean of the values, from value counts."""
    timed = F.when(F.col("_x").isNotNull(), F.col("_n"))
    return F.round(F.try_divide(F.sum(F.col("_x") * F.col("_n")), F.sum(timed)) + ROUND_UP_FROM, LATENCY_DIGITS)


def _level_metrics() -> list[Column]:
    """Counts, accuracy and mean latency of a level, from value counts."""
    return [
        F.sum("_n").alias("questions"),
        F.coalesce(F.sum("_c"), F.lit(0)).cast("bigint").alias("bonnes_reponses"),
        F.try_divide(F.sum("_c").cast("double"), F.sum("_k")).alias("precision"),
        mean_value().alias("latence_moyenne"),
    ]


def aggregate_results(df: DataFrame, dims) -> DataFrame:
    """Per level: questions, bonnes_reponses, precision (nulls skipped), mean and median
    latency, precision_pct. Null keys form their own group; no columns: one row.

    The input is read once, into value counts from which all metrics follow.
    """
    dims = list(dims)
    counts = value_counts(df, dims, F.col("response_time"), _graded_sums())
    if dims:
        out = attach_quantiles(counts.groupBy(*dims).agg(*_level_metrics()), counts, dims, {"latence_mediane": 0.5})
    else:
        median = quantiles_of(counts, dims, {"latence_mediane": 0.5}).select("latence_mediane")
        out = counts.agg(*_level_metrics()).withColumn("latence_mediane", median.scalar())
        out = out.withColumn("questions", F.coalesce("questions", F.lit(0)))
    return out.withColumns({"latence_mediane": F.round("latence_mediane", LATENCY_DIGITS),
                            "precision_pct": F.col("precision") * 100})


def difficulty_rank(c: Column) -> Column:
    """Position in easy < medium < hard; other values null (sorted last)."""
    pos = F.array_position(F.array(*[F.lit(d) for d in K.DIFFICULTY_ORDER]), c)
    return F.when(pos > 0, pos)


def report_by_difficulty(ok: DataFrame) -> DataFrame:
    return aggregate_results(ok, ["difficulty"]).orderBy(difficulty_rank(F.col("difficulty")).asc_nulls_last())


def report_by_type(ok: DataFrame) -> DataFrame:
    return aggregate_results(ok, ["type"]).orderBy(F.col("type").asc_nulls_last())


def report_by_category(ok: DataFrame) -> DataFrame:
    return aggregate_results(ok, ["category"]).orderBy(F.col("precision_pct").asc_nulls_last(), "category")


def report_by_category_difficulty(ok: DataFrame) -> DataFrame:
    return aggregate_results(ok, ["category", "difficulty"]).orderBy("category", difficulty_rank(F.col("difficulty")))


def report_by_model(ok: DataFrame) -> DataFrame:
    return (aggregate_results(ok, ["model"])
            .select("model", "questions", "bonnes_reponses", "precision_pct", "latence_moyenne", "latence_mediane")
            .orderBy(F.col("precision_pct").desc_nulls_last(), "model"))


REPORT_LEVELS = {
    "all": [], "difficulty": ["difficulty"], "type": ["type"], "category": ["category"],
    "category_difficulty": ["category", "difficulty"], "model": ["model"],
}


def report_grouping_sets(ok: DataFrame, levels=None, with_median: bool = True) -> DataFrame:
    """All report levels from one scan.

    ``level`` names the grouping set. The rows are added up by the four columns and latency
    first; these value counts, not the rows, are expanded to the levels and ranked there.
    ``levels`` picks some of ``REPORT_LEVELS`` (all by default).
    """
    chosen = {n: REPORT_LEVELS[n] for n in (levels or REPORT_LEVELS)}
    order = ["difficulty", "type", "category", "model"]
    time = F.col("response_time").cast("double")
    fine = (ok.withColumn("_x", F.when(~F.isnan(time), time)).groupBy(*order, "_x")
            .agg(F.count(F.lit(1)).alias("_n"), *[c.alias(n) for n, c in _graded_sums().items()]))
    types = dict(ok.dtypes)
    per_level = F.array(*[
        F.struct(F.lit(name).alias("level"),
                 *[(F.col(c) if c in cols else F.lit(None).cast(types[c])).alias(c) for c in order])
        for name, cols in chosen.items()])
    keys = ["level", *order]
    counts = (fine.select(F.explode(per_level).alias("_l"), "_x", "_n", "_c", "_k").select("_l.*", "_x", "_n", "_c", "_k")
              .groupBy(*keys, "_x").agg(*[F.sum(c).alias(c) for c in ("_n", "_c", "_k")]))
    cols = [*keys, "questions", "bonnes_reponses", (F.col("precision") * 100).alias("precision_pct"), "latence_moyenne"]
    if not with_median:
        return counts.groupBy(*keys).agg(*_level_metrics()).select(*cols)
    counts = ranged(counts, keys)
    out = attach_quantiles(counts.groupBy(*keys).agg(*_level_metrics()), counts, keys, {"latence_mediane": 0.5})
    return out.select(*cols, F.round("latence_mediane", LATENCY_DIGITS).alias("latence_mediane"))


def report_kpis(filtered: DataFrame) -> DataFrame:
    """Questions, success rate, accuracy and latency mean / median / P95 (successes), one scan."""
    ok = F.col("status") == K.STATUS_SUCCESS
    correct = F.when(ok, F.col("ai_correct").cast("int"))
    counts = value_counts(filtered, [], F.when(ok, F.col("response_time")),
                          {"_s": F.count_if(ok), "_c": F.sum(correct), "_k": F.count(correct)})
    found = quantiles_of(counts, [], {"latency_median": 0.5, "latency_p95": 0.95})
    n, s = F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.sum("_s"), F.lit(0))
    out = counts.agg(
        n.alias("questions"), s.alias("successes"),
        (F.try_divide(s.cast("double"), n) * 100).alias("success_rate_pct"),
        (F.try_divide(F.sum("_c").cast("double"), F.sum("_k")) * 100).alias("accuracy_pct"),
        mean_value().alias("latency_mean"))
    return out.withColumns({c: F.round(found.select(c).scalar(), LATENCY_DIGITS) for c in ("latency_median", "latency_p95")})


def latency_quantiles(ok: DataFrame, dims=("model",), probs=(0.5, 0.9, 0.95, 0.99)) -> DataFrame:
    named = {f"p{int(round(p * 100)):02d}": p for p in probs}
    q = group_quantiles(ok, list(dims), "response_time", named)
    return q.select(*dims, *[F.round(c, LATENCY_DIGITS).alias(c) for c in named])


def execution_quality(filtered: DataFrame) -> DataFrame:
    ok = F.col("status") == K.STATUS_SUCCESS
    return filtered.agg(
        F.count_if(ok).alias("successes"),
        F.count_if(~F.col("status").eqNullSafe(K.STATUS_SUCCESS)).alias("failures"),
        F.count_if(ok & ~F.coalesce(F.col("ai_correct"), F.lit(False))).alias("wrong_answers"),
    )


def error_summary(filtered: DataFrame) -> DataFrame:
    """Failures per (model, error); a missing error text gets a fixed label."""
    return (failed(filtered)
            .withColumn("error", F.coalesce(F.col("error"), F.lit(K.ERROR_FILL_LABEL)))
            .groupBy("model", "error").agg(F.count(F.lit(1)).alias("occurrences"))
            .orderBy(F.col("occurrences").desc(), "model", "error"))


def wrong_answers(ok: DataFrame) -> DataFrame:
    """Success rows not graded correct (a null grade counts as wrong)."""
    return ok.filter(~F.coalesce(F.col("ai_correct"), F.lit(False)))


def detail_listing(ok: DataFrame, only_incorrect: bool = False, limit: int | None = None) -> DataFrame:
    """The explorer table: fixed columns, slowest first; the first ``limit`` rows if given (found by
    selection, so no task merges the best rows of all tasks).

    Equal latencies are ordered by the other listed columns, so a latency shared by a
    large share of the rows is split across sort tasks by the range partitioner.
    """
    d = wrong_answers(ok) if only_incorrect else ok
    ties = [F.col(c).asc_nulls_last() for c in K.DETAIL_COLUMNS if c != "response_time"]
    d = d.select(*K.DETAIL_COLUMNS)
    if limit is not None:
        others = [(c, False) for c in K.DETAIL_COLUMNS if c != "response_time"]
        d = first_sorted(d, [("response_time", True), *others], limit)
    return d.orderBy(F.col("response_time").desc_nulls_last(), *ties)


def pivot_category_difficulty(ok: DataFrame) -> DataFrame:
    """precision_pct per category (rows) x difficulty (columns in the fixed order)."""
    correct = F.col("ai_correct").cast("int").cast("double")
    return (ok.groupBy("category").pivot("difficulty", K.DIFFICULTY_ORDER)
            .agg(F.avg(correct) * 100).orderBy("category"))


def latency_histogram(ok: DataFrame, bins: int = 40) -> DataFrame:
    """Counts per difficulty over ``bins`` equal-width bins spanning [min, max]
    (last bin closed; a single-valued range is bin 0). Bounds come from a scalar
    subquery, so no join is needed. NaN latencies are missing; infinite ones have no bin."""
    ok = ok.filter(~F.col("response_time").isin(float("inf"), float("-inf")) & ~F.isnan("response_time"))
    bounds = ok.agg(F.struct(F.min("response_time").alias("lo"), F.max("response_time").alias("hi"))).scalar()
    lo, hi = bounds["lo"], bounds["hi"]
    width = (hi - lo) / bins
    b = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor((F.col("response_time") - lo) / width), F.lit(bins - 1))).cast("int")
    return (ok.filter(F.col("response_time").isNotNull())
            .withColumn("bin", b)
            .groupBy("difficulty", "bin").agg(F.count(F.lit(1)).alias("questions"))
            .withColumns({"bin_start": F.round(lo + F.col("bin") * width, LATENCY_DIGITS),
                          "bin_end": F.round(lo + (F.col("bin") + 1) * width, LATENCY_DIGITS)})
            .orderBy(difficulty_rank(F.col("difficulty")).asc_nulls_last(), "bin"))


def speed_accuracy(ok: DataFrame) -> DataFrame:
    """Points (mean latency, precision, size) per category and per model, from one
    grouping-sets pass over the two levels (no median needed)."""
    g = report_grouping_sets(ok, levels=["category", "model"], with_median=False)
    name = F.when(F.col("level") == "category", F.col("category")).otherwise(F.col("model"))
    return g.select("level", name.alias("name"), "latence_moyenne", "precision_pct", "questions")
