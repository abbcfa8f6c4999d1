"""Exact quantiles vs numpy; report semantics."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quizlake.operators import gold, report
from quizlake.operators.quantiles import group_quantiles, quantiles_of, value_counts
from quizlake.plans import fixtures as fx
from tests.conftest import SF001


def test_quantiles_match_numpy(spark):
    rng = np.random.default_rng(5)
    n = 3000
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", None], n, p=[0.7, 0.2, 0.1]),
                        "x": np.concatenate([rng.exponential(3.0, n - 6), [1e9, -4, 2, 2, 2, 2]])})
    df = spark.createDataFrame(pdf)
    got = group_quantiles(df, ["g"], "x", {"p50": 0.5, "p95": 0.95, "p10": 0.1, "low": 0.0, "top": 1.0}).toPandas()
    assert len(got) == 3
    for _, r in got.iterrows():
        x = pdf.x[pdf.g.isna() if r.g is None else pdf.g == r.g]
        assert np.allclose([r.p50, r.p95, r.p10, r.low, r.top], np.quantile(x, [0.5, 0.95, 0.1, 0, 1]))
    assert np.isclose(group_quantiles(df, [], "x", {"m": 0.5}).first().m, pdf.x.median())


INF = float("inf")


@pytest.mark.parametrize("values,median,top", [
    ([1.0, INF, 2.0], 2.0, INF), ([-INF, -INF, 5.0], -INF, 5.0), ([INF] * 4, INF, INF), ([7.0] * 101, 7.0, 7.0),
    ([1e-300, 1e300, 1.0, -1e300, 1e-5], 1e-5, 1e300), ([float("nan"), None, 3.0], 3.0, 3.0),
    ([0.0, -0.0, 0.0], 0.0, 0.0), ([None, float("nan")], None, None), ([1.0, 2.0, 3.0, 4.0], 2.5, 4.0),
    ([float(i) for i in range(999)], 499.0, 998.0),
])
def test_hard_values(spark, values, median, top):
    df = spark.createDataFrame([("k" if i % 2 else None, v) for i, v in enumerate(values)], "g string, x double")
    r = group_quantiles(df, [], "x", {"m": 0.5, "t": 1.0}).first()
    assert (r.m, r.t) == (median, top)
    by = {r.g: r.t for r in group_quantiles(df, ["g"], "x", {"t": 1.0}).collect()}
    kept = {g: [v for i, v in enumerate(values) if ("k" if i % 2 else None) == g and v is not None and v == v] for g in by}
    assert by == {g: (max(v) if v else None) for g, v in kept.items()}


def test_one_group_spreads_over_range_partitions(spark):
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_011).cast("double").alias("x"))
    counts = value_counts(df, [], F.col("x"))
    sizes = [r["count"] for r in counts.groupBy("_p").count().collect()]
    assert len(sizes) > 4 and max(sizes) < 3 * 20_000 / len(sizes)
    assert quantiles_of(counts, [], {"m": 0.5}).first().m == float(np.median([(i * 7919) % 20_011 for i in range(20_000)]))


def test_report_reads_its_input_once(spark):
    ok = report.successful(report.apply_filters(fx.attempts(spark, SF001)))
    plan = report.aggregate_results(ok, ["difficulty"])._jdf.queryExecution().executedPlan().toString()
    assert "parquet" not in plan.lower()  # everything follows from the checkpointed value counts


def test_numbers_are_decimal(spark):
    texts = ["1.5", " 2 ", "-3e2", ".5", "7.", "nan", "NaN", "12f", "12d", "0x10p0", "1_000", "", " ", "1e", "inf", "-Infinity", "abc", "1,5"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.x for r in df.select(report.coerce_number(F.col("t")).alias("x")).collect()]
    assert got == [1.5, 2.0, -300.0, 0.5, 7.0] + [None] * 9 + [INF, -INF, None, None]


def test_histogram_ignores_missing_latencies(spark):
    df = spark.createDataFrame([("easy", 1.0), ("easy", 3.0), ("hard", float("nan")), ("hard", None), ("hard", INF), ("easy", 2.9)],
                               "difficulty string, response_time double")
    rows = report.latency_histogram(df, bins=2).collect()
    assert [(r.difficulty, r.bin, r.questions, r.bin_start, r.bin_end) for r in rows] == [("easy", 0, 1, 1.0, 2.0), ("easy", 1, 2, 2.0, 3.0)]


def test_two_accuracy_definitions_differ_on_null_grades(spark):
    df = spark.createDataFrame(
        [("c", "easy", "success", True, 1.0), ("c", "easy", "success", None, 2.0),
         ("c", "easy", "success", False, 3.0), ("c", "easy", "error", None, None)],
        "category string, difficulty string, status string, ai_correct boolean, response_time double")
    sql_style = gold.accuracy_by_category(df).first()
    assert sql_style.total_questions == 3 and sql_style.accuracy_pct == 33.33
    rep = report.aggregate_results(report.successful(df), ["category"]).first()
    assert rep.questions == 3 and rep.bonnes_reponses == 1 and rep.precision_pct == 50.0
    assert rep.latence_mediane == 2.0


def test_filters_drop_nulls_and_unknown_difficulties(spark):
    df = spark.createDataFrame(
        [("m", "easy", "c"), (None, "easy", "c"), ("m", "expert", "c"), ("m", "hard", None)],
        "model string, difficulty string, category string")
    assert report.apply_filters(df).count() == 1
    opts = {(r.filter, r.value) for r in report.filter_options(df).collect()}
    assert ("difficulty", "expert") not in opts and ("model", None) not in opts


def test_error_summary_labels_missing_error(spark):
    a = fx.attempts(spark, SF001)
    kept = report.apply_filters(a)
    rows = report.error_summary(kept).collect()
    assert any(r.error == "Erreur non renseignée" for r in rows)
    # an unknown status is no success either
    assert sum(r.occurrences for r in rows) == kept.filter("not (status <=> 'success')").count()


def test_pivot_has_fixed_columns(spark):
    df = spark.createDataFrame([("c", "easy", True)], "category string, difficulty string, ai_correct boolean")
    p = report.pivot_category_difficulty(df)
    assert p.columns == ["category", "easy", "medium", "hard"]
    r = p.first()
    assert r.easy == 100.0 and r.medium is None and r.hard is None


def test_levels_agree_with_the_built_in_percentile(spark):
    ok = report.successful(report.apply_filters(fx.attempts(spark, SF001)))
    want = {r.difficulty: (r.n, round(r.m, 6), round(r.a, 6)) for r in ok.groupBy("difficulty").agg(
        F.count("*").alias("n"), F.percentile("response_time", 0.5).alias("m"), F.avg("response_time").alias("a")).collect()}
    got = {r.difficulty: (r.questions, r.latence_mediane, r.latence_moyenne) for r in report.aggregate_results(ok, ["difficulty"]).collect()}
    assert got == want
    levels = report.report_grouping_sets(ok).collect()
    assert {r.difficulty: (r.questions, r.latence_mediane, r.latence_moyenne) for r in levels if r.level == "difficulty"} == want
    whole = report.aggregate_results(ok, []).first()
    assert [(r.questions, r.latence_mediane) for r in levels if r.level == "all"] == [(whole.questions, whole.latence_mediane)]


def test_empty_reports(spark):
    none = fx.attempts(spark, SF001).filter("false")
    assert report.aggregate_results(none, ["model"]).count() == 0 and report.report_grouping_sets(none).count() == 0
    k = report.report_kpis(none).first()
    assert k.questions == 0 and k.successes == 0 and k.latency_median is None and k.success_rate_pct is None
    assert report.aggregate_results(none, []).first().questions == 0
    assert report.latency_histogram(none).count() == 0 and report.pivot_category_difficulty(none).count() == 0
    assert gold.error_rate(none).count() == 0 and gold.accuracy_by_category(none).count() == 0


def test_group_without_values_keeps_a_null_row(spark):
    rows = [("a", float(i)) for i in range(30)] + [("b", None), ("b", float("nan")), (None, 4.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    assert {r.g: r.m for r in group_quantiles(df, ["g"], "x", {"m": 0.5}).collect()} == {"a": 14.5, "b": None, None: 4.0}
