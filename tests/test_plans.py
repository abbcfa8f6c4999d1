"""Plan guards over every registered query: no cartesian products, no nested-loop
joins, no row-at-a-time Python UDFs; Python only in the scorer hook and where CSV lines are joined to
records (Arrow batches)."""

from quizlake.plans.catalog import QUERIES
from tests.conftest import SF001
from tools.plan_audit import audit

SKIP = {"stream_incremental", "stream_dedupe"}  # run their streams while building; the result is a sink scan
PYTHON_ALLOWED = {"score_batch", "csv_roundtrip", "bronze_defaults"}


def test_no_forbidden_plan_nodes(spark):
    for name, fn in QUERIES.items():
        if name in SKIP:
            continue
        row = audit(fn(spark, SF001))
        assert not row["forbidden"], (name, row)
        if name not in PYTHON_ALLOWED:
            assert row["arrow_python"] == 0, (name, row)


def test_keep_first_limits_groups_before_the_shuffle(spark):
    row = audit(QUERIES["dedupe_items"](spark, SF001))
    assert row["group_limit"] == 2 and row["hash"] == 1  # partial limit, exchange, final limit


def test_silver_is_read_narrowly_with_pushed_filters(spark):
    from quizlake.operators import gold, report
    from quizlake.plans import fixtures as fx
    from quizlake.session import fresh_dir
    from quizlake.sources import files

    path = fresh_dir(spark, "plan-silver")
    files.write_silver(fx.attempts(spark, SF001), path)
    staged = files.stage_view(spark, path)
    one = report.apply_filters(staged, models=["model_1"])
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")  # else the plan's text is cut
    plan = gold.accuracy_by_difficulty(one)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(status,success)" in plan
    assert "PartitionFilters: [" in plan and "model" in plan.split("PartitionFilters: [")[1].split("]")[0]
    schema = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert "prompt" not in schema and "choices" not in schema and "question_clean" not in schema
