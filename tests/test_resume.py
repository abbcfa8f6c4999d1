"""Silver persistence, checkpoint compatibility, resume idempotence, keep-first."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from quizlake.operators import clean, grade, resume
from quizlake.plans import fixtures as fx
from quizlake.sources import files
from tests.conftest import SF001


def _graded(spark, items=None):
    items = items if items is not None else clean.clean_items(fx.bronze(spark, SF001))
    return grade.grade_responses(items, fx.responses(items), fx.FIXTURE_MODEL, fx.FIXTURE_RUN_TS)


def test_silver_files_keep_types_and_nulls(spark):
    path = tempfile.mkdtemp(prefix="silver-")
    g = _graded(spark)
    files.write_silver(g, path)
    back = files.read_silver(spark, path)
    types = dict(back.dtypes)
    assert (types["ai_correct"], types["temperature"], types["response_time"]) == ("boolean", "bigint", "double")
    grades = [{r[0]: r[1] for r in df.groupBy("ai_correct").count().collect()} for df in (g, back)]
    assert grades[0] == grades[1] and grades[0][None] > 0
    with pytest.raises(ValueError, match="not found"):
        files.read_silver(spark, os.path.join(path, "absent"))
    narrow = tempfile.mkdtemp(prefix="silver-narrow-") + "/t"
    g.select("question_id", "model").write.parquet(narrow)
    with pytest.raises(ValueError, match="ai_correct"):
        files.read_silver(spark, narrow)


def test_run_store_resumes_from_what_was_saved(spark):
    items = clean.clean_items(fx.bronze(spark, SF001))
    resp = fx.responses(items)

    def run(some):
        return grade.grade_responses(some, resp, fx.FIXTURE_MODEL, "t")

    store = resume.RunStore(tempfile.mkdtemp(prefix="run-"))
    assert store.load(spark, items, fx.FIXTURE_MODEL).count() == 0
    first = run(clean.limit_items(items, items.count() // 2))
    store.save_partial(first)
    saved = store.load(spark, items, fx.FIXTURE_MODEL)
    assert saved.count() == first.count() > 0
    with pytest.raises(ValueError, match="parameters"):
        store.load(spark, items, "someone else")
    with pytest.raises(ValueError, match="parameters"):
        store.load(spark, items, fx.FIXTURE_MODEL, max_tokens=7)
    assert store.load(spark, items, fx.FIXTURE_MODEL, restart=True).count() == 0
    merged = resume.merge_results(saved, run(resume.pending(items, saved)))
    store.commit(merged)
    assert store.load(spark, items, fx.FIXTURE_MODEL).count() == items.count()
    store.save_partial(first)  # a later run under way is preferred to the final table
    assert store.load(spark, items, fx.FIXTURE_MODEL).count() == first.count()
    one = items.limit(1)
    assert store.load(spark, one, fx.FIXTURE_MODEL).join(one, "question_id", "left_anti").count() == 0
    other = resume.RunStore(tempfile.mkdtemp(prefix="run-"))
    other.log(spark).commit(replace={other.FINAL: spark.createDataFrame([("q",)], "question_id string")})
    with pytest.raises(ValueError, match="missing required columns"):
        other.load(spark, items, fx.FIXTURE_MODEL)


def test_null_params_are_incompatible(spark):
    g = _graded(spark).withColumn("temperature", F.lit(None).cast("bigint"))
    res = resume.checkpoint_compat(g).first()
    assert res.compatible is False and res.matching_rows == 0


def test_multi_model_partitions_coexist(spark):
    path = tempfile.mkdtemp(prefix="silver-mm-")
    items = clean.clean_items(fx.bronze(spark, SF001))
    r = fx.responses(items)
    files.write_silver(grade.grade_responses(items, r, fx.FIXTURE_MODEL, "t"), path)
    r2 = r.withColumn("model", F.lit("second"))
    files.write_silver(grade.grade_responses(items, r2, "second", "t"), path)
    back = files.read_silver(spark, path)
    assert back.select("model").distinct().count() == 2
    # rewriting one model replaces only its partition
    files.write_silver(grade.grade_responses(items, r2, "second", "t2"), path)
    back = files.read_silver(spark, path)
    assert back.filter("model = 'second'").select("benchmark_timestamp").distinct().first()[0] == "t2"
    assert back.filter(f"model = '{fx.FIXTURE_MODEL}'").count() == items.count()


def test_resume_in_two_halves_equals_whole(spark):
    items = clean.clean_items(fx.bronze(spark, SF001))
    resp = fx.responses(items)
    whole = grade.grade_responses(items, resp, fx.FIXTURE_MODEL, "t")
    first = grade.grade_responses(clean.limit_items(items, 60), resp, fx.FIXTURE_MODEL, "t")
    todo = resume.pending(items, first)
    merged = resume.merge_results(first, grade.grade_responses(todo, resp, fx.FIXTURE_MODEL, "t"))
    cols = ["question_id", "status", "error", "ai_answer", "ai_correct", "response_time"]
    assert sorted(map(tuple, merged.select(cols).collect()), key=str) == \
        sorted(map(tuple, whole.select(cols).collect()), key=str)
    # run again: nothing pending, merge unchanged
    assert resume.pending(items, merged).count() == 0


def test_retry_errors_only_redoes_targeted_errors(spark):
    items = clean.clean_items(fx.bronze(spark, SF001))
    saved = _graded(spark, items)
    kept = resume.retry_errors(saved, items)
    assert kept.filter("status = 'error'").count() == 0
    assert resume.pending(items, kept).count() == saved.filter("status = 'error'").count()


def test_keep_first_under_shuffled_input(spark):
    b = clean.prepare_bronze(fx.bronze(spark, SF001)).repartition(7)
    first = clean.keep_first(b, "question_id")
    mins = b.groupBy("question_id").agg(F.min("ordinal").alias("ordinal"))
    assert first.select("question_id", "ordinal").exceptAll(mins).count() == 0
    assert first.count() == mins.count()


def test_incomplete_bronze_files(spark):
    folder = tempfile.mkdtemp(prefix="bronze-")
    with open(os.path.join(folder, "items.csv"), "w", encoding="utf-8") as f:
        f.write("category,correct_answer\nGeo,Nile\n")
    with pytest.raises(ValueError, match="missing required columns: incorrect_answers, question"):
        files.read_bronze_csv(spark, folder)
    with pytest.raises(ValueError, match="not found"):
        files.read_bronze_csv(spark, folder + "-absent")


def test_keep_first_follows_file_order(spark):
    folder = tempfile.mkdtemp(prefix="bronze-order-")
    head = "question,correct_answer,incorrect_answers,difficulty\n"
    for name, rows in (("a_first.csv", 3), ("b_second.csv", 400)):  # larger files are scheduled first
        with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
            f.write(head + "".join(f"Q{i},A,\"[\"\"B\"\"]\",{name}\n" for i in range(rows)))
    bronze = files.read_bronze_csv(spark, folder)
    first = clean.keep_first(clean.prepare_bronze(bronze), "question_id").collect()
    assert len(first) == 400
    assert sorted(r.question for r in first if r.difficulty == "a_first.csv") == ["Q0", "Q1", "Q2"]
    order = [r.question for r in bronze.orderBy("ordinal").collect()]
    assert order == [f"Q{i}" for i in range(3)] + [f"Q{i}" for i in range(400)]


def test_csv_keeps_text_exactly(spark):
    d = tempfile.mkdtemp(prefix="bronze-rt-")
    rows = [(1, " lead", "trail ", 'quo"te', "multi\nline", "[\"a\"]", "", "3", "t")]
    df = spark.createDataFrame(rows, "ordinal long, category string, type string, difficulty string, question string,"
                                     " incorrect_answers string, correct_answer string, category_id string, fetched_at string")
    files.write_bronze_csv(df, d)
    back = files.read_bronze_csv(spark, d).first()
    assert (back.category, back.type, back.difficulty, back.question, back.correct_answer) == \
        (" lead", "trail ", 'quo"te', "multi\nline", "")
