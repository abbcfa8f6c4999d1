"""The registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the driver's tables (through ``fixtures``) and runs the mart's
operators over all of their rows. ``quizlake.plans.oracle`` holds an independent
DuckDB SQL text for every query that SQL can express.
"""

from __future__ import annotations

import os

from pyspark import StorageLevel
from pyspark.sql import functions as F

from quizlake.functions import html_decode, normalize_answer, parse_distractors, question_id
from quizlake.functions.keys import json_array_text
from quizlake.functions.timefmt import iso_utc_naive
from quizlake.operators import clean, gold, grade, materialized, report, resume, sketches
from quizlake.plans import fixtures as fx
from quizlake.session import fresh_dir, shared_dir
from quizlake.sources import bucketed, files, payloads, queue

LATENCY_PROBS = {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}
SAVED_BUCKETS = 16  # of the bucketed saved results
LISTING_N = 250  # rows of the bounded listing
LIMIT_N = 100  # rows of the --limit query (a limit is its feature)
FILTER_SELECTION = {"models": ["model_1"], "difficulties": ["medium", "hard"],
                    "categories": ["click", "view", "purchase"]}


# --------------------------------------------------------------------------- inputs

def _attempts_ok(spark, sf):
    return report.successful(report.apply_filters(report.prepare_report_input(fx.attempts(spark, sf))))


def _attempts_filtered(spark, sf):
    return report.apply_filters(report.prepare_report_input(fx.attempts(spark, sf)))


def _items(spark, sf):
    """Cleaned items, materialised once (reliable checkpoint in the shared folder):
    grading reads them twice and the cut lineage keeps later plans small."""
    shared_dir(spark)
    items = clean.clean_items(fx.bronze(spark, sf)).persist(StorageLevel.MEMORY_AND_DISK)
    out = items.checkpoint()  # computed once into the cache, then written from it
    items.unpersist()
    return out


def _graded(spark, sf, items=None):
    items = _items(spark, sf) if items is None else items
    return grade.grade_responses(items, fx.responses(items), fx.FIXTURE_MODEL, fx.FIXTURE_RUN_TS)


def _checkpoint(spark, sf, items=None):
    """Silver saved by an earlier run over the first half of the items, read from its files."""
    items = _items(spark, sf) if items is None else items
    first = clean.limit_items(items, items.count() // 2)
    graded = grade.grade_responses(first, fx.responses(items), fx.FIXTURE_MODEL, fx.FIXTURE_RUN_TS)
    run = resume.RunStore(fresh_dir(spark, "run"))
    run.save_partial(graded)
    return run.load(spark, items, fx.FIXTURE_MODEL)


# --------------------------------------------------------------------------- gold

def q_gold_accuracy_overall(spark, sf):
    return gold.accuracy_overall(fx.attempts(spark, sf))


def q_gold_accuracy_by_category(spark, sf):
    return gold.accuracy_by_category(fx.attempts(spark, sf))


def q_gold_accuracy_by_difficulty(spark, sf):
    return gold.accuracy_by_difficulty(fx.attempts(spark, sf))


def q_gold_error_rate(spark, sf):
    return gold.error_rate(fx.attempts(spark, sf))


def q_gold_hardest_questions(spark, sf):
    return gold.hardest_questions(fx.attempts(spark, sf))


def q_gold_hardest_items(spark, sf):
    return gold.hardest_items(fx.attempts(spark, sf))


def q_gold_accuracy_by_category_big(spark, sf):
    return gold.accuracy_by_category(fx.attempts_big(spark, sf))


def q_gold_error_rate_big(spark, sf):
    return gold.error_rate(fx.attempts_big(spark, sf))


def q_gold_on_silver(spark, sf):
    """Gold over the graded Silver of the item bank (the end-to-end chain)."""
    return gold.accuracy_by_difficulty(_graded(spark, sf))


# --------------------------------------------------------------------------- report

def q_report_by_difficulty(spark, sf):
    return report.report_by_difficulty(_attempts_ok(spark, sf))


def q_report_by_type(spark, sf):
    return report.report_by_type(_attempts_ok(spark, sf))


def q_report_by_category(spark, sf):
    return report.report_by_category(_attempts_ok(spark, sf))


def q_report_by_category_difficulty(spark, sf):
    return report.report_by_category_difficulty(_attempts_ok(spark, sf))


def q_report_by_model(spark, sf):
    return report.report_by_model(_attempts_ok(spark, sf))


def q_report_grouping_sets(spark, sf):
    return report.report_grouping_sets(_attempts_ok(spark, sf))


def q_report_kpis(spark, sf):
    return report.report_kpis(_attempts_filtered(spark, sf))


def q_report_kpis_big(spark, sf):
    return report.report_kpis(report.apply_filters(fx.attempts_big(spark, sf)))


def q_report_by_model_big(spark, sf):
    return report.report_by_model(report.successful(report.apply_filters(fx.attempts_big(spark, sf))))


def q_latency_quantiles(spark, sf):
    return report.latency_quantiles(_attempts_ok(spark, sf), ["model"])


def q_execution_quality(spark, sf):
    return report.execution_quality(_attempts_filtered(spark, sf))


def q_error_summary(spark, sf):
    return report.error_summary(_attempts_filtered(spark, sf))


def q_pivot_category_difficulty(spark, sf):
    return report.pivot_category_difficulty(_attempts_ok(spark, sf))


def q_latency_histogram(spark, sf):
    return report.latency_histogram(_attempts_ok(spark, sf))


def q_speed_accuracy(spark, sf):
    return report.speed_accuracy(_attempts_ok(spark, sf))


def q_filter_options(spark, sf):
    return report.filter_options(fx.attempts(spark, sf))


def q_report_filter(spark, sf):
    f = report.apply_filters(fx.attempts(spark, sf), **FILTER_SELECTION)
    return f.select("question_id", "model", "difficulty", "category", "status")


def q_wrong_answers(spark, sf):
    return report.wrong_answers(_attempts_ok(spark, sf)).select(
        "question_id", "model", "category", "difficulty", "ai_answer", "correct_answer_clean", "ai_correct")


def q_detail_listing(spark, sf):
    return report.detail_listing(_attempts_ok(spark, sf))


def q_detail_listing_top(spark, sf):
    """The slowest attempts (a bounded listing; ties at the cut follow the other columns)."""
    return report.detail_listing(_attempts_ok(spark, sf), limit=LISTING_N)


def q_coerce_latency(spark, sf):
    a = fx.attempts(spark, sf)
    r = F.col("ordinal") % 13
    text = F.when(r == 0, "n/a").when(r == 1, "nan").when(r == 2, "12f").when(r == 3, "0x10p0").when(r == 4, " 12.5e2 ")
    a = a.withColumn("response_time", text.otherwise(F.col("response_time").cast("string")))
    return report.prepare_report_input(a).select("question_id", "response_time", "ai_correct")


def q_attempt_label(spark, sf):
    return grade.attempt_label(fx.attempts(spark, sf))


# --------------------------------------------------------------------------- clean

def q_question_id(spark, sf):
    b = fx.bronze(spark, sf)
    return b.select("ordinal", question_id(F.col("category"), F.col("question"), F.col("correct_answer"),
                                           F.col("incorrect_answers")).alias("question_id"))


def q_dedupe_items(spark, sf):
    return clean.keep_first(clean.prepare_bronze(fx.bronze(spark, sf)), "question_id").select(
        "ordinal", "question_id", "difficulty", "source")


def q_duplicate_count(spark, sf):
    return clean.duplicate_count(clean.prepare_bronze(fx.bronze(spark, sf)))


def q_limit_items(spark, sf):
    return clean.limit_items(clean.clean_items(fx.bronze(spark, sf)), LIMIT_N).select("ordinal", "question_id")


def q_html_decode(spark, sf):
    """Character references decoded over each whole page (every byte of the text)."""
    p = fx.table(spark, sf, "pages")
    return p.select("page_id", html_decode(F.col("html")).alias("text"))


def q_normalize_answer(spark, sf):
    b = fx.bronze(spark, sf, with_duplicates=False)
    return b.select("ordinal", normalize_answer(F.col("correct_answer")).alias("answer_key"),
                    normalize_answer(F.col("question")).alias("question_key"))


def q_parse_distractors(spark, sf):
    b = fx.bronze(spark, sf, with_duplicates=False)
    p = parse_distractors(F.col("incorrect_answers"))
    return b.select("ordinal", p["dialect"].alias("list_dialect"),
                    F.when(p["answers"].isNotNull(), F.size(p["answers"])).cast("bigint").alias("n_answers"),
                    json_array_text(p["answers"]).alias("answers_json"),
                    p["error"].alias("list_error"), p["warning"].alias("list_warning"))


def q_clean_items(spark, sf):
    return clean.clean_items(fx.bronze(spark, sf)).select("ordinal", "question_id", "question_clean", "correct_answer_clean",
                                    "incorrect_answers_clean", "cleaning_warning", "list_dialect", "item_error")


def q_build_choices(spark, sf):
    return clean.clean_items(fx.bronze(spark, sf)).select("ordinal", "question_id", "choices")


def q_build_prompt(spark, sf):
    return clean.clean_items(fx.bronze(spark, sf)).select("ordinal", "prompt")


def q_csv_roundtrip(spark, sf):
    path = fresh_dir(spark, "bronze-csv")
    files.write_bronze_csv(fx.bronze(spark, sf), path)
    return files.read_bronze_csv(spark, path)


def q_bronze_defaults(spark, sf):
    path = fresh_dir(spark, "bronze-csv-partial")
    b = fx.bronze(spark, sf).drop("category", "type", "difficulty")
    files.write_bronze_csv(b, path)
    return clean.prepare_bronze(files.read_bronze_csv(spark, path)).select(
        "ordinal", "category", "type", "difficulty", "question_id")


# --------------------------------------------------------------------------- grade

def q_extract_reply(spark, sf):
    r = fx.responses(_items(spark, sf))
    x = grade.extract_reply(F.col("payload"))
    return r.select("question_id", x["valid_json"].alias("valid_json"),
                    x["n_choices"].cast("bigint").alias("n_choices"),
                    x["content"].alias("content"), x["finish_reason"].alias("finish_reason"))


def q_grade_responses(spark, sf):
    return _graded(spark, sf).select("ordinal", "question_id", "status", "error", "ai_answer", "ai_correct",
                                     "response_time", "cleaning_warning")


def q_silver_roundtrip(spark, sf):
    path = fresh_dir(spark, "silver")
    files.write_silver(_graded(spark, sf), path)
    stg = files.stage_view(spark, path)
    return stg.select("ordinal", "question_id", "model", "status", "error", "ai_answer", "ai_correct",
                      "response_time", "temperature", "max_tokens", "prompt_version")


def _staged_attempts(spark, sf):
    """The attempts written as Silver files (one folder a model) and staged as a view."""
    path = fresh_dir(spark, "silver-attempts")
    files.write_silver(fx.attempts(spark, sf), path)
    return files.stage_view(spark, path)


def q_stg_attempts(spark, sf):
    return _staged_attempts(spark, sf).select("question_id", "model", "category", "type", "difficulty", "status", "error",
                                              "ai_answer", "ai_correct", "response_time", "prompt_version")


def q_gold_views(spark, sf):
    """Gold views over the staging view of the Silver files."""
    gold.create_views(_staged_attempts(spark, sf))
    by = spark.table("gold_accuracy_by_category")
    rate = spark.table("gold_error_rate").select(F.col("category").alias("_c"), "error_rate_pct")
    return by.join(rate, by.category.eqNullSafe(F.col("_c")), "left").drop("_c")


def q_report_on_silver(spark, sf):
    staged = report.apply_filters(report.prepare_report_input(_staged_attempts(spark, sf)), models=["model_1"])
    return report.report_by_category_difficulty(report.successful(staged))


def q_detail_export(spark, sf):
    """The wrong answers of the staged attempts, exported as CSV and read back."""
    path = fresh_dir(spark, "detail-csv")
    ok = report.successful(report.apply_filters(report.prepare_report_input(_staged_attempts(spark, sf))))
    files.write_detail_csv(report.detail_listing(ok, only_incorrect=True), path)
    return spark.read.options(**files.CSV_OPTIONS).schema(
        "model string, category string, difficulty string, question_clean string, ai_answer string, "
        "correct_answer_clean string, ai_correct boolean, response_time double").csv(path)


def q_score_batch(spark, sf):
    items = _items(spark, sf)
    resp = grade.score_batch(items, grade.echo_scorer, "echo-model")
    return grade.grade_responses(items, resp, "echo-model", fx.FIXTURE_RUN_TS).select(
        "question_id", "status", "ai_correct", "error")


# --------------------------------------------------------------------------- resume

def q_checkpoint_compat(spark, sf):
    """Three saved files: mixed models (none can resume), one model, one model with a null parameter."""
    a = fx.attempts(spark, sf)
    one = a.filter("model = 'model_1'")
    nulls = one.withColumn("temperature", F.when(F.col("ordinal") % 50 != 1, F.col("temperature")))
    found = [resume.checkpoint_compat(df).withColumn("saved", F.lit(name))
             for name, df in (("mixed", a), ("one model", one), ("null parameter", nulls))]
    return found[0].union(found[1]).union(found[2])


def q_resume_pending(spark, sf):
    items = _items(spark, sf)
    return resume.pending(items, _checkpoint(spark, sf, items)).select("ordinal", "question_id")


def q_resume_retry(spark, sf):
    items = _items(spark, sf)
    kept = resume.retry_errors(_checkpoint(spark, sf, items), items)
    return resume.pending(items, kept).select("ordinal", "question_id")


def q_resume_kept(spark, sf):
    """Checkpoint holding every item twice (original run, then copies) filtered to the
    current source and reduced to the first row per item."""
    items = _items(spark, sf)
    raw = clean.clean_items(fx.bronze(spark, sf), dedupe=False)
    saved = grade.grade_responses(raw, fx.responses(items), fx.FIXTURE_MODEL, fx.FIXTURE_RUN_TS)
    source = items.filter(F.col("item_error").isNull())
    return resume.resume_kept(saved, source).select("ordinal", "question_id", "difficulty", "status")


def q_resume_merge(spark, sf):
    items = _items(spark, sf)
    saved = _checkpoint(spark, sf, items)
    todo = resume.pending(items, saved)
    new = grade.grade_responses(todo, fx.responses(items), fx.FIXTURE_MODEL, fx.FIXTURE_RUN_TS)
    return resume.merge_results(saved, new).select("ordinal", "question_id", "status", "ai_correct")


def q_run_summary(spark, sf):
    items = _items(spark, sf)
    return resume.run_summary(_graded(spark, sf, items), items)


def q_resume_rounds(spark, sf):
    """Scored in saved rounds, stopped after two of them and started again."""
    items = _items(spark, sf)
    run, n = resume.RunStore(fresh_dir(spark, "run-rounds")), items.count() // 4 + 1
    for most in (2, None):
        saved = resume.score_in_rounds(run, items, grade.echo_scorer, "echo-model", fx.FIXTURE_RUN_TS, n, max_rounds=most)
    return saved.select("question_id", "status", "ai_correct", "error")


def q_resume_bucketed(spark, sf):
    """Pending items against saved results that are bucketed by item (the saved side is not moved)."""
    items = _items(spark, sf)
    path = fresh_dir(spark, "saved")
    done = bucketed.write_saved(_checkpoint(spark, sf, items), os.path.basename(path).replace("-", "_"), SAVED_BUCKETS, path)
    return resume.pending(items, done).select("ordinal", "question_id")


# --------------------------------------------------------------------------- materialised Gold

def _gold_store(spark, sf):
    """Gold rows over a growing Silver: one model first, then the others, then the first one replaced."""
    a, silver = fx.attempts(spark, sf), fresh_dir(spark, "silver-gold")
    store = materialized.GoldStore(spark, fresh_dir(spark, "gold"))
    one = F.col("model") == "model_1"
    for part in (a.filter(one & (F.col("ordinal") % 2 == 0)), a.filter(F.col("model").isNull() | ~one), a.filter(one)):
        files.write_silver(part, silver)
        store.refresh(silver)
    return store.parts()


def q_gold_materialised(spark, sf):
    return materialized.accuracy_by_category(_gold_store(spark, sf))


def q_gold_materialised_errors(spark, sf):
    return materialized.error_rate(_gold_store(spark, sf))


def q_latency_sketch(spark, sf):
    """Approximate latency quantiles per model from merged sketches: rows sketched, and whether every
    quantile's rank lies within the stated error of the exact one."""
    ok = _attempts_ok(spark, sf)
    found = sketches.quantiles_from(sketches.merged(sketches.sketches(ok, ["model", "category"], "response_time"), ["model"]),
                                    LATENCY_PROBS)
    errors = sketches.rank_errors(ok, ["model"], "response_time", found, LATENCY_PROBS)
    within = errors.groupBy("model").agg((F.max("error") <= sketches.rank_error()).alias("within_error"))
    return within.join(found.select("model", "rows"), "model")


# --------------------------------------------------------------------------- ingest

def q_ingest_payload(spark, sf):
    """Recorded pages written as files, read back and ingested under the loose policy."""
    path = fresh_dir(spark, "payloads")
    payloads.write_payload_files(fx.payload_pages(spark, sf), path)
    return payloads.ingest_pages(payloads.read_payload_files(spark, path), fetched_at=fx.FIXTURE_RUN_TS,
                                 source=fx.PAYLOAD_SOURCE)


def q_ingest_categories(spark, sf):
    return payloads.ingest_categories(fx.category_catalog_payload(spark, sf))


def q_ingest_counts(spark, sf):
    return payloads.ingest_counts(fx.category_count_payloads(spark, sf))


def q_iso_timestamps(spark, sf):
    """Fetch times rendered as ``isoformat()`` text (C18) for every event. The stored
    values are naive UTC wall clocks."""
    e = fx.table(spark, sf, "events")
    return e.select("event_id", iso_utc_naive(F.col("ts")).alias("fetched_at"))


def q_page_plan(spark, sf):
    return payloads.page_plan(fx.declared_counts(spark, sf))


def q_payload_disposition(spark, sf):
    return payloads.payload_disposition(fx.payload_pages(spark, sf))


def q_bronze_completeness(spark, sf):
    declared = payloads.ingest_counts(fx.category_count_payloads(spark, sf))
    collected = payloads.ingest_pages(fx.payload_pages(spark, sf), fetched_at=fx.FIXTURE_RUN_TS,
                                      source=fx.PAYLOAD_SOURCE)
    return payloads.bronze_completeness(declared, collected)


def _page_queue(spark, sf):
    """The planned pages asked for until they are answered, from recorded attempts."""
    path = fresh_dir(spark, "page-queue")
    run = queue.PageQueue(spark, path, fx.RECORDED_ATTEMPTS)
    counts = payloads.ingest_counts(fx.category_count_payloads(spark, sf))
    plan = payloads.page_plan(counts, "total_question_count", fx.PAGE_ITEMS).select(
        "category_id", F.col("page").alias("page_no"))
    # every round reads both: they are derived once, not from the tables again for each round
    saved = []
    for name, df in (("plan", plan), ("recorded", fx.recorded_attempts(spark, sf))):
        df.write.parquet(f"{path}/{name}")
        saved.append(spark.read.schema(df.schema).parquet(f"{path}/{name}"))
    run.run(saved[0], queue.recorded_transport(saved[1]))
    return run


def q_retry_pages(spark, sf):
    """What became of each planned page, and after how many attempts."""
    return _page_queue(spark, sf).status()


def q_retry_ingest(spark, sf):
    return _page_queue(spark, sf).ingest(fx.FIXTURE_RUN_TS, fx.PAYLOAD_SOURCE)


def q_retry_completeness(spark, sf):
    declared = payloads.ingest_counts(fx.category_count_payloads(spark, sf))
    return payloads.bronze_completeness(declared, q_retry_ingest(spark, sf))


# --------------------------------------------------------------------------- streaming

def q_stream_incremental(spark, sf):
    from quizlake.streaming.incremental import run_incremental_demo
    return run_incremental_demo(spark, sf)


def q_stream_dedupe(spark, sf):
    """First arrivals of the bank's items from the state store: originals, later their copies, then both
    again as new files."""
    from quizlake.streaming.dedupe import start_dedupe

    base = fresh_dir(spark, "stream-dedupe")
    bronze = fx.bronze(spark, sf)
    cut = F.col("ordinal") < fx.DUPLICATE_OFFSET
    for arrival in (bronze.filter(cut), bronze.filter(~cut), bronze):
        arrival.write.mode("append").parquet(f"{base}/source")
        start_dedupe(spark, f"{base}/source", f"{base}/sink", f"{base}/checkpoint", "7 days").awaitTermination()
    return spark.read.parquet(f"{base}/sink").select("question_id", "category", "correct_answer")


QUERIES = {name[2:]: fn for name, fn in list(globals().items()) if name.startswith("q_") and callable(fn)}
