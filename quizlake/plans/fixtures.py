"""Adapters from the driver's tables to the mart's shapes.

Every fixture is derived by Spark from the given tables, so its size grows with the
scale factor. The same derivations are written independently in DuckDB SQL in
``quizlake.plans.oracle`` for the correctness check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizlake import constants as K

FIXTURE_MODEL = "fixture-model"
FIXTURE_RUN_TS = "2024-01-01T00:00:00+00:00"
PAYLOAD_SOURCE = "recorded-api"  # Bronze ``source`` label of the recorded API pages
DUPLICATE_OFFSET = 1 << 52  # the copy flag of an ordinal: copies come after all originals


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _difficulty(n: F.Column) -> F.Column:
    return F.when(n % 3 == 0, "easy").when(n % 3 == 1, "medium").otherwise("hard")


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver-shaped graded attempts from ``events`` (one attempt per event), with null models,
    categories and statuses, an unlisted difficulty, and successes without a grade."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    return (
        e.select("event_id", "user_id", "event_type", "value", k.alias("k"))
        .select(
            F.col("event_id").cast("string").alias("question_id"),
            F.col("event_id").alias("ordinal"),
            F.when(F.col("event_id") % 89 != 3, F.col("event_type")).alias("category"),
            F.when(F.col("event_id") % 5 == 0, "boolean").otherwise("multiple").alias("type"),
            F.when(F.col("event_id") % 83 == 5, "expert").otherwise(_difficulty(F.col("user_id"))).alias("difficulty"),
            F.when(F.col("event_id") % 97 != 7, F.concat(F.lit("model_"), (F.col("user_id") % 2).cast("string"))).alias("model"),
            F.lit(K.PROMPT_VERSION).alias("prompt_version"),
            F.lit(K.TEMPERATURE).cast("bigint").alias("temperature"),
            F.lit(K.MAX_TOKENS).cast("bigint").alias("max_tokens"),
            F.concat(F.lit("Question "), F.col("event_id").cast("string")).alias("question_clean"),
            F.concat(F.lit("Answer "), (F.col("k") % 4).cast("string")).alias("correct_answer_clean"),
            F.when(F.col("k") % 10 == 0, F.lit(None).cast("string"))
            .when(F.col("k") % 3 == 0, F.concat(F.lit("Answer "), (F.col("k") % 4).cast("string")))
            .otherwise(F.concat(F.lit("Answer "), ((F.col("k") + 1) % 4).cast("string"))).alias("ai_answer"),
            F.when((F.col("k") % 10 == 0) | (F.col("event_id") % 73 == 9), F.lit(None).cast("boolean"))
            .otherwise(F.col("k") % 3 == 0).alias("ai_correct"),
            F.col("value").alias("response_time"),
            F.when(F.col("event_id") % 79 == 11, F.lit(None).cast("string"))
            .when(F.col("k") % 10 == 0, K.STATUS_ERROR).otherwise(K.STATUS_SUCCESS).alias("status"),
            F.when(F.col("k") % 20 == 0, F.lit("Timeout: timeout")).alias("error"),
        )
    )


def attempts_big(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bench-sized attempts table from ``lineitem`` (one attempt per line)."""
    li = table(spark, sf_dir, "lineitem")
    err = F.col("l_partkey") % 10 == 0
    correct = F.col("l_suppkey") % 3 == 0
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("question_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ordinal"),
        F.col("l_returnflag").alias("category"),
        F.col("l_linestatus").alias("type"),
        _difficulty(F.col("l_linenumber")).alias("difficulty"),
        F.concat(F.lit("model_"), (F.col("l_suppkey") % 2).cast("string")).alias("model"),
        F.lit(K.PROMPT_VERSION).alias("prompt_version"),
        F.lit(K.TEMPERATURE).cast("bigint").alias("temperature"),
        F.lit(K.MAX_TOKENS).cast("bigint").alias("max_tokens"),
        F.concat(F.lit("Order "), F.col("l_orderkey").cast("string")).alias("question_clean"),
        F.concat(F.lit("Part "), F.col("l_partkey").cast("string")).alias("correct_answer_clean"),
        F.when(err, F.lit(None).cast("string"))
        .when(correct, F.concat(F.lit("Part "), F.col("l_partkey").cast("string")))
        .otherwise(F.concat(F.lit("Supplier "), F.col("l_suppkey").cast("string"))).alias("ai_answer"),
        F.when(err, F.lit(None).cast("boolean")).otherwise(correct).alias("ai_correct"),
        F.col("l_quantity").alias("response_time"),
        F.when(err, K.STATUS_ERROR).otherwise(K.STATUS_SUCCESS).alias("status"),
        F.when(F.col("l_partkey") % 20 == 0, F.lit("Timeout: timeout")).alias("error"),
    )


def _bronze_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One item per page: the whole page as question, part names as answers (before encoding).
    Some questions are blank and some answers empty."""
    pages = table(spark, sf_dir, "pages")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    n = part.select(F.count(F.lit(1))).scalar()
    pid = F.col("page_id")
    base = pages.select(
        pid,
        F.when(pid % 31 == 3, F.lit("  ")).otherwise(F.col("html")).alias("question"),
        (pid % n).alias("kc"), ((pid * 7 + 1) % n).alias("ka"), ((pid * 13 + 2) % n).alias("kb"),
    )
    pc = part.select(F.col("p_partkey").alias("kc"),
                     F.concat("p_name", F.lit(" &amp; "), "p_brand").alias("correct_answer"))
    pa = part.select(F.col("p_partkey").alias("ka"), F.concat("p_name", F.lit(" &amp; co")).alias("inc1"))
    pb = part.select(F.col("p_partkey").alias("kb"), F.col("p_name").alias("inc2"))
    # parts grow with the items: shuffled, as a broadcast goes through the driver each time it is read
    j = base
    for side, key in ((pc, "kc"), (pa, "ka"), (pb, "kb")):
        j = j.join(side.hint("merge"), key, "left")
    return j.select(
        pid.alias("ordinal"),
        F.concat(F.lit("cat_"), (pid % 7).cast("string")).alias("category"),
        F.when(pid % 5 == 0, "boolean").otherwise("multiple").alias("type"),
        _difficulty(pid).alias("difficulty"),
        "question",
        F.when(pid % 29 == 7, F.lit("")).otherwise(F.coalesce("correct_answer", F.lit(""))).alias("correct_answer"),
        F.coalesce("inc1", F.lit("")).alias("inc1"), F.coalesce("inc2", F.lit("")).alias("inc2"),
        (pid % 7).alias("cat_no"),
    )


def bronze(spark: SparkSession, sf_dir: str, with_duplicates: bool = True) -> DataFrame:
    """Bronze item rows (all text) from ``pages`` and ``part``.

    The question is the whole page (it carries HTML entities); answers are part names.
    Distractor lists use the JSON dialect, the Python-literal dialect (with escapes), are
    tuples, hold a non-text element or are garbage.
    With ``with_duplicates`` every item appears a second time later in file order
    with another difficulty and fetch time (same item key), which keep-first dedupe
    must drop.
    """
    b = _bronze_base(spark, sf_dir)
    pid = F.col("ordinal")
    q = F.lit("'")
    inc = (
        F.when(pid % 17 == 5, F.lit("garbage"))
        .when(pid % 17 == 9, F.concat(F.lit("("), q, "inc1", q, F.lit(",)")))
        .when(pid % 17 == 13, F.concat(F.lit("["), q, "inc1", q, F.lit(", None]")))
        .when(pid % 10 == 7, F.concat(F.lit("["), q, "inc1", F.lit("\\xa0"), q, F.lit(", u"), q, F.lit("\\u00e9 "), "inc2", q, F.lit("]")))
        .when(pid % 10 == 3, F.concat(F.lit("["), q, "inc1", q, F.lit(", "), q, "inc2", q, F.lit("]")))
        .otherwise(F.concat(F.lit('["'), "inc1", F.lit('", "'), "inc2", F.lit('"]')))
    )
    items = b.select(
        "ordinal", "category", "type", "difficulty", "question", "correct_answer",
        inc.alias("incorrect_answers"),
        F.lit("fixture").alias("source"),
        F.col("cat_no").cast("string").alias("category_id"),
        F.lit(FIXTURE_RUN_TS).alias("fetched_at"),
    )
    if not with_duplicates:
        return items
    dups = items.select(
        (F.col("ordinal") + DUPLICATE_OFFSET).alias("ordinal"), "category", "type",
        _difficulty(F.col("ordinal") + 1).alias("difficulty"), "question", "correct_answer",
        "incorrect_answers", F.lit("fixture-copy").alias("source"), "category_id",
        F.lit("2024-01-02T00:00:00+00:00").alias("fetched_at"),
    )
    return items.unionByName(dups)


PAGE_ITEMS = 10
ITEMS_PER_BLOCK = 7 * PAGE_ITEMS  # page_id % 7 is the category: ten items a recorded page


def page_response_code(cat_no: F.Column, page_no: F.Column) -> F.Column:
    """Recorded response code of a page: mostly 0, sometimes 5 (rate limit), 4 (token
    empty), 1 (no results), or null (the page is not JSON)."""
    h = (page_no * 7 + cat_no) % 23
    return F.when(h == 20, F.lit(None).cast("int")).when(h == 5, 5).when(h == 11, 4).when(h == 17, 1).otherwise(0)


def payload_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded item-bank API pages: (category_id, page_no, payload JSON text).

    Each page holds at most ten items of one category, in item order; a page's items
    are bounded, so gathering them per page never builds an unbounded group.
    """
    pages = _item_pages(spark, sf_dir)
    rc = page_response_code(F.col("category_id"), F.col("page_no"))
    payload = F.to_json(F.struct(rc.alias("response_code"),
                                 F.when(rc == 0, F.transform("items", lambda x: x["r"]))
                                 .otherwise(F.array()).alias("results")))
    payload = F.when(rc.isNull(), F.lit("<html>busy</html>")).otherwise(payload)
    return pages.select("category_id", "page_no", payload.alias("payload"))


def _item_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(category_id, page_no, items): the item bank in pages of at most ten items."""
    b = _bronze_base(spark, sf_dir)
    item = F.struct(F.col("ordinal").alias("o"), F.struct(
        "category", "type", "difficulty", "question", "correct_answer",
        F.array("inc1", "inc2").alias("incorrect_answers")).alias("r"))
    return (b.groupBy(F.col("cat_no").alias("category_id"), (F.col("ordinal") / ITEMS_PER_BLOCK).cast("bigint").alias("page_no"))
            .agg(F.array_sort(F.collect_list(item)).alias("items")))


RECORDED_ATTEMPTS = 4  # attempts that the retry queries make


def recorded_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded answers per attempt: (category_id, page_no, attempt, payload).

    Every third page is rate limited for its first 1 to 5 attempts, so some need more attempts than
    are made; some of them are not answered at all the first time. The others answer at once, a few
    with another code."""
    pages = _item_pages(spark, sf_dir)
    page, cat = F.col("page_no"), F.col("category_id")
    limited = (page + cat) % 3 == 1
    waits = F.when(limited, 1 + (page * 2 + cat) % 5).otherwise(0)
    pages = pages.select("*", waits.alias("waits")).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("waits").cast("int"))).alias("attempt"))
    silent = (F.col("attempt") == 0) & limited & ((page + 3 * cat) % 4 == 0)
    rc = F.when(F.col("attempt") < F.col("waits"), 5).when(~limited & ((page * 7 + cat) % 23 == 11), 4) \
        .when(~limited & ((page * 7 + cat) % 23 == 20), F.lit(None).cast("int")).otherwise(0)
    payload = F.to_json(F.struct(rc.alias("response_code"),
                                 F.when(rc == 0, F.transform("items", lambda x: x["r"])).otherwise(F.array()).alias("results")))
    payload = F.when(rc.isNull(), F.lit("<html>busy</html>")).otherwise(payload)
    return pages.filter(~silent).select("category_id", "page_no", "attempt", payload.alias("payload"))


def category_count_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared question count per category (count-endpoint documents)."""
    b = _bronze_base(spark, sf_dir)
    counts = b.groupBy(F.col("cat_no").alias("category_id")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("category_id", F.to_json(F.struct(
        F.col("category_id"),
        F.struct(F.col("n").alias("total_question_count")).alias("category_question_count"))).alias("payload"))


def category_catalog_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The category-list document (one document; its size is the number of categories)."""
    b = _bronze_base(spark, sf_dir)
    cats = b.select(F.col("cat_no").alias("id"), F.col("category").alias("name")).distinct()
    return cats.agg(F.to_json(F.struct(F.array_sort(F.collect_list(F.struct("id", "name")))
                                       .alias("trivia_categories"))).alias("payload"))


def declared_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared totals per category for the page plan: lineitem rows per return flag, and one
    empty category per region."""
    li = table(spark, sf_dir, "lineitem")
    none = table(spark, sf_dir, "region").select(F.col("r_name").alias("category"), F.lit(0).cast("bigint").alias("total"))
    return li.groupBy(F.col("l_returnflag").alias("category")).agg(F.count(F.lit(1)).alias("total")).union(none)


#: Malformed replies; ``None`` stands for a good one followed by other text.
MALFORMED = ['{"choices": [', '{"choices": []}', '{"error": "overloaded"}', "[1, 2]", None,
             '{"choices": [{"message": {"content": 42}, "finish_reason": "stop"}]}',
             '{"choices": [{"message": {"content": {"a": 1}}, "finish_reason": "stop"}]}',
             '{"choices": [{"message": {}, "finish_reason": "stop"}]}']


def responses(items: DataFrame, model: str = FIXTURE_MODEL) -> DataFrame:
    """Recorded model replies for cleaned items, one branch per ``ordinal % 11``.

    0 no reply, 1 transport error, 2 malformed payload (8 kinds), 3 blank content,
    4 truncated, 5 upper-cased answer with spaces and a dot, 6 unrelated text,
    7 sentence containing the answer, 8 answer with an entity, 9-10 exact answer.
    """
    b = F.col("ordinal") % 11
    c = F.col("correct_answer_clean")
    content = (
        F.when(b == 3, F.lit("   "))
        .when(b == 5, F.concat(F.lit("  "), F.upper(c), F.lit(". ")))
        .when(b == 6, F.lit("I do not know"))
        .when(b == 7, F.concat(F.lit("It is "), c, F.lit(".")))
        .when(b == 8, F.col("correct_answer"))
        .otherwise(c)
    )
    finish = F.when(b == 4, "length").otherwise("stop")
    good = F.to_json(F.struct(F.array(F.struct(F.struct(content.alias("content")).alias("message"),
                                                 finish.alias("finish_reason"))).alias("choices")))
    kind = F.floor(F.col("ordinal") / 11) % len(MALFORMED)
    malformed = F.concat(good, F.lit(" trailing"))
    for i, text in enumerate(MALFORMED):
        if text is not None:
            malformed = F.when(kind == i, F.lit(text)).otherwise(malformed)
    return items.filter(b != 0).select(
        F.lit(model).alias("model"),
        "question_id",
        F.when(b == 1, F.lit(None).cast("string")).when(b == 2, malformed).otherwise(good).alias("payload"),
        ((F.col("ordinal") % 7).cast("double") / 4).alias("response_time"),
        F.when(b == 1, F.lit("Timeout: timeout")).alias("transport_error"),
    )
