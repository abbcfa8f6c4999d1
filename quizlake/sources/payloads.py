"""Item-bank ingest from recorded API documents (pages, category list, counts).

The original tool pages a REST API one request at a time; here the recorded
documents are a table (one JSON text per page) and ingest is a parse + explode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizlake import constants as K
from quizlake.functions.keys import json_array_text
from quizlake.schemas import (CATEGORIES_PAYLOAD_SCHEMA, COUNT_PAYLOAD_SCHEMA,
                              PAGE_PAYLOAD_SCHEMA)


PAGE_FILE_SCHEMA = "category_id bigint, page_no bigint, payload string"


def write_payload_files(pages: DataFrame, path: str) -> None:
    """Recorded pages as JSON-lines files: category, page number and the document's text."""
    pages.select("category_id", "page_no", "payload").write.json(path)


def read_payload_files(spark, path: str) -> DataFrame:
    """Recorded pages as ``write_payload_files`` wrote them."""
    return spark.read.schema(PAGE_FILE_SCHEMA).json(path)


def ingest_categories(docs: DataFrame) -> DataFrame:
    """(id, name) per category from the category-list document(s)."""
    return (docs.select(F.from_json("payload", CATEGORIES_PAYLOAD_SCHEMA).alias("d"))
            .select(F.inline("d.trivia_categories")))


def ingest_counts(docs: DataFrame) -> DataFrame:
    """Declared question count per category from the count documents."""
    d = docs.select(F.from_json("payload", COUNT_PAYLOAD_SCHEMA).alias("d"))
    return d.select(F.col("d.category_id").alias("category_id"),
                    F.col("d.category_question_count.total_question_count").alias("total_question_count"))


PLAN_BLOCK = 1 << 16  # pages planned from one row


def page_plan(counts: DataFrame, total_col: str = "total", page_size: int = K.PAGE_SIZE) -> DataFrame:
    """Requests needed per category: ``min(page_size, remaining)`` items each; a
    category with no questions needs none."""
    t = F.col(total_col)
    last = F.expr(f"({total_col} - 1) div {page_size}")
    block = F.sequence(F.lit(0).cast("bigint"), F.expr(f"(({total_col} - 1) div {page_size}) div {PLAN_BLOCK}"))
    # blocks of pages first, dealt over the tasks, then the pages of each block
    blocks = counts.filter(t > 0).withColumn("_b", F.explode(block)).repartition(*counts.columns, "_b")
    pages = F.sequence(F.col("_b") * PLAN_BLOCK, F.least(last, (F.col("_b") + 1) * PLAN_BLOCK - 1))
    return (blocks.withColumn("page", F.explode(pages)).drop("_b")
            .withColumn("amount", F.least(F.lit(page_size).cast("bigint"), t - F.col("page") * page_size)))


def disposition(rc: Column) -> tuple[Column, Column]:
    """What each policy does with a page: strict accepts 0, retries 5, fails the
    job on anything else; loose accepts 0, retries 5, stops the category otherwise."""
    strict = F.when(rc == K.RC_OK, "accept").when(rc == K.RC_RATE_LIMIT, "retry").otherwise("fail")
    loose = F.when(rc == K.RC_OK, "accept").when(rc == K.RC_RATE_LIMIT, "retry").otherwise("stop")
    return strict, loose


def _with_stop(pages: DataFrame) -> DataFrame:
    """Adds ``_stop``: the category's first page that is neither accepted nor retried (an
    unreadable page has no response code and stops too)."""
    bad = ~F.coalesce(F.col("response_code").isin(K.RC_OK, K.RC_RATE_LIMIT), F.lit(False))
    stop = pages.filter(bad).groupBy("category_id").agg(F.min("page_no").alias("_stop"))
    return pages.join(stop, "category_id", "left")


def payload_disposition(pages: DataFrame) -> DataFrame:
    """Per recorded page: response code, strict and loose action. Under the loose
    policy the pages after a category's first stop are never requested ("skipped")."""
    rc = F.get_json_object("payload", "$.response_code").cast("int")
    d = pages.select("category_id", "page_no", rc.alias("response_code"))
    strict, loose = disposition(F.col("response_code"))
    return (_with_stop(d)
            .select("category_id", "page_no", "response_code", strict.alias("strict_action"),
                    F.when(F.col("page_no") > F.col("_stop"), "skipped").otherwise(loose).alias("loose_action")))


PAGE_BITS, ITEM_BITS = 37, 6  # pages of a category and items of a page that an ordinal can tell apart


def page_ordinal(category: Column, page: Column, pos: Column) -> Column:
    """Request order as one number; parts that do not fit their bits fail the job."""
    fits = ((category >= 0) & (category < 1 << (63 - PAGE_BITS - ITEM_BITS)) & (page >= 0) & (page < 1 << PAGE_BITS)
            & (pos < 1 << ITEM_BITS))
    packed = category * (1 << (PAGE_BITS + ITEM_BITS)) + page * (1 << ITEM_BITS) + pos
    return F.when(fits, packed).otherwise(F.raise_error(F.lit("category, page or item number out of range")).cast("bigint"))


def ingest_pages(pages: DataFrame, fetched_at: str, source: str,
                 strict: bool = False) -> DataFrame:
    """Bronze rows from accepted pages, in request order (``ordinal``).

    ``incorrect_answers`` is stored as JSON text exactly as ``json.dumps`` writes it;
    ``source`` labels where the documents came from (written on every row).
    Loose policy: a category ends at its first page that is neither accepted nor retried, later
    pages are never requested. With ``strict`` such a page fails the job. ``payload_disposition``
    reports every page, unreadable ones too.
    """
    d = pages.select("category_id", "page_no", F.from_json("payload", PAGE_PAYLOAD_SCHEMA).alias("d"))
    d = d.withColumn("response_code", F.col("d.response_code"))
    if strict:
        known = F.coalesce(F.col("response_code").isin(K.RC_OK, K.RC_RATE_LIMIT), F.lit(False))
        code = F.coalesce(F.col("response_code").cast("string"), F.lit("none (unreadable page)"))
        ok = d.filter(F.when(known, F.col("response_code") == K.RC_OK).otherwise(
            F.raise_error(F.concat(F.lit("item bank error: response_code="), code)).cast("boolean")))
    else:
        ok = _with_stop(d).filter((F.col("response_code") == K.RC_OK)
                                  & (F.col("_stop").isNull() | (F.col("page_no") < F.col("_stop"))))
    rows = ok.select("category_id", "page_no", F.posexplode("d.results").alias("pos", "r"))
    return rows.select(
        page_ordinal(F.col("category_id"), F.col("page_no"), F.col("pos")).alias("ordinal"),
        F.col("r.category").alias("category"), F.col("r.type").alias("type"),
        F.col("r.difficulty").alias("difficulty"), F.col("r.question").alias("question"),
        F.col("r.correct_answer").alias("correct_answer"),
        json_array_text(F.col("r.incorrect_answers")).alias("incorrect_answers"),
        F.lit(source).alias("source"), F.col("category_id").cast("string").alias("category_id"),
        F.lit(fetched_at).alias("fetched_at"),
    )


def bronze_completeness(declared: DataFrame, collected: DataFrame) -> DataFrame:
    """Declared vs collected items per category (full outer: either side may miss)."""
    c = collected.groupBy("category_id").agg(F.count(F.lit(1)).alias("collected"))
    d = declared.select(F.col("category_id").cast("string").alias("category_id"),
                        F.col("total_question_count").alias("declared"))
    j = d.join(c, "category_id", "full_outer")
    return j.select("category_id", F.coalesce("declared", F.lit(0)).alias("declared"),
                    F.coalesce("collected", F.lit(0)).alias("collected"),
                    (F.coalesce("declared", F.lit(0)) - F.coalesce("collected", F.lit(0))).alias("missing"))
