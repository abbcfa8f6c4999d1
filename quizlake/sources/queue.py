"""Work queue for item-bank pages: rate-limited pages are planned again with an attempt number.

A round asks for every page of the queue at once through a ``transport`` (a function from a queue
DataFrame to answers; on a cluster a ``mapInPandas`` client, in tests a join with recorded answers).
Its answers are written as one folder per attempt before anything is decided, so a run that dies
asks again only for the round under way. From them the next queue follows: pages answered with a
rate limit or not at all are asked again, one attempt higher, until they are answered or
``max_attempts`` is reached. Pages behind a page that ends its category are not asked for any more.

Each round reads only the answers of its own attempt; the ends of categories, one row each, are
carried from round to round. The number of rounds is bounded by ``max_attempts``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from quizlake import constants as K
from quizlake.sources.payloads import disposition, ingest_pages
from quizlake.sources.versions import folder_missing

#: A queue (category_id, page_no, attempt, ...) to answers (category_id, page_no, payload).
Transport = Callable[[DataFrame], DataFrame]

ANSWER_SCHEMA = "category_id bigint, page_no bigint, attempt int, asked boolean, payload string"
MAX_ATTEMPTS = 5

PAGE_KEY = ["category_id", "page_no"]


def response_code(payload="payload"):
    """Code of a recorded answer; null where it is not JSON or has none."""
    return F.get_json_object(payload, "$.response_code").cast("int")


def _again():
    """Answers that put their page back into the queue: none, or a rate limit."""
    return F.col("payload").isNull() | F.coalesce(response_code() == K.RC_RATE_LIMIT, F.lit(False))


def _ends(answers: DataFrame) -> DataFrame:
    """(category_id, stop): the first page answered with anything but items or a rate limit."""
    code = response_code()
    ends = ~_again() & ~F.coalesce(code == K.RC_OK, F.lit(False))
    return answers.filter(ends).groupBy("category_id").agg(F.min("page_no").alias("stop"))


class PageQueue:
    """Answers of all attempts below ``path``, and what is still to ask."""

    def __init__(self, spark, path: str, max_attempts: int = MAX_ATTEMPTS):
        self.spark, self.path, self.max_attempts = spark, path, max_attempts

    def _folder(self, attempt: int) -> str:
        return f"{self.path}/attempt={attempt}"

    def _round(self, attempt: int) -> DataFrame | None:
        """Answers of one attempt, None where that round did not end."""
        try:
            done = self.spark.read.schema("done boolean").parquet(f"{self.path}/done={attempt}")
        except AnalysisException as exc:
            if not folder_missing(exc):
                raise
            return None
        if done.isEmpty():
            return None
        return self.spark.read.schema(ANSWER_SCHEMA).parquet(self._folder(attempt))

    def run(self, plan: DataFrame, transport: Transport) -> int:
        """Ask until nothing is left to ask; the number of rounds that asked for something."""
        queue = plan.select("*", F.lit(0).alias("attempt"))
        ends = self.spark.createDataFrame([], "category_id bigint, stop bigint")
        rounds = 0
        for attempt in range(self.max_attempts):
            answers = self._round(attempt)
            if answers is None:
                if queue.isEmpty():
                    break
                got = transport(queue).select(*PAGE_KEY, "payload", F.lit(True).alias("answered"))
                asked = queue.select(*PAGE_KEY, "attempt").join(got, PAGE_KEY, "left").select(
                    *PAGE_KEY, "attempt", F.col("answered").isNotNull().alias("asked"), "payload")
                asked.write.mode("overwrite").parquet(self._folder(attempt))
                self.spark.range(1).select(F.lit(True).alias("done")).coalesce(1).write.mode("overwrite").parquet(
                    f"{self.path}/done={attempt}")
                answers = self._round(attempt)
            rounds += 1
            ends = (ends.unionByName(_ends(answers)).groupBy("category_id").agg(F.min("stop").alias("stop")))
            left = answers.filter(_again()).join(ends, "category_id", "left")
            left = left.filter(F.col("stop").isNull() | (F.col("page_no") < F.col("stop")))
            queue = (plan.join(left.select(*PAGE_KEY).distinct(), PAGE_KEY, "left_semi")
                     .withColumn("attempt", F.lit(attempt + 1)))
        return rounds

    def answers(self) -> DataFrame:
        """Every answer of every attempt."""
        rounds = [r for r in (self._round(a) for a in range(self.max_attempts)) if r is not None]
        if not rounds:
            return self.spark.createDataFrame([], ANSWER_SCHEMA)
        out = rounds[0]
        for r in rounds[1:]:
            out = out.unionByName(r)
        return out

    def last_answers(self) -> DataFrame:
        """One row per page: its last attempt (0-based), how often it was asked, that answer."""
        best = F.max(F.struct("attempt", "payload"))
        return (self.answers().groupBy(*PAGE_KEY)
                .agg(best.alias("b"), F.count(F.lit(1)).alias("attempts"))
                .select(*PAGE_KEY, F.col("b.attempt").alias("attempt"), "attempts", F.col("b.payload").alias("payload")))

    def status(self) -> DataFrame:
        """Per page: attempts, last response code and what became of it: ``accept``, ``stop`` (ends its
        category), ``skipped`` (behind a stop) or ``gave_up`` (still rate limited or unanswered)."""
        last = self.last_answers().select(*PAGE_KEY, "attempts", response_code().alias("response_code"),
                                          _again().alias("again"))
        _, loose = disposition(F.col("response_code"))
        action = F.when(F.col("again"), "gave_up").otherwise(loose)
        stops = last.withColumn("action", action).filter("action = 'stop'").groupBy("category_id").agg(
            F.min("page_no").alias("stop"))
        return last.join(stops, "category_id", "left").select(
            *PAGE_KEY, "attempts", "response_code",
            F.when(F.col("page_no") > F.col("stop"), "skipped").otherwise(action).alias("action"))

    def ingest(self, fetched_at: str, source: str, strict: bool = False) -> DataFrame:
        """Bronze rows of the accepted pages. ``strict`` fails on pages that stop a category and on
        pages that were given up."""
        last = self.last_answers()
        if strict:
            last = last.withColumn("payload", F.when(~_again(), F.col("payload")).otherwise(F.raise_error(
                F.concat(F.lit("item bank error: no answer after "), F.col("attempts").cast("string"),
                         F.lit(" attempts")))))
        else:  # pages without any answer neither count nor stop their category
            last = last.filter(F.col("payload").isNotNull())
        return ingest_pages(last.select(*PAGE_KEY, "payload"), fetched_at, source, strict)


def recorded_transport(recorded: DataFrame) -> Transport:
    """Answers from a table of recorded attempts (category_id, page_no, attempt, payload)."""
    def transport(queue: DataFrame) -> DataFrame:
        return queue.select(*PAGE_KEY, "attempt").join(recorded, [*PAGE_KEY, "attempt"])

    return transport
