"""Incremental runs: checkpoint compatibility, pending work, retries, merges, summaries.

Silver is keyed by (model, prompt_version, temperature, max_tokens, question_id), so
several models and parameter sets live side by side; the id-set operations of the
original loop become semi / anti joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizlake import constants as K
from quizlake.operators.clean import keep_first, limit_items
from quizlake.operators.gold import pct
from quizlake.operators.grade import Scorer, grade_responses, score_batch
from quizlake.operators.quantiles import quantiles_of, value_counts
from quizlake.operators.report import mean_value
from quizlake.schemas import SILVER_SCHEMA, conform, require_columns
from quizlake.sources.versions import VersionLog


def _params_match(model, prompt_version, temperature, max_tokens):
    return ((F.col("model") == model) & (F.col("prompt_version") == prompt_version)
            & (F.col("temperature") == temperature) & (F.col("max_tokens") == max_tokens))


def checkpoint_compat(saved: DataFrame, prompt_version: str = K.PROMPT_VERSION,
                      temperature: int = K.TEMPERATURE, max_tokens: int = K.MAX_TOKENS) -> DataFrame:
    """For each model present in the checkpoint: can a run of that model resume from it?

    All rows must match (a null compares as a mismatch), so one foreign row rejects
    the whole file. Computed without pairing models with rows: matching rows per model
    against the file's total row count.
    """
    total = saved.select(F.count(F.lit(1))).scalar()
    match = F.coalesce(_params_match(F.col("model"), F.lit(prompt_version), F.lit(temperature),
                                     F.lit(max_tokens)), F.lit(False))
    per_model = (saved.filter(F.col("model").isNotNull())
                 .groupBy("model").agg(F.count_if(match).alias("matching_rows")))
    return per_model.select("model", F.lit(total).alias("rows"), "matching_rows",
                            (F.lit(total) - F.col("matching_rows")).alias("incompatible_rows"),
                            (F.col("matching_rows") == F.lit(total)).alias("compatible"))


def assert_compatible(saved: DataFrame, model: str, prompt_version: str = K.PROMPT_VERSION,
                      temperature: int = K.TEMPERATURE, max_tokens: int = K.MAX_TOKENS) -> None:
    """Raise unless every checkpoint row was produced with the same parameters."""
    bad = saved.filter(~F.coalesce(_params_match(F.lit(model), F.lit(prompt_version), F.lit(temperature),
                                                 F.lit(max_tokens)), F.lit(False)))
    if not bad.isEmpty():
        raise ValueError("checkpoint was produced by another model or other parameters; use restart")


class RunStore:
    """A run's results on shared storage: a partial table while it lasts, the final one after.

    Both are targets of one ``VersionLog``: saving and committing write new folders and then one log
    entry, so a run that dies at any moment resumes from exactly what its last entry names, and the
    final table replaces the partial one in a single step. Loading prefers the partial table, refuses
    results of another model or other parameters, and keeps the first saved row of each item that is
    still in the source. Results that the log names but that are gone are an error."""

    PARTIAL, FINAL = "partial", "final"

    def __init__(self, path: str):
        self.path = path

    def log(self, spark) -> VersionLog:
        return VersionLog(spark, self.path)

    def load(self, spark, source: DataFrame, model: str, restart: bool = False, **parameters) -> DataFrame:
        log = self.log(spark)
        saved = None
        if not restart:
            held = log.targets()
            saved = log.read(self.PARTIAL if self.PARTIAL in held else self.FINAL)
        if saved is None:
            return spark.createDataFrame([], SILVER_SCHEMA)
        require_columns(saved, K.CHECKPOINT_REQUIRED_COLUMNS, "checkpoint")
        assert_compatible(saved, model, **parameters)
        return resume_kept(saved, source)

    def save_partial(self, results: DataFrame) -> None:
        """All results so far (they may have been read from the table that they replace)."""
        self.log(results.sparkSession).commit(replace={self.PARTIAL: conform(results, SILVER_SCHEMA)})

    def add_partial(self, results: DataFrame) -> None:
        """Further results next to the saved ones, which are not written again."""
        self.log(results.sparkSession).commit(append={self.PARTIAL: conform(results, SILVER_SCHEMA)})

    def commit(self, results: DataFrame) -> None:
        """The final table; the partial one goes in the same step."""
        self.log(results.sparkSession).commit(
            replace={self.FINAL: conform(results, SILVER_SCHEMA), self.PARTIAL: None})


def score_in_rounds(store: RunStore, items: DataFrame, scorer: Scorer, model: str, run_ts: str, rows_per_round: int,
                    limit: int | None = None, retry: bool = False, max_rounds: int | None = None,
                    partitions: int | None = None, **parameters) -> DataFrame:
    """Score what is not done yet, ``rows_per_round`` items at a time in file order, each round saved.

    A run that is stopped loses at most the round under way; started again it goes on with the items
    that are not saved. ``limit`` targets the first items in file order, ``retry`` scores their saved
    errors again. After the last round the results become final. ``max_rounds`` ends the call earlier
    (the saved rounds stay partial). Returns all saved results.
    """
    spark = items.sparkSession
    selected = items if limit is None else limit_items(items, limit)
    done = store.load(spark, items, model, **parameters)
    if retry:
        store.save_partial(retry_errors(done, selected))
    elif store.PARTIAL not in store.log(spark).targets():
        store.save_partial(done)
    rounds = 0
    while max_rounds is None or rounds < max_rounds:
        done = store.load(spark, items, model, **parameters)
        todo = limit_items(pending(selected, done), rows_per_round)
        if todo.isEmpty():
            store.commit(done)
            break
        replies = score_batch(todo, scorer, model, partitions)
        store.add_partial(grade_responses(todo, replies, model, run_ts, **parameters))
        rounds += 1
    return store.load(spark, items, model, **parameters)


def resume_kept(saved: DataFrame, source: DataFrame) -> DataFrame:
    """Saved rows whose item is still in the source, first saved row per item.

    Membership is a property of the item, so keep-first runs before the semi join:
    an item saved many times is cut to one row per task before the shuffle, and the
    join reuses the window's partitioning on ``question_id``.
    """
    first = keep_first(saved, "question_id")
    return first.join(source.select("question_id").distinct(), "question_id", "left_semi")


def retry_errors(saved: DataFrame, target: DataFrame) -> DataFrame:
    """Drop targeted error rows so they are attempted again; keep successes and rows
    outside the target."""
    t = target.select("question_id").distinct().withColumn("_t", F.lit(True))
    j = saved.join(t, "question_id", "left")
    return j.filter((F.col("status") == K.STATUS_SUCCESS) | F.col("_t").isNull()).drop("_t")


def pending(selected: DataFrame, done: DataFrame) -> DataFrame:
    """Selected items not done yet (keys are never null, so an anti join is exact)."""
    return selected.join(done.select("question_id").distinct(), "question_id", "left_anti")


def merge_results(kept: DataFrame, new: DataFrame) -> DataFrame:
    """Earlier results plus this run's, by column name."""
    return kept.unionByName(new, allowMissingColumns=True)


def run_summary(results: DataFrame, target: DataFrame) -> DataFrame:
    """End-of-run summary over the targeted items: processed, valid, errors, correct,
    wrong, accuracy, mean and median latency of valid answers."""
    r = results.join(target.select("question_id").distinct(), "question_id", "left_semi")
    ok = F.col("status") == K.STATUS_SUCCESS
    right = ok & F.coalesce(F.col("ai_correct"), F.lit(False))
    counts = value_counts(r, [], F.when(ok, F.col("response_time")), {"_s": F.count_if(ok), "_c": F.count_if(right)})
    n, s, c = [F.coalesce(F.sum(x), F.lit(0)) for x in ("_n", "_s", "_c")]
    out = counts.agg(n.alias("processed"), s.alias("valid"), (n - s).alias("errors"), c.alias("correct"),
                     (s - c).alias("wrong"), pct(c, s).alias("accuracy_pct"),
                     mean_value().alias("mean_time"))
    return out.withColumn("median_time", F.round(quantiles_of(counts, [], {"m": 0.5}).select("m").scalar(), 6))
