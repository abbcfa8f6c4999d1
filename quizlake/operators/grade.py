"""Scoring: attach each item's recorded reply, classify failures, grade by strict match."""

from __future__ import annotations

from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quizlake import constants as K
from quizlake.functions import is_blank, normalize_answer
from quizlake.schemas import RESPONSE_SCHEMA, SILVER_SCHEMA, conform

MSG_NO_RESPONSE = "RequestException: no recorded response"
MSG_BAD_JSON = "JSONDecodeError: reply is not valid JSON"
MSG_NOT_OBJECT = f"ValueError: {K.MSG_UNEXPECTED_JSON}"
MSG_NO_CHOICES = "KeyError: 'choices'"
MSG_NO_CHOICE = "IndexError: list index out of range"
MSG_NO_MESSAGE = "KeyError: 'message'"
MSG_NO_CONTENT = "KeyError: 'content'"


def _kind(v: Column) -> Column:
    """JSON kind of a variant (null where there is none)."""
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def _not_subscriptable(kind: Column) -> Column:
    """Python's error for a text key on a value that is no object."""
    name = F.when(kind == "VOID", "NoneType").when(kind == "BOOLEAN", "bool").when(kind == "BIGINT", "int").otherwise("float")
    return (F.when(kind == "ARRAY", "TypeError: list indices must be integers or slices, not str")
            .when(kind == "STRING", "TypeError: string indices must be integers, not 'str'")
            .otherwise(F.concat(F.lit("TypeError: '"), name, F.lit("' object is not subscriptable"))))


def extract_reply(payload: Column) -> Column:
    """``choices[0].message.content`` and ``choices[0].finish_reason`` of a reply, and why not.

    The whole payload must be one JSON value (Spark's parser alone would ignore trailing text:
    inside an array with one further element it cannot), and an object; ``content`` counts only
    as text. ``shape_error`` is the first step that fails.
    """
    wrapped = F.concat(F.lit("["), payload, F.lit(",0]"))
    valid = F.coalesce(F.try_parse_json(wrapped).isNotNull() & (F.json_array_length(wrapped) == 2), F.lit(False))
    reply = F.when(valid, F.try_parse_json(payload))

    def at(path: str) -> Column:
        return F.try_variant_get(reply, path, "variant")

    choices, first = at("$.choices"), at("$.choices[0]")
    message, content = at("$.choices[0].message"), at("$.choices[0].message.content")
    n = F.when(_kind(choices) == "ARRAY", F.json_array_length(F.get_json_object(payload, "$.choices")))
    error = (
        F.when(~valid, F.lit(MSG_BAD_JSON))
        .when(_kind(reply) != "OBJECT", F.lit(MSG_NOT_OBJECT))
        .when(choices.isNull(), F.lit(MSG_NO_CHOICES))
        .when(_kind(choices) == "OBJECT", F.lit("KeyError: 0"))
        .when(_kind(choices) != "ARRAY", _not_subscriptable(_kind(choices)))
        .when(n == 0, F.lit(MSG_NO_CHOICE))
        .when(_kind(first) != "OBJECT", _not_subscriptable(_kind(first)))
        .when(message.isNull(), F.lit(MSG_NO_MESSAGE))
        .when(_kind(message) != "OBJECT", _not_subscriptable(_kind(message)))
        .when(content.isNull(), F.lit(MSG_NO_CONTENT))
    )
    return F.struct(
        valid.alias("valid_json"),
        F.coalesce(n, F.lit(0)).alias("n_choices"),
        F.when(_kind(content) == "STRING", F.try_variant_get(content, "$", "string")).alias("content"),
        F.try_variant_get(reply, "$.choices[0].finish_reason", "string").alias("finish_reason"),
        error.alias("shape_error"),
    )


def classify(item_error: Column, has_row: Column, transport_error: Column, r: Column) -> Column:
    """First failure wins: item, transport, payload, empty or non-text reply, truncation."""
    content = r["content"]
    return (
        F.when(item_error.isNotNull(), item_error)
        .when(~has_row, F.lit(MSG_NO_RESPONSE))
        .when(transport_error.isNotNull(), transport_error)
        .when(r["shape_error"].isNotNull(), r["shape_error"])
        .when(content.isNull() | is_blank(content), F.lit(f"ValueError: {K.MSG_EMPTY_REPLY}"))
        .when(r["finish_reason"] == "length", F.lit(f"ValueError: {K.MSG_TRUNCATED}"))
    )


def dedupe_replies(responses: DataFrame) -> DataFrame:
    """One reply per item of one model, chosen deterministically.

    An at-least-once scorer (task retries, replayed batches) can record an item twice;
    a delivered reply is preferred to a transport error, then the smallest payload text,
    then the shortest time.
    Partitioned by ``question_id`` only (the model is fixed), so the scoring join reuses
    this partitioning, and Spark's partial group limit trims repeats before the shuffle.
    """
    w = Window.partitionBy("question_id").orderBy(F.col("transport_error").asc_nulls_first(),
                                                  F.col("payload").asc_nulls_last(),
                                                  F.col("response_time").asc_nulls_last())
    return responses.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def grade_responses(items: DataFrame, responses: DataFrame, model: str,
                    run_ts: str, prompt_version: str = K.PROMPT_VERSION,
                    temperature: int = K.TEMPERATURE, max_tokens: int = K.MAX_TOKENS) -> DataFrame:
    """Silver rows: cleaned items left-joined to ``model``'s replies and graded.

    A missing reply, a transport error, a malformed payload, an empty or truncated
    answer all give an error row with a null grade; only ``success`` rows are graded.
    """
    r = (dedupe_replies(responses.filter(F.col("model") == model))
         .select("question_id", "payload", F.col("response_time").alias("_rt"), "transport_error",
                 F.lit(True).alias("_has_row")))
    j = items.join(r, "question_id", "left")
    has_row = F.coalesce(F.col("_has_row"), F.lit(False))
    j = j.withColumn("_r", extract_reply(F.col("payload")))
    err = classify(F.col("item_error"), has_row, F.col("transport_error"), F.col("_r"))
    sent = F.col("item_error").isNull() & has_row
    answer_ok = (sent & F.col("transport_error").isNull() & F.col("_r.valid_json")
                 & F.col("_r.content").isNotNull() & ~is_blank(F.col("_r.content")))
    out = j.withColumn("error", err).withColumns({
        "model": F.lit(model),
        "prompt_version": F.lit(prompt_version),
        "temperature": F.lit(temperature).cast("bigint"),
        "max_tokens": F.lit(max_tokens).cast("bigint"),
        "benchmark_timestamp": F.lit(run_ts),
        "status": F.when(F.col("error").isNull(), K.STATUS_SUCCESS).otherwise(K.STATUS_ERROR),
        "ai_answer": F.when(answer_ok, F.col("_r.content")),
        "response_time": F.when(sent, F.col("_rt")),
    })
    out = out.withColumn(
        "ai_correct",
        F.when(F.col("status") == K.STATUS_SUCCESS,
               normalize_answer(F.col("ai_answer")) == normalize_answer(F.col("correct_answer_clean"))))
    return conform(out, SILVER_SCHEMA)


def attempt_label(df: DataFrame) -> DataFrame:
    """Per-attempt console label: ERREUR for errors, OK / FAUX by grade."""
    label = (F.when(F.col("status") == K.STATUS_ERROR, K.LABEL_ERROR)
             .when(F.col("ai_correct"), K.LABEL_OK).otherwise(K.LABEL_WRONG))
    return df.select("model", "question_id", label.alias("label"),
                     F.coalesce("error", "ai_answer").alias("detail"))


# ---------------------------------------------------------------------------
# Scorer hook: batch inference over partitions (replaces one blocking request per row)
# ---------------------------------------------------------------------------

Scorer = Callable[[pd.DataFrame], pd.DataFrame]
REPLY_COLUMNS = ["payload", "response_time", "transport_error"]


def _failed(ids, error: str) -> pd.DataFrame:
    return pd.DataFrame({"question_id": list(ids), "payload": None, "response_time": None, "transport_error": error})


def _scored(scorer: Scorer, batch: pd.DataFrame) -> pd.DataFrame:
    """One reply row per item of the batch, matched by ``question_id``.

    A batch whose call fails is asked again item by item, so only the items that fail by
    themselves become error rows. An item without a reply, or with several, is an error row.
    """
    try:
        got = scorer(batch)
        if "question_id" not in got.columns:
            if len(got) != len(batch):
                raise ValueError(f"scorer returned {len(got)} rows for {len(batch)} items")
            got = got.reset_index(drop=True).assign(question_id=batch["question_id"].to_numpy())
    except Exception as exc:
        if len(batch) == 1:
            return _failed(batch["question_id"], f"{type(exc).__name__}: {exc}")
        return pd.concat([_scored(scorer, batch.iloc[i:i + 1]) for i in range(len(batch))])
    got = got.reindex(columns=["question_id", *REPLY_COLUMNS])
    got = got[got["question_id"].isin(batch["question_id"])]
    several = got["question_id"].duplicated(keep=False)
    missing = ~batch["question_id"].isin(got["question_id"])
    if not several.any() and not missing.any():
        return got
    rows = [*got[~several].to_dict("records"),
            *_failed(got["question_id"][several].unique(), "ValueError: several replies for one item").to_dict("records"),
            *_failed(batch["question_id"][missing], "ValueError: no reply for this item").to_dict("records")]
    return pd.DataFrame(rows, columns=["question_id", *REPLY_COLUMNS])


def score_batch(items: DataFrame, scorer: Scorer, model: str, partitions: int | None = None) -> DataFrame:
    """Run ``scorer`` over the sendable items, partition by partition.

    ``scorer`` takes a pandas batch with ``question_id`` and ``prompt`` and returns ``payload``,
    ``response_time`` and ``transport_error`` per item, in the batch's order or with its
    ``question_id``. A failing item yields a transport error, never a failed job. Items in error
    before the request are not sent. ``partitions`` sets the number of concurrent scorer tasks.
    The replies are checkpointed, so nothing that reads them calls the scorer again.
    """
    from quizlake.session import shared_dir, ship_modules

    ship_modules(items.sparkSession)
    todo = items.filter(F.col("item_error").isNull()).select("question_id", "prompt")
    if partitions:
        todo = todo.repartition(partitions, "question_id")
    columns = [f.name for f in RESPONSE_SCHEMA.fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield _scored(scorer, batch.reset_index(drop=True)).assign(model=model)[columns]

    shared_dir(items.sparkSession)
    return todo.mapInPandas(run, RESPONSE_SCHEMA).checkpoint()


def echo_scorer(pdf: pd.DataFrame) -> pd.DataFrame:
    """Deterministic offline scorer: answers with the first listed choice."""
    import json

    def reply(prompt: str):
        lines = [ln[2:] for ln in prompt.split("\n") if ln.startswith("- ")]
        content = lines[0] if lines else ""
        return json.dumps({"choices": [{"message": {"content": content}, "finish_reason": "stop"}]},
                          ensure_ascii=False)

    return pd.DataFrame({"payload": [reply(p) for p in pdf["prompt"]],
                         "response_time": [float(len(p)) / 1000.0 for p in pdf["prompt"]],
                         "transport_error": [None] * len(pdf)})
