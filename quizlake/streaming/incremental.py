"""Incremental scoring with Structured Streaming.

The original tool resumes a long scoring loop from a checkpoint file written every
ten rows. Here new Bronze files are the stream; each micro-batch is cleaned,
deduplicated against everything already committed (anti join on the item key),
graded and written as one partition per parameters and ``batch_id``. The stream checkpoint and the
sink live under the cluster's shared checkpoint location, so a restarted or replayed
query neither loses nor duplicates rows:

* a replayed batch overwrites its own ``batch_id`` partition (dynamic overwrite) below its
  model's and parameters' partition, and its done-set excludes that partition, so it cannot
  anti-join against itself, and other parameters score everything anew;
* items repeated in a later batch are skipped (first arrival wins); within a batch
  the first row in file order wins;
* of the history of committed keys only the partitions that may hold a key of the batch are read
  (``streaming.keyindex``), one column of them, and never shuffled whole: it is first cut to the
  keys of the current batch by a semi join.
"""

from __future__ import annotations

import hashlib
import json

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from quizlake import constants as K
from quizlake.operators.clean import clean_items
from quizlake.operators.grade import Scorer, grade_responses, score_batch
from quizlake.schemas import BRONZE_SCHEMA, SILVER_SCHEMA
from quizlake.session import fresh_dir
from quizlake.sources.files import missing_path
from quizlake.streaming.keyindex import possible_batches, write_filter

BRONZE_FILE_SCHEMA = T.StructType([T.StructField("ordinal", T.LongType(), True), *BRONZE_SCHEMA.fields])
SINK_SCHEMA = T.StructType([*SILVER_SCHEMA.fields, T.StructField("run", T.StringType(), True),
                            T.StructField("batch_id", T.LongType(), True)])


def run_key(parameters: dict) -> str:
    """Names the model and generation parameters: the sink's outer partition."""
    return hashlib.sha256(json.dumps(parameters, sort_keys=True).encode()).hexdigest()[:16]


def index_of(sink_dir: str) -> str:
    """Folder of the committed-key index of a sink."""
    return f"{sink_dir.rstrip('/')}-keys"


def committed(spark: SparkSession, sink_dir: str, parameters: dict, batch_id: int, keys: DataFrame) -> DataFrame:
    """Items that earlier batches scored with the same model and parameters, as far as they may be
    among ``keys``: batches that the key index rules out are not read."""
    try:
        done = spark.read.schema(SINK_SCHEMA).parquet(sink_dir)
    except AnalysisException as exc:
        if not missing_path(exc):
            raise
        return spark.createDataFrame([], SINK_SCHEMA).select("question_id")
    run = run_key(parameters)
    done = done.filter((F.col("run") == run) & (F.col("batch_id") != batch_id))
    batches = possible_batches(spark, index_of(sink_dir), run, keys)
    if batches is not None:
        done = done.filter(F.col("batch_id").isin(batches) if batches else F.lit(False))
    return done.select("question_id")


def start_incremental_scoring(spark: SparkSession, source_dir: str, responses: DataFrame | None, model: str,
                              run_ts: str, sink_dir: str, checkpoint_dir: str,
                              max_files_per_trigger: int | None = None, scorer: Scorer | None = None,
                              prompt_version: str = K.PROMPT_VERSION, temperature: int = K.TEMPERATURE,
                              max_tokens: int = K.MAX_TOKENS):
    """Start the query (``availableNow``: process what has arrived, then stop).

    Items are graded from recorded ``responses``, or by ``scorer`` when one is given. An item is
    done when it was scored with the same model, prompt version and generation parameters."""
    parameters = {"model": model, "prompt_version": prompt_version, "temperature": temperature, "max_tokens": max_tokens}

    def process(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        items = clean_items(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # The committed key set grows with history: cut it to this batch's keys first
            # (a semi join whose small side AQE can broadcast from its measured size), so
            # each batch scans one column of the history instead of shuffling all of it.
            keys = items.select("question_id")
            done = committed(s, sink_dir, parameters, batch_id, keys).join(keys, "question_id", "left_semi")
            todo = items.join(done, "question_id", "left_anti")
            write_filter(todo, index_of(sink_dir), run_key(parameters), batch_id)  # before the rows
            if scorer is not None:
                replies = score_batch(todo, scorer, model)
            else:  # only this batch's replies are deduplicated
                replies = responses.join(todo.select("question_id"), "question_id", "left_semi")
            graded = grade_responses(todo, replies, run_ts=run_ts, **parameters).withColumns({
                "run": F.lit(run_key(parameters)), "batch_id": F.lit(batch_id).cast("long")})
            (graded.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("run", "batch_id").parquet(sink_dir))
        finally:
            items.unpersist()

    reader = spark.readStream.schema(BRONZE_FILE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)
    return (stream.writeStream.foreachBatch(process)
            .option("checkpointLocation", checkpoint_dir)
            .trigger(availableNow=True).start())


def read_sink(spark: SparkSession, sink_dir: str) -> DataFrame:
    return spark.read.schema(SINK_SCHEMA).parquet(sink_dir)


def run_incremental_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two arrivals of item files over the fixture bank: first the originals, later
    their copies. Each arrival is one ``availableNow`` run of the same query (same
    checkpoint), so the second run only sees the new files and scores nothing twice."""
    from quizlake.plans import fixtures as fx

    base = fresh_dir(spark, "stream")
    src, sink, ckpt = f"{base}/source", f"{base}/sink", f"{base}/checkpoint"
    bronze = fx.bronze(spark, sf_dir, with_duplicates=True)
    cut = F.col("ordinal") < fx.DUPLICATE_OFFSET
    responses = fx.responses(clean_items(bronze))
    for arrival in (bronze.filter(cut), bronze.filter(~cut)):
        arrival.write.mode("append").parquet(src)
        q = start_incremental_scoring(spark, src, responses, fx.FIXTURE_MODEL, fx.FIXTURE_RUN_TS, sink, ckpt)
        q.awaitTermination()
    return read_sink(spark, sink).select("ordinal", "question_id", "model", "status", "error", "ai_answer",
                                         "ai_correct", "response_time", "temperature", "max_tokens",
                                         "prompt_version")
