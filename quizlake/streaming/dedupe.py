"""Keep the first arrival of an item in a stream, from the state store.

The batch path compares with everything ever committed (``streaming.incremental``). Here the memory is
the stream's own: each key seen stays in the state store until the watermark passes its event time plus
``delay``, so the state is bounded by the keys of that time, not by the history. Copies of an item that
arrive within the delay are dropped, also after a restart or a replayed batch (state and offsets are
one checkpoint). Rows older than the watermark are dropped as late; a copy that arrives after its key
was forgotten, but is not late itself, is a new first arrival.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizlake.operators.clean import prepare_bronze
from quizlake.streaming.incremental import BRONZE_FILE_SCHEMA


def first_arrivals(stream: DataFrame, delay: str) -> DataFrame:
    """Bronze rows of a stream with their item key, copies within ``delay`` of event time dropped."""
    rows = prepare_bronze(stream).withColumn("fetch_time", F.to_timestamp("fetched_at"))
    return rows.withWatermark("fetch_time", delay).dropDuplicatesWithinWatermark(["question_id"])


def start_dedupe(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str, delay: str,
                 max_files_per_trigger: int | None = None):
    """Start the query over new Bronze files (process what has arrived, then stop)."""
    reader = spark.readStream.schema(BRONZE_FILE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return (first_arrivals(reader.parquet(source_dir), delay).writeStream.format("parquet")
            .option("path", sink_dir).option("checkpointLocation", checkpoint_dir)
            .outputMode("append").trigger(availableNow=True).start())
