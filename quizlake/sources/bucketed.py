"""Saved results bucketed by item key: resume joins without moving the saved side.

A saved result is looked up by ``question_id`` on every resume: which items are done (J1), which saved
rows belong to the source (J3), which row of an item came first. Written into a fixed number of buckets
by that key, sorted inside, all three read the saved table where it lies; only the items of the new run
are exchanged, to the same buckets. The number of buckets is chosen once, for the table's full size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quizlake.schemas import SILVER_SCHEMA, conform

KEY = "question_id"


def write_saved(results: DataFrame, name: str, buckets: int, path: str | None = None) -> DataFrame:
    """Results as a bucketed table ``name`` (external below ``path`` if given); the table."""
    spark = results.sparkSession
    # one task per bucket writes one sorted file; without this every task would write to every bucket
    rows = conform(results, SILVER_SCHEMA).repartition(buckets, KEY)
    writer = rows.write.mode("overwrite").format("parquet").bucketBy(buckets, KEY).sortBy(KEY)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return saved(spark, name)


def saved(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)

