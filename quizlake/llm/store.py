"""Results written once under the cluster's shared folder and read again (cuts lineage)."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

from quizlake.session import fresh_dir

#: Bytes of a row group: what a writing task holds back.
ROW_GROUP = 32 << 20

_SHIPPED: set[str] = set()


#: Rows of an Arrow batch at most: texts are long, and each task holds a few batches.
BATCH_ROWS = 1_000


def ship(spark: SparkSession) -> None:
    """Hand this package's modules to the Python workers (once per application)."""
    sc = spark.sparkContext
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(), "quizlake_modules.zip")  # the driver serves it to the executors
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """``df`` as a Parquet table below ``spark.checkpoint.dir``; every later read uses those files."""
    path = fresh_dir(df.sparkSession, name)
    df.write.option("parquet.block.size", ROW_GROUP).option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
