"""SparkSession construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings that the library relies on for correctness (UTC rendering of timestamps)
# and for plans that hold at scale (AQE re-planning, skew-join splitting, partition
# coalescing).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "quizlake", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Settings for large clusters (~100 TB inputs): many shuffle partitions that AQE
# coalesces to ~256 MB, skew splitting above 1 GB, broadcast only under a measured
# 64 MB, Kryo, and a larger Arrow batch cap for the scorer hook.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
}


def cluster_session(app_name: str = "quizlake", extra: dict | None = None) -> SparkSession:
    """Session for a cluster run (master and checkpoint folder come from the launcher)."""
    builder = SparkSession.builder.appName(app_name)
    for k, v in {**DEFAULT_CONF, **CLUSTER_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder under the cluster's shared checkpoint location.

    The location comes from ``spark.checkpoint.dir``. Only when the session has
    none and is local (a test run) is a private scratch folder created and registered;
    a cluster without one is an error, so nothing is written to a machine-local path.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="quizlake-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
        try:
            spark.conf.set("spark.checkpoint.dir", base)
        except Exception:  # core conf not settable at runtime: the context holds it
            pass
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    path = os.path.join(base, *parts) if parts else base
    return path


_SHIPPED: set[str] = set()


def ship_modules(spark: SparkSession) -> None:
    """Hand the package's modules to the Python workers, once per application (they need no install)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(), "quizlake_core.zip")  # the driver serves it to the executors
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                out.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the shared location (one per run)."""
    return shared_dir(spark, f"{name}-{uuid.uuid4().hex[:12]}")
