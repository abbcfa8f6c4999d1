"""Index of committed keys: which committed partitions can hold a key of this batch?

Every committed partition (run, batch) has a Bloom filter of its keys, cut into segments by key hash,
so a partition of any size is filtered by rows of ``SEGMENT_BITS / 8`` bytes that are built and tested
in tasks. Before a batch reads the history, its keys are tested against all filters; only partitions
with at least one possible hit are read, by partition pruning. A filter never misses a key it holds.

A batch's filter is written before its rows: a partition without a filter does not exist, and a filter
without rows (a run that died in between) costs nothing. A replayed batch writes the same filter again.
With ``BITS_PER_KEY`` bits and ``PROBES`` probes a key that is not there passes one filter in about
170,000, so batches of up to some tens of thousands of new keys skip nearly all of the history.

The batch's key hashes are broadcast (8 bytes a key) after they were counted; a batch of more than
``MAX_KEYS`` keys reads the whole history instead, which costs little next to its own size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from quizlake.session import ship_modules
from quizlake.sources.files import missing_path

BITS_PER_KEY, PROBES = 32, 8
SEGMENT_BITS = 1 << 19  # 64 KB
SEGMENT_KEYS = SEGMENT_BITS // BITS_PER_KEY
MAX_KEYS = 4 << 20

INDEX_SCHEMA = "segment bigint, segments bigint, bits binary, run string, batch_id bigint"


def _bits_of(h: np.ndarray) -> np.ndarray:
    """Probed bits of each key within its segment (one row a probe), by double hashing."""
    u = h.view(np.uint64)
    step = (u * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)) | np.uint64(1)
    return np.stack([(u + np.uint64(i) * step) & np.uint64(SEGMENT_BITS - 1) for i in range(PROBES)]).astype(np.int64)


def _segment_of(h: np.ndarray, segments: int) -> np.ndarray:
    return ((h.view(np.uint64) >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)


def write_filter(keys: DataFrame, index_dir: str, run: str, batch_id: int) -> None:
    """The filter of one committed partition from its keys (column ``question_id``)."""
    ship_modules(keys.sparkSession)
    n = keys.count()
    segments = max(-(-n // SEGMENT_KEYS), 1)

    def segment(batches):
        for batch in batches:
            h = batch.column("h").to_numpy()
            yield batch.append_column("segment", pa.array(_segment_of(h, segments).astype(np.int64)))

    def build(key, table):
        bits = np.zeros(SEGMENT_BITS // 8, np.uint8)
        at = np.unique(_bits_of(table.column("h").to_numpy()))
        np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
        return pa.table({"segment": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([bits.tobytes()], pa.binary())})

    hashed = keys.select(F.xxhash64("question_id").alias("h")).mapInArrow(segment, "h bigint, segment bigint")
    rows = hashed.groupBy("segment").applyInArrow(build, "segment bigint, bits binary")
    rows = rows.select("segment", F.lit(segments).cast("bigint").alias("segments"), "bits", F.lit(run).alias("run"),
                       F.lit(batch_id).cast("bigint").alias("batch_id"))
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run", "batch_id")
     .parquet(index_dir))


def possible_batches(spark: SparkSession, index_dir: str, run: str, keys: DataFrame) -> list[int] | None:
    """Batches of ``run`` that may hold one of ``keys`` (one number a batch reaches the driver); None:
    all of them have to be read (no index yet, or too many keys to test)."""
    try:
        index = spark.read.schema(INDEX_SCHEMA).parquet(index_dir)
    except AnalysisException as exc:
        if not missing_path(exc):
            raise
        return None
    ship_modules(spark)
    h = keys.select(F.xxhash64("question_id").alias("h"))
    if h.limit(MAX_KEYS + 1).count() > MAX_KEYS:
        return None
    wanted = h.toPandas()["h"].to_numpy(np.int64)
    wanted = wanted[np.argsort(wanted.view(np.uint64))]
    shared = spark.sparkContext.broadcast(wanted)

    def test(batches):
        hashes = shared.value
        by_segment: dict[int, np.ndarray] = {}
        for batch in batches:
            found = []
            for batch_id, segment, segments, raw in zip(*(batch.column(c).to_pylist() for c in batch.schema.names)):
                if segments not in by_segment:
                    by_segment[segments] = _segment_of(hashes, segments)
                lo, hi = np.searchsorted(by_segment[segments], np.array([segment, segment + 1], np.uint64))
                at = _bits_of(hashes[lo:hi])
                bits = np.frombuffer(raw, np.uint8)
                if ((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=0).any():
                    found.append(batch_id)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], ["batch_id"])

    hits = (index.where(F.col("run") == run).select("batch_id", "segment", "segments", "bits")
            .mapInArrow(test, "batch_id bigint").distinct().collect())
    return sorted(r["batch_id"] for r in hits)
