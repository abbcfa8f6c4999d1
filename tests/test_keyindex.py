"""Committed-key index: no key is missed, and only the batches that may hold one are read."""

import os
import tempfile

import pytest

from quizlake.operators.clean import clean_items
from quizlake.plans import fixtures as fx
from quizlake.streaming import incremental as inc
from quizlake.streaming import keyindex as X
from tests.conftest import SF001


def _keys(spark, names):
    return spark.createDataFrame([(x,) for x in names], "question_id string")


@pytest.mark.parametrize("segment_keys", [X.SEGMENT_KEYS, 40])
def test_no_key_is_missed(spark, monkeypatch, segment_keys):
    monkeypatch.setattr(X, "SEGMENT_KEYS", segment_keys)
    index = tempfile.mkdtemp(prefix="index-") + "/t"
    assert X.possible_batches(spark, index, "r", _keys(spark, ["k1"])) is None
    for batch in range(4):
        X.write_filter(_keys(spark, [f"b{batch}-{i}" for i in range(300)]), index, "r", batch)
    X.write_filter(_keys(spark, ["b0-1"]), index, "another", 9)
    X.write_filter(_keys(spark, []), index, "r", 7)
    for wanted, batches in ((["b0-0", "new"], [0]), ([f"b{b}-{299 - b}" for b in range(4)], [0, 1, 2, 3]),
                            ([f"new{i}" for i in range(500)], []), ([], [])):
        assert X.possible_batches(spark, index, "r", _keys(spark, wanted)) == batches
    every = [f"b{i % 4}-{i}" for i in range(300)]
    assert X.possible_batches(spark, index, "r", _keys(spark, every)) == [0, 1, 2, 3]
    X.write_filter(_keys(spark, ["other"]), index, "r", 0)  # a replayed batch replaces its filter
    assert X.possible_batches(spark, index, "r", _keys(spark, ["b0-0", "b1-0"])) == [1]


def test_more_keys_than_are_tested_read_everything(spark, monkeypatch):
    monkeypatch.setattr(X, "MAX_KEYS", 3)
    index = tempfile.mkdtemp(prefix="index-") + "/t"
    X.write_filter(_keys(spark, ["a"]), index, "r", 0)
    assert X.possible_batches(spark, index, "r", _keys(spark, list("wxyz"))) is None
    assert X.possible_batches(spark, index, "r", _keys(spark, list("xyz"))) == []


def test_a_batch_reads_only_the_files_that_may_hold_its_keys(spark):
    base = tempfile.mkdtemp(prefix="stream-index-")
    bronze = fx.bronze(spark, SF001, with_duplicates=False).checkpoint()
    responses = fx.responses(clean_items(bronze)).checkpoint()
    for part in range(4):
        bronze.where(f"ordinal % 4 = {part}").coalesce(1).write.mode("append").parquet(f"{base}/source")
        inc.start_incremental_scoring(spark, f"{base}/source", responses, fx.FIXTURE_MODEL, "t", f"{base}/sink",
                                      f"{base}/ckpt").awaitTermination()
    sink = inc.read_sink(spark, f"{base}/sink")
    parameters = {"model": fx.FIXTURE_MODEL, "prompt_version": inc.K.PROMPT_VERSION, "temperature": inc.K.TEMPERATURE,
                  "max_tokens": inc.K.MAX_TOKENS}
    batches = sorted(r[0] for r in sink.select("batch_id").distinct().collect())
    assert len(batches) == 4 and sink.count() == sink.select("question_id").distinct().count() == bronze.count()

    def read_by(keys):
        """Batches whose files the plan's scan reads (by its own metrics: files and rows)."""
        df = inc.committed(spark, f"{base}/sink", parameters, 99, keys)
        plan = df._jdf.queryExecution().executedPlan()
        rows = df._jdf.queryExecution().toRdd().count()
        metrics = plan.collectLeaves().head().metrics()
        read = [] if not metrics.contains("numFiles") else [metrics.apply(m).value() for m in ("numFiles", "numOutputRows")]
        per = {b: (len([f for f in os.listdir(f"{base}/sink/run={inc.run_key(parameters)}/batch_id={b}") if f.startswith("part")]),
                   sink.where(f"batch_id = {b}").count()) for b in batches}
        found = sorted(b for b in batches if any(f"batch_id={b}/" in r[0] for r in df.select("_metadata.file_path").distinct().collect()))
        assert read in ([], [sum(per[b][0] for b in found), sum(per[b][1] for b in found)])
        assert rows == sum(per[b][1] for b in found)
        return found

    one = sink.where(f"batch_id = {batches[2]}").select("question_id").limit(3)
    assert read_by(one) == [batches[2]]
    two = sink.where(f"batch_id in ({batches[0]}, {batches[3]})").select("question_id")
    assert read_by(two) == [batches[0], batches[3]]
    assert read_by(_keys(spark, ["never seen"])) == []
    found = inc.committed(spark, f"{base}/sink", parameters, 99, two).join(two, "question_id", "left_semi")
    assert found.count() == two.count()
    # the batch itself is never part of its own history
    assert read_by(one) != [] and inc.committed(spark, f"{base}/sink", parameters, batches[2], one).count() == 0
