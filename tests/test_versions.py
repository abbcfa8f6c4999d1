"""Versioned result folders: commits are all or nothing, losses are errors, rounds are saved."""

import os
import shutil
import signal
import subprocess
import sys
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from quizlake.operators import clean, grade, resume
from quizlake.plans import fixtures as fx
from quizlake.sources.versions import LostResults, VersionLog
from tests.conftest import SF001


def _log(spark):
    return VersionLog(spark, tempfile.mkdtemp(prefix="versions-"))


def _n(spark, n):
    return spark.range(n).toDF("id")


def test_targets_change_together(spark):
    log = _log(spark)
    assert log.version() == 0 and log.read("a") is None and log.vacuum() == 0
    log.commit(replace={"partial": _n(spark, 3)})
    log.commit(append={"partial": _n(spark, 4)})
    assert log.read("partial").count() == 7 and log.read("final") is None
    log.commit(replace={"final": log.read("partial"), "partial": None})
    assert log.read("final").count() == 7 and log.read("partial") is None and log.version() == 3
    log.commit(replace={"final": _n(spark, 0)})
    assert log.read("final").count() == 0
    assert log.vacuum() == 3 and log.vacuum() == 0
    assert log.version() == 4 and log.read("final").count() == 0


@pytest.mark.parametrize("step", ["write", "_append"])
def test_death_before_the_entry_changes_nothing(spark, monkeypatch, step):
    log = _log(spark)
    log.commit(replace={"partial": _n(spark, 5), "final": _n(spark, 2)})
    real = getattr(VersionLog, step)

    def dies(self, *args):
        if step == "write":  # files of an unfinished job stay behind
            name, rows = real(self, *args)
            shutil.move(f"{self.path}/data/{name}", f"{self.path}/data/_unfinished")
        raise KeyboardInterrupt

    monkeypatch.setattr(VersionLog, step, dies)
    with pytest.raises(KeyboardInterrupt):
        log.commit(replace={"final": _n(spark, 9), "partial": None})
    monkeypatch.undo()
    assert (log.version(), log.read("partial").count(), log.read("final").count()) == (1, 5, 2)
    assert log.vacuum() == 1
    assert log.commit(replace={"final": _n(spark, 9), "partial": None}) == 2
    assert log.read("partial") is None and log.read("final").count() == 9


def test_lost_results_are_an_error(spark):
    log = _log(spark)
    log.commit(replace={"partial": _n(spark, 50).repartition(4)})
    (name, _), = log.targets()["partial"]
    folder = f"{log.path}/data/{name}"
    part = sorted(f for f in os.listdir(folder) if f.startswith("part-"))[0]
    os.remove(f"{folder}/{part}")
    with pytest.raises(LostResults, match="50 committed"):
        log.read("partial").count()
    shutil.rmtree(folder)
    with pytest.raises(LostResults):
        log.read("partial")
    store = resume.RunStore(log.path)
    with pytest.raises(LostResults):
        store.load(spark, fx.bronze(spark, SF001), "m")


def test_second_writer_of_a_version_fails(spark):
    log = _log(spark)
    log.commit(replace={"a": _n(spark, 1)})
    rival = [(2, "", {"a": [("gone", 0)]})]
    spark.createDataFrame(rival, "version bigint, token string, targets map<string, array<struct<folder: string,"
                                 " rows: bigint>>>").write.mode("append").parquet(f"{log.path}/log")
    with pytest.raises(RuntimeError, match="another writer"):
        log._append(2, {})


WRITER = """
import sys
sys.path.insert(0, {root!r})
from quizlake.session import build_session
from quizlake.sources.versions import VersionLog
spark = build_session(master="local[2]", shuffle_partitions=2)
log = VersionLog(spark, {path!r})
n = 0
while True:
    n += 1
    log.commit(replace={{"partial": spark.range(1000 * n).toDF("id"), "final": spark.range(n).toDF("id")}})
    print(n, flush=True)
"""


def test_killed_writer_leaves_a_whole_state(spark):
    path = tempfile.mkdtemp(prefix="versions-kill-")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for wait in (0.05, 0.4):
        writer = subprocess.Popen([sys.executable, "-c", WRITER.format(root=root, path=path)],
                                  stdout=subprocess.PIPE, stderr=subprocess.DEVNULL, text=True)
        assert writer.stdout.readline().strip() == "1"
        time.sleep(wait)
        os.kill(writer.pid, signal.SIGKILL)  # in the middle of a later commit
        writer.wait()
        time.sleep(2)  # its Spark process ends with it
        log = VersionLog(spark, path)
        final = log.read("final").count()
        assert final >= 1 and log.read("partial").count() == 1000 * final
    log.vacuum()
    assert log.read("partial").count() == 1000 * log.read("final").count()


def test_rounds_are_saved_and_not_scored_again(spark):
    items = clean.clean_items(fx.bronze(spark, SF001)).checkpoint()
    n = items.count()
    store = resume.RunStore(tempfile.mkdtemp(prefix="rounds-"))

    def go(stamp, **more):
        return resume.score_in_rounds(store, items, grade.echo_scorer, "m", stamp, n // 4 + 1, **more)

    first = go("one", max_rounds=2)
    half = 2 * (n // 4 + 1)
    assert first.count() == half and first.agg(F.max("ordinal")).first()[0] == \
        items.orderBy("ordinal").limit(half).agg(F.max("ordinal")).first()[0]
    assert store.log(spark).read(store.FINAL) is None
    whole = go("two")
    assert {r[0]: r[1] for r in whole.groupBy("benchmark_timestamp").count().collect()} == {"one": half, "two": n - half}
    assert store.log(spark).read(store.PARTIAL) is None and store.log(spark).read(store.FINAL).count() == n
    assert go("three").where("benchmark_timestamp = 'three'").count() == 0
    errors = whole.where("status = 'error'").count()
    again = go("four", retry=True)
    assert again.count() == n and again.where("benchmark_timestamp = 'four'").count() == errors > 0
    want = grade.grade_responses(items, grade.score_batch(items, grade.echo_scorer, "m"), "m", "t")
    cols = ["question_id", "status", "ai_correct", "error", "response_time"]
    assert sorted(map(str, again.select(cols).collect())) == sorted(map(str, want.select(cols).collect()))
