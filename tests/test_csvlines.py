"""Multi-line CSV by byte ranges: equal rows and order, however the files are cut."""

import csv
import os
import random
import tempfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quizlake.sources import csvlines, files

HEADER = ["question", "correct_answer", "incorrect_answers"]
PARTS = ["a", "é", '"', "\n", ",", " ", "x\r\n", '""', "\n\n", "word "]


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield spark
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def _write(folder, name, rows, end="\n"):
    with open(os.path.join(folder, name), "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=end)
        w.writerow(HEADER)
        w.writerows(rows)


def _rows(rng, n):
    rows = [[f"{i}:" + "".join(rng.choices(PARTS, k=rng.randint(0, 30))), *("".join(rng.choices(PARTS, k=rng.randint(0, 9)))
                                                                         for _ in range(2))] for i in range(n)]
    rows[n // 2][1] = "line\n" * 3000  # a value over several splits
    return [tuple(r) for r in rows]


def _read(spark, path):
    got = files.read_bronze_csv(spark, path)
    rows = [tuple(r) for r in got.orderBy("ordinal").select(*HEADER).collect()]
    assert got.select("ordinal").distinct().count() == len(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_rows_and_order(small_splits, seed):
    spark, rng, folder = small_splits, random.Random(seed), tempfile.mkdtemp(prefix="csv-")
    want = []
    for name, end in (("a.csv", "\n"), ("b.csv", "\r\n"), ("c.csv", "\n")):
        rows = _rows(rng, 150)
        _write(folder, name, rows, end)
        want += rows
    assert _read(spark, folder) == want


def test_one_large_file_is_read_by_many_tasks(small_splits):
    spark, folder = small_splits, tempfile.mkdtemp(prefix="csv-")
    rows = _rows(random.Random(3), 600)
    _write(folder, "one.csv", rows)
    found, known = csvlines.records(spark, folder)
    assert known.count() > 10 and known.where("inside").count() > 3
    tasks = found.withColumn("t", F.spark_partition_id()).select("block").distinct().count()
    assert tasks > 10
    plain = spark.read.options(**files.CSV_OPTIONS).csv(folder)
    assert plain.rdd.getNumPartitions() == 1
    as_text = sorted(tuple(v or "" for v in r) for r in plain.collect())
    assert sorted(_read(spark, folder)) == as_text == sorted(rows)


def test_unbalanced_quotes_are_an_error(spark):
    folder = tempfile.mkdtemp(prefix="csv-")
    with open(f"{folder}/a.csv", "w") as f:
        f.write('question,correct_answer,incorrect_answers\n"open,b,c\n')
    with pytest.raises(Exception, match="unbalanced quotes"):
        files.read_bronze_csv(spark, folder).collect()


def test_files_without_rows_and_empty_lines(spark):
    folder = tempfile.mkdtemp(prefix="csv-")
    for name, text in (("a.csv", ""), ("b.csv", "\n\n"), ("c.csv", "\nx,y,z\n\n")):
        with open(f"{folder}/{name}", "w") as f:
            f.write(",".join(HEADER) + "\n" + text)
    assert _read(spark, folder) == [("x", "y", "z")]


def test_batches_are_bounded_whatever_the_length_of_lines(spark):
    values = pa.array(["x" * n for n in (10, 5000, 0, 700, 800, 10, 3000, 1)] + ["y" * 10] * 1000)
    cut = list(csvlines.slices(values, 1000))
    assert pa.concat_arrays(cut).equals(values)
    assert len(cut) > 10 and all(sum(map(len, c.to_pylist()[1:])) <= 1000 for c in cut)
    assert [len(c) for c in csvlines.slices(values)] == [len(values)]
    assert [len(c) for c in csvlines.slices(values.slice(0, 0))] == [0]
    for conf in ("maxRecordsPerBatch", "maxBytesPerBatch"):
        spark.conf.unset(f"spark.sql.execution.arrow.{conf}")
    folder, rows = tempfile.mkdtemp(prefix="csv-"), _rows(random.Random(4), 300)
    _write(folder, "a.csv", rows)
    assert _read(spark, folder) == rows
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) == csvlines.BATCH_ROWS
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) == csvlines.BATCH_BYTES
    # records that run over several slices
    split, found = csvlines._Split("f", 0, False), []
    for part in csvlines.slices(pa.array(['a,"b', "c" * 50, 'd"', "e,f", '"g', 'h"']), 20):
        found += split.add(part)
    assert found == [(0, csvlines.WHOLE, 'a,"b\n' + "c" * 50 + '\nd"'), (3, csvlines.WHOLE, "e,f"),
                     (4, csvlines.WHOLE, '"g\nh"')]
    assert split.rest() == []
