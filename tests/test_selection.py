"""First-n-in-order by selection: equal to orderBy + limit, exact with ties and nulls."""

import random

import pytest

from pyspark.sql import functions as F

from quizlake.operators import clean, selection
from quizlake.plans import fixtures as fx
from tests.conftest import SF001


def _ids(df, col="id"):
    return sorted(r[0] for r in df.select(col).collect())


def test_first_rows_equals_order_limit_on_unique_keys(spark):
    rnd = random.Random(7)
    vals = rnd.sample(range(-10**15, 10**15), 3000)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, o long").repartition(5)
    for n in (1, 2, 17, 1000, 2999, 3000, 5000):
        want = _ids(df.orderBy("o").limit(n))
        assert _ids(selection.first_rows(df, "o", n)) == want, n
    assert selection.first_rows(df, "o", 0).count() == 0


def test_first_rows_exact_count_with_ties_and_nulls(spark):
    rows = [(i, i // 100 if i < 900 else None) for i in range(1000)]  # 9 values x 100, 100 nulls
    df = spark.createDataFrame(rows, "id long, o long").repartition(4)
    for n in (50, 100, 101, 450, 899, 900, 901, 950, 1000, 1200):
        got = selection.first_rows(df, "o", n).collect()
        assert len(got) == min(n, 1000), n
        # every row strictly before the cut value is in, nothing after it
        os_ = [r.o for r in got]
        cut = sorted((o for o in os_ if o is not None))[-1] if any(o is not None for o in os_) else None
        assert sum(1 for r in rows if r[1] is not None and cut is not None and r[1] < cut) <= len(got)
        assert all(o is None or o <= cut for o in os_)
        if n <= 900:
            assert all(o is not None for o in os_)
        assert len({r.id for r in got}) == len(got)


def test_first_rows_wide_range_and_single_value(spark):
    vals = [-(2**62), -5, 0, 3, 2**62, 2**63 - 1]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, o long")
    for n in range(1, 7):
        assert _ids(selection.first_rows(df, "o", n)) == list(range(n))
    same = spark.createDataFrame([(i, 42) for i in range(10)], "id long, o long")
    assert selection.first_rows(same, "o", 4).count() == 4
    assert selection.kth_smallest(same, "o", 3) == (42, 0, 10)


def test_limit_items_keeps_file_order_prefix(spark):
    items = clean.clean_items(fx.bronze(spark, SF001))
    want = _ids(items.orderBy("ordinal").limit(60), "ordinal")
    assert _ids(clean.limit_items(items, 60), "ordinal") == want
    assert clean.limit_items(items, 10**9).count() == items.count()
    assert clean.limit_items(items.filter(F.lit(False)), 5).count() == 0


LISTED = [(None, "a"), (float("nan"), "b"), (float("inf"), "c"), (float("-inf"), "d"), (1e308, "e"), (-1e308, "f"), (5e-324, "g"),
          (0.0, "h"), (-0.0, "i"), (2.5, None)] + [(7.0, f"t{i % 40:02d}") for i in range(300)] + [(i / 7, "z") for i in range(60)]


@pytest.mark.parametrize("descending", [True, False])
def test_first_sorted_equals_limit_with_ties(spark, descending):
    df = spark.createDataFrame(LISTED, "x double, s string").repartition(5)
    order = [F.col("x").desc_nulls_last() if descending else F.col("x").asc_nulls_last(), F.col("s").asc_nulls_last()]
    for n in (0, 1, 2, 3, 4, 9, 40, 70, 200, 365, 369, 370, 500):
        got = selection.first_sorted(df, [("x", descending), ("s", False)], n).collect()
        want = df.orderBy(*order).limit(n).collect()
        assert sorted(map(str, got)) == sorted(map(str, want)), n
    assert selection.first_sorted(df.limit(0), [("x", descending)], 3).count() == 0


def test_dense_numbers_follow_the_order(spark):
    df = spark.createDataFrame([(f"f{i * 7919 % 1000:04d}",) for i in range(1000)], "s string").repartition(6)
    got = {r.s: r.n for r in selection.dense_numbers(df, "s", "n").collect()}
    assert got == {s: i for i, s in enumerate(sorted(got))}
