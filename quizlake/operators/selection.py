"""Exact "first n rows in order" without funnelling rows through one task.

``df.orderBy(c).limit(n)`` plans as TakeOrderedAndProject (or Sort + GlobalLimit for a
large n): every task ships its n best whole rows to a single task that merges them.
With tens of thousands of tasks that single task receives n rows per task -- far more
than n -- however small n is. Here the n-th smallest order value is found first by
selection over the order column alone, and the rows are then kept by a filter, which
runs in every task where the data already is:

1. count, min and max of the order column;
2. each pass splits the open integer range [a, b] into ``BUCKETS`` equal buckets and
   counts rows per bucket with a partial (map-side) aggregate; at most ``BUCKETS``
   small rows reach the driver, which picks the bucket holding the wanted rank. A
   range of 2**64 values closes in at most 7 passes;
3. rows below the found value are kept by a filter; rows equal to it (ties), or rows
   with a null order value when n exceeds the non-null rows, are cut to the exact
   number needed by giving them unique ids in a written checkpoint and selecting again.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 4096
_WIDE = "decimal(20,0)"  # differences of two bigints never overflow here


def kth_smallest(df: DataFrame, col: str, k: int) -> tuple[int | None, int, int]:
    """The ``k``-th smallest (0-based) non-null value of the integer column ``col``,
    the number of rows strictly below it and the number equal to it;
    ``(None, n, 0)`` when there are only n <= k non-null values."""
    x = df.select(F.col(col).cast("bigint").alias("_x")).filter(F.col("_x").isNotNull())
    x = x.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n, a, b = x.agg(F.count(F.lit(1)), F.min("_x"), F.max("_x")).first()
        if k < 0 or k >= n:
            return None, n, 0
        below, equal = 0, n
        while a != b:
            width = (b - a) // BUCKETS + 1
            bucket = ((F.col("_x").cast(_WIDE) - F.lit(a).cast(_WIDE)) / F.lit(width)).cast("bigint")
            counts = (x.filter(F.col("_x").between(a, b)).groupBy(bucket.alias("_k"))
                      .agg(F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_a"), F.max("_x").alias("_b"))
                      .collect())  # at most BUCKETS rows
            for row in sorted(counts, key=lambda r: r["_k"]):
                if below + row["_n"] > k:
                    a, b, equal = row["_a"], row["_b"], row["_n"]
                    break
                below += row["_n"]
        return a, below, equal
    finally:
        x.unpersist()


def dense_numbers(df: DataFrame, col: str, name: str) -> DataFrame:
    """Adds ``name``: 0, 1, 2, ... in order of ``col`` (distinct values), without gathering the rows.

    Rows are range-partitioned and written once; a running sum over the partitions (one small row
    each) gives the first number of each, and the rows of a partition are numbered on their own."""
    from quizlake.session import shared_dir

    shared_dir(df.sparkSession)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(parts, col).withColumn("_p", F.spark_partition_id()).checkpoint()
    sizes = rows.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_p").orderBy(col)) - 1
    return (rows.join(F.broadcast(sizes), "_p").withColumn(name, F.col("_before") + within.cast("bigint"))
            .drop("_p", "_before"))


def _kth_double(x: DataFrame, k: int, n: int) -> float:
    """The ``k``-th smallest (0-based) of the ``n`` finite doubles ``_x``. Each pass keeps the bucket of
    the wanted rank between its own smallest and largest value, so the range shrinks every time."""
    a, b = x.agg(F.min("_x"), F.max("_x")).first()
    below = 0
    while a != b:
        span = b / 2 - a / 2  # halves: the difference of two doubles can overflow
        share = (F.col("_x") / 2 - a / 2) / span if span > 0 else F.when(F.col("_x") > a, 1.0).otherwise(0.0)
        bucket = F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1))
        counts = (x.filter(F.col("_x").between(a, b)).groupBy(bucket.alias("_k"))
                  .agg(F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_a"), F.max("_x").alias("_b"))
                  .collect())  # at most BUCKETS rows
        for row in sorted(counts, key=lambda r: r["_k"]):
            if below + row["_n"] > k:
                a, b = row["_a"], row["_b"]
                break
            below += row["_n"]
    return a


def first_sorted(df: DataFrame, keys: list[tuple[str, bool]], n: int) -> DataFrame:
    """The first ``n`` rows of ``df`` in the order of ``keys`` ((column, descending) pairs, nulls last),
    as ``orderBy(...).limit(n)`` gives them; rows that tie in all keys are taken in any order.

    The leading key (a number) is cut by selection, so all other rows are dropped where they are. What
    is left, the rows up to the cut with all its ties, is range-partitioned by all keys and written
    once; whole partitions before the cut are kept and only the one that holds it is numbered. However
    many rows share the leading value, no task gathers them."""
    from quizlake.session import shared_dir

    if n <= 0:
        return df.limit(0)
    lead, descending = keys[0]
    x = F.col(lead).cast("double")
    inf = float("inf")
    kind = F.when(x.isNull(), 4).when(F.isnan(x), 3).when(x == inf, 2).when(x == -inf, 0).otherwise(1)
    place = F.when(x.isNull(), 4).otherwise(3 - kind) if descending else kind  # in sort order
    sizes = {r["k"]: r["n"] for r in df.groupBy(place.alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before, cut = 0, None
    for k in sorted(sizes):
        if before + sizes[k] >= n:
            cut = k
            break
        before += sizes[k]
    if cut is None:
        return df  # not more than n rows
    finite = 3 - 1 if descending else 1
    signed = -x if descending else x
    if cut == finite:
        own = df.filter(place == cut).select(signed.alias("_x")).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            edge = _kth_double(own, n - before - 1, sizes[cut])
        finally:
            own.unpersist()
        kept = df.filter((place < cut) | ((place == cut) & (signed <= F.lit(edge))))
    else:
        kept = df.filter(place <= cut)
    order = [F.col(c).desc_nulls_last() if d else F.col(c).asc_nulls_last() for c, d in keys]
    shared_dir(df.sparkSession)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (kept.withColumn("_u", F.monotonically_increasing_id()).repartitionByRange(parts, *order, "_u")
            .withColumn("_p", F.spark_partition_id()).checkpoint())
    upto = 0
    for p, size in sorted((r["_p"], r["count"]) for r in rows.groupBy("_p").count().collect()):  # one row a partition
        if upto + size >= n:
            break
        upto += size
    number = F.row_number().over(Window.partitionBy("_p").orderBy(*order, "_u"))
    last = rows.filter(F.col("_p") == p).withColumn("_n", number).filter(F.col("_n") <= n - upto).drop("_n")
    return rows.filter(F.col("_p") < p).unionByName(last).drop("_p", "_u")


def _take_any(df: DataFrame, m: int) -> DataFrame:
    """Exactly ``m`` rows of ``df`` (any; all when it holds fewer).

    Rows get unique ids (partition, position) that are frozen by a reliable checkpoint
    in the shared checkpoint folder, so a retried task cannot renumber them.
    """
    from quizlake.session import shared_dir

    if m <= 0:
        return df.limit(0)
    shared_dir(df.sparkSession)
    t = df.withColumn("_u", F.monotonically_increasing_id()).checkpoint()
    u, _, _ = kth_smallest(t, "_u", m - 1)
    if u is None:  # fewer than m rows
        return t.drop("_u")
    return t.filter(F.col("_u") <= u).drop("_u")


def first_rows(df: DataFrame, order: str, n: int) -> DataFrame:
    """The first ``n`` rows of ``df`` by ascending integer ``order``, nulls last (as
    ``orderBy(asc_nulls_last(order)).limit(n)``; rows tied at the cut are taken in
    any order). Result rows are not sorted."""
    if n <= 0:
        return df.limit(0)
    x = F.col(order)
    kth, below, equal = kth_smallest(df, order, n - 1)
    if kth is None:  # n reaches past the non-null rows: all of them, then null rows
        return df.filter(x.isNotNull()).unionByName(_take_any(df.filter(x.isNull()), n - below))
    if below + equal <= n:  # no tie cut at the boundary (always so for unique order values)
        return df.filter(x <= kth)
    return df.filter(x < kth).unionByName(_take_any(df.filter(x == kth), n - below))
