"""Mixing sources to target weights by Sainte-Lague apportionment of words.

Sources, ordered by code point with null last, weigh 5, 2, 1, repeating. Their targets share all
words of the input by weight; a target stops at ``MAX_REPEATS`` times its source's size and the
excess is shared again by weight among the others until none is above.

Sainte-Lague apportionment (highest quotients claim / (2 q + 1)) turns the targets into whole words
once for the whole input, within each source's repeats. Documents are dealt to shards by a seeded
hash of their id, and a source's quota is spread over its shards in proportion to what they hold of
it: shard after shard gets the whole words of the claim added up so far less those already given,
so the remainder is carried on and the shards' quotas add up to the source's. A source then lays its
documents of the shard end to end in seeded order and takes its quota of words from there, whole
rounds first; so every document is taken either r or r + 1 times, but for the one where the quota
ends. Work per shard is bounded by the shard's size, whatever a source's share.

Cases: null, empty and blank texts have size 0 and are taken 0 times; a null source is a source;
copies and repeated rows are documents of their own (ties in the seeded order are broken by size,
so equal rows are interchangeable); a table without words has targets of 0; other columns are
ignored by ``mix_sources`` and kept by ``mixed``; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quizlake.llm.store import saved, table

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
#: Documents of a shard (on average), the seed of shards and orders, and neighbouring shards whose
#: claims are added up together.
SHARD_DOCS, SEED, RUN = 4000, 20240611, 1024


def word_count() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def targets(sizes: list[int], weights=WEIGHTS, most: int = MAX_REPEATS) -> list[float]:
    """Targets of the sources in order: shares of the total by weight, capped, excess reshared."""
    total = float(sum(sizes))
    weight = [float(weights[i % len(weights)]) for i in range(len(sizes))]
    out = [0.0] * len(sizes)
    free, left = list(range(len(sizes))), total
    while free:
        unit = left / sum(weight[i] for i in free)
        over = [i for i in free if unit * weight[i] > most * sizes[i]]
        if not over:
            for i in free:
                out[i] = unit * weight[i]
            break
        for i in over:
            out[i] = float(most * sizes[i])
            left -= out[i]
        free = [i for i in free if i not in set(over)]
    return out


def sainte_lague(claims: list[float], seats: int) -> list[int]:
    """Seats by highest quotients claim / (2 q + 1); equal quotients go to the earlier claim.

    Every claim first gets the whole quotas it certainly has (its proportional share less one
    half of the claims, rounded down), then single seats follow by quotient."""
    total = sum(claims)
    if total <= 0 or seats <= 0:
        return [0] * len(claims)
    unit = total / seats
    divisor = unit * (1 + len(claims) / (2.0 * seats)) + 1e-12
    quota = [max(0, int(c / divisor + 0.5 - 1e-9)) for c in claims]
    while sum(quota) > seats:  # rounding of the divisor: the weakest last seats go back
        i = min((i for i in range(len(claims)) if quota[i]), key=lambda i: (claims[i] / (2 * quota[i] - 1), -i))
        quota[i] -= 1
    heap = [(-c / (2 * q + 1), i) for i, (c, q) in enumerate(zip(claims, quota)) if c > 0]
    heapq.heapify(heap)
    for _ in range(seats - sum(quota)):
        _, i = heap[0]
        quota[i] += 1
        heapq.heapreplace(heap, (-claims[i] / (2 * quota[i] + 1), i))
    return quota


def quotas(goal: list[float], sizes: list[int], most: int = MAX_REPEATS) -> list[int]:
    """Whole words of the sources: the targets apportioned, none above ``most`` times its size."""
    out, free, left = [0] * len(sizes), list(range(len(sizes))), sum(sizes)
    while free:
        seats = sainte_lague([goal[i] for i in free], left)
        over = [i for i, q in zip(free, seats) if q >= most * sizes[i]]
        if not over:
            for i, q in zip(free, seats):
                out[i] = q
            break
        for i in over:
            out[i] = most * sizes[i]
            left -= out[i]
        free = [i for i in free if i not in set(over)]
    return out


def _spread(held: DataFrame) -> DataFrame:
    """(shard, rank, held, take): each source's quota over its shards, the remainder carried on."""
    at = held.withColumn("run", F.expr(f"shard div {RUN}"))
    by_run = at.groupBy("rank", "run").agg(F.sum("held").alias("words"))
    earlier = Window.partitionBy("rank").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    by_run = by_run.select("rank", "run", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("earlier"))
    inside = Window.partitionBy("rank", "run").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    at = at.withColumn("inside", F.sum("held").over(inside)).join(by_run, ["rank", "run"]).withColumn("upto", F.expr("earlier + inside"))

    def given(words: str) -> str:
        return (f"cast(quota as decimal(18,0)) * cast({words} as decimal(18,0)) "
                "div cast(greatest(source_size, 1) as decimal(18,0))")

    return at.select("shard", "rank", "held", F.expr(f"({given('upto')}) - ({given('(upto - held)')})").alias("take"))


def source_targets(sized: DataFrame) -> DataFrame:
    """(source, rank, source_size, target, quota): one row a source."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("size")).collect()  # one row a source
    rows = sorted(((r["source"], int(r["size"] or 0)) for r in sums), key=lambda r: (r[0] is None, r[0] or ""))
    sizes = [n for _, n in rows]
    goal = targets(sizes)
    schema = T.StructType([T.StructField("source", sized.schema["source"].dataType), T.StructField("rank", T.IntegerType()),
                           T.StructField("source_size", T.LongType()), T.StructField("target", T.DoubleType()),
                           T.StructField("quota", T.LongType())])
    # as an Arrow table: rows of Python objects would start Python workers of their own in every executor
    found = [[s for s, _ in rows], list(range(len(rows))), sizes, goal, quotas(goal, sizes)]
    return sized.sparkSession.createDataFrame(pa.table([pa.array(c) for c in found], names=schema.names), schema)


def _dealt(sized: DataFrame, n_docs: int) -> DataFrame:
    """``sized`` rows plus source_size, target and taken."""
    shards = max(1, -(-n_docs // SHARD_DOCS))
    plan = source_targets(sized).withColumnRenamed("source", "__source")
    where = F.pmod(F.xxhash64("doc_id", "size", F.lit(SEED)), F.lit(shards)).cast("int")
    docs = (sized.withColumn("shard", where)
            .join(plan, F.col("source").eqNullSafe(F.col("__source"))).drop("__source"))
    held = _spread(docs.groupBy("shard", "rank", "source_size", "quota").agg(F.sum("size").alias("held")))
    order = Window.partitionBy("shard", "rank").orderBy(F.xxhash64("doc_id", F.lit(SEED + 1)), "doc_id", "size")
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    laid = docs.withColumn("before", before).join(held, ["shard", "rank"])
    rounds = F.expr("take div greatest(held, 1)")
    rest = F.expr("least(greatest(take % greatest(held, 1) - before, 0), size)")
    return laid.withColumn("taken", rounds * F.col("size") + rest)


def mix_sources(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    sized = saved(docs.select("doc_id", "source", word_count().alias("size")), "sizes")
    return _dealt(sized, sized.count()).select("doc_id", "size", "source_size", "target", "taken")


def mixed(docs: DataFrame) -> DataFrame:
    """Documents that the mix takes, with ``size``, ``source_size``, ``target`` and ``taken``.

    Columns of those names in ``docs`` give way to the mix's."""
    extra = ["size", "source_size", "target", "taken"]
    columns = [c for c in docs.columns if c not in extra]
    docs = docs.select(*columns)
    sized = docs.withColumn("size", word_count())
    narrow = saved(sized.select("doc_id", "source", "size"), "sizes")
    taken = _dealt(narrow, narrow.count()).where("taken > 0")
    # repeated rows of one document agree in id, source and size: numbered, they match one to one
    same = Window.partitionBy("doc_id", "source", "size")
    key = ["doc_id", "source", "size"]
    left = sized.withColumn("__n", F.row_number().over(same.orderBy("text")))
    right = (taken.withColumn("__n", F.row_number().over(same.orderBy(F.desc("taken"))))
             .select(*[F.col(c).alias(f"__{c}") for c in key], F.col("__n").alias("__m"), "source_size", "target", "taken"))
    match = F.col("__n") == F.col("__m")
    for c in key:
        match = match & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return left.join(right, match).select(*columns, *extra)


def op4_sainte_lague_mix(spark, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))
