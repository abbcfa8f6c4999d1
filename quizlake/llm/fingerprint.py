"""Document fingerprints: bottom-k sketches of five-word shingle hashes, in DataFrame functions only.

A text's words are lower-cased runs without white space; its shingles are hashed (a text of fewer
words is one shingle) and the ``K`` smallest distinct hashes, sorted, are the sketch. The sketch of
a union is the bottom k of the merged sketches, so parts can be sketched apart and merged
(``merge``, ``merge_groups``). Among the bottom k of a union, the share that both sketches hold
estimates resemblance; from it and the estimated distinct counts follows containment.

``compare_edited`` needs each document's successor by (doc_id, text). Documents are dealt, once, to
buckets of neighbouring ids (split at approximate quantiles, found by a binary search written as
an expression); the first rows of a bucket are also dealt, as guards, to the bucket before, so
``lead`` within a bucket never misses the successor.

Cases: null and empty texts have an empty sketch and the fingerprint ``""``; two empty sketches
are alike to 1, an empty and another one to 0; equal texts have equal fingerprints; rows with one
doc_id follow each other in text order, a null doc_id stands before all others; a single document
is its own successor; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quizlake.llm.store import table

SHINGLE, K = 5, 128
#: Documents of a bucket (on average) and most buckets (beyond that, buckets grow).
BUCKET_DOCS, MAX_BUCKETS = 2000, 20_000


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often the expression repeats it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def shingle_hashes(text: Column, shingle: int = SHINGLE) -> Column:
    """Hashes of the shingles, in text order; empty without words."""
    clean = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(" \t\n\u000b\f\r"))
    words = F.transform(F.split(clean, r"[\x20\x09-\x0D]+"), lambda w: F.xxhash64(w))

    def hashes(h):
        at = F.sequence(F.lit(0), F.greatest(F.size(h) - shingle, F.lit(0)))
        return F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(shingle)]))

    return F.when(F.length(clean) > 0, bound(words, hashes)).otherwise(
        F.expr("cast(array() as array<bigint>)"))


def sketch(text: Column, k: int = K, shingle: int = SHINGLE) -> Column:
    """Bottom-k sketch: the k smallest distinct shingle hashes, ascending."""
    return bottom(shingle_hashes(text, shingle), k)


def bottom(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two sketched sets."""
    return bottom(F.concat(a, b), k)


def merge_groups(df: DataFrame, key: str, sketches: str, k: int = K) -> DataFrame:
    """(key, sketch): one merged sketch a group; a hot group is cut to k hashes before it moves."""
    rows = df.select(key, F.explode(sketches).alias("__h"))
    order = Window.partitionBy(key).orderBy("__h")
    small = rows.withColumn("__r", F.dense_rank().over(order)).where(F.col("__r") <= k)
    return small.groupBy(key).agg(F.sort_array(F.collect_set("__h")).alias("sketch"))


def distinct_count(s: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles behind a sketch (exact below k)."""
    reach = (F.element_at(s, -1).cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise((k - 1) / F.greatest(reach, F.lit(1e-300)))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of the sketched sets."""
    def share(union):
        both = F.size(F.array_intersect(union, F.array_intersect(a, b)))
        return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))

    return bound(merge(a, b, k), share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first set's shingles that the second has."""
    common = resemblance(a, b, k) * distinct_count(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), common / distinct_count(a, k)))


def as_text(s: Column) -> Column:
    """The sketch as text: hexadecimal hashes, comma-joined."""
    return F.array_join(F.transform(s, lambda x: F.hex(x)), ",")


def from_text(s: Column) -> Column:
    """The sketch that ``as_text`` wrote."""
    return F.when(F.length(s) == 0, F.expr("cast(array() as array<bigint>)")).otherwise(
        F.transform(F.split(s, ","), lambda x: F.conv(x, 16, -10).cast("bigint")))


def _position(firsts: list[int], key: Column) -> Column:
    """Number of ``firsts`` (ascending) at or below the key, less one, by binary steps."""
    steps = [1 << i for i in reversed(range(len(firsts).bit_length()))]
    values = F.lit(firsts)

    def step(at, s):
        up = at + s
        return F.when((up <= len(firsts)) & (F.get(values, up - 1) <= key), up).otherwise(at)

    return F.greatest(F.aggregate(F.lit(steps), F.lit(0), step) - 1, F.lit(0))


def _with_successor(docs: DataFrame) -> DataFrame:
    """(doc_id, text, sketch, next_text, next_sketch) of every row, in one shuffle of the texts."""
    spark = docs.sparkSession
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    n = docs.agg(F.count("*")).first()[0]
    buckets = max(1, min(MAX_BUCKETS, -(-n // BUCKET_DOCS)))
    found = docs.select(key.alias("k")).agg(
        F.min("k"), F.percentile_approx("k", [i / buckets for i in range(1, buckets)] or [0.5], 20 * buckets + 1000)).first()
    firsts = sorted({found[0], *found[1]}) if n else [0]
    pos = _position(firsts, key)
    placed = docs.select("doc_id", "text", key.alias("k"), pos.alias("pos"))
    opens = F.get(F.lit(firsts), F.col("pos")) == F.col("k")
    before = F.pmod(F.col("pos") - 1, F.lit(len(firsts)))
    here = F.struct(F.col("pos").alias("bucket"), F.lit(0).alias("guard"))
    # a guard of the bucket before; after the last document comes the first again
    there = F.struct(before.alias("bucket"), F.lit(1).alias("guard"))
    dealt = placed.select("doc_id", "text", "k", F.explode(F.when(opens, F.array(here, there)).otherwise(F.array(here))).alias("x"))
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), buckets // 8)
    rows = (dealt.select("doc_id", "text", "k", "x.bucket", "x.guard").repartition(partitions, "bucket")
            .withColumn("sketch", sketch(F.col("text"))))
    order = Window.partitionBy("bucket").orderBy("guard", "k", "text")
    follow = F.lead(F.struct("text", "sketch")).over(order)
    return (rows.withColumn("next", follow).where("guard = 0")
            .select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "sketch",
                    F.coalesce("next.text", F.lit("")).alias("next_text"), F.col("next.sketch").alias("next_sketch")))


def compare_edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness (see module)."""
    rows = _with_successor(docs.select("doc_id", "text"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - half), F.substr("next_text", F.lit(1), half))
    rows = rows.select("doc_id", n.cast("bigint").alias("n_chars"), "sketch", "next_sketch", edited.alias("edited"))
    rows = rows.select("doc_id", "n_chars", "sketch", "next_sketch",
                       F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       sketch(F.col("edited")).alias("edited_sketch"))
    return rows.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("sketch")).alias("fingerprint"),
                       as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
                       resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
                       resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"))


def op8_bottom_k_fingerprints(spark, sf_dir: str) -> DataFrame:
    return compare_edited(table(spark, sf_dir, "documents"))
