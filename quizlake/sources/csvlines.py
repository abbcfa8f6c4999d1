"""Multi-line CSV read by byte ranges: one large file becomes many tasks.

Spark splits a text file at line ends, but a quoted CSV value may hold line ends itself. A line end
separates records exactly where the number of quotes before it in the file is even (quotes inside a
value are doubled and keep the count even). So:

1. one pass adds up the quotes of every split; a running sum over the splits of a file (one small row
   each) tells which splits begin inside a quoted value;
2. a second pass joins lines to records inside each split. Records that cross a split boundary leave
   a fragment in each split; only these fragments are shuffled, to be put together by record;
3. each record is parsed by Spark's own CSV reader expression.

The list of splits that begin inside a value is broadcast as one 64-bit hash a split (8 bytes for each
``spark.sql.files.maxPartitionBytes`` of input). Quoting must follow the usual rule (a value with
quotes is quoted, quotes in it doubled); a file with an odd number of quotes is an error. A compressed
file is one split. Empty lines are skipped; lines may end with CR LF.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Lines and bytes of an Arrow batch at most, and bytes of lines joined to records at once (a longer
#: line is a batch of its own): what a task holds depends on neither the input nor the size of a split.
BATCH_ROWS, BATCH_BYTES = 1_000, 4 << 20
WHOLE, HEAD, MIDDLE, TAIL = 0, 1, 2, 3
RECORDS = "file string, block bigint, line bigint, kind int, text string"
_SCHEMA = pa.schema([("file", pa.string()), ("block", pa.int64()), ("line", pa.int64()), ("kind", pa.int32()),
                     ("text", pa.string())])


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _small_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches; smaller bounds stay."""
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        conf = f"spark.sql.execution.arrow.{name}"
        now = spark.conf.get(conf).lower().removesuffix("b")
        if not (now.isdecimal() and 0 < int(now) <= most):
            spark.conf.set(conf, most)


def slices(values: pa.Array, most: int | None = None):
    """``values`` in order, cut into arrays of about ``most`` bytes."""
    most = BATCH_BYTES if most is None else most
    piece = np.cumsum(pc.binary_length(values).to_numpy(zero_copy_only=False)) // most
    cuts = [0, *(np.flatnonzero(piece[1:] != piece[:-1]) + 1).tolist(), len(values)]
    return (values.slice(lo, hi - lo) for lo, hi in zip(cuts, cuts[1:]))


def splits(lines: DataFrame) -> DataFrame:
    """(file, block, inside): does the split begin inside a quoted value?"""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    per = lines.groupBy("file", "block").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    total = Window.partitionBy("file")
    odd = F.sum("quotes").over(total) % 2 == 1
    inside = F.coalesce(F.sum("quotes").over(before) % 2 == 1, F.lit(False))
    return per.select("file", "block", F.when(odd, F.raise_error(
        F.concat(F.lit("unbalanced quotes in "), F.col("file"))).cast("boolean")).otherwise(inside).alias("inside"))


class _Split:
    """Joins the lines of one split to records."""

    def __init__(self, file: str, block: int, inside: bool):
        self.file, self.block, self.inside = file, block, inside
        self.line, self.open, self.first = 0, [], 0 if not inside else -1
        self.whole = not inside  # the open record began in this split

    def add(self, values: pa.Array):
        """Records that end within ``values``: (line, kind, text)."""
        odd = pc.count_substring(values, '"').to_numpy(zero_copy_only=False) % 2
        after = (np.cumsum(odd) + self.inside) % 2
        ends = np.flatnonzero(after == 0)  # a record ends with these lines
        texts = values.to_pylist()
        lo, out = 0, []
        for hi in ends.tolist():
            part = texts[lo:hi + 1] if hi > lo or self.open else None
            if self.open:
                part = self.open + part
                self.open = []
                out.append((self.first, WHOLE if self.whole else HEAD, "\n".join(part)))
            else:
                at = self.line + lo
                if self.inside and lo == 0 and not self.whole:
                    out.append((-1, HEAD, texts[0] if part is None else "\n".join(part)))
                else:
                    out.append((at, WHOLE, texts[lo] if part is None else "\n".join(part)))
            self.whole, lo = True, hi + 1
        if lo < len(texts):
            if not self.open and self.whole:
                self.first = self.line + lo
            self.open += texts[lo:]
        self.inside = bool(after[-1]) if len(after) else self.inside
        self.line += len(texts)
        return out

    def rest(self):
        """What the split leaves open: the tail of a record that goes on in the next split."""
        if not self.open:
            return []
        return [(self.first, TAIL if self.whole else MIDDLE, "\n".join(self.open))]


def records(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(file, block, line, text) of every record below ``path``, and the splits. (block, line) ascend
    in file order; ``block + line`` does too, and is below the file's size."""
    from quizlake.session import shared_dir, ship_modules

    shared_dir(spark)
    ship_modules(spark)
    _small_batches(spark)
    lines = _lines(spark, path)
    known = splits(lines).checkpoint()
    odd = known.where("inside").select(F.xxhash64("file", "block").alias("h")).toPandas()["h"].to_numpy(np.int64)
    shared = spark.sparkContext.broadcast(np.sort(odd))

    def run(batches):
        begin, split = shared.value, None

        def rows(found):
            if found:
                at, kind, text = zip(*found)
                n = len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([split.file] * n), pa.array([split.block] * n, pa.int64()), pa.array(at, pa.int64()),
                     pa.array(kind, pa.int32()), pa.array(text, pa.string())], schema=_SCHEMA)

        for batch in batches:
            h = batch.column("h").to_numpy()
            cuts = [0, *(np.flatnonzero(h[1:] != h[:-1]) + 1).tolist(), len(h)]
            for lo, hi in zip(cuts, cuts[1:]):
                file, block = batch.column("file")[lo].as_py(), batch.column("block")[lo].as_py()
                if split is None or (split.file, split.block) != (file, block):
                    if split is not None:
                        yield from rows(split.rest())
                    i = int(np.searchsorted(begin, h[lo]))
                    split = _Split(file, block, i < len(begin) and begin[i] == h[lo])
                for values in slices(batch.column("value").slice(lo, hi - lo)):
                    yield from rows(split.add(values))
        if split is not None:
            yield from rows(split.rest())

    found = lines.withColumn("h", F.xxhash64("file", "block")).mapInArrow(run, RECORDS)
    whole = found.where(F.col("kind") == WHOLE).select("file", "block", "line", "text")
    pieces = found.where(F.col("kind") != WHOLE)
    # fragments in file order; a head comes before the tail that its split may leave
    upto = Window.partitionBy("file").orderBy("block", F.col("kind") == TAIL).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    pieces = pieces.withColumn("record", F.sum((F.col("kind") == TAIL).cast("bigint")).over(upto))
    joined = pieces.groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("block", "kind", "line", "text"))).alias("p"))
    crossing = joined.select("file", F.col("p")[0]["block"].alias("block"), F.col("p")[0]["line"].alias("line"),
                             F.array_join(F.transform("p", lambda x: x["text"]), "\n").alias("text"))
    return whole.unionByName(crossing), known


def parsed(rows: DataFrame, columns: list[str], options: dict) -> DataFrame:
    """Records parsed into text columns; the header record of each file and empty lines are left out."""
    text = F.regexp_replace("text", "\r\\z", "")
    schema = ", ".join(f"`{c}` string" for c in columns)
    body = rows.select("file", "block", "line", text.alias("text")).where(
        "not (block = 0 and line = 0) and text <> ''")
    return body.select("file", "block", "line", F.from_csv("text", schema, options).alias("r")).select(
        "file", "block", "line", "r.*")
