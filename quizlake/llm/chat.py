"""Chat formatting by prefix-target expansion: one example for every assistant turn.

An example holds all turns before an assistant turn as context and that reply as the only
trainable text. A turn is written

    <|turn|>ROLE<|text|>TEXT<|end|>

and inside roles and texts ``&`` and ``<`` are written ``&amp;`` and ``&lt;`` (fixed values), so
no control string can occur there and every text can be read back. Turns after the last
assistant turn (or a conversation without one) are kept in one more example with nothing
trainable. ``digest`` reads the conversation back from the examples' own text.

A conversation's turns are gathered in one row, since its digest runs over all of them in order;
its examples are made from that row one by one.

Cases: null texts and null roles are empty; equal turn numbers are ordered by role, then text;
repeated rows are turns of their own; a null conv_id is a conversation of its own; roles compare
exactly; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizlake.llm.store import table

# Fixed values of the template.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
ASSISTANT = "assistant"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def expand(conversations: DataFrame) -> DataFrame:
    """One row per example: conv_id, target (number of the trainable turn, null: none), formatted,
    loss_start and loss_chars (code points of the trainable span within formatted)."""
    turns = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))).alias("turns"))
    written = F.transform("turns", lambda t: F.concat(
        F.lit(TURN), escape(t["role"]), F.lit(TEXT), escape(t["text"]), F.lit(END)))
    n = F.size("turns")
    numbers = F.sequence(F.lit(1), n)
    replies = F.filter(numbers, lambda i: F.element_at("turns", i)["role"] == ASSISTANT)
    tail = F.when(F.element_at("turns", -1)["role"] == ASSISTANT, F.expr("cast(array() as array<int>)")).otherwise(
        F.array(-n))  # all turns, nothing trainable
    cases = turns.select("conv_id", "turns", written.alias("written"), F.explode(F.concat(replies, tail)).alias("case"))
    upto = F.abs("case")
    formatted = F.array_join(F.slice("written", F.lit(1), upto), "")
    reply = F.length(escape(F.element_at("turns", upto)["text"]))
    made = cases.select("conv_id", F.when(F.col("case") > 0, F.col("case")).alias("target"), formatted.alias("formatted"),
                        F.when(F.col("case") > 0, reply).otherwise(0).alias("loss_chars"))
    start = F.when(F.col("target").isNotNull(), F.length("formatted") - len(END) - F.col("loss_chars"))
    return made.withColumn("loss_start", start)


def digest(examples: DataFrame) -> DataFrame:
    """One row per conversation, read back from the formatted examples."""
    reply = unescape(F.substr("formatted", F.col("loss_start") + 1, F.col("loss_chars")))
    parts = F.split("formatted", F.lit(r"\Q" + END + r"\E"))
    read = F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda p: F.struct(
        unescape(F.substring_index(F.substr(p, F.lit(len(TURN) + 1)), TEXT, 1)).alias("role"),
        unescape(F.substring_index(p, TEXT, -1)).alias("text")))
    # the longest example holds every turn; of the others only the reply is needed
    whole = examples.groupBy("conv_id").agg(
        F.max_by("formatted", F.length("formatted")).alias("formatted"),
        F.array_join(F.transform(F.array_sort(F.collect_list(
            F.when(F.col("target").isNotNull(), F.struct("target", reply.alias("reply"))))), lambda x: x["reply"]), "").alias("loss"),
        F.sum(F.length("formatted")).cast("bigint").alias("formatted_chars"))
    back = whole.select("conv_id", read.alias("turns"), "loss", "formatted_chars")
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"),
                       F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
                       F.length("loss").cast("bigint").alias("loss_chars"),
                       F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")


def op5_prefix_targets(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")],
                                  "conv_id long, turn long, role string, text string")
    return digest(expand(rows.unionByName(probe)))


#: The same digests in DuckDB SQL, from the turns themselves (lengths of the written turns added up).
OP5_SQL = f"""WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, '{ASSISTANT}', '</s>[INST] ok [/INST]')),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, role DESC, text DESC) = 1 AS last,
    {len(TURN + TEXT + END)} + length(replace(replace(role, '&', '&amp;'), '<', '&lt;'))
      + length(replace(replace(text, '&', '&amp;'), '<', '&lt;')) AS written FROM c),
p AS (SELECT *, sum(written) OVER (PARTITION BY conv_id ORDER BY i) AS upto FROM o)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = '{ASSISTANT}'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = '{ASSISTANT}'), '')) AS loss_sha256,
  CAST(coalesce(sum(upto) FILTER (WHERE role = '{ASSISTANT}' OR last), 0) AS BIGINT) AS formatted_chars
FROM p GROUP BY conv_id"""
