"""Operator 8: chat formatting by relational expressions only.

Turns are collected as structs and sorted, first per stretch of ``CHUNK`` turn
numbers (so a very long conversation is sorted by many tasks), then the stretches are
put together per conversation. Adjacent turns of one role share a block. Output:

    <|turn|>role<|body|>text<|next|>text<|end|>\\n

Control strings of this and of other public templates inside texts get a backslash
after their first sign, on top of those they have, so unescaping gives back the text.
The formatted string also comes as segments with the loss mask: a segment under the
mask is one assistant text.

Defined cases: a null text or role is empty; null turns sort first, equal turns by
role and text; rows with a null id form one conversation; repeated rows stay; an
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK = 1024
LOSS_ROLE = "assistant"
#: What follows the first sign of a control string.
_TAILS = r"(\||/?s>|/?INST\]|/?<?/?SYS>>)"
_CONTROL = rf"(<|\[)(\\*){_TAILS}"
_ESCAPED = rf"(<|\[)(\\*)\\{_TAILS}"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", loss_role: str = LOSS_ROLE, chunk: int = CHUNK) -> DataFrame:
    """conv_id, segments (array of text and loss) and formatted, a row per conversation."""
    src = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                       F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    parts = src.groupBy("conv_id", F.floor(F.col("turn") / chunk).alias("stretch")).agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    whole = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("stretch", "turns"))).alias("parts")).select(
        "conv_id", F.flatten(F.col("parts.turns")).alias("turns"))

    def segments(turn, i):
        before, after = F.get(F.col("turns"), i - 1)["role"], F.get(F.col("turns"), i + 1)["role"]
        head = F.when(before.eqNullSafe(turn["role"]), F.lit("<|next|>")).otherwise(
            F.concat(F.lit("<|turn|>"), escape(turn["role"]), F.lit("<|body|>")))
        tail = F.when(after.eqNullSafe(turn["role"]), F.lit("")).otherwise(F.lit("<|end|>\n"))
        return F.array(F.struct(head.alias("text"), F.lit(False).alias("loss")),
                       F.struct(escape(turn["text"]).alias("text"), (turn["role"] == loss_role).alias("loss")),
                       F.struct(tail.alias("text"), F.lit(False).alias("loss")))

    marked = whole.select("conv_id", F.flatten(F.transform("turns", segments)).alias("segments"))
    return marked.withColumn("formatted", F.array_join(F.col("segments.text"), ""))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (role and text) and loss_text, read from the output alone."""
    blocks = F.filter(F.split("formatted", r"<\|turn\|>", -1), lambda block, k: k > 0)

    def block_turns(block):
        role = F.substring_index(block, "<|body|>", 1)
        body = F.substring_index(F.substring_index(block, "<|body|>", -1), "<|end|>\n", 1)
        return F.transform(F.split(body, r"<\|next\|>", -1),
                           lambda t: F.struct(unescape(role).alias("role"), unescape(t).alias("text")))

    loss = F.filter("segments", lambda s: s["loss"])
    return formatted.select("conv_id", "formatted", F.flatten(F.transform(blocks, block_turns)).alias("turns"),
                            F.array_join(F.transform(loss, lambda s: unescape(s["text"])), "").alias("loss_text"))


def digests(formatted: DataFrame) -> DataFrame:
    """The digest columns of the read-back output."""
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_back(formatted).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
