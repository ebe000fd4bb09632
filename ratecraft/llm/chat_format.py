"""Prefix-target expansion of conversations (operator 5), DataFrame functions only.

Every assistant turn becomes an example of its own: ``text`` holds the formatted turns before it,
then the reply; only the reply's characters [loss_start, loss_end) are trainable. Turns after the
last assistant turn would belong to no example, so a conversation that ends otherwise gets one
closing example with an empty loss span; nothing of a conversation is lost.

A turn is ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts a backslash is put
into every ``<|`` (after "<", before any backslashes that stand there), so no control string can
occur in them; in roles "%" and line breaks are percent-encoded as well. ``unescape_*`` undo it.

Defined cases: null texts and roles are empty; turns of one conversation are ordered by (turn,
role, text), nulls first, and repeated rows are turns of their own; a null conversation id is a
conversation. An empty table gives no rows. Other columns are not read.

A conversation is one value here (its digest and its examples need its turns in order), so its
turns meet in one row: a conversation must fit in a task, the examples of one need not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def escape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return escape_text(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape_text(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def expand_prefix_targets(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
                          role: str = "role", text: str = "text", trained_role: str = "assistant") -> DataFrame:
    """conv_id, example (0, 1, ... within the conversation), is_target, n_turns (of the example),
    text, loss_start, loss_end (code points from 0)."""
    plain = F.coalesce(F.col(role), F.lit(""))
    said = escape_text(F.coalesce(F.col(text), F.lit("")))
    head = F.concat(F.lit(START), escape_role(plain), F.lit("\n"))
    turns = conversations.select(
        F.col(conv_id).alias("conv_id"),
        F.struct(F.col(turn).alias("turn"), plain.alias("role"), said.alias("said"), head.alias("head")).alias("t"))
    convs = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    convs = convs.withColumn("pieces", F.transform("turns", lambda t: F.concat(t["head"], t["said"], F.lit(f"{END}\n"))))
    last = F.size("turns") - 1
    # the position of every turn that closes an example
    ends = F.filter(F.sequence(F.lit(0), last), lambda i: (
        F.get("turns", i)["role"] == trained_role) | (i == last))
    examples = convs.select("conv_id", "turns", "pieces", F.posexplode(ends).alias("example", "i"))
    this = F.get("turns", F.col("i"))
    examples = examples.select(
        "conv_id", "example", (F.col("i") + 1).alias("n_turns"),
        (this["role"] == trained_role).alias("is_target"),
        F.array_join(F.slice("pieces", F.lit(1), F.col("i")), "").alias("context"),
        F.get("pieces", F.col("i")).alias("piece"), F.length(this["head"]).alias("head"),
        F.length(this["said"]).alias("said"))
    start = F.length("context") + F.when(F.col("is_target"), F.col("head")).otherwise(F.length("piece"))
    return examples.select(
        "conv_id", "example", "is_target", "n_turns", F.concat("context", "piece").alias("text"),
        start.alias("loss_start"), (start + F.when(F.col("is_target"), F.col("said")).otherwise(0)).alias("loss_end"))


def read_turns(text: Column) -> Column:
    """The turns (role, text) of an example's text, unescaped."""
    parts = F.filter(F.split(text, r"<\|im_start\|>", -1), lambda _, i: i > 0)
    return F.transform(parts, lambda p: F.struct(
        unescape_role(F.substring_index(p, "\n", 1)).alias("role"),
        unescape_text(F.substring(p, F.instr(p, F.lit("\n")) + 1,
                                  F.length(p) - F.instr(p, F.lit("\n")) - len(END) - 1)).alias("text")))


def trained_text(text: Column, loss_start: Column, loss_end: Column) -> Column:
    """What an example trains, unescaped."""
    return unescape_text(F.substring(text, loss_start + 1, loss_end - loss_start))
