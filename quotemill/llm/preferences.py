"""Operator 3, preference formatting, in DataFrame operations only.

The longest common prefix of turns of a chosen and a rejected conversation is rendered once,
as prompt. What is left of each is a completion; its mask says which characters are trained on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Around a turn: its role, the text, the end of the turn.
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
TRAINED = "assistant"


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), F.coalesce(role, F.lit("")), F.lit(CLOSE), F.coalesce(text, F.lit("")), F.lit(END))


def _conversations(turns: DataFrame, name: str) -> DataFrame:
    """(pair_id, ``name``): the turns of each side, in order, with their places in the rendered conversation."""
    distinct = turns.select("pair_id", "turn", "role", "text").where("pair_id is not null").distinct()
    earlier = Window.partitionBy("pair_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    size = F.length(rendered(F.col("role"), F.col("text"))).cast("long")
    placed = distinct.withColumn("start", F.coalesce(F.sum(size).over(earlier), F.lit(0).cast("long")))
    return placed.groupBy("pair_id").agg(F.array_sort(F.collect_list(F.struct("start", "turn", "role", "text"))).alias(name))


def _completion(side: str, prefix: str) -> tuple[Column, Column]:
    """(text, spans) of the turns of ``side`` after the prefix."""
    rest = F.slice(F.col(side), F.col(prefix) + 1, F.size(side))
    text = F.array_join(F.transform(rest, lambda t: rendered(t["role"], t["text"])), "")
    # from the end of the role to the end of the turn
    spans = F.transform(
        F.filter(rest, lambda t: t["role"] == TRAINED),
        lambda t: F.struct(
            (t["start"] - F.get(F.col(side), F.col(prefix))["start"] + len(OPEN + TRAINED + CLOSE)).alias("start"),
            (F.length(F.coalesce(t["text"], F.lit(""))) + len(END)).cast("long").alias("length"),
        ),
    )
    return text, spans


def preference_pairs(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """Format pairs of conversations, given by their turns (pair_id, turn, role, text).

    Returns pair_id, prefix_turns int, prompt, chosen, rejected (texts), and chosen_spans,
    rejected_spans: array<struct<start, length>>, the characters of each completion to train on, which
    are the texts of the assistant's turns and their ends.

    Turns are equal if role and text are (null equals null) at the same place in the order of turn numbers.
    Rows with equal turn numbers are ordered by role and text; a repeated row is one turn. A null role or text is
    rendered as an empty one. Pairs of which only one side has turns, and rows without pair_id, are left out. If one
    side is the beginning of the other, its completion is empty. Extra columns are not read.

    A conversation is one value, so it has to fit into a row; pairs spread over tasks.
    """
    both = _conversations(chosen, "a").join(_conversations(rejected, "b"), "pair_id")
    shorter = F.least(F.size("a"), F.size("b"))
    differ = F.filter(
        F.sequence(F.lit(0), shorter - 1),
        lambda i: ~(
            F.get("a", i)["role"].eqNullSafe(F.get("b", i)["role"]) & F.get("a", i)["text"].eqNullSafe(F.get("b", i)["text"])
        ),
    )
    both = both.withColumn("prefix_turns", F.coalesce(F.get(differ, F.lit(0)), shorter))
    prompt = F.array_join(
        F.transform(F.slice("a", F.lit(1), F.col("prefix_turns")), lambda t: rendered(t["role"], t["text"])), ""
    )
    (chosen_text, chosen_spans), (rejected_text, rejected_spans) = (_completion(side, "prefix_turns") for side in "ab")
    return both.select(
        "pair_id",
        "prefix_turns",
        prompt.alias("prompt"),
        chosen_text.alias("chosen"),
        rejected_text.alias("rejected"),
        chosen_spans.alias("chosen_spans"),
        rejected_spans.alias("rejected_spans"),
    )
