"""Preference formatting: pairs of conversations as one prompt and two completions.

The turns that both conversations of a pair begin with are rendered once as the
prompt; what follows in each is its completion.  A completion carries the
spans of its assistant texts; everything else in it, and all of the prompt, is
masked in training.

Only DataFrame functions: a conversation is one sorted array of turns, the
common prefix ends at the first false of an element-wise comparison.

Defined results: turns go by number, then role and text; rows that repeat a
turn count once; a null role or text counts as empty; a null conversation id
takes no part; a conversation without its partner gives a row without the other
side and without prompt; if one conversation begins with all of the other, the
shorter completion is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"


def conversations(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """conv_id, turns: array of (role, text) in order."""
    rows = turns.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"), F.struct(
            "turn", F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_set("t")).alias("t")).select(
        "conv_id", F.transform("t", lambda x: F.struct(
            x["role"].alias("role"), x["text"].alias("text"))).alias("turns"))


def _turn(x: Column) -> Column:
    return F.concat(F.lit("<|"), x["role"], F.lit("|>\n"), x["text"], F.lit("\n"))


def render(turns: Column) -> Column:
    """``<|role|>`` line, text, line feed, for every turn."""
    return F.array_join(F.transform(turns, _turn), "")


def spans(turns: Column) -> Column:
    """(start, end) of every assistant text in the rendered turns, in code points."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast(
        "array<struct<start: int, end: int>>").alias("found"))

    def step(s: Column, x: Column) -> Column:
        text = s["at"] + F.length(x["role"]) + F.lit(len("<||>\n"))
        end = text + F.length(x["text"])
        here = F.array(F.struct(text.cast("int").alias("start"), end.cast("int").alias("end")))
        return F.struct((end + 1).cast("int").alias("at"), F.when(
            x["role"] == ASSISTANT, F.concat(s["found"], here)).otherwise(s["found"]).alias("found"))

    return F.aggregate(turns, start, step, lambda s: s["found"])


def preference_pairs(chosen: DataFrame, rejected: DataFrame, on: str) -> DataFrame:
    """One row per value of ``on``: both sides have ``on``, ``conv_id``, ``turns``."""
    a = chosen.select(on, F.col("conv_id").alias("chosen_id"), F.col("turns").alias("c"))
    b = rejected.select(on, F.col("conv_id").alias("rejected_id"), F.col("turns").alias("r"))
    both = a.join(b, on, "full_outer")
    same = F.zip_with("c", "r", lambda x, y: F.coalesce(
        (x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False)))
    stop = F.array_position(same, False)
    n = F.coalesce(F.when(stop > 0, stop - 1).otherwise(F.size(same)), F.lit(0)).cast("int")
    both = both.withColumn("n_common", n)

    def rest(side: str) -> Column:
        return F.slice(side, F.col("n_common") + 1, F.size(side))

    return both.select(
        on, "chosen_id", "rejected_id", "n_common",
        F.coalesce(render(F.slice("c", 1, F.col("n_common"))), F.lit("")).alias("prompt"),
        render(rest("c")).alias("chosen"), render(rest("r")).alias("rejected"),
        spans(rest("c")).alias("chosen_spans"), spans(rest("r")).alias("rejected_spans"))


def listed(found: str) -> Column:
    """Spans as ``start:end`` joined by commas."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(
        ":", x["start"].cast("string"), x["end"].cast("string"))), ",")
