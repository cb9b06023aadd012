"""Preference formatting, in DataFrame functions only.

Chosen and rejected conversations come as tables of turns (pair_id, turn,
role, text). The longest common turn prefix ends before the first turn that
differs or that one side lacks; it is found by joining turn with turn and a
minimum per pair, never by gathering a conversation. The common turns are
rendered once as the prompt, the others as two completions. Every turn reads
``<|role|>\\ntext<|end|>\\n``; in completions the text and end mark of
assistant turns are learned (mask spans, in characters from the start of the
row's text), prompts and other turns are not.

Output rows are bounded: a segment (prompt, chosen, rejected) comes in parts
of the turns numbered ``part * PART`` to ``part * PART + PART - 1``, so a
conversation of any length is spread over tasks; nearly all have one part.

Defined results: null roles and texts are empty ones; turns without a pair_id
or a turn number are no part of any conversation; turns that share a number
are ordered by role and text; a pair with an empty prompt has no prompt row, a
side that ends with the prompt has no completion row. A conversation that
only one side has is all completion. Other columns are ignored. Empty tables
give an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART = 64


def _turns(turns: DataFrame, side: str) -> DataFrame:
    rows = turns.filter(F.col("pair_id").isNotNull() & F.col("turn").isNotNull()).select(
        "pair_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    nth = F.row_number().over(Window.partitionBy("pair_id", "turn").orderBy("role", "text"))
    return rows.withColumn("nth", nth).withColumn("side", F.lit(side))


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("<|end|>\n"))


def preference_rows(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rows of a pair: pair_id, segment, part, n_turns, n_prompt (common turns of the pair), text, mask (start-end,
    comma-joined)."""
    # both sides of a turn meet in one group, so the texts are shuffled once
    both = _turns(chosen, "chosen").unionByName(_turns(rejected, "rejected"))
    met = both.groupBy("pair_id", "turn", "nth").agg(F.collect_list(F.struct("side", "role", "text")).alias("sides"))
    one, two = F.get("sides", F.lit(0)), F.get("sides", F.lit(1))
    same = (F.size("sides") == 2) & (one["role"] == two["role"]) & (one["text"] == two["text"])
    met = met.withColumn("same", same)
    here = F.struct("turn", "nth")
    ends = met.groupBy("pair_id").agg(F.min(F.when(~F.col("same"), here)).alias("end"))
    met = met.join(ends, "pair_id").withColumn("common", F.col("end").isNull() | (here < F.col("end")))
    sides = F.explode(F.when(F.col("common"), F.slice("sides", 1, 1)).otherwise(F.col("sides")))
    rows = met.select("pair_id", "turn", "nth", "common", sides.alias("own"))
    segment = F.when(F.col("common"), F.lit("prompt")).otherwise(F.col("own.side"))
    rows = rows.select("pair_id", segment.alias("segment"), F.floor(F.col("turn") / PART).alias("part"), "turn", "nth",
                       F.col("own.role").alias("role"), rendered(F.col("own.role"), F.col("own.text")).alias("text"))
    parts = rows.groupBy("pair_id", "segment", "part").agg(
        F.array_sort(F.collect_list(F.struct("turn", "nth", "role", "text"))).alias("turns"))
    lengths = F.transform("turns", lambda t: F.char_length(t["text"]))
    parts = parts.withColumn("lengths", lengths)
    # running ends of the turns, then the learned span of each assistant turn
    ends_of = F.aggregate("lengths", F.array().cast("array<int>"),
                          lambda acc, n: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + n)))
    parts = parts.withColumn("ends", F.when(F.size("lengths") > 0, ends_of))
    span = F.transform("turns", lambda t, i: F.when(
        (t["role"] == "assistant") & (F.col("segment") != "prompt"),
        F.concat((F.get("ends", i) - F.get("lengths", i) + F.char_length(t["role"]) + 5).cast("string"), F.lit("-"),
                 (F.get("ends", i) - 1).cast("string"))))
    counted = met.filter("common").groupBy("pair_id").agg(F.count("*").alias("n_prompt"))
    return (parts.join(counted, "pair_id", "left").select(
        "pair_id", "segment", F.col("part").cast("long").alias("part"), F.size("turns").cast("long").alias("n_turns"),
        F.coalesce("n_prompt", F.lit(0)).alias("n_prompt"),
        F.array_join(F.transform("turns", lambda t: t["text"]), "").alias("text"),
        F.array_join(F.filter(span, lambda s: s.isNotNull()), ",").alias("mask")))


def swapped_reply_pairs(conversations: DataFrame, per_range: int = 1000) -> tuple[DataFrame, DataFrame]:
    """Weak preferences from plain conversations: each conversation is chosen; rejected is the same one with its
    last assistant turn replaced by the last assistant turn of the next conversation (conv_id order inside ranges of
    ``per_range`` ids, the last one takes the first's) and what follows it cut off. Conversations without an
    assistant turn make no pair."""
    turns = conversations.filter(F.col("conv_id").isNotNull() & F.col("turn").isNotNull()).select(
        F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    last = (turns.filter(F.col("role") == "assistant").groupBy("pair_id")
            .agg(F.max(F.struct("turn", "text")).alias("last")))
    group = F.floor(F.col("pair_id") / per_range)
    along = Window.partitionBy(group).orderBy("pair_id")
    first = F.first("last.text").over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    swap = last.select("pair_id", F.col("last.turn").alias("at"), F.coalesce(F.lead("last.text").over(along), first).alias("reply"))
    kept = turns.join(swap, "pair_id")
    chosen = kept.select("pair_id", "turn", "role", "text")
    rejected = (kept.filter(F.col("turn") < F.col("at")).select("pair_id", "turn", "role", "text")
                .union(swap.select("pair_id", "at", F.lit("assistant"), "reply")))
    return chosen, rejected
