"""Preference pairs of conversations: the shared beginning once as prompt, both endings as masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A rendered turn is <|role|>, a line break, the text and this end.
END = "<|end|>\n"
TRAINED = "assistant"


def rendered(role: Column, text: Column) -> Column:
    """A turn as text; marks inside the text lose their form, so that a text cannot pose as a turn."""
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), F.replace(text, F.lit("<|"), F.lit("< |")), F.lit(END))


def numbered(conversations: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """(conv_id, position, role, text): turns in order, from 1; null roles are unknown, null texts empty.

    Turns that share a number follow role and text; null numbers come first; rows without a conversation drop out.
    """
    turns = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).alias("conv_id"), "turn", F.coalesce("role", F.lit("unknown")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    return turns.select("conv_id", F.row_number().over(order).alias("position"), "role", "text")


def stale_answer_pairs(conversations: DataFrame) -> DataFrame:
    """(pair_id, side, position, role, text): conversations up to their last answer against one that repeats the answer before.

    The pair has the conversation's id; conversations with fewer than two answers make no pair.
    """
    turns = numbered(conversations)
    before = Window.partitionBy("conv_id").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    answer = F.when(F.col("role") == TRAINED, F.col("position"))
    turns = turns.withColumn("last", F.max(answer).over(whole)).withColumn(
        "stale", F.last(F.when(F.col("role") == TRAINED, F.col("text")), ignorenulls=True).over(before)
    )
    turns = turns.withColumn("paired", F.max((F.col("position") == F.col("last")) & F.col("stale").isNotNull()).over(whole))
    turns = turns.where("paired and position <= last")
    sides = F.explode(F.array(F.lit("chosen"), F.lit("rejected"))).alias("side")
    both = turns.select(F.col("conv_id").alias("pair_id"), "position", "role", "text", "last", "stale", sides)
    text = F.when((F.col("side") == "rejected") & (F.col("position") == F.col("last")), F.col("stale")).otherwise(F.col("text"))
    return both.select("pair_id", "side", "position", "role", text.alias("text"))


def format_preferences(pairs: DataFrame) -> DataFrame:
    """One row per pair: pair_id, prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask.

    ``pairs`` has pair_id, side (chosen or rejected), position (from 1, without gaps), role and text. The longest common
    prefix of turns (equal role and text) is rendered once as the prompt; each side's other turns are its
    completion. A mask lists start:end (code points of the completion, end exclusive) of what is to be
    learned: the answers' texts with their end mark. Sides without a difference make no row; a side that is
    missing counts as empty. Null ids drop out; null roles are unknown, null texts empty. Other columns are not read.
    """
    turns = pairs.where("pair_id is not null").select(
        "pair_id", "side", "position", F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    turn = F.struct("role", "text")
    places = turns.groupBy("pair_id", "position").agg(
        ((F.count(F.lit(1)) == 2) & (F.min(turn) == F.max(turn))).alias("same")
    )
    first = places.where("not same").groupBy("pair_id").agg((F.min("position") - 1).alias("prompt_turns"))
    shown = rendered(F.col("role"), F.col("text"))
    parts = turns.join(first, "pair_id").withColumn("shown", shown)
    behind = F.col("position") > F.col("prompt_turns")
    reach = Window.partitionBy("pair_id", "side").orderBy("position")
    length = F.when(behind, F.length("shown")).otherwise(0)
    parts = parts.withColumn("end", F.sum(length).over(reach))
    head = F.length("role") + 5
    learned = F.when(
        behind & (F.col("role") == TRAINED), F.concat_ws(":", F.col("end") - F.length("shown") + head, F.col("end") - 1)
    )

    def joined(what: Column, between: str) -> Column:
        in_order = F.array_sort(F.collect_list(F.when(what.isNotNull(), F.struct("position", what.alias("part")))))
        return F.array_join(F.transform(in_order, lambda p: p["part"]), between)

    chosen, rejected = F.col("side") == "chosen", F.col("side") == "rejected"
    return parts.groupBy("pair_id").agg(
        F.first("prompt_turns").alias("prompt_turns"),
        joined(F.when(chosen & ~behind, F.col("shown")), "").alias("prompt"),
        joined(F.when(chosen & behind, F.col("shown")), "").alias("chosen"),
        joined(F.when(rejected & behind, F.col("shown")), "").alias("rejected"),
        joined(F.when(chosen, learned), ",").alias("chosen_mask"),
        joined(F.when(rejected, learned), ",").alias("rejected_mask"),
    )
