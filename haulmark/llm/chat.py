"""Chat formatting after collapsing cumulative snapshots.

A logged conversation that is a prefix of a longer one, or equal to another, is a snapshot of it and goes; the
rest is rendered. Turns are numbered within their conversation by (turn, role, text), and the rolling hash of a
prefix is the XOR of two 64-bit hashes of (number, role, text): the number is part of what is hashed, so the
value depends on the order, and it extends from turn to turn by one XOR. Distinct prefixes are grouped before
the anti join, so a first turn that very many conversations share is one row on the right side.

Defined cases: rows without conv_id belong to no conversation and are left out; a null turn comes first, null
roles and texts are kept apart from empty ones in the hash and rendered as empty. Turns that repeat a number stay, in
the order above. Of equal conversations the one with the smallest conv_id stays. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulmark.llm.common import stage

TURN = "<|{role}|>\n{text}\n"
END = "<|end|>"


def prefixes(conversations: DataFrame) -> DataFrame:
    """conv_id, place, role, text and the prefix hash (h1, h2) up to and with each turn."""
    by_turn = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = by_turn.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A null is hashed with a mark of its own, since a hash skips nulls.
    parts = [F.col("place"), F.col("role").isNull(), F.coalesce("role", F.lit("")), F.col("text").isNull(),
             F.coalesce("text", F.lit(""))]
    return (conversations.select("conv_id", "turn", "role", "text").filter("conv_id IS NOT NULL")
            .withColumn("place", F.row_number().over(by_turn))
            .withColumn("h1", F.bit_xor(F.xxhash64(*parts)).over(so_far))
            .withColumn("h2", F.bit_xor(F.xxhash64(F.lit("second"), *parts)).over(so_far))
            .drop("turn"))


def maximal(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns and n_copies of the conversations that no other one continues or repeats."""
    last = turns.groupBy("conv_id").agg(F.max(F.struct("place", "h1", "h2")).alias("last"))
    whole = (last.select("conv_id", F.col("last.place").alias("n_turns"), "last.h1", "last.h2")
             .groupBy("n_turns", "h1", "h2").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies")))
    inner = (turns.join(last.select("conv_id", F.col("last.place").alias("size")), "conv_id")
             .filter("place < size").select(F.col("place").alias("n_turns"), "h1", "h2").distinct())
    return whole.join(inner, ["n_turns", "h1", "h2"], "left_anti").select("conv_id", "n_turns", "n_copies")


def render(turns: DataFrame, kept: DataFrame) -> DataFrame:
    """One row per kept conversation with its text in the chat template."""
    head, tail = TURN.split("{role}")[0], TURN.split("{role}")[1].split("{text}")
    one = F.concat(F.lit(head), F.coalesce("role", F.lit("")), F.lit(tail[0]), F.coalesce("text", F.lit("")), F.lit(tail[1]))
    spoken = (turns.join(kept.select("conv_id"), "conv_id", "left_semi")
              .groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("place", one.alias("said")))).alias("said")))
    return (kept.join(spoken, "conv_id")
            .select("conv_id", "n_turns", "n_copies", F.concat(F.array_join("said.said", ""), F.lit(END)).alias("rendered")))


def collapse_and_render(conversations: DataFrame) -> DataFrame:
    turns = stage(prefixes(conversations), "turns")
    return render(turns, stage(maximal(turns), "maximal"))
