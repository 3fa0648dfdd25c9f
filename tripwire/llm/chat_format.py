"""Chat formatting with collapse of cumulative snapshots.

A logged conversation is often stored again after every turn, so that shorter
logs are prefixes of longer ones. Each turn gets a hash of its place, role and
text, and the running exclusive-or of these is a hash of the prefix up to the
turn (two of them, 128 bits together). A conversation whose whole hash is the
hash of a proper prefix of another is left out by an anti-join; of equal
conversations the one with the least conv_id stays. Those left are rendered.

Prefixes are made distinct before the join (with partial counts on the map
side), so a first turn or a conversation that many logs share is one row there.

Defined results: turns are ordered by turn number, then role, then text (nulls
first). A null role counts as ``user`` and a null text as empty. Rows with a
null conv_id are one conversation. Equal rows are separate turns. Other
columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Marks around a turn.
BEGIN, END = "<|im_start|>", "<|im_end|>"


def maximal_conversations(conversations: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, turns)`` of the conversations that are no prefix of a longer one and equal none of a
    smaller id; ``turns`` is an array of ``(place, role, text)``."""
    turns = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = turns.withColumn("place", F.row_number().over(in_order))
    so_far = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hashed = placed.select(
        "conv_id", "place", "role", "text",
        F.xxhash64("place", "role", "text").alias("x"),
        F.xxhash64(F.lit("second"), "text", "place", "role").alias("y"),
    )
    running = hashed.select(
        "conv_id", "place", F.bit_xor("x").over(so_far).alias("hx"), F.bit_xor("y").over(so_far).alias("hy"),
        F.lead("place").over(Window.partitionBy("conv_id").orderBy("place")).isNull().alias("whole"),
    )
    proper = running.where("not whole").select("place", "hx", "hy").distinct()
    whole = running.where("whole").groupBy("place", "hx", "hy").agg(F.min("conv_id").alias("conv_id"))
    kept = whole.join(proper, ["place", "hx", "hy"], "left_anti").select(F.col("conv_id").alias("kept_id"))
    rows = hashed.join(kept, F.col("conv_id").eqNullSafe(F.col("kept_id")), "left_semi")
    return rows.groupBy("conv_id").agg(
        F.count("*").alias("n_turns"), F.array_sort(F.collect_list(F.struct("place", "role", "text"))).alias("turns")
    )


def render(conversations: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, text)`` of ``maximal_conversations`` rows: every turn between marks, with its role."""
    mark = lambda t: F.concat(F.lit(BEGIN), t["role"], F.lit("\n"), t["text"], F.lit(END + "\n"))
    return conversations.select("conv_id", "n_turns", F.array_join(F.transform("turns", mark), "").alias("text"))


def format_chats(conversations: DataFrame) -> DataFrame:
    """Maximal conversations, rendered."""
    return render(maximal_conversations(conversations))
