"""Chat formatting: logged snapshots of one conversation collapse to the longest, then render.

A log holds a conversation again after every turn. Rolling hashes over the turns tell which
conversations are a beginning of a longer one; what is left is rendered as one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourloom.llm.common import stored

#: One turn of the rendered text.
OPEN, CLOSE = "<|{role}|>\n", "\n<|end|>\n"


def turn_hashes(turns: DataFrame) -> DataFrame:
    """Rows ``conv_id, step, h1, h2``: the hashes of each conversation's first ``step`` turns.

    A turn's hash is salted with its step, and the rolling hash is the exclusive-or of all so
    far, which is a running aggregate that needs no array. Two of 64 bits are kept. Texts are
    hashed before the exchange, so only numbers travel.
    """
    hashed = turns.select(
        "conv_id", "turn", F.xxhash64(F.lit(1), "role", "text").alias("t1"), F.xxhash64(F.lit(2), "role", "text").alias("t2")
    ).distinct()
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "t1", "t2")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = hashed.withColumn("step", F.row_number().over(order))
    return steps.select(
        "conv_id",
        "step",
        F.bit_xor(F.xxhash64("step", "t1")).over(so_far).alias("h1"),
        F.bit_xor(F.xxhash64("step", "t2")).over(so_far).alias("h2"),
    )


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """Rows ``conv_id, n_turns, n_snapshots`` of the conversations that no longer one begins with.

    ``n_snapshots`` counts the conversations of exactly these turns; the smallest id stands
    for them.
    """
    hashes = stored(turn_hashes(turns), "turn-hashes")
    whole = hashes.groupBy("conv_id").agg(F.max_by(F.struct("step", "h1", "h2"), "step").alias("end")).select("conv_id", "end.*")
    one_each = whole.groupBy("step", "h1", "h2").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_snapshots"))
    ends = whole.select("conv_id", F.col("step").alias("last"))
    begun = hashes.join(ends, "conv_id").where(F.col("step") < F.col("last")).select("step", "h1", "h2").distinct()
    left = one_each.join(begun, ["step", "h1", "h2"], "left_anti")
    return left.select("conv_id", F.col("step").cast("long").alias("n_turns"), "n_snapshots")


def render(turns: Column) -> Column:
    """One text of an array of turns with ``role`` and ``text``."""
    head, tail = OPEN.split("{role}")
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(head), t["role"], F.lit(tail), t["text"], F.lit(CLOSE))), "")


def format_chats(conversations: DataFrame) -> DataFrame:
    """Rows ``conv_id, n_turns, n_snapshots, rendered`` of the maximal conversations.

    A conversation is its turns in order of ``turn`` (null first), then role and text hash
    order among equal ``turn``. It goes if its turns are the beginning of a longer one; of
    conversations with the same turns the smallest id stays.

    A null role or text is an empty one. Rows that repeat in all four columns are one turn
    logged twice. Rows without ``conv_id`` belong to no conversation and are left out. Other
    columns are ignored; an empty table gives an empty one. Turn and end marks are those of
    ``OPEN`` and ``CLOSE``; a text is rendered as it is.
    """
    turns = conversations.where("conv_id IS NOT NULL").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    kept = maximal_conversations(turns)
    told = turns.join(kept.select("conv_id"), "conv_id", "left_semi").distinct()
    t1, t2 = F.xxhash64(F.lit(1), "role", "text"), F.xxhash64(F.lit(2), "role", "text")
    # sort_array puts a null turn first, as the hashes do.
    texts = told.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", t1.alias("t1"), t2.alias("t2"), "role", "text"))).alias("turns")
    )
    return kept.join(texts, "conv_id").select("conv_id", "n_turns", "n_snapshots", render(F.col("turns")).alias("rendered"))
