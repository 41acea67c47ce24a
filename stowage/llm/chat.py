"""Chat formatting after collapsing cumulative snapshots.

A logged conversation that is the beginning of a longer one is a snapshot of it and is dropped; of equal
conversations the one with the least conv_id stays.  What stays is rendered as one text.

Every turn has a hash of its place, role and text, and the rolling hash of a conversation up to a turn is
the exclusive or of its turns' hashes, 128 bits in two halves.  Because it can be put together from
parts, a conversation is worked on in blocks of ``BLOCK`` places: turns are numbered in range partitions
(``number_rows``), rolling hashes are made within a block, and the blocks' hashes summed up.  A conversation
with a third of all turns spreads over its blocks, also where turn numbers repeat or are null.  Anti-joins on hashes of distinct prefixes keep the maximal conversations.

Rendered text comes in parts of one block each, so no cell grows with a conversation; most have one part.

Defined cases: turns are ordered by turn, then role, nulls first (equal roles by the hash of the text); a null role is ``unknown``, a
null text empty when rendered, but both differ from these when compared; rows without conv_id are one
conversation; repeated rows are turns of their own; ``<|`` inside a text is written ``< |`` so that it
cannot be taken for a marker; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import number_rows
from .common import keep_table, pick

BLOCK = 1024
START, END = "<|im_start|>", "<|im_end|>"


def turns_of(conversations: DataFrame) -> DataFrame:
    rows = pick(conversations, conv_id="conv_id", turn="turn", role="role", text="text")
    a, b = halves(F.col("role"), F.col("text"))
    return rows.withColumns({"conv": F.coalesce(F.col("conv_id").cast("string"), F.lit("")), "ta": a, "tb": b})


def placed_turns(turns: DataFrame) -> DataFrame:
    """Turns with their place (from 1), n_turns and block of at most ``BLOCK`` places.  Runs a job.

    Turns that are equal in all of the order have one role and one text, so any order of them will do; the
    row's own number only lets them go to several partitions.  The turns are stored first, as a number taken after a
    join would be another one when a lost task is run again.
    """
    own = keep_table(turns, "turns").withColumns({
        "has_turn": F.col("turn").isNotNull(), "turn": F.coalesce("turn", F.lit(0)),
        "has_role": F.col("role").isNotNull(), "role_": F.coalesce("role", F.lit("")), "row": F.monotonically_increasing_id(),
    })
    order = ["has_turn", "turn", "has_role", "role_", "ta", "tb", "row"]
    placed = number_rows(own, ["conv"], order, "place", "n_turns")
    place, n_turns = F.col("place").cast("bigint"), F.col("n_turns").cast("bigint")
    return placed.withColumns({"place": place, "n_turns": n_turns, "block": F.floor((place - 1) / BLOCK).cast("bigint")})


def halves(*what) -> list:
    """Two 64-bit hashes; flags tell a null from what it would hash like."""
    flagged = [x for c in what for x in (c.isNull(), c)]
    return [F.xxhash64(F.lit(salt), *flagged) for salt in (1, 2)]


def rolling_hashes(turns: DataFrame) -> DataFrame:
    """conv_id, conv, place, n_turns and the two halves of the rolling hash at each turn."""
    slim = placed_turns(turns.select("conv_id", "conv", "turn", "role", "ta", "tb"))
    pa, pb = F.xxhash64(F.lit(3), "place", "ta", "tb"), F.xxhash64(F.lit(4), "place", "tb", "ta")
    placed = keep_table(slim.select("conv_id", "conv", "block", "place", "n_turns", pa.alias("a"), pb.alias("b")), "placed")
    blocks_before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    xor = lambda c, w: F.bit_xor(c).over(w)
    within = Window.partitionBy("conv", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    totals = placed.groupBy("conv", "block").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    earlier = totals.select(
        "conv", "block", *(F.coalesce(xor(c, blocks_before), F.lit(0)).alias(f"{c}_before") for c in ("a", "b"))
    )
    rolled = placed.select("conv_id", "conv", "block", "place", "n_turns", *(xor(c, within).alias(c) for c in ("a", "b")))
    return rolled.join(earlier, ["conv", "block"]).select(
        "conv_id", "conv", "place", "n_turns", *(F.col(c).bitwiseXOR(F.col(f"{c}_before")).alias(c) for c in ("a", "b"))
    )


def maximal_conversations(conversations: DataFrame) -> DataFrame:
    """conv, n_turns, copies: conversations that begin no longer one, one of each group of equals."""
    hashes = keep_table(rolling_hashes(turns_of(conversations)), "rolling")
    whole = hashes.filter("place = n_turns")
    prefixes = hashes.filter("place < n_turns").select(F.col("place").alias("n_turns"), "a", "b").distinct()
    one = whole.groupBy("n_turns", "a", "b").agg(
        F.min_by("conv", F.struct(F.col("conv_id"), F.col("conv"))).alias("conv"), F.count(F.lit(1)).alias("copies")
    )
    return one.join(prefixes, ["n_turns", "a", "b"], "left_anti").select("conv", "n_turns", "copies")


def chat_texts(conversations: DataFrame) -> DataFrame:
    """conv_id, part, n_turns (of the conversation), copies, text.  Runs jobs: hashes are stored once."""
    chosen = keep_table(maximal_conversations(conversations), "chosen").select("conv", "copies")
    clean = F.replace(F.coalesce("text", F.lit("")), F.lit("<|"), F.lit("< |"))
    line = F.concat(F.lit(START), F.coalesce("role", F.lit("unknown")), F.lit("\n"), clean, F.lit(END + "\n"))
    turns = turns_of(conversations).select("conv_id", "conv", "turn", "role", "ta", "tb", line.alias("line"))
    rendered = placed_turns(turns.join(chosen, "conv"))
    ordered = F.array_sort(F.collect_list(F.struct("place", "line")))
    texts = rendered.groupBy("conv", "block").agg(
        F.min("conv_id").alias("conv_id"), F.min("n_turns").alias("n_turns"), F.min("copies").alias("copies"),
        F.array_join(F.transform(ordered, lambda x: x["line"]), "").alias("text"),
    )
    return texts.select("conv_id", F.col("block").cast("int").alias("part"), "n_turns", "copies", "text")
