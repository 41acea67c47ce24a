"""Prefix trie of conversations by van Emde Boas recursion.

A conversation is a sequence of turns; every distinct beginning is a node.  The recursion cuts depth in halves:

1. *Cut and name.*  A piece of at most 2^k turns with a named root is cut at 2^(k-1).  The cut prefix gets a name, the
   digest of the root's name and of the upper half, and becomes the root of the lower half.  Both halves go on alone
   and in parallel, down to single turns; equal names are one node.  The digest of a half is itself made from its
   halves, so a piece needs the digests of aligned blocks only.  Up to ``BLOCK`` turns of a conversation lie in one row
   and are cut inside the task; longer conversations are cut as sequences of blocks first, by the same function
   (``prefix_names`` calls itself on the blocks), and hand the blocks their root names by a join.
2. *Build.*  Nodes come from one grouping of names; members and counts are partial aggregates.
3. *Graft.*  Subtree totals go upward from the smallest pieces to the largest: in round k every root of a lower tree, that
   is a node at an odd multiple of 2^k, has its total in full, and hands it to its 2^k ancestors in the upper tree (found
   along one conversation that passes through it).  After log2(depth) rounds each node has received from each
   descendant exactly once.  A round handles half of the nodes' path steps at most, all pieces at once.

Rows are turns, prefixes and nodes; nothing is gathered by conversation or by node beyond ``BLOCK`` digests or
``ENDS`` ids.  A turn that a third of all conversations begin with, and a conversation with a third of all turns, only
make long groups for partial aggregates and equi joins.

Defined cases: turns are ordered by turn (null first), then role, then text, a null role or text being empty; equal turns
of a conversation are turns of their own; rows without conv_id belong to no conversation and are left out; an empty
table has no node, not even a root; further columns are ignored.  Names are 128-bit parts of SHA-256 digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keep_table, pick

# Turns of a conversation that lie in one row: some 16 KB of digests.
BLOCK = 1024
# Ids that are joined to one piece of text before they are digested.
ENDS = 512
EMPTY = b"\0" * 16


def digest(*parts: bytes) -> bytes:
    return hashlib.sha256(b"".join(parts)).digest()[:16]


def cut(root: bytes, turns: list[bytes], size: int) -> tuple[list[bytes], bytes | None]:
    """Names of the prefixes before each turn of a piece, and the piece's own digest if it is full.

    ``size`` is a power of two and not below the number of turns.
    """
    if size == 1:
        return [root], turns[0]
    half = size // 2
    upper, above = cut(root, turns[:half], half)
    if len(turns) <= half:
        return upper, None
    lower, below = cut(digest(root, above), turns[half:], half)
    return upper + lower, digest(above, below) if len(turns) == size else None


def whole(turns: list[bytes]) -> bytes:
    """Digest of a full block, from the digests of its halves."""
    while len(turns) > 1:
        turns = [digest(a, b) for a, b in zip(turns[::2], turns[1::2])]
    return turns[0]


def placed(rows: DataFrame, order: list[str], keep: list[str]) -> DataFrame:
    """conv_id, ``pos`` from 0 in ``order`` within each conversation, and the columns to ``keep``.  Runs jobs.

    Rows are range partitioned by conversation and order, numbered in place, stored, and moved up by the rows of the
    conversation in earlier partitions.  A random last key lets equal rows go to several partitions; any order will do
    for them.  The placement is stored as counts and rows must see the same one.
    """
    dealt = rows.withColumn("_any", F.rand(7)).repartitionByRange("conv_id", *order, "_any")
    numbered = dealt.sortWithinPartitions("conv_id", *order).select(
        "conv_id", *keep, F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_row")
    )
    stored = keep_table(numbered, "placed")
    sizes = stored.groupBy("conv_id", "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    # one row per conversation and partition that holds some of it
    before = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("conv_id", "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return stored.join(shift, ["conv_id", "_part"]).select("conv_id", (F.col("_row") + F.col("_shift")).alias("pos"), *keep)


def prefix_names(sequence: DataFrame, longest: int) -> DataFrame:
    """``sequence`` (conv_id, pos, turn: 16 bytes; turn null at the end) -> (conv_id, pos, name of the prefix before pos)."""
    items = F.array_sort(F.collect_list(F.struct("pos", "turn")))
    blocks = sequence.groupBy("conv_id", F.floor(F.col("pos") / BLOCK).alias("block")).agg(
        F.transform(items, lambda x: F.coalesce(x["turn"], F.lit(EMPTY))).alias("turns")
    )
    if longest < BLOCK:
        rooted = blocks.withColumn("root", F.lit(EMPTY))
    else:
        above = prefix_names(block_digests(blocks), longest // BLOCK).select("conv_id", F.col("pos").alias("block"), F.col("name").alias("root"))
        rooted = blocks.join(above, ["conv_id", "block"])

    def work(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                ids, places, names = [], [], []
                for row in batch.slice(i, 64).to_pylist():
                    size = 1 << max(0, len(row["turns"]) - 1).bit_length()
                    found, _ = cut(row["root"], row["turns"], size)
                    ids += [row["conv_id"]] * len(found)
                    places += range(row["block"] * BLOCK, row["block"] * BLOCK + len(found))
                    names += found
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(places, pa.int64()), pa.array(names, pa.binary())], ["conv_id", "pos", "name"])

    return rooted.select("conv_id", "block", "turns", "root").mapInArrow(work, "conv_id bigint, pos bigint, name binary")


def block_digests(blocks: DataFrame) -> DataFrame:
    """Each conversation as the sequence of its blocks; the last one, which no prefix holds in full, ends it."""

    def work(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            found = [whole(t) if len(t) == BLOCK else None for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], ["conv_id", "pos", "turn"])

    return blocks.select("conv_id", "block", "turns").mapInArrow(work, "conv_id bigint, pos bigint, turn binary")


def grafted(nodes: DataFrame, paths: DataFrame, deepest: int, totals: list[str]) -> DataFrame:
    """``nodes`` (name, conv_id, depth and ``totals`` of the node alone) with totals over subtrees.  Runs a job a round."""
    for k in range(max(0, deepest).bit_length()):
        # roots of lower trees, and the blocks of depths above them; a block keeps one conversation's long path in pieces
        unit = min(1 << k, BLOCK)
        odd = nodes.filter(F.col("depth") % (2 << k) == (1 << k))
        first, last = F.floor((F.col("depth") - (1 << k)) / unit), F.floor((F.col("depth") - 1) / unit)
        upper = odd.select("conv_id", *totals, F.explode(F.sequence(first, last)).alias("at"))
        above = paths.filter(F.col("depth") % (2 << k) < (1 << k)).select("conv_id", "name", F.floor(F.col("depth") / unit).alias("at"))
        given = above.join(upper, ["conv_id", "at"]).groupBy("name").agg(*(F.sum(t).alias(f"more_{t}") for t in totals))
        sums = {t: F.col(t) + F.coalesce(F.col(f"more_{t}"), F.lit(0)) for t in totals}
        nodes = keep_table(nodes.join(given, "name", "left").withColumns(sums).drop(*(f"more_{t}" for t in totals)), f"graft{k}")
    return nodes


def end_digests(ends: DataFrame) -> DataFrame:
    """``ends`` (name, conv_id) -> (name, ends_sha256): SHA-256 of the ascending ids joined by commas.

    Ids are joined to pieces of ``ENDS`` in range partitions, whatever node they belong to; a node's pieces are then
    read in order and fed to one digest, which never holds more than a piece.
    """
    pieces = ends.repartitionByRange("name", "conv_id").sortWithinPartitions("name", "conv_id")

    def join(batches: Iterator[pa.RecordBatch]):
        name, ids = None, []

        def out():
            return pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])], ["name", "first", "ids"])

        for batch in batches:
            for one, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if ids and (one != name or len(ids) == ENDS):
                    yield out()
                    ids = []
                name = one
                ids.append(conv)
        if ids:
            yield out()

    def total(batches: Iterator[pa.RecordBatch]):
        name, sha = None, None
        row = lambda: pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([sha.hexdigest()])], ["name", "ends_sha256"])
        for batch in batches:
            for one, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if one == name:
                    sha.update(b"," + ids.encode())
                    continue
                if sha:
                    yield row()
                name, sha = one, hashlib.sha256(ids.encode())
        if sha:
            yield row()

    joined = pieces.mapInArrow(join, "name binary, first bigint, ids string")
    ordered = joined.repartition("name").sortWithinPartitions("name", "first")
    return ordered.mapInArrow(total, "name binary, ends_sha256 string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per node of ``turns`` (``ordered_turns``; pos from 0 without gaps, or -1 for a conversation without turns).

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.  Runs jobs.
    """
    turns = keep_table(turns.select("conv_id", "pos", "turn", "bytes"), "turns")
    lengths = turns.groupBy("conv_id").agg((F.max("pos") + 1).alias("depth"))
    longest = lengths.agg(F.max("depth")).first()[0] or 0
    real = turns.filter("pos >= 0")
    ended = real.select("conv_id", "pos", "turn").union(lengths.select("conv_id", "depth", F.lit(None).cast("binary")))
    named = prefix_names(ended, longest).withColumnRenamed("pos", "depth")
    # the prefix of depth d ends with turn d - 1
    last = real.select("conv_id", (F.col("pos") + 1).alias("depth"), "bytes")
    paths = named.join(last, ["conv_id", "depth"], "left").select("conv_id", "depth", "name", F.coalesce("bytes", F.lit(0)).alias("bytes"))
    paths = keep_table(paths, "paths")
    nodes = paths.groupBy("name").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.first("depth").alias("depth"), F.first("bytes").alias("bytes")
    )
    nodes = keep_table(nodes, "nodes")
    up = nodes.filter("depth > 0").select("name", "conv_id", (F.col("depth") - 1).alias("depth"))
    parents = keep_table(paths.select("conv_id", "depth", F.col("name").alias("parent")).join(up, ["conv_id", "depth"]).select("name", "parent"), "parents")
    children = parents.groupBy("parent").agg(F.count(F.lit(1)).alias("n_children")).withColumnRenamed("parent", "name")
    start = nodes.join(children, "name", "left").select(
        "name", "conv_id", "depth", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.col("n_children").isNull().cast("bigint").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"),
    )
    totals = grafted(keep_table(start, "start"), paths.select("conv_id", "depth", "name"), longest, ["n_leaves", "saved_tokens"])
    ends = end_digests(paths.join(lengths, ["conv_id", "depth"]).select("name", "conv_id"))
    owners = nodes.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    above = parents.join(owners, "parent").select("name", "parent_conv_id")
    return (
        totals.join(above, "name", "left")
        .join(ends, "name", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos, turn (digest of role and text) and bytes (of the text), in order.  Runs jobs."""
    rows = pick(conversations, conv_id="conv_id", at="turn", role="role", text="text").filter("conv_id IS NOT NULL")
    filled = rows.select(F.col("conv_id").cast("bigint").alias("conv_id"), "at", *(F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")))
    said = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    told = filled.select("*", F.unhex(F.substring(said, 1, 32)).alias("turn"), F.octet_length("text").cast("bigint").alias("bytes"))
    return placed(told, ["at", "role", "text"], ["turn", "bytes"])


def with_shared_beginnings(turns: DataFrame) -> DataFrame:
    """Conversation c begins with the first h turns of c - c % 5 in place of its own; h = crc32(decimal c) % 9.

    One with no turn left has a row with pos -1.
    """
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    c = F.col("conv_id")
    rule = sizes.select("conv_id", "n", (F.crc32(c.cast("string")) % 9).alias("h"), (c - c % 5).alias("base"))
    base_size = sizes.select(c.alias("base"), F.col("n").alias("base_n"))
    rule = rule.join(base_size, "base", "left").withColumn("given", F.least("h", F.coalesce("base_n", F.lit(0))))
    # at most 8 turns of a base go to the few conversations that begin with them
    first = turns.filter("pos < 8").select(c.alias("base"), "pos", "turn", "bytes")
    begin = rule.join(first, "base").filter("pos < h").select("conv_id", "pos", "turn", "bytes")
    own = turns.join(rule.select("conv_id", "h", "given"), "conv_id").filter("pos >= h")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("given")).alias("pos"), "turn", "bytes")
    none = rule.filter("given = 0 AND n <= h").selectExpr("conv_id", "-1L AS pos", "CAST(NULL AS binary) AS turn", "0L AS bytes")
    return begin.union(own).union(none)
