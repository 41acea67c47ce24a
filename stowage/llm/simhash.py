"""SimHash near-duplicates through covering locality-sensitive hashing.

Fingerprints within ``radius`` bits are linked, and links make components.  Candidates come from
``2^(radius+1) - 1`` structured bit masks: bit i is given a non-zero vector m(i) of radius+1 bits, and
mask v keeps the bits with odd m(i).v.  The bits in which two fingerprints of the radius differ span
at most ``radius`` dimensions, so some v is orthogonal to all of them: under that mask both are equal.
Every such pair meets in some table, for certain and not just probably.

Work is on distinct fingerprints, so exact copies cost nothing.  A bucket of up to ``BUCKET`` of them
is compared in one task; a larger one is masked again on the bits its first mask left out, which
bounds a second-level bucket to 2^12 fingerprints at radius 2 whatever the data.  A bucket hands on a
spanning forest of its links, never its pairs.

Defined cases: null and empty texts have fingerprint 0 and are linked like any other; fewer words than
a shingle make one shingle of all words; repeated rows give repeated results; a component without any
doc_id has a null component_id; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, keep_table, pick

BITS = 64
BUCKET = 1024
SEED = 42


def covering_masks(bits: list[int], radius: int) -> list[int]:
    """One mask for each non-zero vector of radius + 1 bits."""
    vectors = range(1, 2 ** (radius + 1))
    given = {bit: 1 + i % len(vectors) for i, bit in enumerate(bits)}
    return [sum(1 << bit for bit in bits if (given[bit] & v).bit_count() % 2) for v in vectors]


def signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def fingerprint(text: str | None, words: int) -> int:
    """SimHash of lower-cased word shingles; signed."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    shingles = zip(*(found[i:] for i in range(words))) if len(found) >= words else [found]
    total, n, block = np.zeros(BITS, np.int64), 0, []

    def add() -> None:
        h = np.array(block, dtype="<u8").view(np.uint8).reshape(-1, 8)
        np.add(total, np.unpackbits(h, axis=1, bitorder="little").sum(0, dtype=np.int64), out=total)

    for shingle in shingles:
        block.append(xxhash.xxh64_intdigest(b" ".join(shingle), SEED))
        if len(block) == 8192:  # a very long text needs no more memory than a short one
            add()
            n += len(block)
            block.clear()
    if block:
        add()
        n += len(block)
    return int(np.packbits(total * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 3, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row (doc_id, text_hash, fingerprint) per document; the fingerprint is a signed long."""

    def run(batches):
        for batch in batches:
            found = pa.array([fingerprint(t, words) for t in batch.column(2).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), found], ["doc_id", "text_hash", "fingerprint"])

    rows = pick(docs, doc_id=id_col, text=text_col).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, f"doc_id {rows.schema[0].dataType.simpleString()}, text_hash bigint, fingerprint bigint")


def spanning_links(found: np.ndarray, radius: int):
    """A spanning forest of the pairs within ``radius`` bits, by search from node to node."""
    if len(found) == 2:
        if int(np.bitwise_count(found[0] ^ found[1])) <= radius:
            yield int(found[0]), int(found[1])
        return
    left = found
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            node = queue.pop()
            near = np.bitwise_count(left ^ node) <= radius
            for other in left[near]:
                yield int(node), int(other)
            queue.extend(left[near])
            left = left[~near]


def fingerprint_links(nodes: DataFrame, radius: int = 2) -> DataFrame:
    """Links (a, b) that connect what pairs within ``radius`` bits connect; ``nodes``: distinct fingerprints."""
    every = list(range(BITS))
    masks = covering_masks(every, radius)
    second = [[m | s for s in covering_masks([b for b in every if not m >> b & 1], radius)] for m in masks]

    entries = nodes.select(
        "fingerprint",
        F.posexplode(F.array(*(F.col("fingerprint").bitwiseAND(F.lit(signed(m))) for m in masks))).alias("t", "key"),
    )
    counted = entries.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = entries.join(counted, ["t", "key"])
    few = members.filter(F.col("n") <= BUCKET).select("t", "key", "fingerprint")
    again = F.array(*(F.array(*(F.lit(signed(m)) for m in own)) for own in second))
    many = (
        members.filter(F.col("n") > BUCKET)
        .select("t", "fingerprint", F.posexplode(F.element_at(again, F.col("t") + 1)).alias("t2", "mask"))
        .select(
            (F.lit(len(masks)) + F.col("t") * len(masks) + F.col("t2")).alias("t"),
            F.col("fingerprint").bitwiseAND(F.col("mask")).alias("key"),
            "fingerprint",
        )
    )
    buckets = few.union(many).groupBy("t", "key").agg(F.collect_list("fingerprint").alias("found"))

    def run(batches):
        for batch in batches:
            links = []
            for found in batch.column(0):
                links.extend(spanning_links(found.values.to_numpy(zero_copy_only=False), radius))
            a, b = zip(*links) if links else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return buckets.filter(F.size("found") > 1).select("found").mapInArrow(run, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, words: int = 3, radius: int = 2, text_col: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (least doc_id of its component),
    root (of the component; also where no document has an id) and text_hash.

    Runs jobs while the plan is built: the narrow (doc_id, fingerprint) table is written once, and
    ``components`` writes its rounds.
    """
    prints = keep_table(fingerprints(docs, words, text_col, id_col), "fingerprints")
    nodes = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"))
    roots = components(fingerprint_links(nodes.select("fingerprint"), radius))
    rooted = nodes.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root")
    )
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    groups = rooted.join(ids, "root").select("fingerprint", "component_id", "root")
    return prints.join(groups, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id", "root", "text_hash"
    )
