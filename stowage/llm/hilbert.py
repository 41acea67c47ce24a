"""Shards along a Hilbert curve over metadata.  DataFrame functions only.

Every dimension is quantised to ``bits`` bits at quantiles of its own values (exact ones over all rows, texts compared
whole), the codes are one index on the Hilbert curve through the cells, and rows in curve order are cut into runs: shards, whose rows are near each other in *all*
dimensions, so that file statistics prune on each of them.

Order by counting instead of one big sort: a cell starts after the cells before it (at most
2^(bits x dimensions) of them, the only rows one task sees alone), and rows within a cell are numbered in
parts (``rank_within``).  So a cell with a third of all rows spreads over many tasks.  Texts
are not shuffled.

Law ``rows``: shard sizes in rows differ by one at most.

Defined cases: a null value has the lowest code; rows with equal values lie in one cell, in a fixed
order; repeated rows take neighbouring places; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import sketch_bounds, with_bucket
from .common import keep_table, pick, rank_within

BITS = 4


def curve_steps(dims: int) -> tuple[list[int], list[int]]:
    """The curve as a table: for state and corner, the place among the corners and the next state.

    A state is an entry corner and a direction; both follow from Gray codes by rule.
    """
    size = 1 << dims
    rotate = lambda x, n: ((x << n % dims) | (x >> (dims - n % dims))) & (size - 1)
    gray = lambda i: i ^ i >> 1
    trailing = lambda i: (~i & (i + 1)).bit_length() - 1  # noqa: E731  low ones of i
    place_of = {gray(i): i for i in range(size)}
    places, states = [], []
    for entry in range(size):
        for turn in range(dims):
            for corner in range(size):
                w = place_of[rotate(corner ^ entry, dims - (turn + 1) % dims)]
                start = 0 if w == 0 else gray(2 * ((w - 1) // 2))
                step = 0 if w == 0 else trailing(w - 1 if w % 2 == 0 else w)
                places.append(w)
                states.append((entry ^ rotate(start, turn + 1)) * dims + (turn + step % dims + 1) % dims)
    return places, states


def curve_index(codes: Sequence[Column], bits: int) -> Column:
    """Index on the Hilbert curve of a cell given by one ``bits``-bit code per dimension."""
    dims = len(codes)
    size = 1 << dims
    places, states = (F.array(*(F.lit(x) for x in table)) for table in curve_steps(dims))

    def step(acc: Column, level: Column) -> Column:
        corner = sum((F.call_function("shiftright", c, level).bitwiseAND(1) * (1 << i) for i, c in enumerate(codes)), F.lit(0))
        at = acc["state"] * size + corner + 1
        return F.struct(
            F.element_at(states, at).alias("state"), (acc["index"] * size + F.element_at(places, at)).alias("index")
        )

    levels = F.array(*(F.lit(level) for level in reversed(range(bits))))
    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("bigint").alias("index"))
    return F.aggregate(levels, start, step, lambda acc: acc["index"])


def quantile_cuts(rows: DataFrame, name: str, cells: int) -> Column:
    """The ``cells - 1`` inner quantiles of column ``name``, ascending, as one literal.  Runs jobs.

    Every row with a value counts, at its exact place in the order of values.  Distinct values are counted and stored once,
    and dealt to buckets between bounds from a sketch, which decide only which task places a value: its place is the rows
    of the buckets before (one sum a bucket) plus the running sum in its own.
    """
    text = dict(rows.dtypes)[name] == "string"
    known = rows.select((F.col(name) if text else F.col(name).cast("double")).alias("value")).filter("value IS NOT NULL")
    counted = keep_table(known.groupBy("value").agg(F.count(F.lit(1)).alias("n")), "values")
    buckets = 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = with_bucket(counted, sketch_bounds(counted, ["value"], buckets), ["value"], buckets)
    placed = dealt.withColumn("upto", F.sum("n").over(Window.partitionBy("_bucket").orderBy("value")))
    sums = placed.groupBy("_bucket").agg(F.max("upto").alias("held"))
    starts = sums.select(
        "_bucket",
        (F.sum("held").over(Window.orderBy("_bucket")) - F.col("held")).alias("start"),
        F.sum("held").over(Window.partitionBy()).alias("total"),
    )
    end = F.col("start") + F.col("upto")
    wanted = lambda i: F.floor(i * F.col("total") / cells) if text else F.ceil(i * F.col("total") / cells) - 1
    here = F.filter(F.sequence(F.lit(1), F.lit(max(1, cells - 1))), lambda i: (wanted(i) >= end - F.col("n")) & (wanted(i) < end))
    found = placed.join(starts, "_bucket").select(F.explode(here).alias("i"), F.struct(F.col("value").alias("c0")).alias("t"))
    cuts = F.transform(F.array_sort(F.collect_list(F.struct("i", "t"))), lambda x: x["t"])
    kind = found.schema["t"].dataType.simpleString()
    return F.from_json(F.lit(found.agg(F.to_json(cuts)).first()[0]), f"array<{kind}>")


def quantile_code(rows: DataFrame, name: str, bits: int) -> Column:
    """How many of the ``2^bits - 1`` inner quantiles of column ``name`` lie below a row's value; null: 0.  Runs jobs."""
    cells, value = 1 << bits, F.col(name)
    cuts = quantile_cuts(rows, name, cells)
    compared = F.struct((value if dict(rows.dtypes)[name] == "string" else value.cast("double")).alias("c0"))
    code = sum((F.coalesce(F.get(cuts, F.lit(i)) < compared, F.lit(False)).cast("int") for i in range(cells - 1)), F.lit(0))
    return F.when(value.isNull(), F.lit(0)).otherwise(code)


def curve_shards(
    docs: DataFrame, shards: int, dimensions: Sequence[str], bits: int = BITS, text_col: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, curve_index, shard, slot.

    Runs jobs: each dimension's distinct values with their counts are stored, for its quantiles, and then the narrow table
    of rows and cells.
    """
    names = [f"d{i}" for i in range(len(dimensions))]
    rows = pick(docs, doc_id=id_col, text=text_col, **dict(zip(names, dimensions)))
    coded = rows.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("bigint").alias("size"),
        F.crc32(F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))).alias("text_crc32"),
        *(quantile_code(rows, n, bits).alias(n) for n in names),
    )
    cells = coded.select("doc_id", "size", "text_crc32", curve_index([F.col(n) for n in names], bits).alias("curve_index"))
    kept = keep_table(cells, "cells")
    counts = kept.groupBy("curve_index").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("curve_index")  # a bounded number of cells
    starts = counts.select(
        "curve_index",
        (F.sum("n").over(before) - F.col("n")).alias("cell_start"),
        F.sum("n").over(Window.partitionBy()).alias("total"),
    )
    placed = rank_within(kept, ["curve_index"]).join(keep_table(starts, "cell-starts"), "curve_index")
    place = F.col("cell_start") + F.col("rank")
    placed = placed.withColumn("place", place).withColumn("shard", F.expr(f"place * {shards} div total"))
    first = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return placed.select(
        "doc_id", "size", "text_crc32", "curve_index", F.col("shard").cast("int").alias("shard"), (F.col("place") - first).alias("slot")
    )
