"""Ranking that holds when one key owns a large share of the rows.

A plain ``row_number`` over a key puts all rows of that key into one task.  Ways
round it, by need: the best row of a key (``latest_per_key``), the first n
rows (``top_n_per_key``, cut before the shuffle) and a full numbering (``rank_rows``, buckets between
bounds from a sketch; ``number_rows``, stored range partitions, where the rows would not come out equal again).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

SALTS = 64


def latest_per_key(df: DataFrame, keys: Sequence[str], newest: Sequence[str], tie: Sequence[str]) -> DataFrame:
    """The newest row per key; among equal times the one with the smallest ``tie``, which so must be named."""
    if not tie:
        raise ValueError("name what decides between equal times")
    order = [F.col(c).desc() for c in newest] + [F.col(c).asc() for c in tie]
    return top_n_per_key(df, keys, order, 1)


def top_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each key in ``order`` (which must be total).

    A row in the first n of its key is in the first n of its key among the rows of any part of them, so a first pass over
    salted keys cuts what the second one has to bring together, for every ``n`` in the same way.  The salt hashes the
    columns that can be hashed (maps cannot).
    """

    def cut(frame: DataFrame, by: Sequence[str]) -> DataFrame:
        ranked = frame.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
        return ranked.filter(F.col("_n") <= n).drop("_n")

    plain = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*plain), F.lit(SALTS)))
    return cut(cut(salted, [*keys, "_salt"]).drop("_salt"), keys)


def _tuple(columns: Sequence[str]) -> Column:
    return F.struct(*(F.col(c).alias(f"c{i}") for i, c in enumerate(columns)))


def sketch_bounds(df: DataFrame, columns: Sequence[str], buckets: int, oversample: int = 8) -> Column:
    """At most ``buckets - 1`` tuples of ``columns``, ascending, that cut the rows into like parts.  Runs a job.

    The sketch keeps the ``buckets * oversample`` rows with the least hash: a uniform sample that can be merged from those of
    any parts.  Tuples that many rows share come once.  The bounds become one literal of the plan, so that finding a row's place copies nothing; they are as many
    short tuples as there are buckets, whatever the rows.
    """
    size = buckets * oversample
    least = df.select(_tuple(columns).alias("t"), F.xxhash64(F.lit(11), *columns).alias("h")).orderBy("h", "t").limit(size)
    held = least.agg(F.array_sort(F.collect_list("t")).alias("t"))
    cut = lambda i: F.get("t", F.floor(i * F.size("t") / buckets).cast("int"))
    some = F.filter(F.transform(F.sequence(F.lit(1), F.lit(max(1, buckets - 1))), cut), lambda x: x.isNotNull())
    kind = least.schema["t"].dataType.simpleString()
    return F.from_json(F.lit(held.select(F.to_json(F.array_distinct(some))).first()[0]), f"array<{kind}>")


def with_bucket(df: DataFrame, bounds: Column, columns: Sequence[str], buckets: int) -> DataFrame:
    """Add ``_bucket``: how many of the ascending ``bounds`` are not above the row's ``columns``, by halving."""
    row = _tuple(columns)
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(max(1, buckets).bit_length()))))
    # a place beyond the last bound gives null and so is not taken
    taken = lambda at, step: F.when(F.get(bounds, at + step - 1) <= row, at + step).otherwise(at)
    return df.withColumn("_bucket", F.aggregate(steps, F.lit(0), taken))


def rank_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: str = "n", total: str = "total", buckets: int | None = None
) -> DataFrame:
    """Number rows 1.. within each key in ``order``, with the size of the key.  Stores nothing; runs a job for the bounds.

    Rows go to buckets between the bounds of a sketch over (key, order), so a key with a third of all rows has a third of the
    buckets.  A number is the place in (key, bucket) plus the rows of the key in lower buckets: at most one count per key and
    bucket.  ``df`` is read for the sketch and for the rows, and again for the counts where columns beyond key and order are
    asked for; it must come out equal each time.  Rows that are equal in key and order are in one bucket, and take
    neighbouring numbers.  A null key is a key like any other.  ``buckets`` is
    four times the shuffle partitions unless given.
    """
    buckets = buckets or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [*keys, *(c for c in order if c not in keys)]
    bounds = sketch_bounds(df, by, buckets)
    dealt = with_bucket(df, bounds, by, buckets)
    place = F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy(*order))
    placed = dealt.withColumn("_place", place)
    # from the placed rows, so that the shuffle of the rows serves both where no further column is asked for
    # keys as a result of the group, so that a key that the plan knows to be one value still is a key
    own = [f"_of_{k}" for k in keys]
    counts = placed.groupBy(*keys, "_bucket").agg(F.max("_place").alias("_rows"), *[F.first(k).alias(o) for k, o in zip(keys, own)])
    lower = Window.partitionBy(*own).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(
        *own,
        F.col("_bucket").alias("_of_bucket"),
        F.coalesce(F.sum("_rows").over(lower), F.lit(0)).alias("_shift"),
        F.sum("_rows").over(Window.partitionBy(*own)).alias(total),
    )
    # null-safe throughout: a test for nulls would make the rows' shuffle another one than that of the counts
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(o)) for k, o in zip(["_bucket", *keys], ["_of_bucket", *own])])
    return placed.join(shifts, same).select(*df.columns, (F.col("_place") + F.col("_shift")).alias(n), total)


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: str = "n", total: str = "total") -> DataFrame:
    """Number rows 1.. within each key in ``order``, with the size of the key.

    Rows are range partitioned by (key, order), so a hot key spreads over many tasks.  The
    placement is written once to the checkpoint folder (this runs a job), because the
    counts and the rows must see the same placement even after an executor is lost.  Rows
    with a null key are numbered as one key.  A
    number is then the place in the task plus the rows of the key in earlier tasks.
    """
    placed = cut_lineage(
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    runs = placed.groupBy(*keys, "_part").agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_size"))
    # one row per key and range partition: bounded by the number of partitions
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        *keys,
        "_part",
        (F.coalesce(F.sum("_size").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
        F.sum("_size").over(Window.partitionBy(*keys)).alias(total),
    )
    runs = runs.select(*[F.col(k).alias(f"_run_{k}") for k in [*keys, "_part"]], "_shift", total)
    # a null key is a key like any other
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_run_{k}")) for k in keys], F.col("_part") == F.col("_run__part"))
    return placed.join(runs, same).select(*df.columns, (F.col("_pos") + F.col("_shift")).alias(n), total)


def block_chunks(files: DataFrame, keys: Sequence[str], order: Sequence[str], size: int = 100) -> DataFrame:
    """Pack the ordered rows of each key into blocks of ``size``: ``chunk`` from 0."""
    numbered = rank_rows(files, keys, order, n="_n", total="_total")
    return numbered.withColumn("chunk", F.floor((F.col("_n") - 1) / size).cast("bigint")).drop("_n", "_total")


def systematic_sample(rows: DataFrame, keys: Sequence[str], order: Sequence[str], samples: int, step: int) -> DataFrame:
    """First, last, ``samples - 2`` evenly spread rows and every ``step``-th row per key.

    Keeps the 0-based ``position`` and the ``total`` of the key.
    """
    numbered = rank_rows(rows, keys, order, n="_n", total="total").withColumn("position", F.col("_n") - 1)
    position, total = F.col("position"), F.col("total")
    keep = (position == 0) | (position == total - 1)
    if samples > 2:
        for i in range(1, samples - 1):
            spread = F.least(F.floor(F.lit(i / (samples - 1)) * total), total - 1)
            keep |= (total > 2) & (position == spread)
    if step > 0:
        keep |= position % step == 0
    return numbered.filter(keep).drop("_n")
