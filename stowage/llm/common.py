"""What several operators share: picking columns, spreading ranks, connected components."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import drop_path, keep_table, scratch_path

# A key's rows are numbered in this many independent parts, so a key with a third of 10^11 rows
# leaves some 10^7 rows for one task.
SPREAD = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Columns by their exact name, under new names; every other column may be called as it likes."""
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    return plain.select(*(F.col(f"c{df.columns.index(name)}").alias(new) for new, name in columns.items()))


def document_key(doc_id: Column, text: Column) -> Column:
    """32 bytes that tell a document by id and text; never null."""
    told = lambda c: F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), c.cast("string")))
    return F.unhex(F.sha2(F.concat(told(doc_id), F.lit("\n"), told(text)), 256))


def tagged(df: DataFrame, **columns: str) -> tuple[DataFrame, list[str]]:
    """The frame under positional names with ``columns`` copied beside them, and the positional names.

    For operators that hand their input's columns on: work with the copies, then ``untagged``.
    """
    own = [f"_in{i}" for i in range(len(df.columns))]
    plain = df.toDF(*own)
    return plain.select(*own, *(F.col(own[df.columns.index(name)]).alias(new) for new, name in columns.items())), own


def untagged(df: DataFrame, own: Sequence[str], names: Sequence[str]) -> DataFrame:
    return df.select(*own).toDF(*names)


def rank_within(kept: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``rank`` (from 0, gapless within ``keys``) and ``key_rows``, in an arbitrary but fixed order.

    Rows of a key are dealt by hash into ``SPREAD`` parts that are numbered apart and shifted by the
    parts before them (at most ``SPREAD`` rows a key), so a hot key spreads over many tasks.  Equal
    rows take neighbouring numbers.  ``kept`` is read twice and so must be a stored table; its keys
    must not be null.
    """
    columns = kept.columns
    part = kept.withColumn("_part", F.pmod(F.xxhash64(*columns), F.lit(SPREAD)))
    sizes = part.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n"))
    of_key = Window.partitionBy(*keys)
    starts = sizes.select(
        *keys,
        "_part",
        (F.sum("_n").over(of_key.orderBy("_part")) - F.col("_n")).alias("_start"),
        F.sum("_n").over(of_key).alias("key_rows"),
    )
    numbered = part.withColumn("_n", F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*columns)))
    joined = numbered.join(starts, [*keys, "_part"])
    return joined.select(*columns, (F.col("_start") + F.col("_n") - 1).alias("rank"), "key_rows")


def components(links: DataFrame) -> DataFrame:
    """Connected components of ``links`` (a, b): one row (node, root), root the least node.

    Large-star and small-star steps in turn: each pulls neighbours to the least node they see, until
    nothing moves.  Runs jobs: every round is one table in the shared folder, and only its row count
    and checksum come to the driver.  Minima are partial aggregates; the join on a node with many
    neighbours is a plain equi join that adaptive execution can split.
    """
    spark = links.sparkSession

    def stored(edges: DataFrame):
        path = scratch_path(spark, "links")
        edges.write.parquet(path)
        table = spark.read.schema("u bigint, v bigint").parquet(path)
        seen = table.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()
        return table, path, tuple(seen)

    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct()
    edges, path, seen = stored(edges)
    while True:
        both = edges.union(edges.select("v", "u")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges, new_path, now = stored(small.union(least).distinct())
        drop_path(spark, path)
        path = new_path
        if now == seen:
            break
        seen = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


__all__ = ["components", "document_key", "keep_table", "pick", "rank_within", "table", "tagged", "untagged"]
