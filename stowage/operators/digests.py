"""Reconciliation by digests: two inventories are compared by order-free sums, and only what differs is read.

An inventory is stored by hash bucket of its key, with one digest per (group, bucket): rows, and two sums of 64-bit hashes
that do not depend on the order of rows.  Two inventories of the same bucketing agree on a bucket when the digests agree
(unequal rows pass as equal with a chance of about 2^-127), so a nightly comparison of two catalogues that differ in a few
places reads a few buckets.  The list of buckets that differ has at most ``buckets`` numbers, whatever the tables hold; it is
the one thing that comes to the driver, so that it prunes folders when the plan is made.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .reconcile import dark_or_missing, site_block_diff, summary_of_counts

BUCKETS = 1024


@dataclass(frozen=True)
class Inventory:
    """A stored inventory: ``group`` and ``item`` columns are its key, ``values`` what is compared beside it."""

    path: str
    group: str
    item: str
    values: tuple[str, ...] = ()
    buckets: int = BUCKETS
    schema: str | None = None  # as DDL, so that no file is opened to learn it

    def rows(self, spark: SparkSession) -> DataFrame:
        reader = spark.read.schema(self.schema) if self.schema else spark.read
        return reader.parquet(f"{self.path}/rows")

    def digests(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/digests")


def write_inventory(
    df: DataFrame, path: str, group: str, item: str, values: Sequence[str] = (), buckets: int = BUCKETS
) -> Inventory:
    """Store ``df`` (group, item, values) by bucket with its digests.  Runs two jobs.

    The bucket hashes group and item, so a group with a third of all rows spreads over all buckets.
    """
    kept = df.select(group, item, *values).withColumn("bucket", F.pmod(F.xxhash64(group, item), F.lit(buckets)).cast("int"))
    schema = ", ".join(f"`{name}` {kind}" for name, kind in kept.dtypes)
    inventory = Inventory(path, group, item, tuple(values), buckets, schema)
    kept.repartition("bucket").sortWithinPartitions("bucket", group).write.partitionBy("bucket").parquet(f"{path}/rows")
    stored = inventory.rows(df.sparkSession)
    row = lambda salt: F.xxhash64(F.lit(salt), *(x for c in (group, item, *values) for x in (F.col(c).isNull(), c)))
    total = lambda salt: F.sum(row(salt).cast("decimal(20,0)")).alias(f"sum{salt}")
    digests = stored.groupBy(group, "bucket").agg(F.count(F.lit(1)).alias("n"), total(1), total(2))
    digests.write.parquet(f"{path}/digests")
    return inventory


def compared_buckets(spark: SparkSession, left: Inventory, right: Inventory) -> DataFrame:
    """(group, bucket, n_left, n_right, same) for every bucket that either side has."""
    if (left.buckets, left.values, left.group, left.item) != (right.buckets, right.values, right.group, right.item):
        raise ValueError("the inventories are not stored alike")
    of = lambda inv, side: inv.digests(spark).select(inv.group, "bucket", F.struct("n", "sum1", "sum2").alias(side))
    a, b = of(left, "a").withColumnRenamed(left.group, "_group"), of(right, "b").withColumnRenamed("bucket", "_bucket")
    both = a.join(b, F.col("_group").eqNullSafe(F.col(right.group)) & (F.col("bucket") == F.col("_bucket")), "full_outer")
    return both.select(
        F.when(F.col("a").isNull(), F.col(right.group)).otherwise(F.col("_group")).alias(left.group),
        F.coalesce("bucket", "_bucket").alias("bucket"),
        F.coalesce("a.n", F.lit(0)).alias("n_left"),
        F.coalesce("b.n", F.lit(0)).alias("n_right"),
        F.col("a").eqNullSafe(F.col("b")).alias("same"),
    )


def rows_that_may_differ(spark: SparkSession, left: Inventory, right: Inventory) -> tuple[DataFrame, DataFrame]:
    """Both sides' rows in buckets that differ for their group.  Runs a job for the list of bucket numbers."""
    differ = compared_buckets(spark, left, right).filter(~F.col("same")).select(F.col(left.group).alias("_group"), F.col("bucket").alias("_bucket"))
    numbers = [r[0] for r in differ.select("_bucket").distinct().collect()]
    own = lambda df: (df["bucket"] == F.col("_bucket")) & df[left.group].eqNullSafe(F.col("_group"))

    def side(inventory: Inventory) -> DataFrame:
        read = inventory.rows(spark).filter(F.col("bucket").isin(numbers) if numbers else F.lit(False))
        return read.join(differ, own(read), "left_semi").drop("bucket")

    return side(left), side(right)


def incomplete_blocks(spark: SparkSession, source: Inventory, catalogue: Inventory) -> DataFrame:
    """``site_block_diff`` without its complete rows: inventories of (site, block) with ``n_files``."""
    left, right = rows_that_may_differ(spark, source, catalogue)
    return site_block_diff(left, right).filter("label <> 'complete'")


def block_summary(spark: SparkSession, source: Inventory, catalogue: Inventory) -> DataFrame:
    """``site_block_diff_summary`` where blocks in equal buckets are counted from the digests alone."""
    equal = compared_buckets(spark, source, catalogue).filter("same").groupBy(source.group).agg(F.sum("n_left").alias("n"))
    equal = equal.select(source.group, F.lit("complete").alias("label"), "n")
    left, right = rows_that_may_differ(spark, source, catalogue)
    read = site_block_diff(left, right).groupBy(source.group, "label").agg(F.count(F.lit(1)).alias("n"))
    return summary_of_counts(equal.unionByName(read))


def dark_missing_by_digest(spark: SparkSession, listing: Inventory, dump: Inventory) -> DataFrame:
    """``dark_missing_files`` over inventories of (rse, path) that were stored with the same roots and ignored folders."""
    return dark_or_missing(*rows_that_may_differ(spark, listing, dump))


def in_scope(paths: DataFrame, scope: Column) -> DataFrame:
    """(rse, path) as an inventory holds them: inside the scope, once."""
    return paths.select("rse", "path").filter(scope).distinct()
