"""A stored table that batches of a stream update, each exactly once.

The table lies in ``<path>/batch=<n>/bucket=<b>``: a bucket is a hash of the key, and a batch writes the buckets of the names
it reports, whole, under its own number.  Nothing that is there is changed.  A reader takes each bucket from the newest
batch that has finished, which the writer's success mark says; what a batch left that died half-way is not seen, and
goes when the batch is played again.  A batch that has finished and is played again does nothing.

A merge that can take several batches at once need not run for each: ``keep_batch`` only adds the changes to a log
(``<path>/log/batch=<n>``), and ``fold`` merges what waits there, as the form of the last batch in it.  The log is folded
when it has grown to ``FOLD_AT`` times what was written of the table, so that the table is written a number of times that
grows with the logarithm of the changes and not with the number of batches.

One writer at a time, as with any stream.  Lists of batches and of buckets come to the driver: as many numbers as there
are buckets, and batches.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


FOLD_AT = 4


@dataclass(frozen=True)
class UpsertTable:
    """``key``: the column whose hash deals rows into ``buckets``; ``schema``: of the rows, as DDL.

    ``placed``: merges get both frames with the columns ``bucket`` and ``_part`` (a part of a bucket, by another hash of the
    key), deal rows by them and hand them on; what comes out is then written where it is, without another shuffle.
    """

    path: str
    key: str
    schema: str
    buckets: int = 256
    placed: bool = False

    def bucket(self, key: Column) -> Column:
        """A null key has the bucket of an empty text, as it must not get lost."""
        return F.pmod(F.xxhash64(F.coalesce(key.cast("string"), F.lit(""))), F.lit(self.buckets)).cast("int")

    def batches(self, spark: SparkSession) -> list[int]:
        """Numbers of the finished batches."""
        return _finished(spark, self.path)

    def waiting(self, spark: SparkSession) -> list[int]:
        """Numbers of the batches in the log that are not merged yet."""
        merged = max(self.batches(spark), default=-2)
        return [n for n in _finished(spark, f"{self.path}/log") if n > merged]

    def stored(self, spark: SparkSession, only: list[int] | None = None) -> DataFrame:
        """Rows of each bucket (of ``only`` these) in their newest form; folders that are not wanted are not read."""
        done = self.batches(spark)
        whole = T.StructType([*_fields(spark, self.schema), T.StructField("batch", T.LongType()), T.StructField("bucket", T.IntegerType())])
        if not done:
            return spark.createDataFrame([], whole).drop("batch", "bucket")
        rows = spark.read.schema(whole).option("basePath", self.path).parquet(*(f"{self.path}/batch={n}" for n in done))
        places = rows.select("batch", "bucket")
        newest = (places if only is None else places.filter(F.col("bucket").isin(only))).groupBy("bucket").agg(F.max("batch").alias("batch")).collect()
        by_batch: dict[int, list[int]] = {}
        for r in newest:
            by_batch.setdefault(r["batch"], []).append(r["bucket"])
        wanted = [(F.col("batch") == n) & F.col("bucket").isin(own) for n, own in by_batch.items()]
        return rows.filter(reduce(lambda a, b: a | b, wanted, F.lit(False))).drop("batch", "bucket")

    def write(self, rows: DataFrame, number: int) -> None:
        if "_part" in rows.columns:
            dealt = rows.drop("_part")
        else:
            dealt = rows.withColumn("bucket", self.bucket(F.col(self.key))).repartition("bucket")
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/batch={number}")

    def _merged(self, spark: SparkSession, touched: list[int], changes: DataFrame, key: Column, merge: Callable) -> DataFrame:
        old = self.stored(spark, touched)
        if not self.placed:
            return merge(old, changes)
        # as many parts as give each task of a shuffle its own
        parts = F.lit(max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // self.buckets))
        part = lambda k: F.pmod(F.xxhash64(F.lit(7), F.coalesce(k.cast("string"), F.lit(""))), parts).cast("int")
        place = lambda rows, k: rows.withColumns({"bucket": self.bucket(k), "_part": part(k)})
        return merge(place(old, F.col(self.key)), place(changes, key))

    def create(self, rows: DataFrame) -> None:
        """First contents, as batch -1.  Does nothing if they are there."""
        if -1 not in self.batches(rows.sparkSession):
            self.write(rows, -1)

    def merge_batch(self, changes: DataFrame, number: int, key: Column, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """Replace the buckets of the changes' ``key`` by ``merge(old rows, changes)``; nothing if the batch has finished."""
        spark = changes.sparkSession
        if number in self.batches(spark):
            return
        if self.waiting(spark):
            raise ValueError("batches wait in the log: fold them first")
        touched = [r[0] for r in changes.select(self.bucket(key).alias("b")).distinct().collect()]
        if touched:
            self.write(self._merged(spark, touched, changes, key, merge), number)

    def keep_batch(self, changes: DataFrame, number: int, key: Column, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """Add a batch to the log; nothing if it is there or merged.  ``merge`` must take the changes of several batches,
        told apart by a column ``batch``."""
        spark = changes.sparkSession
        log = f"{self.path}/log"
        if number <= max(self.batches(spark), default=-2) or number in _finished(spark, log):
            return
        changes.write.mode("overwrite").parquet(f"{log}/batch={number}")
        held = sum(_bytes(spark, f"{self.path}/batch={n}") for n in self.batches(spark))
        if sum(_bytes(spark, f"{log}/batch={n}") for n in self.waiting(spark)) >= FOLD_AT * held:
            self.fold(spark, changes.schema, key, merge)

    def fold(self, spark: SparkSession, schema: T.StructType, key: Column, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """Merge the batches that wait in the log (rows of ``schema``); a reader sees all of them or none."""
        numbers = self.waiting(spark)
        if not numbers:
            return
        log = f"{self.path}/log"
        whole = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
        changes = spark.read.schema(whole).option("basePath", log).parquet(*(f"{log}/batch={n}" for n in numbers))
        touched = [r[0] for r in changes.select(self.bucket(key).alias("b")).distinct().collect()]
        if touched:
            self.write(self._merged(spark, touched, changes, key, merge), numbers[-1])

    def vacuum(self, spark: SparkSession) -> None:
        """Drop buckets that a newer finished batch has replaced.  No reader may be on its way in an older form.

        The newest form of each bucket and the success marks stay, so a reader sees the same before, during and after.
        """
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        base = hadoop.Path(self.path)
        fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        seen: set[str] = set()
        for n in reversed(self.batches(spark)):
            for status in fs.listStatus(hadoop.Path(base, f"batch={n}")):
                name = status.getPath().getName()
                if name.startswith("bucket=") and name in seen:
                    fs.delete(status.getPath(), True)
                elif name.startswith("bucket="):
                    seen.add(name)


def _finished(spark: SparkSession, folder: str) -> list[int]:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    base = hadoop.Path(folder)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return []
    found = [s.getPath() for s in fs.listStatus(base) if s.getPath().getName().startswith("batch=")]
    return sorted(int(p.getName().split("=")[1]) for p in found if fs.exists(hadoop.Path(p, "_SUCCESS")))


def _bytes(spark: SparkSession, folder: str) -> int:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def _fields(spark: SparkSession, ddl: str) -> list[T.StructField]:
    return spark.createDataFrame([], ddl).schema.fields


def upsert_sink(
    stream: DataFrame, table: UpsertTable, key: Column, merge: Callable[[DataFrame, DataFrame], DataFrame], several: bool = False
):
    """A writer of ``stream`` whose batches go into ``table``; give it a progress folder and start it.

    ``several``: ``merge`` takes the changes of several batches, told apart by a column ``batch``.  Batches then wait in
    the table's log, and ``table.fold`` brings in the last ones before the table is read.
    """
    into = table.keep_batch if several else table.merge_batch
    return stream.writeStream.foreachBatch(lambda batch, number: into(batch, number, key, merge))
