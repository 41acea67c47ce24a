"""Snapshots stored in buckets of a column, so that joins and groups on it need no shuffle.

A daily snapshot is written once and joined on the same names all day.  Written by hash bucket of the name, sorted within
the bucket, contents, replicas and locks meet bucket by bucket: only what is asked for (a list of names, the members of
some containers) is shuffled to them, never they themselves.  All tables that are to meet need one number of buckets.

Spark knows buckets of catalogue tables only, so a snapshot is opened as a table of the session's catalogue over its
folder; the folder itself, with the number of the bucket in each file's name, is all that is kept.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex}"


def write_bucketed(df: DataFrame, path: str, by: str, buckets: int, label: str = "snapshot") -> DataFrame:
    """Store ``df`` in ``buckets`` of column ``by`` below ``path`` and open it.  Runs a job.

    Rows are dealt by bucket first, so that a bucket is one file and its order is known.
    """
    name = _name(label)
    dealt = df.repartition(buckets, by)
    dealt.write.format("parquet").bucketBy(buckets, by).sortBy(by).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def open_bucketed(spark: SparkSession, path: str, schema: str, by: str, buckets: int, label: str = "snapshot") -> DataFrame:
    """A snapshot that ``write_bucketed`` left at ``path``; ``schema`` is DDL."""
    name, folder = _name(label), path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY (`{by}`) SORTED BY (`{by}`) INTO {buckets} BUCKETS LOCATION '{folder}'")
    return spark.table(name)
