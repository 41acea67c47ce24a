"""Daily catalogue snapshots: ``<base>/<day>/<table>`` in Parquet (or Avro where the
package is installed)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import id_hex


def snapshot_scan(
    spark: SparkSession,
    base: str,
    day: str,
    table: str,
    columns: Sequence[str] = (),
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """One table of one day, narrowed to ``columns`` so that only those are read.

    The day is part of the path: no other day is listed, let alone read.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(f"{base.rstrip('/')}/{day}/{table}")
    return df.select(*columns) if columns else df


def snapshot_days(spark: SparkSession, base: str, table: str, fmt: str = "parquet") -> DataFrame:
    """All days of a table in the partitioned layout ``<base>/<table>/day=<day>``; a filter
    on ``day`` prunes folders."""
    return spark.read.format(fmt).option("basePath", f"{base}/{table}").load(f"{base}/{table}/day=*")


def write_snapshot(df: DataFrame, base: str, day: str, table: str, fmt: str = "parquet") -> str:
    path = f"{base.rstrip('/')}/{day}/{table}"
    df.write.format(fmt).mode("overwrite").save(path)
    return path


def with_hex_ids(df: DataFrame, *columns: str) -> DataFrame:
    """Binary id columns as lower-case hex text."""
    return df.withColumns({c: id_hex(c) for c in columns})
