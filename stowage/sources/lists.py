"""Hand-off files: lists of names, CSV and JSON lists, and the sinks that write them.

Sinks write from the executors, one file per partition; nothing is brought to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .listing import folder_files


def did_list_scan(spark: SparkSession, path: str) -> DataFrame:
    """Text of one name per line: trimmed, blank lines dropped."""
    name = F.regexp_replace("value", r"^\s+|\s+$", "")
    return spark.read.text(path).select(name.alias("name")).filter("name <> ''")


def csv_list_scan(
    spark: SparkSession, path: str, required: Sequence[str], schema: T.StructType | str | None = None
) -> DataFrame:
    """CSV with a header that must hold the required columns (an error otherwise).

    All columns are text unless a schema is given: no pass over the data to guess types.
    """
    df = spark.read.option("header", True).option("escape", '"').csv(path)
    lost = [c for c in required if c not in df.columns]
    if lost:
        raise ValueError(f"{path} must contain columns {', '.join(required)}; missing {', '.join(lost)}")
    if schema is None:
        return df
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    return df.select(*[F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in wanted])


def edge_csv_scan(spark: SparkSession, path: str) -> DataFrame:
    """Quoted two-column CSV without header: parent, child."""
    return (
        spark.read.option("quote", '"').option("escape", '"').schema("name string, child_name string").csv(path)
        .select(F.trim(F.col("name")).alias("name"), F.trim(F.col("child_name")).alias("child_name"))
        .filter("name IS NOT NULL AND child_name IS NOT NULL")
    )


def json_list_scan(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Nested JSON documents, each file one document or one list."""
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def list_sink_text(df: DataFrame, path: str, column: str | None = None) -> None:
    """Distinct values of one column, one per line, no header."""
    column = column or df.columns[0]
    df.select(F.col(column).cast("string").alias("value")).distinct().write.mode("overwrite").text(path)


def list_sink_csv(df: DataFrame, path: str) -> None:
    """Distinct rows as CSV with header."""
    df.distinct().write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def line_counts(spark: SparkSession, path: str) -> DataFrame:
    """Files, lines and non-blank lines per folder.

    A file counts one line more than it has newlines.  Lines are read as rows, so a file of
    any size is split over tasks; whether its last line ends in a newline follows from the
    file size.  An empty file, which a scan leaves out, counts one line: files are listed by
    tasks of their own (``folder_files``), and nothing is listed on the driver but folders.
    """
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(path)
    pieces = F.filter(F.split("value", "\r"), lambda p: p.rlike(r"\S"))
    per_file = (
        lines.select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_size").alias("size"),
            (F.octet_length("value") + 1).cast("bigint").alias("bytes"),
            F.size(pieces).alias("filled"),
        )
        .groupBy("file", "size")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("bytes").alias("bytes"), F.sum("filled").alias("filled"))
        .select("file", (F.col("rows") + F.when(F.col("bytes") == F.col("size"), 1).otherwise(0)).alias("total"), "filled")
    )
    # a scan gives URIs: without scheme, and with escaped characters as they are
    plain = F.url_decode(F.replace(F.regexp_replace("file", r"^[a-z0-9]+:/+", "/"), F.lit("+"), F.lit("%2B")))
    listing = folder_files(spark, path).withColumn("file", F.regexp_replace("file", "^/*", "/"))
    return (
        listing.join(per_file.withColumn("file", plain), "file", "left")
        .groupBy("folder")
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.sum(F.coalesce("total", F.lit(1))).alias("total_lines"),
            F.sum(F.coalesce("filled", F.lit(0))).alias("non_blank_lines"),
        )
    )


def catalogue_dump(accounts: DataFrame, identities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accounts with their sorted X509 identities, and identity -> e-mail.

    The identities of one account are few by nature (a person's certificates)."""
    x509 = identities.filter("authtype = 'X509'")
    lists = x509.groupBy("account").agg(F.array_sort(F.collect_set("identity")).alias("dns"))
    dump = accounts.select("account", "email").join(lists, "account", "left").withColumn(
        "dns", F.coalesce("dns", F.array().cast("array<string>"))
    )
    emails = x509.filter("email IS NOT NULL").groupBy("identity").agg(F.max("email").alias("email"))
    return dump, emails


def did_glob(dids: DataFrame, pattern: str, did_class: str = "collection") -> DataFrame:
    """Names that match a wildcard (``*``, ``?``) within a class of DID types: all,
    collection, dataset, container or file.  Everything else in the pattern is literal, and
    the literal head of it also goes to the scan as a prefix test."""
    types = {"all": "CDF", "collection": "CD", "dataset": "D", "container": "C", "file": "F"}[did_class]
    like = "".join({"*": "%", "?": "_", "%": "\\%", "_": "\\_", "\\": "\\\\"}.get(ch, ch) for ch in pattern)
    return dids.filter(F.col("did_type").isin(*types) & F.col("name").like(like)).select("name")
