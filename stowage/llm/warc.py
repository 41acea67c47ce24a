"""Content-addressed WARC archive.

An archive is two tables: ``payloads`` holds each distinct payload once under its SHA-256, ``records``
the exact header block of every record and the digest of its payload.  Reading joins them: a record is
its header, its block (the payload, or nothing for a revisit) and the closing line ends.  Every payload
is hashed again on reading, and a wrong one is an error.

Of records with equal payloads of at least ``revisit_from`` bytes the one with the largest id is the
response and the others revisit it.  Groups are found by digests alone; payload bytes are moved
once, by (digest, id), so a payload that a third of all pages share does not gather in one task.

Defined cases: a null html is an empty payload; a null url has no Target-URI line, line ends in a url
are percent-encoded; rows repeated with the responding id are responses each; a record without id
revisits a response with id where there is one; an empty table gives an empty archive; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import pick

REVISIT_FROM = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n"


def header_block(kind: Column, url: Column, date: str) -> Column:
    """The record's header, with the empty line that ends it."""
    clean_url = F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    revisit = kind == "revisit"
    identity = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: "), F.coalesce(identity(F.col("page_id")), F.lit("<urn:page:>"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), clean_url),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), identity(F.col("first_id")))),
        F.lit("Content-Type: text/html"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit("0")).otherwise(F.col("n").cast("string"))),
    ]
    return F.concat(F.concat_ws(END, *lines), F.lit(END + END))  # concat_ws leaves out null lines


def write_archive(
    pages: DataFrame, path: str, revisit_from: int = REVISIT_FROM, date: str = "1970-01-01T00:00:00Z",
    id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> None:
    """Write ``path/payloads`` and ``path/records``.  ``date`` stands where the pages have no fetch time."""
    rows = pick(pages, page_id=id_col, url=url_col, html=html_col).select(
        "page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload")
    )
    hashed = rows.select("page_id", "url", "payload", F.sha2("payload", 256).alias("sha256"))
    groups = hashed.groupBy("sha256").agg(F.max("page_id").alias("first_id"))

    facts = hashed.select("page_id", "url", "sha256", F.sha1("payload").alias("sha1"), F.octet_length("payload").alias("n"))
    again = (F.col("n") >= revisit_from) & F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    kind = F.when(again, F.lit("revisit")).otherwise(F.lit("response"))
    records = facts.join(groups, "sha256").select("sha256", header_block(kind, F.col("url"), date).alias("header"))
    records.write.parquet(f"{path}/records")

    # one row of each group brings the bytes
    key = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    owners = groups.select("sha256", key("first_id").alias("owner"))
    own = hashed.select("sha256", key("page_id").alias("owner"), "payload").join(owners, ["sha256", "owner"])
    first = F.row_number().over(Window.partitionBy("sha256", "owner").orderBy("sha256"))
    own.withColumn("_n", first).filter("_n = 1").select("sha256", "payload").write.parquet(f"{path}/payloads")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: header, its fields, payload facts checked against the stored digest, block, record."""
    stored = spark.read.parquet(f"{path}/payloads")
    checked = F.when(F.sha2("payload", 256) == F.col("sha256"), F.sha1("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload does not match its digest "), F.col("sha256")))
    )
    payloads = stored.select(
        "sha256", "payload", checked.alias("payload_digest"), F.octet_length("payload").cast("bigint").alias("payload_bytes")
    )
    field = lambda name: F.regexp_extract("header", rf"(?m)^{name}: ([^\r\n]*)", 1)
    number = lambda name: F.nullif(F.regexp_extract(field(name), "^<urn:page:(.*)>$", 1), F.lit(""))
    records = spark.read.parquet(f"{path}/records").select(
        "sha256",
        "header",
        number("WARC-Record-ID").alias("record_id"),
        field("WARC-Type").alias("record_type"),
        number("WARC-Refers-To").alias("refers_to"),
        field("WARC-Payload-Digest").alias("told_digest"),
    )
    block = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    ends = F.lit((END + END).encode())
    return records.join(payloads, "sha256").select(
        "header", "record_id", "record_type", "refers_to", "told_digest", "payload_digest", "payload_bytes",
        block.alias("block"), F.concat(F.encode("header", "UTF-8"), block, ends).alias("record"),
    )
