"""Registered queries: snapshot and list scans, sinks, dumps.

Queries about files first write what Spark derives from the tables to the shared scratch
folder and then read it back with the scan under test.
"""

import os

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import lists as ls
from ..sources import snapshots as sn
from . import registered


@registered("snapshot_scan", "SELECT l_orderkey, l_partkey, l_suppkey, l_returnflag FROM lineitem")
def _(c):
    # the test folder is laid out as <base>/<day>/<table>
    base, day = os.path.split(c.sf_dir)
    return sn.snapshot_scan(c.spark, base, day, "lineitem.parquet", ["l_orderkey", "l_partkey", "l_suppkey", "l_returnflag"])


@registered(
    "snapshot_days",
    "SELECT name, type, CAST(strftime(ts, '%Y-%m-%d') AS VARCHAR) AS day FROM (SELECT event_id AS name, event_type AS type, ts FROM events)"
    " WHERE strftime(ts, '%Y-%m-%d') >= '2024-01-10'",
)
def _(c):
    base = scratch_path(c.spark, "snapshot")
    rows = c.events.select(F.col("event_id").alias("name"), F.col("event_type").alias("type"), F.date_format("ts", "yyyy-MM-dd").alias("day"))
    rows.write.partitionBy("day").parquet(f"{base}/events")
    return sn.snapshot_days(c.spark, base, "events").filter("day >= '2024-01-10'").withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@registered("did_list_scan", "SELECT name FROM files")
def _(c):
    path = scratch_path(c.spark, "names")
    lines = F.explode(F.array(F.concat(F.lit("  "), "name", F.lit("\t")), F.lit("   ")))
    c.files.select(lines.alias("value")).write.text(path)
    return ls.did_list_scan(c.spark, path)


@registered(
    "csv_list_scan",
    'SELECT name AS "FILENAME", \'a;"b",c\' AS "RSES", bytes AS "BYTES" FROM files',
)
def _(c):
    path = scratch_path(c.spark, "csv")
    ls.list_sink_csv(c.files.select(F.col("name").alias("FILENAME"), F.lit('a;"b",c').alias("RSES"), F.col("bytes").alias("BYTES")), path)
    return ls.csv_list_scan(c.spark, path, ["FILENAME", "RSES"], "FILENAME string, RSES string, BYTES bigint")


@registered("edge_csv_scan", "SELECT name, child_name FROM contents")
def _(c):
    path = scratch_path(c.spark, "edges")
    c.contents.select("name", "child_name").write.option("quoteAll", True).csv(path)
    return ls.edge_csv_scan(c.spark, path)


@registered(
    "json_list_scan",
    "SELECT rse, site, unnest(['root', 'davs']) AS protocol, unnest([tier, tier + 1]) AS prio FROM rses",
)
def _(c):
    # one document per site, a list of its few endpoints, each in its own file
    path = scratch_path(c.spark, "json")
    proto = lambda name, prio: F.struct(F.lit(name).alias("protocol"), prio.alias("prio"))
    entry = F.struct("rse", "site", F.array(proto("root", F.col("tier")), proto("davs", F.col("tier") + 1)).alias("protocols"))
    # opening a file takes far longer than its few bytes, which do not tell that many tasks are needed
    tasks = int(c.spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = c.rses.withColumn("folder", F.col("site")).repartition(tasks, "folder")
    docs = dealt.groupBy("folder").agg(F.to_json(F.collect_list(entry)).alias("value"))
    docs.write.partitionBy("folder").text(path)
    schema = "rse string, site string, protocols array<struct<protocol:string,prio:bigint>>"
    return ls.json_list_scan(c.spark, path, schema).select("rse", "site", F.inline("protocols"))


@registered("list_sink_text", "SELECT DISTINCT child_name AS name FROM contents")
def _(c):
    path = scratch_path(c.spark, "list")
    ls.list_sink_text(c.contents, path, "child_name")
    return ls.did_list_scan(c.spark, path)


@registered(
    "line_counts",
    r"""SELECT source, CAST(sum(length(text) - length(replace(text, chr(10), '')) + 1) AS BIGINT) AS newlines,
              CAST(sum(len(list_filter(string_split_regex(text, '\r|\n'), lambda x: regexp_matches(x, '[^ \t\v\f]')))) AS BIGINT) AS non_blank_lines
        FROM documents GROUP BY 1""",
)
def _(c):
    path = scratch_path(c.spark, "lines")
    c.documents.select("source", F.col("text").alias("value")).write.partitionBy("source").text(path)
    out = ls.line_counts(c.spark, path)
    source = F.regexp_extract("folder", "source=([^/]*)$", 1)
    # every file counts one line more than its newlines
    return out.select(source.alias("source"), (F.col("total_lines") - F.col("files")).alias("newlines"), "non_blank_lines")


@registered(
    "catalogue_dump",
    """SELECT a.account, a.email, coalesce(string_agg(DISTINCT i.identity, ',' ORDER BY i.identity), '') AS dns
       FROM accounts a LEFT JOIN identities_now i ON i.account = a.account AND i.authtype = 'X509' GROUP BY 1, 2""",
)
def _(c):
    dump, _emails = ls.catalogue_dump(c.accounts, c.identities_now)
    return dump.withColumn("dns", F.array_join("dns", ","))


@registered(
    "catalogue_dump_emails",
    "SELECT identity, max(email) AS email FROM identities_now WHERE authtype = 'X509' AND email IS NOT NULL GROUP BY 1",
)
def _(c):
    return ls.catalogue_dump(c.accounts, c.identities_now)[1]


@registered(
    "did_glob",
    "SELECT name FROM (SELECT DISTINCT name, did_type FROM contents) WHERE did_type = 'C' AND name LIKE '/C1%/Era_-v1/%'",
)
def _(c):
    return ls.did_glob(c.contents.select("name", "did_type").distinct(), "/C1*/Era?-v1/*", "container")


@registered("list_sink_csv", "SELECT DISTINCT name, did_type FROM contents")
def _(c):
    path = scratch_path(c.spark, "sink")
    ls.list_sink_csv(c.contents.select("name", "did_type"), path)
    return ls.csv_list_scan(c.spark, path, ["name", "did_type"])
