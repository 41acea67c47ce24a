"""URL filtering against lists as they were when each page was fetched.  DataFrame functions only.

List changes (domain, action, date) become validity intervals: an entry holds from its date to the next
change of its domain; ``remove`` ends it.  Of changes on one date the strictest counts (block, then allow, then remove).
A capture is judged by its host and the domains above it: of the entries active on its date
the one with the longest domain decides.

Captures are reduced to distinct (host, date) before the join, so a hot host counts once a
date, and intervals are cut at the borders of periods of ``PERIOD`` days: the join is on (domain, period),
which splits a domain with a long history or many dates.  Open intervals end with the last capture.

Defined cases: hosts are lower case without port, user and closing dot; a url without scheme and host, or a null, has no
host and is not blocked; a capture without date matches no entry; list rows without domain, date or known action have no effect;
repeated rows give repeated results; an empty list blocks nothing; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pick

PERIOD = 91
HOST = r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
ACTIONS = ("remove", "allow", "block")  # by strictness


def host_of(url: Column) -> Column:
    """The host of a url; null where there is none."""
    found = F.regexp_extract(F.lower(url), HOST, 1)
    return F.nullif(F.regexp_replace(found, r"\.+$", ""), F.lit(""))


def period(date: Column) -> Column:
    return F.floor(F.datediff(date, F.lit("1970-01-01").cast("date")) / PERIOD)


def intervals(changes: DataFrame) -> DataFrame:
    """domain, action, valid_from, valid_to (exclusive; null: still valid) of the entries that block or allow."""
    rows = pick(changes, domain="domain", action="action", listed="listed_on")
    strict = F.array_position(F.array(*(F.lit(a) for a in ACTIONS)), F.col("action"))
    known = rows.filter("domain IS NOT NULL AND listed IS NOT NULL").withColumn("s", strict).filter("s > 0")
    dated = known.groupBy(F.lower("domain").alias("domain"), "listed").agg(F.max("s").cast("int").alias("s"))
    to = F.lead("listed").over(Window.partitionBy("domain").orderBy("listed"))
    spans = dated.withColumn("valid_to", to).filter("s > 1")
    action = F.element_at(F.array(*(F.lit(a) for a in ACTIONS)), F.col("s"))
    return spans.select("domain", action.alias("action"), F.col("listed").alias("valid_from"), "valid_to")


def judge_captures(captures: DataFrame, changes: DataFrame) -> DataFrame:
    """One row per capture (page_id, url, fetched_on): page_id, host, fetched_on, action, domain, valid_from, blocked."""
    rows = pick(captures, page_id="page_id", url="url", fetched_on="fetched_on").select(
        "page_id", host_of(F.col("url")).alias("host"), "fetched_on"
    )
    asked = rows.filter("host IS NOT NULL AND fetched_on IS NOT NULL").select("host", "fetched_on").distinct()
    labels = F.split("host", r"\.")
    above = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), ".")
    )
    keyed = asked.select("host", "fetched_on", period(F.col("fetched_on")).alias("p"), F.explode(above).alias("domain"))
    latest = rows.select(F.max("fetched_on")).scalar()
    # an empty side has no last capture: then nothing is asked either
    until = F.greatest("valid_from", F.least(F.coalesce(F.date_sub("valid_to", 1), latest), latest))
    cut = intervals(changes).filter(F.col("valid_from") <= latest)
    cut = cut.withColumn("p", F.explode(F.sequence(period(F.col("valid_from")), period(until))))
    inside = (F.col("fetched_on") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("fetched_on") < F.col("valid_to")))
    entry = F.struct(F.length("domain").alias("n"), "domain", "action", "valid_from")
    verdicts = keyed.join(cut, ["domain", "p"]).filter(inside).groupBy("host", "fetched_on").agg(F.max(entry).alias("e"))
    return rows.join(verdicts, ["host", "fetched_on"], "left").select(
        "page_id", "host", "fetched_on", F.col("e.action").alias("action"), F.col("e.domain").alias("domain"),
        F.col("e.valid_from").alias("valid_from"), F.coalesce(F.col("e.action") == "block", F.lit(False)).alias("blocked"),
    )
