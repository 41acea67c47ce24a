"""Space, weights, quotas and availability of endpoints.

Endpoint tables are small beside file tables, yet nothing here relies on it: totals are
scalar subqueries (one value, never a single-task window), lookups are equi joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import human_size_si, min_free_bytes
from ..session import keep_table
from .ranking import latest_per_key

# Usage sources that must be known, free-space thresholds, weight total.
REQUIRED_SOURCES = ("static", "used", "expired")
FREE_THRESHOLD = 2e15
FREE_PERCENT_THRESHOLD = 2
TOTAL_WEIGHT = 100
ENABLED_STATUS = ("dependable", "enabled")
# Files from which on a dataset is not brought together row by row.
LARGE_DATASET = 100_000


# --- attributes and usage ------------------------------------------------------------
def attributes_wide(attributes: DataFrame) -> DataFrame:
    """(rse, key, value) -> (rse, attrs map).  A map holds one entry per attribute key of
    one endpoint, so its size does not follow the data."""
    pairs = attributes.groupBy("rse", "key").agg(F.max("value").alias("value"))
    return pairs.groupBy("rse").agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("attrs"))


def rse_select(rses: DataFrame, predicate: str) -> DataFrame:
    """Endpoints that satisfy a SQL predicate over their columns; may be empty."""
    return rses.where(predicate)


def rses_for_account(attributes: DataFrame, account: str, keys=("site_admins", "rule_approvers")) -> DataFrame:
    """Endpoints that list ``account`` in one of the named comma lists (exact name)."""
    hit = F.col("key").isin(*keys) & F.array_contains(F.split("value", ","), account)
    return attributes.filter(hit).select("rse").distinct()


def rse_usage_pivot(usage: DataFrame, sources: Sequence[str] = ("static", "used", "expired", "unavailable")) -> DataFrame:
    """(rse, source, used) -> one column per source.  The sources are named, so Spark needs
    no extra pass to find them."""
    return usage.groupBy("rse").pivot("source", list(sources)).agg(F.max("used"))


def usage_complete(wide: DataFrame) -> DataFrame:
    """Endpoints with every required source; the others are skipped."""
    return wide.na.drop(subset=list(REQUIRED_SOURCES))


def share_of_total(wide: DataFrame, col: str = "static") -> DataFrame:
    """``col`` over its sum on all rows, as ``share``; the sum is a scalar subquery."""
    total = wide.agg(F.sum(col)).scalar()
    return wide.withColumn("share", F.try_divide(F.col(col).cast("double"), total.cast("double")))


# --- placement weight ----------------------------------------------------------------
def dm_weight(
    usage: DataFrame,
    rses: DataFrame,
    limits: DataFrame,
    static_weight: float,
    free_weight: float,
    expired_weight: float,
    quadratic: bool,
) -> DataFrame:
    """Placement weight per endpoint of ``rses``, normalised to 100.

    ``rses`` is (rse, availability_write, coefficient); ``limits`` (rse, min_free).  A
    weight is zero when writing is off or unknown, or the endpoint is over its quota.
    Endpoints without static space are left out; with no positive weight at all the
    weights are null.  Runs a job: the wide table, a row per endpoint, is stored once, as its totals and its rows are
    asked for one after the other.
    """
    wide = usage_complete(rse_usage_pivot(usage)).join(rses, "rse").filter("static <> 0").join(limits, "rse", "left")
    known = keep_table(wide, "weights")
    total = known.agg(F.sum("static")).scalar().cast("double")
    free = F.col("static") - F.col("used") - F.coalesce("min_free", F.lit(0))
    off = ~F.coalesce(F.col("availability_write"), F.lit(False)) | (F.col("free") < 0)
    static = F.col("static").cast("double")
    raw = (
        F.lit(static_weight) * F.col("relative_pledge")
        + F.lit(free_weight) * (F.col("free") / static)
        + F.lit(expired_weight) * (F.col("expired") / static)
    )
    weighted = (
        known.withColumn("free", free)
        .withColumn("relative_pledge", static / total)
        .withColumn("coefficient", F.coalesce(F.col("coefficient").cast("double"), F.lit(1.0)))
        .withColumn("raw", F.when(off, 0.0).otherwise(raw) * F.col("coefficient"))
        .withColumn("raw", F.pow("raw", F.lit(2.0)) if quadratic else F.col("raw"))
    )
    whole = weighted.agg(F.sum("raw")).scalar()
    return weighted.withColumn("dm_weight", F.try_divide(F.col("raw"), whole) * TOTAL_WEIGHT).select(
        "rse", "static", "used", "expired", "free", "relative_pledge", "coefficient", "dm_weight"
    )


def dm_weight_report(weights: DataFrame) -> DataFrame:
    """Petabytes, percentages and weight; disk and tape parts, heaviest first."""
    peta = lambda c: F.round(F.col(c) / 1e15, 6)
    percent = lambda c: F.round(F.col(c) / F.col("static") * 100, 6)
    return weights.select(
        "rse",
        F.when(F.col("rse").contains("Tape"), "tape").otherwise("disk").alias("part"),
        peta("static").alias("pledge_pb"),
        peta("free").alias("free_pb"),
        peta("expired").alias("expired_pb"),
        F.round(F.col("relative_pledge") * 100, 6).alias("relative_pledge_pct"),
        percent("free").alias("relative_free_pct"),
        percent("expired").alias("relative_expired_pct"),
        "coefficient",
        F.round("dm_weight", 6).alias("dm_weight"),
    ).orderBy("part", F.desc("dm_weight"), "rse")


# --- site metrics --------------------------------------------------------------------
def metric_window_scan(metrics: DataFrame, start: Column, end: Column, fields: Sequence[str]) -> DataFrame:
    """Metric rows with ``start <= ts < end``, chosen fields, newest first."""
    return metrics.filter((F.col("ts") >= start) & (F.col("ts") < end)).select("ts", *fields).orderBy(F.desc("ts"))


def latest_metric_per_site(metrics: DataFrame, tie: Sequence[str]) -> DataFrame:
    return latest_per_key(metrics, ["name"], ["ts"], tie)


def first_candidate(df: DataFrame, candidates: Sequence[Column], targets: DataFrame, out: str) -> DataFrame:
    """Each row with the first of its candidate names that exists in ``targets``, as ``out``.

    Rows without any hit drop; equal rows stay apart.
    """
    known = targets.select("rse").distinct()
    hits = [f"_hit{i}" for i in range(len(candidates))]
    for hit, candidate in zip(hits, candidates):
        df = df.join(known.withColumnRenamed("rse", hit), candidate == F.col(hit), "left")
    return df.withColumn(out, F.coalesce(*hits)).drop(*hits).filter(F.col(out).isNotNull())


def site_metric_to_rse(sites: DataFrame, disk_rses: DataFrame, tape_rses: DataFrame) -> DataFrame:
    """One row per site and matched endpoint: ``<site>_Tape`` for tape; for disk the first
    of ``<site>``, ``<site>_Disk``, ``<site>_User``."""
    name = F.col("name")
    disk = first_candidate(
        sites, [name, F.concat(name, F.lit("_Disk")), F.concat(name, F.lit("_User"))], disk_rses, "rse"
    )
    tape = sites.withColumn("rse", F.concat(name, F.lit("_Tape"))).join(tape_rses.select("rse"), "rse", "left_semi")
    return disk.withColumn("kind", F.lit("disk")).unionByName(tape.withColumn("kind", F.lit("tape")))


def site_capacity_plan(
    matched: DataFrame, usage: DataFrame, limits: DataFrame, percents: DataFrame, default_percent: float = 10.0
) -> DataFrame:
    """Static usage and minimum free space to set.

    ``matched`` comes from ``site_metric_to_rse`` with ``tape_usable``, ``disk_experiment_use``
    and ``disk_local_use`` in TB.  A ``_User`` endpoint holds the local part only.  Disk
    without its main part is skipped; a row is planned when either value differs.
    """
    experiment, local = F.col("disk_experiment_use") * 1e12, F.col("disk_local_use") * 1e12
    user, tape = F.col("rse").endswith("_User"), F.col("kind") == "tape"
    static = F.when(tape, F.col("tape_usable") * 1e12).when(user, local).otherwise(experiment + local)
    main = F.when(user, local).otherwise(experiment)
    limit = F.when(~tape, min_free_bytes("new_static", "percent", default_percent))
    changed = (F.col("new_static") != F.col("old_static")) | (~tape & (F.col("new_limit") != F.col("old_limit")))
    return (
        matched.filter(tape | (main != 0))
        .join(usage.filter("source = 'static'").select("rse", F.col("used").alias("old_static")), "rse", "left")
        .join(limits.select("rse", F.col("min_free").alias("old_limit")), "rse", "left")
        .join(percents.select("rse", "percent"), "rse", "left")
        .withColumn("new_static", static)
        .withColumn("new_limit", limit)
        .na.fill(0, ["old_static", "old_limit"])
        .filter(changed)
        .select("rse", "kind", "old_static", "new_static", "old_limit", "new_limit")
    )


def local_quota_plan(wanted: DataFrame, group_accounts: DataFrame, current: DataFrame) -> DataFrame:
    """Quota of the local account of an endpoint: ``wanted`` is (rse, quota).  The first of
    ``<rse>_local_users`` and ``<rse>_local`` that exists gets it, if it differs."""
    base = F.lower("rse")
    found = first_candidate(
        wanted,
        [F.concat(base, F.lit("_local_users")), F.concat(base, F.lit("_local"))],
        group_accounts.select(F.col("account").alias("rse")),
        "account",
    )
    return (
        found.join(current.select("account", "rse", F.col("quota").alias("old_quota")), ["account", "rse"], "left")
        .na.fill(0, ["old_quota"])
        .filter(F.col("old_quota") != F.col("quota"))
        .select("account", "rse", "old_quota", "quota")
    )


def user_quota_plan(
    users: DataFrame, limits: DataFrame, default_quota: int, option: str = "set-new-only"
) -> DataFrame:
    """Quota of users (account, rse).  ``reset-all`` sets the default; ``set-new-only``
    leaves users with another quota alone.  A quota is only ever raised."""
    joined = users.join(limits.select("account", "rse", F.col("quota").alias("old_quota")), ["account", "rse"], "left")
    if option == "set-new-only":
        joined = joined.filter(F.col("old_quota").isNull() | (F.col("old_quota") == default_quota))
    elif option != "reset-all":
        raise ValueError(option)
    return (
        joined.na.fill(0, ["old_quota"])
        .withColumn("quota", F.lit(default_quota).cast("bigint"))
        .filter(F.col("quota") > F.col("old_quota"))
    )


# --- availability --------------------------------------------------------------------
def occupancy_ok(wide: DataFrame, free_threshold: float = FREE_THRESHOLD, percent: float = FREE_PERCENT_THRESHOLD) -> DataFrame:
    """False only when free bytes and free percentage are both below their thresholds; an
    endpoint with a missing metric counts as fine."""
    missing = F.greatest(*[F.col(c).isNull().cast("int") for c in ("static", "used", "expired", "unavailable")]) == 1
    free = F.col("static") - F.col("used")
    low = (free < free_threshold) & (F.try_divide(free * 100.0, F.col("static")) < percent)
    return wide.select("rse", F.coalesce(missing | ~low, F.lit(True)).alias("occupancy_ok"))


def tape_output_flag(rses: DataFrame, skip: DataFrame, occupancy: DataFrame) -> DataFrame:
    """Whether real tape endpoints may take production output."""
    return (
        rses.filter("rse_type = 'TAPE' AND cms_type = 'real'")
        .join(skip.select("rse"), "rse", "left_anti")
        .join(occupancy, "rse", "left")
        .select("rse", F.coalesce("occupancy_ok", F.lit(True)).alias("output_tape"))
    )


def availability_plan(statuses: DataFrame, rses: DataFrame, skip: DataFrame, occupancy: DataFrame) -> DataFrame:
    """Read, write and delete switches from the newest status of each site.

    ``statuses`` is (name, ts, status).  Disk is ``<site>`` or ``<site>_Disk``, tape
    ``<site>_Tape``.  Tier-3 and skipped endpoints stay as they are; full disks lose write.
    """
    name = F.col("name")
    latest = latest_metric_per_site(statuses, ["status"])
    disk = first_candidate(latest, [name, F.concat(name, F.lit("_Disk"))], rses, "rse")
    tape = latest.withColumn("rse", F.concat(name, F.lit("_Tape"))).join(rses.select("rse"), "rse", "left_semi")
    on = F.coalesce(F.col("status").isin(*ENABLED_STATUS), F.lit(False))
    room = F.col("rse").contains("_Tape") | F.coalesce("occupancy_ok", F.lit(True))
    return (
        disk.unionByName(tape)
        .filter(~F.col("rse").startswith("T3_"))
        .join(skip.select("rse"), "rse", "left_anti")
        .join(occupancy, "rse", "left")
        .select(
            "rse",
            on.alias("availability_read"),
            (on & room).alias("availability_write"),
            on.alias("availability_delete"),
        )
    )


# --- datasets ------------------------------------------------------------------------
def dataset_summary(files: DataFrame, replicas: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``files`` is (dataset, name, bytes, events), ``replicas`` (name, rse, state).

    Returns totals per dataset and the same per dataset and endpoint over available
    replicas.  Missing sizes and events count as nothing.  Runs a job, for the large datasets.
    """
    totals = lambda df, *by: df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("file_count"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum("events"), F.lit(0)).alias("events"),
    )
    whole = totals(files, "dataset").withColumn("size", human_size_si("bytes"))
    small, large, names = _at_datasets(files, replicas.filter("state = 'A'").select("name", "rse"))
    each = lambda rows: totals(rows.withColumn("code", F.explode("at")), "dataset", "code")
    both = each(small).unionByName(each(large))
    return whole, both.select("dataset", F.get(names, "code").alias("rse"), "file_count", "bytes", "events")


def _endpoint_codes(there: DataFrame) -> tuple[DataFrame, Column]:
    """``there`` (name, rse) as (name, high, low): a row per name with the numbers of its endpoints; and the names of the numbers.

    The names are one sorted array, a value no longer than a row that lists all endpoints.  A number goes as 8 high and
    16 low bits in arrays of their own: 3 bytes, where a name takes some 8 even after compression.  Runs jobs: rows, names
    and sets are stored.
    """
    known = keep_table(there, "there")
    names = keep_table(known.select("rse").distinct().agg(F.array_sort(F.collect_list("rse")).alias("names")), "endpoints")
    codes = names.select(F.posexplode("names").alias("code", "rse"))
    sets = known.join(codes, "rse", "left").groupBy("name").agg(F.array_sort(F.collect_list("code")).alias("codes"))
    high = F.transform("codes", lambda c: F.shiftright(c, 16).cast("tinyint"))
    low = F.transform("codes", lambda c: (c.bitwiseAND(0xFFFF) - 0x8000).cast("smallint"))
    return keep_table(sets.select("name", high.alias("high"), low.alias("low")), "sets"), names.scalar()


def _at_datasets(files: DataFrame, there: DataFrame) -> tuple[DataFrame, DataFrame, Column]:
    """``files`` (dataset, name, ...) with ``at``: the numbers of their endpoints in ``there`` (name, rse), one entry a replica.

    A file travels to its dataset once, with that list, and becomes a row per endpoint only there: the first frame has the
    rows of a dataset in one task, and four times the tasks of a shuffle, as its rows become many.  The second has the datasets
    of more than ``LARGE_DATASET`` files, as they come.  Third are the names of the numbers, as an array.  The names of large
    datasets are stored, so that Spark knows how few they are, and so are the lists: this runs jobs, whose shuffles are gone
    before the files travel.
    """
    sets, names = _endpoint_codes(there)
    counts = files.groupBy("dataset").agg(F.count(F.lit(1)).alias("n"))
    large = keep_table(counts.filter(F.col("n") > LARGE_DATASET).select("dataset"), "large")
    held = files.join(sets, "name").drop("name")
    tasks = 4 * int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = F.zip_with("high", "low", lambda h, l: h.cast("int") * 0x10000 + l.cast("int") + 0x8000)
    numbered = lambda rows: rows.withColumn("at", at).drop("high", "low")
    small = held.join(large, "dataset", "left_anti").repartition(tasks, "dataset")
    return numbered(small), numbered(held.join(large, "dataset", "left_semi")), names


def block_replica_nodes(contents: DataFrame, replicas: DataFrame) -> DataFrame:
    """Block -> sorted endpoints with an available file of it (a set of endpoint names)."""
    files = contents.filter("did_type = 'D' AND child_type = 'F'").select(
        F.col("name").alias("dataset"), F.col("child_name").alias("name")
    )
    small, large, names = _at_datasets(files, replicas.filter("state = 'A'").select("name", "rse"))
    held = lambda rows: rows.select("dataset", F.explode_outer("at").alias("code")).select("dataset", F.get(names, "code").alias("rse"))
    sets = lambda rows: held(rows).groupBy("dataset").agg(F.collect_set("rse").alias("rses"))
    return sets(small).unionByName(sets(large)).select(F.col("dataset").alias("block"), F.array_sort("rses").alias("rses"))


def blocks_in_container(contents: DataFrame, containers: DataFrame) -> DataFrame:
    """Datasets of the listed containers; a name that is no container gives none."""
    return (
        contents.filter("did_type = 'C' AND child_type = 'D'")
        .join(containers.select("name"), "name", "left_semi")
        .select(F.col("name").alias("container"), F.col("child_name").alias("block"))
    )


def rse_progress_rollup(dataset_replicas: DataFrame, rses: DataFrame, tier: str = "/NANOAOD") -> DataFrame:
    """Blocks, files and bytes done and possible per test endpoint and in total, for blocks
    of one data tier.  Endpoints with nothing possible are hidden."""
    test = rses.filter("cms_type = 'test'").select("rse")
    done = (
        dataset_replicas.filter(F.col("name").contains(tier))
        .join(test, "rse", "left_semi")
        .rollup("rse")
        .agg(
            F.count(F.lit(1)).alias("blocks"),
            F.coalesce(F.sum("available_length"), F.lit(0)).alias("files"),
            F.coalesce(F.sum("length"), F.lit(0)).alias("files_possible"),
            F.coalesce(F.sum("available_bytes"), F.lit(0)).alias("bytes"),
            F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes_possible"),
        )
        .filter("files_possible > 0 AND bytes_possible > 0")
    )
    return done.select(
        F.coalesce("rse", F.lit("TOTAL")).alias("rse"),
        "blocks",
        "files",
        "files_possible",
        F.round(F.col("files") * 100.0 / F.col("files_possible"), 6).alias("files_pct"),
        F.round(F.col("bytes") / 1e12, 6).alias("tb"),
        F.round(F.col("bytes_possible") / 1e12, 6).alias("tb_possible"),
    )


def staging_estimate(dataset_replicas: DataFrame, limit_tb: float = 30.0) -> DataFrame:
    """Bytes of a container, bytes not on disk, and the grouping a staging rule should use."""
    on_disk = (F.col("state") == "AVAILABLE") & ~F.col("rse").contains("_Tape")
    blocks = dataset_replicas.groupBy("container", "name").agg(
        F.max("bytes").alias("bytes"),
        F.coalesce(F.max(F.when(on_disk, F.col("available_bytes"))), F.lit(0)).alias("disk_bytes"),
    )
    total = blocks.groupBy("container").agg(F.sum("bytes").alias("bytes"), F.sum("disk_bytes").alias("disk_bytes"))
    return total.select(
        "container",
        "bytes",
        (F.col("bytes") - F.col("disk_bytes")).alias("not_on_disk"),
        F.when(F.col("bytes") / 1e12 > limit_tb, "DATASET").otherwise("ALL").alias("grouping"),
    )
