"""Differences between two inventories and the plans that follow from them.

Both inventories are compared for all sites at once with one full outer join on
(site, item), so each side is shuffled once.  The join key carries the item, so a site
that owns a third of all rows still spreads over all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import sync_account_name
from .ranking import block_chunks, top_n_per_key

# Schemes that may be set up at an endpoint.
MANAGED_SCHEMES = ("srm", "srmv2", "gsiftp", "root", "davs")


# --- filters -------------------------------------------------------------------------
def _any(tests: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def pattern_any_filter(df: DataFrame, patterns: Sequence[str], col: str = "name") -> DataFrame:
    """Names that contain any of ``patterns``; no patterns keep all."""
    return df.filter(_any([F.col(col).contains(p) for p in patterns])) if patterns else df


def matches_any(col: str, regexes: Sequence[str]) -> Column:
    """Start-anchored match of any regex."""
    if not regexes:
        return F.lit(False)
    return F.col(col).rlike("^(?:" + "|".join(f"(?:{r})" for r in regexes) + ")")


def select_ignore_filter(df: DataFrame, select: Sequence[str], ignore: Sequence[str] = (), col: str = "name") -> DataFrame:
    return df.filter(matches_any(col, select) & ~matches_any(col, ignore))


def name_prefix_scan(df: DataFrame, prefix: str | None, col: str = "name") -> DataFrame:
    """Names under ``/<prefix>``; a prefix test reaches the Parquet scan."""
    return df.filter(F.col(col).startswith("/" + prefix)) if prefix else df


# --- block lists ---------------------------------------------------------------------
def site_block_diff(source: DataFrame, catalogue: DataFrame, patterns: Sequence[str] = ()) -> DataFrame:
    """(site, block, n_files) twice -> one label per block at each site."""
    left = pattern_any_filter(source, patterns, "block").withColumnRenamed("n_files", "n_source")
    right = pattern_any_filter(catalogue, patterns, "block").withColumnRenamed("n_files", "n_catalogue")
    label = (
        F.when(F.col("n_catalogue").isNull(), "not_in_catalogue")
        .when(F.col("n_source").isNull(), "not_in_source")
        .when(F.col("n_source") == F.col("n_catalogue"), "complete")
        .otherwise("incomplete")
    )
    return left.join(right, ["site", "block"], "full_outer").withColumn("label", label)


def site_block_diff_summary(diff: DataFrame) -> DataFrame:
    """Counts per site and two percentages: of everything seen, and of what should be there."""
    return summary_of_counts(diff.groupBy("site", "label").agg(F.count(F.lit(1)).alias("n")))


def summary_of_counts(counts: DataFrame) -> DataFrame:
    """``site_block_diff_summary`` of (site, label, n), where a label may have several rows."""
    of = lambda label: F.coalesce(F.sum(F.when(F.col("label") == label, F.col("n"))), F.lit(0)).alias(label)
    complete, missing, extra = F.col("complete"), F.col("not_in_catalogue"), F.col("not_in_source")
    percent = lambda whole: F.round(F.try_divide(complete * 100.0, whole), 6)
    return (
        counts.groupBy("site")
        .agg(*[of(x) for x in ("complete", "incomplete", "not_in_catalogue", "not_in_source")])
        .withColumn("pct_complete", percent(complete + missing + extra))
        .withColumn("pct_added", percent(complete + missing))
    )


def dataset_list_diff(
    source: DataFrame, catalogue: DataFrame, select: Sequence[str] = (".*",), ignore: Sequence[str] = ()
) -> DataFrame:
    """(site, name, n_files) twice -> missing, to_remove, to_update or unchanged, with a
    flag whether the name filters pick the row for work."""
    left = source.withColumnRenamed("n_files", "n_source")
    right = catalogue.withColumnRenamed("n_files", "n_catalogue")
    label = (
        F.when(F.col("n_catalogue").isNull(), "missing")
        .when(F.col("n_source").isNull(), "to_remove")
        .when(F.col("n_source") != F.col("n_catalogue"), "to_update")
        .otherwise("unchanged")
    )
    picked = matches_any("name", select) & ~matches_any("name", ignore)
    return (
        left.join(right, ["site", "name"], "full_outer")
        .withColumn("label", label)
        .withColumn("selected", picked & (F.col("label") != "unchanged"))
    )


def dataset_list_summary(diff: DataFrame) -> DataFrame:
    counts = []
    for label in ("missing", "to_remove", "to_update"):
        hit = F.col("label") == label
        counts += [F.count_if(hit).alias(label), F.count_if(hit & F.col("selected")).alias(f"{label}_selected")]
    return diff.groupBy("site").agg(F.count(F.lit(1)).alias("tot"), *counts, F.count_if("selected").alias("selected"))


def empty_source_guard(diff: DataFrame, source: DataFrame, allow_clean: bool = False) -> DataFrame:
    """Drop the rows of sites of which the raw ``source`` list, before any name pattern, has no row at all.

    An empty list is what a failed fetch looks like, and all removals for such a site are mistrusted; a pattern that matches
    nothing at a site with a list is not.  Rows of the list without a site say nothing of any site.
    """
    if allow_clean:
        return diff
    return diff.join(source.select("site").distinct(), "site", "left_semi")


def capped_actions(plan: DataFrame, n: int, keys: Sequence[str] = ("site", "label"), order: str = "block") -> DataFrame:
    """At most ``n`` actions per kind and site, in name order; the rest wait for the next
    run.  The cap is the feature: a cycle is kept short on purpose."""
    return top_n_per_key(plan, list(keys), [F.col(order)], n)


def datasets_at_rse(rules: DataFrame, dataset_replicas: DataFrame, prefix: str | None = None) -> DataFrame:
    """Datasets at an endpoint kept by an unexpired rule of its sync account, with the
    number of files there."""
    kept = name_prefix_scan(rules.filter((F.col("did_type") == "D") & F.col("expires_at").isNull()), prefix)
    return (
        name_prefix_scan(dataset_replicas, prefix)
        .withColumn("account", F.concat(F.lit("sync_"), F.lower("rse")))
        .join(kept.select("name", "account"), ["name", "account"], "left_semi")
        .select("rse", "name", "available_length")
    )


# --- files and rules of blocks -------------------------------------------------------
def block_replica_plan(source: DataFrame, catalogue: DataFrame) -> DataFrame:
    """(rse, block, name) twice -> files to add and to remove, in one pass over both."""
    key = ["rse", "block", "name"]
    side = lambda df, mark: df.select(*key).distinct().withColumn(mark, F.lit(True))
    both = side(source, "s").join(side(catalogue, "c"), key, "full_outer")
    return both.filter(F.col("s").isNull() | F.col("c").isNull()).select(
        *key, F.when(F.col("c").isNull(), "add").otherwise("remove").alias("action")
    )


def replicas_to_recover(source: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Files the source has and the catalogue holds as not available."""
    return (
        catalogue.filter(F.col("state") != "A")
        .join(source.select("rse", "block", "name"), ["rse", "block", "name"], "left_semi")
        .select("rse", "block", "name", F.lit("A").alias("new_state"))
    )


def attach_missing(plan: DataFrame, contents: DataFrame) -> DataFrame:
    """Planned files that are not yet in their dataset."""
    held = contents.filter("did_type = 'D' AND child_type = 'F'").select(
        F.col("name").alias("block"), F.col("child_name").alias("name")
    )
    return plan.filter("action = 'add'").select("block", "name").distinct().join(held, ["block", "name"], "left_anti")


def rule_plan(presence: DataFrame, rules: DataFrame, cut: int | None = 25) -> DataFrame:
    """Add a rule where a block is at a site without one; delete rules whose block is gone.

    ``presence`` is (rse, block); a rule counts when its account is the endpoint's sync
    account and its expression is exactly that endpoint.
    """
    here = presence.select("rse", "block").distinct().withColumn("present", F.lit(True))
    ours = (
        rules.filter(F.col("rse_expression").startswith("rse="))
        .withColumn("rse", F.expr("substring(rse_expression, 5)"))
        .filter(F.col("account") == sync_account_name("rse", cut=cut))
        .select("rse", F.col("name").alias("block"), "rule_id")
    )
    action = F.when(F.col("rule_id").isNull(), "add").when(F.col("present").isNull(), "delete")
    return (
        here.join(ours, ["rse", "block"], "full_outer")
        .withColumn("action", action)
        .filter(F.col("action").isNotNull())
        .select("rse", "block", "rule_id", "action")
    )


def repair_from_source(source: DataFrame, contents: DataFrame, info: DataFrame) -> DataFrame:
    """Files of a block known to the source but not to the catalogue, with size and checksum."""
    missing = source.select("block", "name").distinct().withColumn("action", F.lit("add"))
    return metadata_for_missing(attach_missing(missing, contents), info)


def metadata_for_missing(missing: DataFrame, info: DataFrame) -> DataFrame:
    return missing.join(info.select("name", "bytes", "adler32"), "name", "left")


# --- storage against catalogue -------------------------------------------------------
def under_any(col: str, folders: Sequence[str]) -> Column:
    """File path below one of ``folders``.  Prefix tests reach the scan of a stored path."""
    return _any([F.col(col).startswith(f.rstrip("/") + "/") for f in folders])


def dark_missing_files(
    listing: DataFrame, dump: DataFrame, roots: Sequence[str], ignore: Sequence[str] = ()
) -> DataFrame:
    """(rse, path) twice -> dark (only on storage) and missing (only in the catalogue)."""
    scope = lambda df: df.select("rse", "path").filter(under_any("path", roots) & ~under_any("path", ignore)).distinct()
    return dark_or_missing(scope(listing), scope(dump))


def dark_or_missing(listing: DataFrame, dump: DataFrame) -> DataFrame:
    both = listing.withColumn("s", F.lit(True)).join(dump.withColumn("c", F.lit(True)), ["rse", "path"], "full_outer")
    return both.filter(F.col("s").isNull() | F.col("c").isNull()).select(
        "rse", "path", F.when(F.col("c").isNull(), "dark").otherwise("missing").alias("label")
    )


def _share_gate(found: DataFrame, totals: DataFrame, now: Column, max_fraction: float, max_age_last_run: int) -> DataFrame:
    """Per endpoint: allowed when the last run is recent and the share of files small.

    ``found`` is (rse, n); ``totals`` is (rse, files, last_run)."""
    recent = F.col("last_run") >= now - F.make_dt_interval(F.lit(max_age_last_run))
    share = F.round(F.try_divide(F.col("n"), F.col("files")), 9)
    return found.join(totals, "rse").select(
        "rse",
        "n",
        share.alias("share"),
        F.when(~recent, "last run too old")
        .when(F.coalesce(share > max_fraction, F.lit(True)), "too many files")
        .otherwise("allowed")
        .alias("gate"),
    )


def dark_action_gate(
    history: DataFrame,
    totals: DataFrame,
    now: Column,
    min_runs: int = 3,
    min_age_first_run: int = 25,
    confirmation_window: int = 35,
    max_age_last_run: int = 3,
    max_fraction: float = 0.01,
) -> DataFrame:
    """Dark files that may be removed.

    ``history`` is (rse, path, run_at), one row per run that saw the file.  A file counts
    when the window holds enough runs and the first of them is old enough; its endpoint
    must pass the share and freshness gate.
    """
    days = lambda n: F.make_dt_interval(F.lit(n))
    confirmed = (
        history.filter((F.col("run_at") >= now - days(confirmation_window)) & (F.col("run_at") <= now))
        .groupBy("rse", "path")
        .agg(F.count_distinct("run_at").alias("runs"), F.min("run_at").alias("first_seen"))
        .filter((F.col("runs") >= min_runs) & (F.col("first_seen") <= now - days(min_age_first_run)))
    )
    per_rse = confirmed.groupBy("rse").agg(F.count(F.lit(1)).alias("n"))
    gates = _share_gate(per_rse, totals, now, max_fraction, max_age_last_run)
    return confirmed.join(gates.select("rse", "gate"), "rse").select("rse", "path", "runs", "gate")


def missing_action_gate(
    missing: DataFrame, totals: DataFrame, now: Column, max_age_last_run: int = 3, max_fraction: float = 0.01
) -> DataFrame:
    per_rse = missing.groupBy("rse").agg(F.count(F.lit(1)).alias("n"))
    return _share_gate(per_rse, totals, now, max_fraction, max_age_last_run)


def unmerged_listing(listing: DataFrame, root: str = "/store/unmerged/", ignore: Sequence[str] = ()) -> DataFrame:
    """Files below ``root`` and outside the ignored folders."""
    return listing.filter(F.col("path").startswith(root) & ~under_any("path", ignore))


# --- accounts, scopes, attributes ----------------------------------------------------
def identity_diff(current: DataFrame, target: DataFrame, authtype: str) -> DataFrame:
    """Identities to add and delete per account.  An X509 pass never deletes token
    identities (``SUB=``) and a token pass deletes nothing else."""
    key = ["account", "identity"]
    side = lambda df, mark: df.select(*key).distinct().withColumn(mark, F.lit(True))
    both = side(target, "t").join(side(current, "c"), key, "full_outer")
    token = F.col("identity").startswith("SUB=")
    own = token if authtype == "OIDC" else ~token
    action = F.when(F.col("c").isNull(), "add").when(F.col("t").isNull() & own, "delete")
    return both.withColumn("action", action).filter(F.col("action").isNotNull()).select(*key, "action")


def account_plan(rses: DataFrame, accounts: DataFrame, attributes: DataFrame, identities: DataFrame) -> DataFrame:
    """What the sync account of every real endpoint lacks: the account, its admin flag,
    the common identity.  ``attributes`` is (account, key, value); ``identities`` holds
    the accounts that have the identity."""
    wanted = rses.filter("cms_type = 'real'").select(F.concat(F.lit("sync_"), F.lower("rse")).alias("account")).distinct()
    admin = attributes.filter((F.col("key") == "admin") & (F.lower("value") == "true"))
    lacks = lambda have, what: wanted.join(have.select("account").distinct(), "account", "left_anti").select(
        "account", F.lit(what).alias("lacks")
    )
    return lacks(accounts, "account").unionByName(lacks(admin, "attribute")).unionByName(lacks(identities, "identity"))


def scope_plan(
    accounts: DataFrame, scopes: DataFrame, include_local: bool = False, only_group_suffix: bool = False
) -> DataFrame:
    """Group scopes to add: wanted minus existing (account, scope) pairs."""
    name = F.col("account")
    local = name.endswith("_local_users") | name.endswith("_local")
    full = F.concat(F.lit("group."), name)
    before = lambda mark: F.substring_index(full, mark, 1)
    scope = F.when(local, before("_local") if include_local else F.lit(None))
    if only_group_suffix:
        scope = scope.when(name.endswith("_group"), before("_group"))
    else:
        scope = scope.otherwise(full)
    wanted = (
        accounts.filter("account_type = 'GROUP'").select("account", scope.alias("scope")).filter("scope IS NOT NULL")
    )
    existing = scopes.filter(F.col("scope").startswith("group.")).select(
        F.expr("substring(scope, 7)").alias("account"), "scope"
    )
    return wanted.distinct().join(existing, ["account", "scope"], "left_anti")


def role_attr_diff(attributes: DataFrame, wanted: DataFrame, rses: Sequence[str]) -> DataFrame:
    """Compare the capacity-manager list of the named endpoints with the wanted accounts.

    Works on (endpoint, account) pairs, so neither list is gathered: an endpoint changes
    when any pair is on one side only."""
    named = attributes.select("rse").filter(F.col("rse").isin(*rses)).distinct()
    have = (
        attributes.filter(F.col("rse").isin(*rses) & (F.col("key") == "site_capacity_manager"))
        .select("rse", F.explode(F.split("value", ",")).alias("account"))
        .distinct()
        .withColumn("h", F.lit(True))
    )
    want = (
        wanted.select("account")
        .distinct()
        .select("account", F.explode(F.array(*[F.lit(r) for r in rses])).alias("rse"))
        .withColumn("w", F.lit(True))
    )
    per_rse = want.join(have, ["rse", "account"], "full_outer").groupBy("rse").agg(
        F.bool_or(F.col("w").isNull() | F.col("h").isNull()).alias("changed"),
        F.count_if(F.col("w").isNotNull() & F.col("h").isNull()).alias("to_add"),
        F.count_if(F.col("h").isNotNull() & F.col("w").isNull()).alias("to_drop"),
    )
    return named.join(per_rse, "rse")


def attribute_diff(wanted: DataFrame, present: DataFrame) -> DataFrame:
    """(rse, key, value) twice -> attributes to set.  A present ``True`` also stands for a
    wanted ``1`` or ``True``.  Attributes nobody wants are left alone."""
    old = present.select("rse", "key", F.col("value").alias("old_value"))
    same = (F.col("value") == F.col("old_value")) | (
        (F.col("old_value") == "True") & F.col("value").isin("1", "True")
    )
    return (
        wanted.join(old, ["rse", "key"], "left")
        .filter(~F.coalesce(same, F.lit(False)))
        .select("rse", "key", "value", "old_value", F.lit("set").alias("action"))
    )


def protocol_diff(wanted: DataFrame, current: DataFrame) -> DataFrame:
    """(rse, scheme, read_priority, definition) twice -> add, replace, delete or unchanged.

    ``definition`` is any comparable column.  ``position`` is the order to work in: lower
    read priority first, deletions after all additions.
    """
    left = wanted.select("rse", "scheme", "read_priority", F.col("definition").alias("wanted"))
    right = current.select("rse", "scheme", F.col("definition").alias("present"))
    managed = F.col("scheme").isin(*MANAGED_SCHEMES)
    action = (
        F.when(F.col("wanted").isNull(), "delete")
        .when(F.col("wanted").eqNullSafe(F.col("present")), "unchanged")
        .when(F.col("present").isNull(), F.when(managed, "add").otherwise("ignored"))
        .when(managed, "replace")
        .otherwise("delete")
    )
    position = F.when(F.col("wanted").isNull(), F.lit(1_000_000)).otherwise(F.col("read_priority"))
    return (
        left.join(right, ["rse", "scheme"], "full_outer")
        .withColumn("action", action)
        .withColumn("position", position.cast("bigint"))
        .select("rse", "scheme", "action", "position")
    )


# --- snapshots -----------------------------------------------------------------------
def deleted_archive(old: DataFrame, new: DataFrame, archive: DataFrame, stamp: Column | None = None) -> DataFrame:
    """Rows gone since the last snapshot and not archived yet, stamped."""
    key = ["scope", "name"]
    return (
        old.join(new.select(*key), key, "left_anti")
        .join(archive.select(*key), key, "left_anti")
        .withColumn("deleted_at", F.current_timestamp() if stamp is None else stamp)
    )


def reuse_violation(new: DataFrame, archive: DataFrame) -> DataFrame:
    """New names that already stand in the archive of deleted names."""
    return new.join(archive.select("scope", "name"), ["scope", "name"], "left_semi")


def immutable_key_change(old: DataFrame, new: DataFrame, key: str, surrogate: str) -> DataFrame:
    """Rows whose ``key`` changed between two snapshots."""
    return (
        old.select(surrogate, F.col(key).alias("old_key"))
        .join(new.select(surrogate, F.col(key).alias("new_key")), surrogate)
        .filter(F.col("old_key") != F.col("new_key"))
    )


def did_restore_plan(names: DataFrame, archive: DataFrame, batch: int = 500) -> DataFrame:
    """Listed names found in the archive, in name order, in batches of ``batch``."""
    found = archive.select("scope", "name", "did_type").join(
        names.select("name").distinct(), "name", "left_semi"
    )
    return block_chunks(found, ["did_type"], ["scope", "name"], batch).withColumnRenamed("chunk", "batch")
