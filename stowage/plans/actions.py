"""Planned actions: every change an operator would make, as rows.

All plans share one shape: position, kind, scope, name, rse, args, reason.  Nothing here
changes a catalogue.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import dataset_from_path, purge_flag
from ..operators.invalidation import last_replica_files
from ..operators.ranking import block_chunks

# Seconds until an erased name expires; order in which lists are worked.
ERASE_LIFETIME = 86400
ORDER = {"delete_rule": 0, "declare_bad": 1, "invalidate": 1, "expire_did": 2, "stuck_rule": 3}


def action_table(
    df: DataFrame,
    kind: str,
    name: Column | str,
    rse: Column | str | None = None,
    scope: Column | str | None = None,
    args: Mapping[str, Column] | None = None,
    reason: str = "",
    position: int | None = None,
) -> DataFrame:
    """Rows of ``df`` as actions of one kind.  Arguments become a map of strings."""
    as_col = lambda v, default: F.lit(default) if v is None else F.col(v) if isinstance(v, str) else v
    pairs = [x for k, v in (args or {}).items() for x in (F.lit(k), v.cast("string"))]
    return df.select(
        F.lit(ORDER.get(kind, 9) if position is None else position).alias("position"),
        F.lit(kind).alias("kind"),
        as_col(scope, "cms").alias("scope"),
        as_col(name, None).cast("string").alias("name"),
        as_col(rse, None).cast("string").alias("rse"),
        (F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,string>")).alias("args"),
        F.lit(reason).alias("reason"),
    )


def invalidation_actions(lists: Mapping[str, DataFrame], reason: str, erase: DataFrame | None = None) -> DataFrame:
    """All actions of an invalidation from its lists (``invalidate_*`` operators).

    Bad replicas are one row per file and endpoint; rule deletions say whether to purge;
    ``erase`` names collections that expire.  A frame missing from ``lists`` is skipped.
    """
    reason = f"File Invalidation Tool - {reason}"
    parts = []
    if "rules" in lists:
        parts.append(
            action_table(lists["rules"], "delete_rule", "rule_id", "rse", args={"purge": purge_flag("rse")}, reason=reason)
        )
    if "replicas" in lists:
        each = lists["replicas"].filter("rses <> ''").select("name", F.explode(F.split("rses", ";")).alias("rse"))
        parts.append(action_table(each, "declare_bad", "name", "rse", args={"force": F.lit("true")}, reason=reason))
    if "files" in lists:
        parts.append(action_table(lists["files"], "invalidate", "name", args={"valid": F.lit("0")}, reason=reason))
    if erase is not None:
        parts.append(
            action_table(erase, "expire_did", "name", args={"lifetime": F.lit(ERASE_LIFETIME)}, reason=reason)
        )
    if "rules_stuck" in lists:
        parts.append(action_table(lists["rules_stuck"], "stuck_rule", "rule_id", args={"state": F.lit("STUCK")}, reason=reason))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def invalidation_plan_by_mode(
    mode: str,
    level: str,
    names: DataFrame,
    lists: Mapping[str, DataFrame],
    reason: str,
    site: str | None = None,
    erase: bool = False,
    last_replicas: DataFrame | None = None,
) -> DataFrame:
    """What one run of an invalidation does, by mode.

    ``global`` acts on the catalogue and on the bookkeeping, ``catalogue-only`` and
    ``bookkeeping-only`` on one of them, ``site-invalidation`` on the replicas at ``site``.
    ``lists`` comes from the ``invalidate_*`` operator of ``level`` (file, dataset, container).
    Rules are deleted, and collections expire, only with ``erase``; suspended rules are
    tried again at file level.  At file level the bookkeeping takes the names as given.
    ``last_replicas`` (all replicas: name, rse, state) makes a site invalidation that takes a
    file's last valid replica invalidate it in the bookkeeping too.
    """
    if mode not in ("global", "catalogue-only", "bookkeeping-only", "site-invalidation"):
        raise ValueError(f"mode {mode!r}")
    if (mode == "site-invalidation") != (site is not None):
        raise ValueError("a site belongs to site-invalidation, and only to it")
    if mode == "site-invalidation" and erase or mode != "site-invalidation" and last_replicas is not None:
        raise ValueError(f"option does not fit mode {mode!r}")
    chosen: dict[str, DataFrame] = {}
    erased = None
    if mode != "bookkeeping-only":
        chosen["replicas"] = lists["replicas"]
        if site is not None:
            here = lists["replicas"].filter(F.array_contains(F.split("rses", ";"), site))
            chosen["replicas"] = here.select("name", F.lit(site).alias("rses"))
        if level == "file":
            chosen["rules_stuck"] = lists["rules_stuck"]
        if erase:
            chosen["rules"] = lists["rules"]
            if level != "file":
                erased = names.select("name").distinct()
            if level == "container":
                erased = erased.unionByName(lists["datasets"].select("name"))
    if mode in ("global", "bookkeeping-only"):
        chosen["files"] = names.select("name").distinct() if level == "file" else lists["files"]
        if level == "container":
            chosen["files"] = chosen["files"].unionByName(names.select("name").distinct())
    if last_replicas is not None:
        chosen["files"] = last_replica_files(chosen["replicas"], last_replicas).filter("last_replica").select("name")
    return invalidation_actions(chosen, reason, erased)


def capacity_actions(plan: DataFrame) -> DataFrame:
    """``site_capacity_plan`` rows as usage and limit settings."""
    usage = action_table(plan, "set_usage", F.lit("static"), "rse", args={"used": F.col("new_static").cast("bigint")})
    limits = plan.filter("new_limit IS NOT NULL")
    return usage.unionByName(
        action_table(limits, "set_limit", F.lit("MinFreeSpace"), "rse", args={"value": F.col("new_limit")})
    )


def weight_actions(weights: DataFrame) -> DataFrame:
    """Weights as attributes; disk endpoints also keep the older attribute name."""
    value = {"value": F.round("dm_weight", 6)}
    new = action_table(weights, "set_attribute", F.lit("dm_weight"), "rse", args=value)
    old = weights.filter(~F.col("rse").contains("Tape"))
    return new.unionByName(action_table(old, "set_attribute", F.lit("ddm_quota"), "rse", args=value))


def link_actions(plan: DataFrame) -> DataFrame:
    """``link_plan`` rows: set or clear the distance."""
    return action_table(
        plan,
        "set_distance",
        "src",
        "dest",
        args={"action": F.col("action"), "distance": F.coalesce(F.col("new_distance").cast("string"), F.lit("none"))},
    )


def availability_actions(plan: DataFrame) -> DataFrame:
    keys = ("availability_read", "availability_write", "availability_delete")
    return action_table(plan, "set_availability", "rse", "rse", args={k: F.col(k) for k in keys})


def fixed_quota_plan(rses: DataFrame, account: str, quota: int = 10_000_000_000_000) -> DataFrame:
    """The same quota for one account on every test endpoint."""
    return action_table(
        rses.filter("cms_type = 'test'"), "set_quota", F.lit(account), "rse", args={"bytes": F.lit(quota)}
    )


def wan_priority_plan(protocols: DataFrame, schemes, **priorities: int | None) -> DataFrame:
    """Protocols of the chosen schemes with new wide-area priorities (read, write,
    third_party_copy, delete).  ``wan`` is a struct column; rows that keep all are left out."""
    given = {k: v for k, v in priorities.items() if v is not None}
    chosen = protocols.filter(F.col("scheme").isin(*schemes))
    if not given:
        return chosen.limit(0)
    wan = F.col("wan")
    for key, value in given.items():
        wan = wan.withField(key, F.lit(value).cast("int"))
    return chosen.withColumn("wan", wan)


def registration_plan(files: DataFrame, folder: str, scope: str, block_size: int = 100) -> DataFrame:
    """Containers, blocks, files and attachments for a list of paths.

    Paths are packed in order into blocks of ``block_size`` per container; a block is named
    by a hash of container and number, so a second run plans the same names.  A path that does
    not fit the folder becomes a ``reject`` row.
    """
    every = files.select(F.col("path").alias("file"), dataset_from_path("path", folder).alias("container"))
    unfit = action_table(
        every.filter("container IS NULL"), "reject", "file", scope=F.lit(scope), reason="path does not fit the folder pattern"
    )
    packed = block_chunks(every.filter("container IS NOT NULL"), ["container"], ["file"], block_size)
    block = F.concat("container", F.lit("#"), F.md5(F.concat_ws("|", "container", F.col("chunk").cast("string"))))
    rows = packed.withColumn("block", block)
    add = lambda df, col, kind, pos: action_table(
        df.select(col).distinct(), "add_did", col, scope=F.lit(scope), args={"type": F.lit(kind)}, position=pos
    )
    attach = lambda df, parent, child, pos: action_table(
        df.select(parent, child).distinct(), "attach", child, scope=F.lit(scope), args={"to": F.col(parent)}, position=pos
    )
    return (
        add(rows, "container", "CONTAINER", 0)
        .unionByName(add(rows, "block", "DATASET", 1))
        .unionByName(attach(rows, "container", "block", 2))
        .unionByName(add(rows, "file", "FILE", 3))
        .unionByName(attach(rows, "block", "file", 4))
        .unionByName(unfit)
    )
