"""Distances, links, regions, subscriptions and role lists.

Settings that an operator keeps in a file (exclusion rules, subscriptions) come in as
Python lists and become column expressions, so no join against a rule table is needed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import rank_rows, top_n_per_key

# Distance per relation of two endpoints.
DISTANCE = {
    "site": 1,
    "region&country": 4,
    "country": 7,
    "region": 10,
    "AC": 11,
    "CD": 12,
    "other": 13,
}
# Suffixes taken off an endpoint name, in this order, to find its site.
SITE_SUFFIXES = ("_Disk", "_Tape", "_Temp", "_Disk_Temp", "_Test", "_Disk_Test", "_Tape_Test", "_Ceph", "_User")

_FIELDS = ("rse", "site", "cms_type", "country", "region")


# --- distances -----------------------------------------------------------------------
def _ends(links: DataFrame, rses: DataFrame) -> DataFrame:
    """Links (src, dest) with the attributes of both ends as structs ``s`` and ``d``."""
    info = rses.select("rse", F.struct(*_FIELDS).alias("_info"))
    side = lambda key, name: info.select(F.col("rse").alias(key), F.col("_info").alias(name))
    return links.join(side("src", "s"), "src").join(side("dest", "d"), "dest")


def rse_distance_matrix(links: DataFrame, rses: DataFrame) -> DataFrame:
    """Distance of each link (src, dest) by the first relation that holds.

    The caller says which links matter (those configured, or those that carried traffic):
    the work grows with the links, not with the square of the endpoints.  Equal unknown
    countries count as equal; a region must be known on both ends.
    """
    s, d = (lambda f: F.col(f"s.{f}")), (lambda f: F.col(f"d.{f}"))
    regions = lambda a, b: ((s("region") == a) & (d("region") == b)) | ((s("region") == b) & (d("region") == a))
    country = s("country").eqNullSafe(d("country"))
    region = F.coalesce((s("region") == d("region")) & (s("region") != ""), F.lit(False))
    distance = (
        F.when(s("site") == d("site"), DISTANCE["site"])
        .when(region & country, DISTANCE["region&country"])
        .when(region, DISTANCE["region"])
        .when(country, DISTANCE["country"])
        .when(regions("A", "C"), DISTANCE["AC"])
        .when(regions("C", "D"), DISTANCE["CD"])
        .otherwise(DISTANCE["other"])
    )
    return _ends(links, rses).select("src", "dest", distance.alias("distance"))


def excluded_links(matrix: DataFrame, rses: DataFrame, rules: Sequence[Mapping[str, Mapping[str, str]]]) -> DataFrame:
    """Distance -1 for links that match any rule ``{"src": {field: regex}, "dest": {...}}``.
    Regexes match from the start; a link of an endpoint to itself stays."""

    def test(rule: Mapping[str, Mapping[str, str]]) -> Column:
        parts = [
            F.coalesce(F.col(f"{end}.{field}").rlike(f"^(?:{regex})"), F.lit(False))
            for key, end in (("src", "s"), ("dest", "d"))
            for field, regex in rule.get(key, {}).items()
        ]
        return reduce(lambda a, b: a & b, parts, F.lit(True))

    hit = reduce(lambda a, b: a | b, [test(r) for r in rules], F.lit(False)) & (F.col("src") != F.col("dest"))
    return _ends(matrix, rses).select("src", "dest", F.when(hit, -1).otherwise(F.col("distance")).alias("distance"))


def link_plan(
    matrix: DataFrame,
    current: DataFrame,
    overwrite: bool = False,
    disable: bool = True,
    skip: Sequence[str] = (),
    partners: Mapping[str, Sequence[str]] | None = None,
    src_regex: str = r"\S+",
    dest_regex: str = r"\S+",
) -> DataFrame:
    """Links to create, update (``overwrite``) or disable, against the current distances.

    ``skip`` endpoints are left alone; an endpoint in ``partners`` only links to those.  A
    current link is a row of ``current``; its distance is null once disabled.
    """
    src, dest = F.col("src"), F.col("dest")
    keep = (src != dest) & src.rlike(f"^(?:{src_regex})") & dest.rlike(f"^(?:{dest_regex})")
    if skip:
        keep &= ~src.isin(*skip) & ~dest.isin(*skip)
    for rse, others in (partners or {}).items():
        keep &= ~((src == rse) & ~dest.isin(*others)) & ~((dest == rse) & ~src.isin(*others))
    known = F.coalesce(F.col("known"), F.lit(False))
    wanted, old = F.col("distance") >= 0, F.col("old_distance")
    action = F.when(wanted & ~known, "create")
    if overwrite:
        action = action.when(wanted & ~old.eqNullSafe(F.col("distance")), "update")
    if disable:
        action = action.when(~wanted & known & old.isNotNull(), "disable")
    return (
        matrix.filter(keep)
        .join(
            current.select("src", "dest", F.col("distance").alias("old_distance"), F.lit(True).alias("known")),
            ["src", "dest"],
            "left",
        )
        .withColumn("action", action)
        .filter(F.col("action").isNotNull())
        .select("src", "dest", "action", "old_distance", F.when(wanted, F.col("distance")).alias("new_distance"))
    )


def active_links(links: DataFrame) -> DataFrame:
    return links.filter(F.col("status") != "deactivated")


# --- regions, institutes, sites ------------------------------------------------------
def region_assign(regions: DataFrame, rses: DataFrame) -> DataFrame:
    """Region of each listed endpoint and of its ``_Test`` twin, where they exist."""
    both = regions.select(F.explode(F.array("rse", F.concat("rse", F.lit("_Test")))).alias("rse"), "region")
    return both.join(rses.select("rse"), "rse", "left_semi").select(
        "rse", F.lit("region").alias("key"), F.col("region").alias("value")
    )


def institute_to_rse(users: DataFrame, policy: DataFrame, defaults: Mapping[str, str]) -> DataFrame:
    """Endpoint of each user by institute.  ``policy`` is (country, rse, institutes array);
    a country with a policy falls back to its default, any other gives none, and so does
    an empty institute."""
    by_institute = (
        policy.select("country", "rse", F.explode("institutes").alias("institute"))
        .groupBy("country", "institute")
        .agg(F.min("rse").alias("rse"))
    )
    fallback = F.lit(None).cast("string")
    for country, rse in defaults.items():
        fallback = F.when(F.col("country") == country, rse).otherwise(fallback)
    named = F.col("institute").isNotNull() & (F.col("institute") != "")
    return users.join(by_institute, ["country", "institute"], "left").select(
        "account", "country", "institute", F.when(named, F.coalesce("rse", fallback)).alias("rse")
    )


def site_managers_to_rse(managers: DataFrame, rses: DataFrame) -> DataFrame:
    """Site managers of each endpoint as a sorted comma list.

    ``managers`` is (site lower case, login).  An endpoint belongs to the site that bears
    its lower-case name, else the first found after taking one suffix off.
    """
    rse = F.col("rse")
    # only the first occurrence of the suffix goes
    cut = lambda s: F.regexp_replace(rse, rf"^(.*?){s}", "$1")
    names = F.array(F.lower(rse), *[F.lower(cut(s)) for s in SITE_SUFFIXES])
    tries = rses.select("rse", F.posexplode(names).alias("_pos", "site"))
    found = tries.join(managers.select("site").distinct(), "site", "left_semi")
    site = top_n_per_key(found, ["rse"], [F.col("_pos")], 1).select("rse", "site")
    lists = managers.groupBy("site").agg(F.array_join(F.array_sort(F.collect_set("login")), ",").alias("site_admins"))
    return site.join(lists, "site").select("rse", "site", "site_admins")


def site_list(sites: DataFrame) -> DataFrame:
    """Sites with facility, tier and country, and whether the two names differ."""
    return sites.select(
        "site", "facility", "tier", "country", (F.col("site") != F.col("facility")).alias("name_mismatch")
    ).orderBy("site")


def role_members(users: DataFrame) -> dict[str, DataFrame]:
    """Role maps (role -> tags) to pairs: site -> managers (login), site -> local
    identities, group -> identities.  Pairs, not lists: a large group stays many rows."""
    roles = users.select("login", "identity", F.explode("roles").alias("role", "tags")).select(
        "login", "identity", "role", F.explode("tags").alias("tag")
    )
    named = lambda mark: F.regexp_replace("tag", f"^{mark}", "")
    managers = roles.filter("role = 'data-manager'").select(
        F.replace(named("site:"), F.lit("-"), F.lit("_")).alias("site"), "login"
    )
    local = roles.filter(
        F.col("role").isin("data-manager", "local-data-manager") & F.col("tag").startswith("site:")
    ).select(named("site:").alias("site"), "identity")
    group = roles.filter((F.col("role") == "group-data-manager") & F.col("tag").startswith("group:")).select(
        named("group:").alias("group"), "identity"
    )
    return {"managers": managers.distinct(), "local": local.distinct(), "group": group.distinct()}


def identity_account_map(special: DataFrame, users: DataFrame, default_email: str) -> DataFrame:
    """identity -> sorted accounts for the identities on the special list (identity,
    account), with the owner's own login added; the owner's e-mail or the default."""
    own = users.join(special.select("identity").distinct(), "identity", "left_semi")
    rows = special.select("identity", "account", F.lit(None).cast("string").alias("email")).unionByName(
        own.select("identity", F.col("login").alias("account"), "email")
    )
    return rows.groupBy("identity").agg(
        F.array_sort(F.collect_set("account")).alias("accounts"),
        F.coalesce(F.max("email"), F.lit(default_email)).alias("email"),
    )


# --- subscriptions -------------------------------------------------------------------
def subscription_match(dids: DataFrame, subscriptions: Sequence[Mapping]) -> DataFrame:
    """One planned rule per DID, matching subscription and rule template.

    A subscription is ``{"name", "filter": {pattern, did_type, scope, account, project},
    "rules": [{copies, rse_expression, activity, grouping, weight, lifetime}]}``; a filter
    key left out matches all.  Every DID is read once whatever the number of subscriptions.
    """

    def matches(wanted: Mapping) -> Column:
        tests = []
        if wanted.get("pattern"):
            tests.append(F.col("name").rlike(f"^(?:{wanted['pattern']})"))
        if wanted.get("did_type"):
            tests.append(F.col("did_type") == wanted["did_type"])
        for key in ("scope", "account", "project"):
            if wanted.get(key):
                tests.append(F.col(key).isin(*wanted[key]))
        return reduce(lambda a, b: a & b, tests, F.lit(True))

    def template(sub: Mapping, rule: Mapping, position: int) -> Column:
        text = lambda key: F.lit(rule.get(key)).cast("string").alias(key)
        return F.struct(
            F.lit(sub["name"]).alias("subscription"),
            F.lit(position).alias("position"),
            F.lit(rule["copies"]).cast("bigint").alias("copies"),
            text("rse_expression"),
            text("activity"),
            text("grouping"),
            text("weight"),
            F.lit(rule.get("lifetime")).cast("bigint").alias("lifetime"),
        )

    planned = [
        F.when(matches(sub.get("filter", {})), F.array(*[template(sub, r, i) for i, r in enumerate(sub["rules"])]))
        for sub in subscriptions
        if sub.get("rules")
    ]
    return dids.select("name", F.explode(F.flatten(F.array_compact(F.array(*planned)))).alias("p")).select("name", "p.*")


# --- site configuration --------------------------------------------------------------
def site_config_select(
    configs: DataFrame, flagged: DataFrame, skip: DataFrame, variant: str = "real", pilot: Sequence[str] = ()
) -> DataFrame:
    """Site entries to set up in one flavour: with an endpoint, flagged for update and not
    skipped under the flavour's name.  The user flavour goes by the pilot list instead of
    the flag."""
    suffix = {"real": "", "test": "_Test", "temp": "_Temp", "user": "_User"}[variant]
    named = (
        configs.filter(F.coalesce(F.col("rse") != "", F.lit(False)))
        .withColumn("site_rse", F.col("rse"))
        .withColumn("rse", F.concat("rse", F.lit(suffix)))
        .withColumn("deterministic", F.lit(variant != "temp"))
        .join(skip.select("rse"), "rse", "left_anti")
    )
    if variant == "user":
        return named.filter(F.col("site_rse").isin(*pilot))
    return named.join(flagged.select("rse"), "rse", "left_semi")


def self_expression_check(attributes: DataFrame, rses: DataFrame) -> DataFrame:
    """Attributes named like an endpoint: must be on that endpoint and on it alone."""
    checked = (
        rses.select(F.col("rse").alias("key"))
        .join(attributes.select("key", "rse"), "key", "left")
        .groupBy("key")
        .agg(
            F.count("rse").alias("holders"),
            F.bool_or(F.coalesce(F.col("rse") == F.col("key"), F.lit(False))).alias("own"),
        )
    )
    verdict = (
        F.when(~F.col("own"), F.when(F.col("holders") == 0, "missing").otherwise("only elsewhere"))
        .when(F.col("holders") > 1, "also elsewhere")
        .otherwise("ok")
    )
    return checked.select(F.col("key").alias("rse"), verdict.alias("verdict"))


# --- flows ---------------------------------------------------------------------------
def source_copy_plan(contents: DataFrame, replicas: DataFrame) -> DataFrame:
    """Available replicas to copy as ``<rse>_Input``, per block and file."""
    files = contents.filter("did_type = 'D' AND child_type = 'F'").select(
        F.col("name").alias("block"), F.col("child_name").alias("name")
    )
    # named before the join: a file is there once per block, so the join has many more rows than the replicas
    sources = replicas.filter("state = 'A'").select("name", F.concat("rse", F.lit("_Input")).alias("rse"), "bytes")
    return files.join(sources, "name").select("block", "name", "rse", "bytes")


def first_n_blocks(blocks: DataFrame, n: int = 3) -> DataFrame:
    """First ``n`` blocks by name of each container."""
    return top_n_per_key(blocks, ["container"], [F.col("block")], n)


def first_blocks_wanted(blocks: DataFrame, wanted: DataFrame) -> DataFrame:
    """The same with a number per container (container, nblocks); null keeps all blocks."""
    numbered = rank_rows(blocks.join(wanted, "container"), ["container"], ["block"])
    return numbered.filter(F.col("nblocks").isNull() | (F.col("n") <= F.col("nblocks"))).select("container", "block")
