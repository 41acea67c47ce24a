"""Decisions on rule requests from usage and endpoint facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import keep_table
from .containers import stats_of

# Activities and limits of automatic approval.
AUTO_ACTIVITY = "User AutoApprove"
AUTO_ACTIVITIES = ("User AutoApprove", "Analysis TapeRecall")
RECALL_ACCOUNT = "crab_tape_recall"
MAX_LIFETIME = 30 * 24 * 3600
MAX_TEMP_LIFETIME = 31 * 24 * 3600
MAX_SINGLE_RSE = 50e12
MAX_ACCOUNT = 1e15
MAX_GLOBAL = 1e16
# Fixed values of the rule truth table.
ANY_RULE_PREFIXES = ("sync_", "wma_")
MANAGED_TIERS = ("/USER", "/NANOAOD", "/NANOAODSIM")


def did_sizes(contents: DataFrame, files: DataFrame, names: DataFrame) -> DataFrame:
    """(name, size) of those ``names`` (name) that are files or hold some.  Runs jobs (``stats_of``).

    One row per name; a name of nothing known has no row.
    """
    asked = keep_table(names.select("name").distinct(), "asked")
    known = files.select("name", F.col("bytes").alias("size"))
    return stats_of(asked, contents, files).select("name", "size").unionByName(known.join(asked, "name", "left_semi"))


def autoapprove_usage(rules: DataFrame, sizes: DataFrame) -> DataFrame:
    """Bytes of names under auto-approve rules, per account (null endpoint) and per account
    and endpoint expression, in one pass."""
    held = rules.filter(F.col("activity") == AUTO_ACTIVITY).join(sizes, "name", "left")
    return held.groupingSets(
        [[F.col("account")], [F.col("account"), F.col("rse_expression")]], "account", "rse_expression"
    ).agg(
        F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"),
        F.grouping("rse_expression").cast("int").alias("whole_account"),
    )


def autoapprove_locked(rules: DataFrame, locks: DataFrame) -> DataFrame:
    """One row: bytes of all locks of auto-approve rules."""
    ours = rules.filter(F.col("activity") == AUTO_ACTIVITY).select("rule_id")
    return locks.join(ours, "rule_id", "left_semi").agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))


def request_rse_facts(request_rses: DataFrame, rses: DataFrame) -> DataFrame:
    """Facts on the endpoints of each request.  ``rses`` is (rse, rse_type, tier, cms_type,
    availability_write, requires_approval)."""
    # the endpoints of a request as a set, which their number bounds: what follows needs no other shuffle by request
    asked = request_rses.groupBy("request_id").agg(F.collect_set("rse").alias("at"))
    return (
        asked.select("request_id", F.explode("at").alias("rse"))
        .join(rses, "rse")
        .groupBy("request_id")
        .agg(
            F.count(F.lit(1)).alias("n_rses"),
            F.count_if("availability_write").alias("n_writable"),
            F.bool_or((F.col("rse_type") == "TAPE") | F.col("tier").isin(0, 3)).alias("barred"),
            F.bool_or(F.coalesce("requires_approval", F.lit(False))).alias("needs_approval"),
            F.bool_and(F.coalesce(F.col("cms_type") == "temp", F.lit(False))).alias("all_temp"),
            F.bool_or(F.col("rse").endswith("_Tape")).alias("any_tape"),
        )
    )


def with_early_reason(requests: DataFrame, facts: DataFrame, banned: DataFrame, max_lifetime: float = MAX_LIFETIME) -> DataFrame:
    """Requests with their facts, and ``early``: the first reason against one that needs no sizes."""
    early = (
        F.when(~F.coalesce("ask_approval", F.lit(False)), "ask_approval missing")
        .when(F.coalesce("barred", F.lit(False)), "tape, tier 3 or tier 0 endpoint")
        .when(F.col("is_banned").isNotNull(), "account banned")
        .when(F.coalesce("locked", F.lit(False)), "locked")
        .when(F.col("lifetime").isNull(), "no lifetime")
        .when(F.col("lifetime") > max_lifetime, "lifetime too long")
    )
    known = requests.join(facts, "request_id", "left").join(banned.select("account", F.lit(True).alias("is_banned")), "account", "left")
    return known.withColumn("early", early)


def _judged(requests: DataFrame, facts: DataFrame | None, banned: DataFrame | None, max_lifetime: float) -> DataFrame:
    if "early" in requests.columns:
        return requests
    return with_early_reason(requests, facts, banned, max_lifetime)


def names_to_size(
    requests: DataFrame, facts: DataFrame | None = None, banned: DataFrame | None = None, max_lifetime: float = MAX_LIFETIME
) -> DataFrame:
    """Names of the requests that come as far as the limits: only theirs need a size (``did_sizes``).

    ``requests`` may be what ``with_early_reason`` gave; facts, banned accounts and lifetime are in it then.
    """
    return _judged(requests, facts, banned, max_lifetime).filter("early IS NULL").select("name").distinct()


def rule_request_decision(
    requests: DataFrame, facts: DataFrame | None, banned: DataFrame | None, sizes: DataFrame, usage: DataFrame, locked: DataFrame,
    max_lifetime: float = MAX_LIFETIME, max_single_rse: float = MAX_SINGLE_RSE,
    max_account: float = MAX_ACCOUNT, max_global: float = MAX_GLOBAL,
) -> DataFrame:
    """Approve an auto-approve request, or the first reason against it.

    ``requests`` has one row per request and name: request_id, position, name, account,
    rse_expression, ask_approval, locked, lifetime.  ``usage`` comes from
    ``autoapprove_usage`` and ``locked`` from ``autoapprove_locked`` (one row, read as a
    scalar).  Limits are checked name by name in position order.  Where ``requests`` is what ``with_early_reason`` gave
    (stored, as the sizes ask for it too), facts, banned accounts and lifetime are in it.
    """
    per_account = usage.filter("whole_account = 1").select("account", F.col("bytes").alias("account_bytes"))
    per_rse = usage.filter("whole_account = 0").select("account", "rse_expression", F.col("bytes").alias("rse_bytes"))
    size, held = F.coalesce("size", F.lit(0)), lambda c: F.coalesce(c, F.lit(0))
    whole = locked.select("bytes").scalar()
    reason = (
        F.when((F.col("n_writable") == 1) & (held("rse_bytes") + size > max_single_rse), "single endpoint usage exceeded")
        .when(held("account_bytes") + size > max_account, "account usage exceeded")
        .when(whole + size > max_global, "global usage exceeded")
    )
    judged = _judged(requests, facts, banned, max_lifetime)
    out = lambda df, why: df.select("request_id", "position", why.alias("reason"))
    # only rows without an early reason travel to the sizes and the usage
    checked = out(
        judged.filter("early IS NULL")
        .join(sizes, "name", "left")
        .join(per_account, "account", "left")
        .join(per_rse, ["account", "rse_expression"], "left"),
        reason,
    ).unionByName(out(judged.filter("early IS NOT NULL"), F.col("early")))
    # min_by over failing rows only: the first name that fails decides
    return checked.groupBy("request_id").agg(
        F.coalesce(
            F.min_by("reason", F.when(F.col("reason").isNotNull(), F.col("position"))), F.lit("approved")
        ).alias("decision")
    )


def rule_add_check(requests: DataFrame, facts: DataFrame, accounts: DataFrame, admins: DataFrame) -> DataFrame:
    """The other checks on a new rule, first match wins; ``auto`` hands over to
    ``rule_request_decision``.

    ``requests``: request_id, issuer, account, activity, ask_approval, locked, lifetime.
    """
    ask, lifetime = F.coalesce("ask_approval", F.lit(False)), F.col("lifetime")
    personal = (F.col("account_type") == "USER") | F.col("account").contains("_local")
    decision = (
        F.when(~ask & F.col("needs_approval"), "refused: endpoint needs approval")
        .when(~F.col("activity").isin(*AUTO_ACTIVITIES) & ask & (F.col("n_rses") != 1), "refused: approval for one endpoint only")
        .when(F.col("activity") == AUTO_ACTIVITY, "auto")
        .when(F.col("account_type").isNotNull() & personal & lifetime.isNull(), "refused: no lifetime")
        .when((F.col("activity") == "Analysis TapeRecall") & (F.col("issuer") == RECALL_ACCOUNT), "allowed")
        .when(F.col("all_temp") & lifetime.isNotNull() & (lifetime < MAX_TEMP_LIFETIME), "allowed")
        .when(F.col("any_tape") & lifetime.isNotNull(), "refused: lifetime on tape")
        .when((F.col("account") == F.col("issuer")) & ~F.coalesce("locked", F.lit(False)), "allowed")
        .when(F.col("is_admin").isNotNull(), "allowed")
        .otherwise("refused")
    )
    return (
        requests.join(facts, "request_id", "left")
        .na.fill({"n_rses": 0, "needs_approval": False, "all_temp": True, "any_tape": False})
        .join(accounts.select("account", "account_type"), "account", "left")
        .join(admins.select(F.col("account").alias("issuer"), F.lit(True).alias("is_admin")), "issuer", "left")
        .select("request_id", decision.alias("decision"))
    )


def rule_logic_matrix(rses: Column, dids: Column, account: Column) -> Column:
    """Allow a rule when all endpoints are test-like, or the account may place anything, or
    every name is of a managed tier.  ``rses`` is an array of struct(name, cms_type)."""
    any_of = lambda col, test: F.exists(F.array(*[F.lit(x) for x in test[1]]), lambda x: test[0](col, x))
    rses_ok = F.forall(rses, lambda r: F.coalesce(r["cms_type"].isin("test", "rw"), F.lit(False)))
    account_ok = any_of(account, (lambda c, x: c.startswith(x), ANY_RULE_PREFIXES))
    tier_ok = F.forall(dids, lambda d: any_of(d, (lambda c, x: c.contains(x), MANAGED_TIERS)))
    return rses_ok | account_ok | tier_ok


def attribute_list_check(requests: DataFrame, attributes: DataFrame, key: str) -> DataFrame:
    """Whether the account of each (rse, account) stands in the endpoint's comma list ``key``."""
    listed = attributes.filter(F.col("key") == key).select("rse", F.split("value", ",").alias("_list"))
    return requests.join(listed, "rse", "left").select(
        "rse", "account", F.coalesce(F.array_contains("_list", F.col("account")), F.lit(False)).alias("allowed")
    )


def site_admin_check(requests: DataFrame, attributes: DataFrame) -> DataFrame:
    return attribute_list_check(requests, attributes, "site_admins")


def capacity_manager_check(requests: DataFrame, attributes: DataFrame) -> DataFrame:
    return attribute_list_check(requests, attributes, "site_capacity_manager")
