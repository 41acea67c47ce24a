"""Registered queries: distances, links, regions, roles, subscriptions, site entries."""

from pyspark.sql import functions as F

from ..operators import expressions as ex
from ..operators import patterns as pt
from ..operators import placement as pl
from . import registered
from .invalidation import replicas_named

_MATRIX = """
    x AS (SELECT l.src, l.dest, s.site AS s_site, d.site AS d_site, s.region AS s_region, d.region AS d_region,
                 s.country AS s_country, d.country AS d_country, s.cms_type AS s_type, d.cms_type AS d_type
          FROM links l JOIN rses s ON s.rse = l.src JOIN rses d ON d.rse = l.dest),
    m AS (SELECT *, CAST(CASE WHEN s_site = d_site THEN 1
             WHEN s_region = d_region AND s_country IS NOT DISTINCT FROM d_country THEN 4
             WHEN s_region = d_region THEN 10
             WHEN s_country IS NOT DISTINCT FROM d_country THEN 7
             WHEN (s_region = 'A' AND d_region = 'C') OR (s_region = 'C' AND d_region = 'A') THEN 11
             WHEN (s_region = 'C' AND d_region = 'D') OR (s_region = 'D' AND d_region = 'C') THEN 12 ELSE 13 END AS INTEGER) AS distance FROM x)
"""
_RULES = [
    {"src": {"rse": ".*_Tape$"}, "dest": {"cms_type": "test"}},
    {"src": {"region": "A"}, "dest": {"country": "B."}},
]
_EXCLUDED = """
    e AS (SELECT src, dest, CASE WHEN src <> dest AND ((src LIKE '%\\_Tape' ESCAPE '\\' AND d_type = 'test')
                 OR (coalesce(s_region LIKE 'A%', false) AND d_country LIKE 'B_%')) THEN -1 ELSE distance END AS distance FROM m)
"""


def _matrix(c):
    return pl.rse_distance_matrix(c.links, c.rses)


@registered("rse_distance_matrix", f"WITH {_MATRIX} SELECT src, dest, distance FROM m")
def _(c):
    return _matrix(c)


@registered("excluded_links", f"WITH {_MATRIX}, {_EXCLUDED} SELECT src, dest, distance FROM e")
def _(c):
    return pl.excluded_links(_matrix(c), c.rses, _RULES)


def _link_plan(c):
    return pl.link_plan(
        pl.excluded_links(_matrix(c), c.rses, _RULES), c.distances, overwrite=True, skip=["T0_AA_S0_Tape"],
        partners={"T1_BB_S1_Tape": ["T1_BB_S1_Disk"]},
    )


@registered(
    "link_plan",
    f"""WITH {_MATRIX}, {_EXCLUDED},
    j AS (SELECT e.src, e.dest, e.distance, n.distance AS old_distance, n.src IS NOT NULL AS known FROM e
          LEFT JOIN distances n ON n.src = e.src AND n.dest = e.dest
          WHERE e.src <> e.dest AND e.src <> 'T0_AA_S0_Tape' AND e.dest <> 'T0_AA_S0_Tape'
            AND NOT (e.src = 'T1_BB_S1_Tape' AND e.dest <> 'T1_BB_S1_Disk') AND NOT (e.dest = 'T1_BB_S1_Tape' AND e.src <> 'T1_BB_S1_Disk')),
    a AS (SELECT *, CASE WHEN distance >= 0 AND NOT known THEN 'create'
                         WHEN distance >= 0 AND old_distance IS DISTINCT FROM distance THEN 'update'
                         WHEN distance < 0 AND known AND old_distance IS NOT NULL THEN 'disable' END AS action FROM j)
    SELECT src, dest, action, old_distance, CASE WHEN distance >= 0 THEN distance END AS new_distance FROM a WHERE action IS NOT NULL""",
)
def _(c):
    return _link_plan(c)


@registered(
    "active_links",
    """SELECT src, dest, distance FROM (SELECT src, dest, distance, CASE WHEN distance IS NULL THEN 'deactivated' ELSE 'ok' END AS status
       FROM distances) WHERE status <> 'deactivated'""",
)
def _(c):
    links = c.distances.withColumn("status", F.when(F.col("distance").isNull(), "deactivated").otherwise("ok"))
    return pl.active_links(links).drop("status")


@registered(
    "region_assign",
    """WITH t AS (SELECT rse FROM rses UNION ALL SELECT rse || '_Test' FROM rses WHERE rse_type = 'DISK')
    SELECT t.rse, 'region' AS key, r.region AS value FROM t JOIN rses r ON t.rse IN (r.rse, r.rse || '_Test') WHERE r.region IS NOT NULL""",
)
def _(c):
    twins = c.rses.filter("rse_type = 'DISK'").select(F.concat("rse", F.lit("_Test")).alias("rse"))
    return pl.region_assign(
        c.rses.filter("region IS NOT NULL").select("rse", "region"), c.rses.select("rse").unionByName(twins)
    )


@registered(
    "institute_to_rse",
    """WITH p AS (SELECT country, 'Institute ' || CAST(tier AS VARCHAR) AS institute, min(rse) AS rse FROM rses WHERE tier > 0 GROUP BY 1, 2),
    u AS (SELECT account, country, CASE WHEN email IS NULL THEN '' ELSE 'Institute ' || substr(account, 2, 1) END AS institute FROM users)
    SELECT u.account, u.country, u.institute,
           CASE WHEN u.institute <> '' THEN coalesce(p.rse, CASE u.country WHEN 'AA' THEN 'T0_AA_S0' END) END AS rse
    FROM u LEFT JOIN p ON p.country = u.country AND p.institute = u.institute""",
)
def _(c):
    policy = c.rses.filter("tier > 0").select(
        "country", "rse", F.array(F.concat(F.lit("Institute "), F.col("tier").cast("string"))).alias("institutes")
    )
    users = c.users.select(
        "account",
        "country",
        F.when(F.col("email").isNull(), "").otherwise(F.concat(F.lit("Institute "), F.substring("account", 2, 1))).alias("institute"),
    )
    return pl.institute_to_rse(users, policy, {"AA": "T0_AA_S0"})


@registered(
    "site_managers_to_rse",
    """WITH l AS (SELECT site, string_agg(DISTINCT login, ',' ORDER BY login) AS site_admins FROM managers GROUP BY site)
    SELECT r.rse, lower(r.site) AS site, l.site_admins FROM rses r JOIN l ON l.site = lower(r.site)""",
)
def _(c):
    return pl.site_managers_to_rse(c.managers, c.rses)


@registered(
    "cric_site_list",
    """SELECT site, upper(site) AS facility, tier, country, site <> upper(site) AS name_mismatch
       FROM (SELECT DISTINCT site, tier, country FROM rses)""",
)
def _(c):
    return pl.site_list(c.rses.select("site", F.upper("site").alias("facility"), "tier", "country").distinct())


def _roles(c):
    tag = F.concat(F.lit("site:"), F.replace(F.lower("site"), F.lit("_"), F.lit("-")))
    group = F.concat(F.lit("group:"), F.coalesce("region", F.lit("none")))
    manager = F.col("account_type") == "GROUP"
    return c.users.select(
        F.col("account").alias("login"),
        F.concat(F.lit("/CN="), "account").alias("identity"),
        F.map_filter(
            F.create_map(
                F.lit("data-manager"), F.when(manager, F.array(tag)),
                F.lit("local-data-manager"), F.when(~manager, F.array(tag, group)),
                F.lit("group-data-manager"), F.array(group),
            ),
            lambda _, v: v.isNotNull(),
        ).alias("roles"),
    )


@registered(
    "role_members",
    """SELECT DISTINCT 'managers' AS part, lower(site) AS target, account AS member FROM users WHERE account_type = 'GROUP'
       UNION ALL SELECT DISTINCT 'local', replace(lower(site), '_', '-'), '/CN=' || account FROM users
       UNION ALL SELECT DISTINCT 'group', coalesce(region, 'none'), '/CN=' || account FROM users""",
)
def _(c):
    parts = pl.role_members(_roles(c))
    out = None
    for name, df in parts.items():
        row = df.toDF("target", "member").select(F.lit(name).alias("part"), "target", "member")
        out = row if out is None else out.unionByName(row)
    return out


@registered(
    "identity_account_map",
    """WITH s AS (SELECT '/DC=org/CN=' || account AS identity, 'special_' || country AS account FROM users WHERE region = 'A'),
    r AS (SELECT identity, account, NULL AS email FROM s
          UNION ALL SELECT '/DC=org/CN=' || account, account, email FROM users WHERE '/DC=org/CN=' || account IN (SELECT identity FROM s))
    SELECT identity, string_agg(DISTINCT account, ',' ORDER BY account) AS accounts, coalesce(max(email), 'nobody@example.org') AS email
    FROM r GROUP BY identity""",
)
def _(c):
    identity = F.concat(F.lit("/DC=org/CN="), "account").alias("identity")
    special = c.users.filter("region = 'A'").select(identity, F.concat(F.lit("special_"), "country").alias("account"))
    users = c.users.select(identity, F.col("account").alias("login"), "email")
    out = pl.identity_account_map(special, users, "nobody@example.org")
    return out.withColumn("accounts", F.array_join("accounts", ","))


_SUBSCRIPTIONS = [
    {
        "name": "nano",
        "filter": {"pattern": "^/.*/NANOAOD(|SIM)$", "did_type": "CONTAINER", "scope": ["cms"]},
        "rules": [
            {"copies": 2, "rse_expression": "region=A", "activity": "Production Output", "grouping": "ALL"},
            {"copies": 1, "rse_expression": "region=B", "activity": "Production Output", "weight": "ddm_quota"},
        ],
    },
    {
        "name": "early",
        "filter": {"pattern": "/C1.*/Era[0-3]-v1/", "account": ["u1", "prod"]},
        "rules": [{"copies": 1, "rse_expression": "region=C", "activity": "Functional Test", "lifetime": 3600}],
    },
    {"name": "nothing", "filter": {"pattern": ".*"}, "rules": None},
]


@registered(
    "subscription_match",
    """WITH d AS (SELECT DISTINCT name FROM contents WHERE did_type = 'C')
    SELECT name, 'nano' AS subscription, 0 AS position, CAST(2 AS BIGINT) AS copies, 'region=A' AS rse_expression,
           'Production Output' AS activity, 'ALL' AS "grouping", NULL::VARCHAR AS weight, NULL::BIGINT AS lifetime
    FROM d WHERE regexp_matches(name, '^/.*/NANOAOD(|SIM)$')
    UNION ALL SELECT name, 'nano', 1, 1, 'region=B', 'Production Output', NULL, 'ddm_quota', NULL FROM d WHERE regexp_matches(name, '^/.*/NANOAOD(|SIM)$')
    UNION ALL SELECT name, 'early', 0, 1, 'region=C', 'Functional Test', NULL, NULL, 3600 FROM d WHERE regexp_matches(name, '^/C1.*/Era[0-3]-v1/')""",
)
def _(c):
    dids = c.contents.filter("did_type = 'C'").select("name").distinct().select(
        "name", F.lit("CONTAINER").alias("did_type"), F.lit("cms").alias("scope"), F.lit("prod").alias("account"), F.lit("P").alias("project")
    )
    return pl.subscription_match(dids, _SUBSCRIPTIONS)


def _subscription_table(c):
    """The two subscriptions as rows, and one more for each nation, which wants containers by their number."""
    rule = "struct<copies: bigint, rse_expression: string, activity: string, grouping: string, weight: string, lifetime: bigint>"
    schema = f"subscription string, pattern string, want_type string, want_scope array<string>, want_account array<string>, want_project array<string>, rules array<{rule}>"
    rows = [
        (s["name"], s["filter"].get("pattern"), s["filter"].get("did_type"), s["filter"].get("scope"), s["filter"].get("account"), None,
         [(r["copies"], r["rse_expression"], r["activity"], r.get("grouping"), r.get("weight"), r.get("lifetime")) for r in s["rules"] or []])
        for s in _SUBSCRIPTIONS
    ]
    own = c.nation.select(
        F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("subscription"),
        F.concat(F.lit("/C"), F.col("n_nationkey").cast("string"), F.lit("/.*-v1/")).alias("pattern"),
        F.lit(None).cast("string").alias("want_type"), *(F.lit(None).cast("array<string>").alias(f"want_{k}") for k in ("scope", "account", "project")),
        F.expr("array(named_struct('copies', n_regionkey, 'rse_expression', 'tier=1', 'activity', 'Test', 'grouping', cast(null as string), "
               "'weight', cast(null as string), 'lifetime', cast(null as bigint)))").alias("rules"),
    )
    return c.spark.createDataFrame(rows, schema).unionByName(own)


@registered(
    "subscription_match_table",
    """WITH d AS (SELECT DISTINCT name FROM contents WHERE did_type = 'C')
    SELECT name, 'nano' AS subscription, 0 AS position, CAST(2 AS BIGINT) AS copies, 'region=A' AS rse_expression,
           'Production Output' AS activity, 'ALL' AS "grouping", NULL::VARCHAR AS weight, NULL::BIGINT AS lifetime
    FROM d WHERE regexp_matches(name, '^/.*/NANOAOD(|SIM)$')
    UNION ALL SELECT name, 'nano', 1, 1, 'region=B', 'Production Output', NULL, 'ddm_quota', NULL FROM d WHERE regexp_matches(name, '^/.*/NANOAOD(|SIM)$')
    UNION ALL SELECT name, 'early', 0, 1, 'region=C', 'Functional Test', NULL, NULL, 3600 FROM d WHERE regexp_matches(name, '^/C1.*/Era[0-3]-v1/')
    UNION ALL SELECT name, 'n' || n_nationkey, 0, n_regionkey, 'tier=1', 'Test', NULL, NULL, NULL FROM d, nation
              WHERE regexp_matches(name, '^/C' || n_nationkey || '/.*-v1/')""",
)
def _(c):
    dids = c.contents.filter("did_type = 'C'").select("name").distinct().select(
        "name", F.lit("CONTAINER").alias("did_type"), F.lit("cms").alias("scope"), F.lit("prod").alias("account"), F.lit("P").alias("project")
    )
    return pt.subscription_rules(dids, _subscription_table(c))


@registered(
    "excluded_links_table",
    f"""WITH {_MATRIX}
    SELECT src, dest, CASE WHEN src <> dest AND ((src LIKE '%\\_Tape' ESCAPE '\\' AND d_type = 'test')
           OR (coalesce(s_region LIKE 'A%', false) AND d_country LIKE 'B_%')
           OR EXISTS (SELECT 1 FROM nation WHERE s_site LIKE '%S' || n_nationkey || '%' AND d_country = substr(n_name, 1, 2))) THEN -1 ELSE distance END AS distance FROM m""",
)
def _(c):
    """Rules as a table: the fixed ones, and one for each nation."""
    fixed = [(f"r{i}", side, f, p) for i, r in enumerate(_RULES) for side in r for f, p in r[side].items()]
    name = F.concat(F.lit("n"), F.col("n_nationkey").cast("string"))
    own = c.nation.select(name.alias("rule_id"), F.lit("src").alias("side"), F.lit("site").alias("field"), F.concat(F.lit(".*S"), F.col("n_nationkey").cast("string")).alias("pattern")).unionByName(
        c.nation.select(name.alias("rule_id"), F.lit("dest").alias("side"), F.lit("country").alias("field"), F.concat(F.substring("n_name", 1, 2), F.lit("$")).alias("pattern"))
    )
    rules = c.spark.createDataFrame(fixed, "rule_id string, side string, field string, pattern string").unionByName(own)
    return pt.excluded_links(_matrix(c), c.rses.select("rse", "site", "cms_type", "country", "region"), rules)


# --- endpoint expressions --------------------------------------------------------------
_EXPRESSION = """CASE CAST(rule_id % 6 AS INT) WHEN 0 THEN rse_expression WHEN 1 THEN 'tier=' || CAST(rule_id % 4 AS {0}) || '&rse_type=DISK'
    WHEN 2 THEN '(tier<2|country=AA)&rse_type=TAPE' WHEN 3 THEN 'tier>1&cms_type=real|region=A' WHEN 4 THEN '*\\rse_type=TAPE' ELSE 'tier=' END"""
_MEANT = """CASE CAST(rule_id % 6 AS INT) WHEN 0 THEN rse = rse_expression WHEN 1 THEN tier = rule_id % 4 AND rse_type = 'DISK'
    WHEN 2 THEN (tier < 2 OR coalesce(country = 'AA', false)) AND rse_type = 'TAPE'
    WHEN 3 THEN (tier > 1 AND cms_type = 'real') OR coalesce(region = 'A', false) WHEN 4 THEN rse_type <> 'TAPE' ELSE false END"""


def _expression_rules(c):
    return c.rules.withColumn("rse_expression", F.expr(_EXPRESSION.format("STRING").replace("\\", "\\\\")))


def _facts(c):
    keys = ("tier", "country", "rse_type", "region", "cms_type")
    pairs = F.array(*(F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("value")) for k in keys))
    return c.rses.select("rse", F.explode(pairs).alias("a")).select("rse", "a.*").filter("value IS NOT NULL")


@registered("rule_rses", f"SELECT rule_id, rse FROM rules JOIN rses ON {_MEANT}")
def _(c):
    return ex.rule_rses(_expression_rules(c), _facts(c))


@registered(
    "rules_reaching",
    f"SELECT rule_id, account, name FROM rules JOIN rses ON {_MEANT} WHERE state = 'W' AND rse = 'T0_AA_S0'",
)
def _(c):
    return ex.rules_reaching(_expression_rules(c), _facts(c), "T0_AA_S0").select("rule_id", "account", "name")


@registered("malformed_expressions", "SELECT DISTINCT 'tier=' AS rse_expression FROM rules WHERE rule_id % 6 = 5")
def _(c):
    return ex.malformed_expressions(_expression_rules(c))


@registered(
    "site_config_select",
    """SELECT rse || '_Test' AS rse, site, true AS deterministic FROM rses
       WHERE availability_write AND tier <> 2""",
)
def _(c):
    twin = F.concat("rse", F.lit("_Test")).alias("rse")
    flagged, skip = c.rses.filter("availability_write").select(twin), c.rses.filter("tier = 2").select(twin)
    return pl.site_config_select(c.rses.select("site", "rse"), flagged, skip, "test").select("rse", "site", "deterministic")


@registered(
    "self_expression_check",
    """WITH h AS (SELECT r.rse AS k, a.rse FROM rses r LEFT JOIN attributes_now a ON a.key = r.rse)
    SELECT k AS rse, CASE WHEN count(*) FILTER (rse = k) = 0 THEN CASE WHEN count(rse) = 0 THEN 'missing' ELSE 'only elsewhere' END
                          WHEN count(rse) > 1 THEN 'also elsewhere' ELSE 'ok' END AS verdict FROM h GROUP BY k""",
)
def _(c):
    return pl.self_expression_check(c.attributes_now, c.rses)


@registered(
    "source_copy_plan",
    """SELECT c.name AS block, r.name, s.rse || '_Input' AS rse, r.bytes FROM contents c JOIN replicas r ON r.name = c.child_name
       JOIN rses s ON s.rse_id = r.rse_id WHERE c.did_type = 'D' AND r.state = 'A'""",
)
def _(c):
    return pl.source_copy_plan(c.contents, replicas_named(c))


def _blocks(c):
    return c.contents.filter("did_type = 'C'").select(F.col("name").alias("container"), F.col("child_name").alias("block"))


@registered(
    "first_n_blocks",
    """SELECT container, block FROM (SELECT name AS container, child_name AS block, row_number() OVER (PARTITION BY name ORDER BY child_name) AS n
       FROM contents WHERE did_type = 'C') WHERE n <= 3""",
)
def _(c):
    return pl.first_n_blocks(_blocks(c), 3)


@registered(
    "first_blocks_wanted",
    """SELECT container, block FROM (SELECT name AS container, child_name AS block, row_number() OVER (PARTITION BY name ORDER BY child_name) AS n
       FROM contents WHERE did_type = 'C') WHERE contains(container, 'RAW') OR n <= 2""",
)
def _(c):
    wanted = _blocks(c).select("container").distinct()
    return pl.first_blocks_wanted(_blocks(c), wanted.withColumn("nblocks", F.when(~F.col("container").contains("RAW"), 2)))
