"""Registered queries: nested contents, tape hints, approval, planned actions."""

from pyspark.sql import functions as F

from ..operators import approval as ap
from ..operators import containers as cont
from ..operators import invalidation as inv
from ..plans import actions as act
from ..session import keep_table
from . import capacity as reg_capacity
from . import placement as reg_placement
from . import registered
from .invalidation import _CDF, locks_named, replicas_named

_STATS = """
    ds AS (SELECT c.name, count(*) AS length, CAST(sum(f.bytes) AS BIGINT) AS size FROM nested_contents c JOIN files f ON f.name = c.child_name
           WHERE c.child_type = 'F' GROUP BY 1),
    cs AS (SELECT c.name, CAST(sum(length) AS BIGINT) AS length, CAST(sum(size) AS BIGINT) AS size FROM nested_contents c JOIN ds ON ds.name = c.child_name
           WHERE c.child_type = 'D' GROUP BY 1),
    ns AS (SELECT c.name, CAST(sum(length) AS BIGINT) AS length, CAST(sum(size) AS BIGINT) AS size FROM nested_contents c JOIN cs ON cs.name = c.child_name
           WHERE c.child_type = 'C' GROUP BY 1),
    stats AS (SELECT * FROM ds UNION ALL SELECT * FROM cs UNION ALL SELECT * FROM ns)
"""


@registered("container_stats", f"WITH {_STATS} SELECT * FROM stats")
def _(c):
    return cont.container_stats(c.nested_contents, c.files)


@registered(
    "container_stats_distinct",
    """WITH p AS (SELECT name, child_name AS file FROM nested_contents WHERE child_type = 'F'
             UNION SELECT a.name, b.child_name FROM nested_contents a JOIN nested_contents b ON b.name = a.child_name AND b.child_type = 'F' WHERE a.child_type = 'D'
             UNION SELECT n.name, b.child_name FROM nested_contents n JOIN nested_contents a ON a.name = n.child_name AND a.child_type = 'D'
                   JOIN nested_contents b ON b.name = a.child_name AND b.child_type = 'F' WHERE n.child_type = 'C')
    SELECT p.name, count(*) AS length, CAST(sum(bytes) AS BIGINT) AS size FROM p JOIN files f ON f.name = p.file GROUP BY 1""",
)
def _(c):
    return cont.container_stats(c.nested_contents, c.files, distinct=True)


@registered(
    "children_by_parent",
    """SELECT name, n // 5 AS chunk, string_agg(child_name, ',' ORDER BY child_name) AS children
       FROM (SELECT name, child_name, row_number() OVER (PARTITION BY name ORDER BY child_name) - 1 AS n FROM contents) GROUP BY 1, 2""",
)
def _(c):
    out = cont.children_by_parent(c.contents, chunk=5)
    return out.withColumn("children", F.array_join("children", ","))


_PARENT = """
    t AS (SELECT child_name AS name, min(name) AS dataset FROM contents WHERE did_type = 'D' GROUP BY 1),
    pa AS (SELECT t.name, split_part(t.dataset, '#', 1) AS parent FROM t)
"""


@registered("tape_parent", f"WITH {_PARENT} SELECT * FROM pa")
def _(c):
    return cont.tape_parent(c.files, c.contents)


@registered(
    "tape_hints",
    f"""WITH {_PARENT}, {_STATS}
    SELECT f.name, CASE WHEN contains(f.name, '/Parking/') THEN 'parking' WHEN contains(f.name, '/RAW/')
                        THEN CASE WHEN f.name LIKE '/store/hi%' THEN 'hiraw' ELSE 'raw' END ELSE split_part(f.name, '/', 3) END AS level_0,
           split_part(f.name, '/', 6) AS level_1, split_part(f.name, '/', 4) AS level_2, pa.parent AS level_3,
           CASE WHEN brand = 'Brand#1' THEN 'Staging' ELSE 'default' END AS activity, stats.length AS parent_length, stats.size AS parent_size,
           f.bytes AS size, f.adler32
    FROM files f LEFT JOIN pa ON pa.name = f.name LEFT JOIN stats ON stats.name = pa.parent""",
)
def _(c):
    files = c.files.select(
        "name", "bytes", F.lit(None).cast("string").alias("md5"), "adler32",
        F.when(F.col("brand") == "Brand#1", "Staging").alias("activity"),
    )
    out = cont.tape_hints(files, c.contents, c.files.select("name", "bytes"))
    level = lambda i: F.try_element_at("collocation_hints", F.lit(str(i))).alias(f"level_{i}")
    return out.select(
        "name", *[level(i) for i in range(4)], "additional_hints.activity",
        F.col("additional_hints.level_3.length").alias("parent_length"), F.col("additional_hints.level_3.size").alias("parent_size"),
        "file_metadata.size", "file_metadata.adler32",
    )


# --- approval ------------------------------------------------------------------------
_SIZES = f"""
    {_STATS},
    sz AS (SELECT name, size FROM stats UNION ALL SELECT name, bytes FROM files),
    us AS (SELECT r.account, r.rse_expression, coalesce(CAST(sum(sz.size) AS BIGINT), 0) AS bytes, grouping(r.rse_expression) AS whole_account
           FROM rules r LEFT JOIN sz ON sz.name = r.name WHERE activity = 'User AutoApprove'
           GROUP BY GROUPING SETS ((r.account), (r.account, r.rse_expression)))
"""


def _sizes(c, *more):
    """Sizes of the names under automatic rules, and of ``more``."""
    names = c.rules.filter(F.col("activity") == ap.AUTO_ACTIVITY).select("name")
    for other in more:
        names = names.union(other.select("name"))
    return ap.did_sizes(c.nested_contents, c.files, names)


@registered("account_rse_autoapprove_usage", f"WITH {_SIZES} SELECT account, rse_expression, bytes, CAST(whole_account AS INTEGER) AS whole_account FROM us")
def _(c):
    return ap.autoapprove_usage(c.rules, _sizes(c))


@registered(
    "autoapprove_locked",
    "SELECT CAST(sum(l.bytes) AS BIGINT) AS bytes FROM locks l WHERE rule_id IN (SELECT rule_id FROM rules WHERE activity = 'User AutoApprove')",
)
def _(c):
    return ap.autoapprove_locked(c.rules, c.locks)


# three in four orders ask for plain disk of one tier only, so that checks beyond the kind of endpoint are reached
_ASKED = "CASE WHEN l_orderkey % 4 = 0 THEN l_suppkey ELSE l_suppkey - l_suppkey % 12 + 1 END"

_REQUESTS = f"""
    rq AS (SELECT o_orderkey AS request_id, CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END AS position, 'u' || CAST(o_custkey AS VARCHAR) AS account,
                  CASE WHEN o_totalprice > 400000 THEN 'u' || CAST(o_custkey AS VARCHAR) WHEN o_totalprice > 300000 THEN 'crab_tape_recall' ELSE 'u1' END AS issuer,
                  o_orderpriority AS priority, o_orderpriority <> '5-LOW' AS ask_approval, o_orderpriority = '4-NOT SPECIFIED' AS locked,
                  CASE WHEN o_orderstatus = 'F' THEN NULL ELSE CAST(round(o_totalprice * 10) AS BIGINT) END AS lifetime, o_custkey FROM orders),
    fc AS (SELECT l_orderkey AS request_id, count(*) AS n_rses, count(*) FILTER (availability_write) AS n_writable,
                  bool_or(rse_type = 'TAPE' OR tier IN (0, 3)) AS barred, bool_or(tier = 1 AND rse_type = 'TAPE') AS needs_approval,
                  false AS all_temp, bool_or(rse LIKE '%\\_Tape' ESCAPE '\\') AS any_tape
           FROM (SELECT DISTINCT l_orderkey, {_ASKED} AS asked FROM lineitem) JOIN rses ON rse_id = asked GROUP BY 1)
"""


def _requests(c):
    return c.sql(
        """SELECT o_orderkey AS request_id, CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END AS position,
                  'u' || CAST(o_custkey AS STRING) AS account,
                  CASE WHEN o_totalprice > 400000 THEN 'u' || CAST(o_custkey AS STRING) WHEN o_totalprice > 300000 THEN 'crab_tape_recall' ELSE 'u1' END AS issuer,
                  o_orderpriority AS priority, o_orderpriority <> '5-LOW' AS ask_approval, o_orderpriority = '4-NOT SPECIFIED' AS locked,
                  CASE WHEN o_orderstatus = 'F' THEN NULL ELSE CAST(round(o_totalprice * 10) AS BIGINT) END AS lifetime FROM orders"""
    )


def _facts(c):
    rses = c.rses.withColumn("requires_approval", F.expr("tier = 1 AND rse_type = 'TAPE'"))
    request_rses = c.sql(f"SELECT l_orderkey AS request_id, rse FROM lineitem JOIN rses ON rse_id = {_ASKED}")
    return ap.request_rse_facts(request_rses, rses)


@registered("request_rse_facts", f"WITH {_REQUESTS} SELECT * FROM fc")
def _(c):
    return _facts(c)


def _decision_sql(single, account, whole):
    return f"""SELECT rr.request_id,
        CASE WHEN NOT ask_approval THEN 'ask_approval missing' WHEN coalesce(fc.barred, false) THEN 'tape, tier 3 or tier 0 endpoint'
             WHEN rr.account IN (SELECT account FROM accounts WHERE email IS NULL) THEN 'account banned' WHEN locked THEN 'locked'
             WHEN lifetime IS NULL THEN 'no lifetime' WHEN lifetime > 30 * 24 * 3600 THEN 'lifetime too long'
             WHEN fc.n_writable = 1 AND coalesce(b.bytes, 0) + coalesce(sz.size, 0) > {single} THEN 'single endpoint usage exceeded'
             WHEN coalesce(a.bytes, 0) + coalesce(sz.size, 0) > {account} THEN 'account usage exceeded'
             WHEN lk.bytes + coalesce(sz.size, 0) > {whole} THEN 'global usage exceeded'
             ELSE 'approved' END AS decision
      FROM rr LEFT JOIN fc ON fc.request_id = rr.request_id LEFT JOIN sz ON sz.name = rr.name
      LEFT JOIN us a ON a.account = rr.account AND a.whole_account = 1
      LEFT JOIN us b ON b.account = rr.account AND b.rse_expression = rr.rse_expression AND b.whole_account = 0
      CROSS JOIN (SELECT coalesce(sum(bytes), 0) AS bytes FROM locks
                  WHERE rule_id IN (SELECT rule_id FROM rules WHERE activity = 'User AutoApprove')) lk"""


_ASKING = f"{_SIZES}, {_REQUESTS}, rr AS (SELECT rq.*, r.name, r.rse_expression FROM rq JOIN rules r ON r.rule_id = rq.request_id)"
# limits that are reached on small tables, without and with the global one
_SMALL = {"open": (9e6, 2e7, 1e16), "full": (9e6, 2e7, 1e3)}


def _decisions(c, *each):
    """Decisions under ``each`` of the limits; what does not depend on them is worked out once."""
    requests = _requests(c).join(c.rules.select(F.col("rule_id").alias("request_id"), "name", "rse_expression"), "request_id")
    banned = c.accounts.filter("email IS NULL").select("account").distinct()
    # the names to size are a job of their own: stored, so that facts and reasons are not worked out again after it
    judged = keep_table(ap.with_early_reason(requests, _facts(c), banned), "judged")
    sizes = _sizes(c, ap.names_to_size(judged))
    usage, locked = ap.autoapprove_usage(c.rules, sizes), ap.autoapprove_locked(c.rules, c.locks)
    named = [dict(zip(("max_single_rse", "max_account", "max_global"), limits)) for limits in each]
    return [ap.rule_request_decision(judged, None, None, sizes, usage, locked, **n) for n in named]


@registered("rule_request_decision", f"WITH {_ASKING} {_decision_sql(50e12, 1e15, 1e16)}")
def _(c):
    return _decisions(c, ())[0]


@registered(
    "rule_request_decision_limits",
    f"WITH {_ASKING} " + " UNION ALL ".join(f"SELECT '{k}' AS limits, * FROM ({_decision_sql(*v)})" for k, v in _SMALL.items()),
)
def _(c):
    open_, full = (d.withColumn("limits", F.lit(k)) for k, d in zip(_SMALL, _decisions(c, *_SMALL.values())))
    return open_.unionByName(full)


@registered(
    "rule_add_check",
    f"""WITH {_REQUESTS}, q AS (SELECT rq.*, CASE priority WHEN '1-URGENT' THEN 'User AutoApprove' WHEN '2-HIGH' THEN 'Analysis TapeRecall' ELSE 'Staging' END AS activity FROM rq)
    SELECT q.request_id, CASE
        WHEN NOT ask_approval AND coalesce(fc.needs_approval, false) THEN 'refused: endpoint needs approval'
        WHEN activity = 'Staging' AND ask_approval AND coalesce(fc.n_rses, 0) <> 1 THEN 'refused: approval for one endpoint only'
        WHEN activity = 'User AutoApprove' THEN 'auto'
        WHEN a.account_type IS NOT NULL AND (a.account_type = 'USER' OR contains(q.account, '_local')) AND lifetime IS NULL THEN 'refused: no lifetime'
        WHEN activity = 'Analysis TapeRecall' AND q.issuer = 'crab_tape_recall' THEN 'allowed'
        WHEN coalesce(fc.all_temp, true) AND lifetime IS NOT NULL AND lifetime < 31 * 86400 THEN 'allowed'
        WHEN coalesce(fc.any_tape, false) AND lifetime IS NOT NULL THEN 'refused: lifetime on tape'
        WHEN q.account = q.issuer AND NOT locked THEN 'allowed'
        WHEN q.issuer IN (SELECT account FROM accounts WHERE email IS NULL) THEN 'allowed' ELSE 'refused' END AS decision
    FROM q LEFT JOIN fc ON fc.request_id = q.request_id LEFT JOIN accounts a ON a.account = q.account""",
)
def _(c):
    activity = F.when(F.col("priority") == "1-URGENT", "User AutoApprove").when(F.col("priority") == "2-HIGH", "Analysis TapeRecall").otherwise("Staging")
    return ap.rule_add_check(
        _requests(c).withColumn("activity", activity), _facts(c), c.accounts, c.accounts.filter("email IS NULL").select("account")
    )


@registered(
    "rule_logic_matrix",
    """SELECT rule_id, account LIKE 'u1%' OR (contains(rse_expression, '_Test')) OR contains(name, '/NANOAOD') AS allowed FROM rules""",
)
def _(c):
    kind = F.when(F.col("rse_expression").contains("_Test"), "test")
    rses = F.array(F.struct(F.col("rse_expression").alias("name"), kind.alias("cms_type")))
    account = F.when(F.col("account").startswith("u1"), F.concat(F.lit("sync_"), "account")).otherwise(F.col("account"))
    return c.rules.select("rule_id", ap.rule_logic_matrix(rses, F.array("name"), account).alias("allowed"))


def _list_check(key):
    return f"""SELECT u.rse, u.account, coalesce(list_contains(string_split(a.value, ','), u.account), false) AS allowed
        FROM (SELECT rse, 'u' || CAST(rse_id AS VARCHAR) AS account FROM rses UNION ALL SELECT rse, 'u1' FROM rses) u
        LEFT JOIN attributes_now a ON a.rse = u.rse AND a.key = '{key}'"""


def _who(c):
    own = F.concat(F.lit("u"), F.col("rse_id").cast("string"))
    return c.rses.select("rse", F.explode(F.array(own, F.lit("u1"))).alias("account"))


@registered("site_admin_check", _list_check("site_admins"))
def _(c):
    return ap.site_admin_check(_who(c), c.attributes_now)


@registered("capacity_manager_check", _list_check("site_capacity_manager"))
def _(c):
    return ap.capacity_manager_check(_who(c), c.attributes_now)


# --- planned actions -----------------------------------------------------------------
def _args(df):
    """Arguments as sorted ``key=value`` text, so that rows compare as plain values."""
    text = F.array_join(F.array_sort(F.transform(F.map_entries("args"), lambda e: F.concat_ws("=", e["key"], e["value"]))), ",")
    return df.withColumn("args", text)


@registered(
    "invalidation_actions",
    f"""WITH {_CDF},
    de AS (SELECT cdf.file, rr.rse, ru.rule_id, ru.state, ru.did_type
           FROM (SELECT name FROM files) n JOIN cdf ON cdf.file = n.name LEFT JOIN rr ON rr.name = cdf.file
           LEFT JOIN ll ON ll.name = cdf.file AND ll.rse = rr.rse LEFT JOIN rules ru ON ru.rule_id = ll.rule_id),
    a AS (SELECT DISTINCT 0 AS position, 'delete_rule' AS kind, CAST(rule_id AS VARCHAR) AS name, rse, 'purge=' || CAST(contains(rse, 'Tape') AS VARCHAR) AS args FROM de WHERE did_type = 'F'
          UNION ALL SELECT DISTINCT 1, 'declare_bad', file, rse, 'force=true' FROM de WHERE rse IS NOT NULL
          UNION ALL SELECT DISTINCT 2, 'expire_did', name, NULL, 'lifetime=86400' FROM contents WHERE did_type = 'D'
          UNION ALL SELECT DISTINCT 3, 'stuck_rule', CAST(rule_id AS VARCHAR), NULL, 'state=STUCK' FROM de WHERE state = 'U')
    SELECT CAST(position AS INTEGER) AS position, kind, 'cms' AS scope, name, rse, args, 'File Invalidation Tool - lost' AS reason FROM a""",
)
def _(c):
    lists = inv.invalidate_files(c.files.select("name"), c.contents, replicas_named(c), locks_named(c), c.rules)
    erase = c.contents.filter("did_type = 'D'").select("name").distinct()
    return _args(act.invalidation_actions(lists, "lost", erase))


@registered(
    "invalidation_plan_by_mode",
    f"""WITH {_CDF},
    de AS (SELECT cdf.container, cdf.dataset, cdf.file, rr.rse, ll.rule_id
           FROM cdf JOIN rr ON rr.name = cdf.file LEFT JOIN ll ON ll.name = cdf.file AND ll.rse = rr.rse),
    site AS (SELECT DISTINCT file FROM de WHERE rse = 'T0_AA_S0'),
    stuck AS (SELECT DISTINCT CAST(de.rule_id AS VARCHAR) AS name FROM de JOIN rules ru ON ru.rule_id = de.rule_id
              WHERE ru.state = 'U' AND de.file IN (SELECT name FROM files)),
    a AS (SELECT DISTINCT 'global' AS mode, 0 AS position, 'delete_rule' AS kind, CAST(rule_id AS VARCHAR) AS name, rse,
                 'purge=' || CAST(contains(rse, 'Tape') AS VARCHAR) AS args FROM de WHERE rule_id IS NOT NULL
          UNION ALL SELECT DISTINCT m.mode, 1, 'declare_bad', file, rse, 'force=true' FROM de, (VALUES ('global'), ('catalogue-only')) m(mode)
          UNION ALL SELECT DISTINCT m.mode, 1, 'invalidate', x.name, NULL, 'valid=0'
                    FROM (SELECT file AS name FROM de UNION SELECT name FROM contents WHERE did_type = 'C') x, (VALUES ('global'), ('bookkeeping-only')) m(mode)
          UNION ALL SELECT 'global', 2, 'expire_did', name, NULL, 'lifetime=86400'
                    FROM (SELECT name FROM contents WHERE did_type = 'C' UNION SELECT dataset FROM de)
          UNION ALL SELECT 'site-invalidation', 1, 'declare_bad', file, 'T0_AA_S0', 'force=true' FROM site WHERE file IN (SELECT name FROM files)
          UNION ALL SELECT 'site-invalidation', 1, 'invalidate', file, NULL, 'valid=0' FROM site
                    WHERE file IN (SELECT name FROM files) AND NOT EXISTS
                          (SELECT 1 FROM rr WHERE rr.name = site.file AND rr.state IN ('A', 'T') AND rr.rse <> 'T0_AA_S0')
          UNION ALL SELECT 'site-invalidation', 3, 'stuck_rule', name, NULL, 'state=STUCK' FROM stuck)
    SELECT mode, CAST(position AS INTEGER) AS position, kind, 'cms' AS scope, name, rse, args, 'File Invalidation Tool - lost' AS reason FROM a""",
)
def _(c):
    names = c.contents.filter("did_type = 'C'").select("name").distinct()
    replicas, locks = replicas_named(c), locks_named(c)
    # step by step, each stored: the shuffles of all steps at once are many times the tables
    whole = inv.invalidate_containers(names, c.contents, replicas, locks, stored=True)
    whole |= {step: keep_table(whole[step], step) for step in ("datasets", "rules")}
    files = c.files.select("name")
    single = inv.invalidate_files(files, c.contents, replicas, locks, c.rules, stored=True)
    plans = {
        "global": act.invalidation_plan_by_mode("global", "container", names, whole, "lost", erase=True),
        "catalogue-only": act.invalidation_plan_by_mode("catalogue-only", "container", names, whole, "lost"),
        "bookkeeping-only": act.invalidation_plan_by_mode("bookkeeping-only", "container", names, whole, "lost"),
        "site-invalidation": act.invalidation_plan_by_mode(
            "site-invalidation", "file", files, single, "lost", site="T0_AA_S0", last_replicas=replicas
        ),
    }
    out = None
    for mode, plan in plans.items():
        part = plan.withColumn("mode", F.lit(mode))
        out = part if out is None else out.unionByName(part)
    return _args(out)


@registered(
    "capacity_actions",
    f"""WITH {reg_capacity._PLAN}
    SELECT 9 AS position, 'set_usage' AS kind, 'cms' AS scope, 'static' AS name, rse, 'used=' || CAST(CAST(floor(new_static) AS BIGINT) AS VARCHAR) AS args, '' AS reason FROM plan
    UNION ALL SELECT 9, 'set_limit', 'cms', 'MinFreeSpace', rse, 'value=' || CAST(new_limit AS VARCHAR), '' FROM plan WHERE new_limit IS NOT NULL""",
)
def _(c):
    return _args(act.capacity_actions(reg_capacity.capacity_plan(c)))


@registered(
    "weight_actions",
    reg_capacity._weight_sql(reg_capacity._DISK, 0.35, 0.35, 0.3, 2)
    + """, n AS (SELECT unnest(['dm_weight', 'ddm_quota']) AS name)
    SELECT 9 AS position, 'set_attribute' AS kind, 'cms' AS scope, n.name, x.rse, 'value' AS args, '' AS reason FROM x, n""",
)
def _(c):
    out = act.weight_actions(reg_capacity._disk_weights(c))
    return out.withColumn("args", F.array_join(F.map_keys("args"), ","))


@registered(
    "link_actions",
    f"""WITH {reg_placement._MATRIX}, {reg_placement._EXCLUDED},
    j AS (SELECT e.src, e.dest, e.distance, n.distance AS old_distance, n.src IS NOT NULL AS known FROM e
          LEFT JOIN distances n ON n.src = e.src AND n.dest = e.dest
          WHERE e.src <> e.dest AND e.src <> 'T0_AA_S0_Tape' AND e.dest <> 'T0_AA_S0_Tape'
            AND NOT (e.src = 'T1_BB_S1_Tape' AND e.dest <> 'T1_BB_S1_Disk') AND NOT (e.dest = 'T1_BB_S1_Tape' AND e.src <> 'T1_BB_S1_Disk')),
    a AS (SELECT *, CASE WHEN distance >= 0 AND NOT known THEN 'create' WHEN distance >= 0 AND old_distance IS DISTINCT FROM distance THEN 'update'
                         WHEN distance < 0 AND known AND old_distance IS NOT NULL THEN 'disable' END AS action FROM j)
    SELECT 9 AS position, 'set_distance' AS kind, 'cms' AS scope, src AS name, dest AS rse,
           'action=' || action || ',distance=' || CASE WHEN distance >= 0 THEN CAST(distance AS VARCHAR) ELSE 'none' END AS args, '' AS reason
    FROM a WHERE action IS NOT NULL""",
)
def _(c):
    return _args(act.link_actions(reg_placement._link_plan(c)))


@registered(
    "availability_actions",
    f"""WITH {reg_capacity._SWITCHES}
    SELECT 9 AS position, 'set_availability' AS kind, 'cms' AS scope, rse AS name, rse,
           'availability_delete=' || availability_delete || ',availability_read=' || availability_read || ',availability_write=' || availability_write AS args,
           '' AS reason FROM sw""",
)
def _(c):
    return _args(act.availability_actions(reg_capacity._availability(c)))


@registered(
    "test_quota_plan",
    """SELECT 9 AS position, 'set_quota' AS kind, 'cms' AS scope, 'ops' AS name, rse, 'bytes=10000000000000' AS args, '' AS reason
       FROM rses WHERE cms_type = 'test'""",
)
def _(c):
    return _args(act.fixed_quota_plan(c.rses, "ops"))


@registered(
    "wan_priority_plan",
    """SELECT rse, scheme, CAST(5 AS INTEGER) AS "read", CAST(read_priority AS INTEGER) AS "write", CAST(0 AS INTEGER) AS third_party_copy,
              CAST(read_priority AS INTEGER) AS "delete" FROM protocols_wanted WHERE scheme IN ('root', 'davs')""",
)
def _(c):
    ops = ("read", "write", "third_party_copy", "delete")
    protocols = c.protocols_wanted.select("rse", "scheme", F.struct(*[F.col("read_priority").cast("int").alias(o) for o in ops]).alias("wan"))
    return act.wan_priority_plan(protocols, ["root", "davs"], read=5, third_party_copy=0).select("rse", "scheme", "wan.*")


@registered(
    "registration_plan",
    """WITH f AS (SELECT '/store/group/x/' || mode || '/P' || status || '/MINI/v1/' || CAST(id AS VARCHAR) || '.root' AS file,
                      '/P' || status || '/' || mode || '-v1/USER' AS container FROM inv_requests),
    n AS (SELECT *, (row_number() OVER (PARTITION BY container ORDER BY file) - 1) // 100 AS chunk FROM f),
    b AS (SELECT *, container || '#' || md5(container || '|' || CAST(chunk AS VARCHAR)) AS block FROM n),
    a AS (SELECT DISTINCT 0 AS position, 'add_did' AS kind, container AS name, 'type=CONTAINER' AS args FROM b
          UNION ALL SELECT DISTINCT 1, 'add_did', block, 'type=DATASET' FROM b UNION ALL SELECT DISTINCT 2, 'attach', block, 'to=' || container FROM b
          UNION ALL SELECT DISTINCT 3, 'add_did', file, 'type=FILE' FROM b UNION ALL SELECT DISTINCT 4, 'attach', file, 'to=' || block FROM b)
    SELECT CAST(position AS INTEGER) AS position, kind, 'user.x' AS scope, name, NULL::VARCHAR AS rse, args, '' AS reason FROM a""",
)
def _(c):
    path = F.concat(F.lit("/store/group/x/"), "mode", F.lit("/P"), "status", F.lit("/MINI/v1/"), F.col("id").cast("string"), F.lit(".root"))
    return _args(act.registration_plan(c.inv_requests.select(path.alias("path")), "/store/group/x", "user.x"))
