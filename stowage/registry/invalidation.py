"""Registered queries: scans with names, invalidation lists, rules, tape files."""

from pyspark.sql import functions as F

from ..operators import invalidation as inv
from . import registered

_CDF = """
    cdf AS (SELECT c.name AS container, c.child_name AS dataset, f.child_name AS file
            FROM contents c LEFT JOIN contents f
              ON f.name = c.child_name AND f.did_type = 'D' AND f.child_type = 'F'
            WHERE c.did_type = 'C' AND c.child_type = 'D'),
    rr AS (SELECT a.name, a.rse_id, a.state, b.rse FROM replicas a JOIN rses b ON a.rse_id = b.rse_id),
    ll AS (SELECT a.name, a.rule_id, a.state, b.rse FROM locks a JOIN rses b ON a.rse_id = b.rse_id)
"""


def replicas_named(c):
    return c.replicas.join(c.rses.select("rse_id", "rse"), "rse_id")


def locks_named(c):
    return c.locks.join(c.rses.select("rse_id", "rse"), "rse_id")


def stamp(name):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


@registered(
    "locks_with_rse",
    "SELECT l.name, l.rse_id, l.rule_id, l.state AS lock_state, l.bytes, r.rse "
    "FROM locks l JOIN rses r ON l.rse_id = r.rse_id",
)
def _(c):
    return inv.locks_with_rse(c.locks, c.rses)


@registered(
    "replicas_with_rse",
    """SELECT a.rse_id, a.name, a.bytes, a.state AS replica_state,
              strftime(make_timestamp(a.tombstone * 1000), '%Y-%m-%d') AS tombstone, b.rse
       FROM replicas a JOIN rses b ON a.rse_id = b.rse_id""",
)
def _(c):
    return inv.replicas_with_rse(c.replicas, c.rses)


@registered(
    "replicas_with_rse_one",
    """SELECT a.rse_id, a.name, a.bytes, a.state AS replica_state,
              strftime(make_timestamp(a.tombstone * 1000), '%Y-%m-%d') AS tombstone, b.rse
       FROM replicas a JOIN rses b ON a.rse_id = b.rse_id WHERE b.rse = 'T0_AA_S0'""",
)
def _(c):
    return inv.replicas_with_rse(c.replicas, c.rses, rse="T0_AA_S0")


# ordered, as the checking engine does not end this join under a limit in several threads
@registered("container_dataset_file", f"WITH {_CDF} SELECT container, dataset, file FROM cdf ORDER BY ALL")
def _(c):
    return inv.container_dataset_file(c.contents)


@registered(
    "replica_rse_list",
    f"WITH {_CDF} SELECT name, string_agg(DISTINCT rse, ';' ORDER BY rse) AS rses FROM rr GROUP BY name",
)
def _(c):
    return inv.replica_rse_list(replicas_named(c))


def _stack(lists):
    """One frame over all lists of an invalidation: kind, name, rse."""
    out = None
    for kind, df in lists.items():
        row = df.select(
            F.lit(kind).alias("kind"),
            F.col("rule_id" if "rule_id" in df.columns else "name").cast("string").alias("name"),
            (F.col("rses") if "rses" in df.columns else F.col("rse") if "rse" in df.columns else F.lit("")).alias("rse"),
        )
        out = row if out is None else out.unionByName(row)
    return out


@registered(
    "invalidate_containers",
    f"""WITH {_CDF},
    de AS (SELECT cdf.container, cdf.dataset, cdf.file, rr.rse, ll.rule_id
           FROM (SELECT DISTINCT name FROM contents WHERE did_type = 'C') n
           JOIN cdf ON cdf.container = n.name JOIN rr ON rr.name = cdf.file
           LEFT JOIN ll ON ll.name = cdf.file AND ll.rse = rr.rse)
    SELECT DISTINCT 'files' AS kind, file AS name, '' AS rse FROM de
    UNION ALL SELECT 'replicas', file, string_agg(DISTINCT rse, ';' ORDER BY rse) FROM de GROUP BY file
    UNION ALL SELECT DISTINCT 'datasets', dataset, '' FROM de
    UNION ALL SELECT DISTINCT 'rules', CAST(rule_id AS VARCHAR), rse FROM de WHERE rule_id IS NOT NULL""",
)
def invalidate_containers(c):
    names = c.contents.filter("did_type = 'C'").select("name").distinct()
    return _stack(inv.invalidate_containers(names, c.contents, replicas_named(c), locks_named(c), stored=True))


@registered(
    "invalidate_datasets",
    f"""WITH {_CDF},
    de AS (SELECT cdf.file, rr.rse, ru.rule_id
           FROM (SELECT DISTINCT name FROM contents WHERE did_type = 'D') n
           JOIN cdf ON cdf.dataset = n.name JOIN rr ON rr.name = cdf.file
           LEFT JOIN ll ON ll.name = cdf.file AND ll.rse = rr.rse
           LEFT JOIN (SELECT rule_id FROM rules WHERE did_type IN ('D', 'F')) ru ON ru.rule_id = ll.rule_id)
    SELECT DISTINCT 'files' AS kind, file AS name, '' AS rse FROM de
    UNION ALL SELECT 'replicas', file, string_agg(DISTINCT rse, ';' ORDER BY rse) FROM de GROUP BY file
    UNION ALL SELECT DISTINCT 'rules', CAST(rule_id AS VARCHAR), rse FROM de WHERE rule_id IS NOT NULL""",
)
def _(c):
    names = c.contents.filter("did_type = 'D'").select("name").distinct()
    return _stack(inv.invalidate_datasets(names, c.contents, replicas_named(c), locks_named(c), c.rules))


@registered(
    "invalidate_files",
    f"""WITH {_CDF},
    de AS (SELECT cdf.file, rr.rse, ru.rule_id, ru.state, ru.did_type
           FROM (SELECT name FROM files) n
           JOIN cdf ON cdf.file = n.name LEFT JOIN rr ON rr.name = cdf.file
           LEFT JOIN ll ON ll.name = cdf.file AND ll.rse = rr.rse
           LEFT JOIN rules ru ON ru.rule_id = ll.rule_id)
    SELECT 'replicas' AS kind, file AS name, coalesce(string_agg(DISTINCT rse, ';' ORDER BY rse), '') AS rse
      FROM de GROUP BY file
    UNION ALL SELECT DISTINCT 'rules', CAST(rule_id AS VARCHAR), rse FROM de WHERE did_type = 'F'
    UNION ALL SELECT DISTINCT 'rules_stuck', CAST(rule_id AS VARCHAR), '' FROM de WHERE state = 'U'""",
)
def _(c):
    return _stack(inv.invalidate_files(c.files.select("name"), c.contents, replicas_named(c), locks_named(c), c.rules))


def _bad_targets(c):
    return inv.replica_rse_list(replicas_named(c).filter("state = 'B'"))


@registered(
    "last_replica_files",
    f"""WITH {_CDF},
    target AS (SELECT name, string_agg(DISTINCT rse, ';' ORDER BY rse) AS rses FROM rr WHERE state = 'B' GROUP BY name)
    SELECT name, rses,
           NOT EXISTS (SELECT 1 FROM rr WHERE rr.name = target.name AND rr.state IN ('A', 'T')
                       AND NOT list_contains(string_split(target.rses, ';'), rr.rse)) AS last_replica
    FROM target""",
)
def _(c):
    return inv.last_replica_files(_bad_targets(c), replicas_named(c))


def _requested_bad(c):
    """Replicas reported through locks, some at endpoints that hold no such replica."""
    return locks_named(c).filter("state <> 'O'").select("rse", "scope", "name").distinct()


@registered(
    "bad_replica_triage",
    f"""WITH {_CDF}
    SELECT q.rse, q.scope, q.name,
           CASE WHEN NOT EXISTS (SELECT 1 FROM rr WHERE rr.rse = q.rse AND rr.name = q.name AND rr.state <> 'C')
                     AND NOT EXISTS (SELECT 1 FROM rr WHERE rr.rse = q.rse AND rr.name = q.name AND rr.state = 'B')
                THEN 'Unknown replica'
                WHEN EXISTS (SELECT 1 FROM rr WHERE rr.rse = q.rse AND rr.name = q.name AND rr.state = 'B')
                THEN 'Already declared' ELSE 'declare' END AS outcome
    FROM (SELECT DISTINCT rse, 'cms' AS scope, name FROM ll WHERE state <> 'O') q""",
)
def _(c):
    named = replicas_named(c)
    return inv.bad_replica_triage(_requested_bad(c), named.filter("state <> 'C'"), named.filter("state = 'B'"))


@registered(
    "rules_by_state_age",
    """SELECT rule_id, account, name, strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at, rse_expression
       FROM rules WHERE state IN ('R', 'S', 'U', 'I', 'W')
         AND created_at < TIMESTAMP '1999-01-01 00:00:00' - INTERVAL 30 DAY AND contains(rse_expression, '_Tape')""",
)
def _(c):
    now = F.lit("1999-01-01 00:00:00").cast("timestamp_ntz")
    out = inv.rules_by_state_age(c.rules, "ALL", now, days=30, rse="_Tape")
    return out.withColumn("updated_at", stamp("updated_at"))


@registered("rules_by_did_type", "SELECT rule_id, name, did_type FROM rules WHERE did_type IN ('D', 'F')")
def _(c):
    return inv.rules_by_did_type(c.rules)


@registered("rules_suspended", "SELECT DISTINCT rule_id FROM rules WHERE state = 'U'")
def _(c):
    return inv.rules_suspended(c.rules)


@registered(
    "rules_waiting_approval",
    """SELECT t.rule_id, CASE WHEN r.state IS NULL THEN 'unknown' WHEN r.state = 'W' THEN 'approve'
              ELSE 'not_needed' END AS decision
       FROM (SELECT DISTINCT l_partkey AS rule_id FROM lineitem
             UNION SELECT -1 - l_partkey FROM lineitem) t LEFT JOIN rules r ON r.rule_id = t.rule_id""",
)
def _(c):
    ids = c.sql("SELECT l_partkey AS rule_id FROM lineitem UNION SELECT -1 - l_partkey FROM lineitem")
    return inv.rules_waiting_approval(ids, c.rules)


@registered(
    "rules_touching_rse",
    f"""WITH {_CDF}
    SELECT rule_id, account, name FROM rules
    WHERE state = 'W' AND rule_id IN (SELECT rule_id FROM ll WHERE rse = 'T0_AA_S0')""",
)
def _(c):
    rule_rses = locks_named(c).select("rule_id", "rse")
    return inv.rules_touching_rse(c.rules, rule_rses, "T0_AA_S0").select("rule_id", "account", "name")


@registered(
    "campaign_cleanup_rules",
    """SELECT 'subscription' AS origin, rule_id, name, rse_expression FROM rules WHERE subscription = 'Placement'
       UNION ALL
       SELECT 'test', rule_id, name, rse_expression FROM rules
       WHERE rse_expression LIKE '%\\_Test' ESCAPE '\\' AND rse_expression NOT LIKE '%\\_Tape\\_Test' ESCAPE '\\'
         AND name IN (SELECT child_name FROM contents WHERE did_type = 'C'
                      UNION SELECT split_part(child_name, '#', 1) FROM contents WHERE did_type = 'C')""",
)
def _(c):
    blocks = c.contents.filter("did_type = 'C'").select(F.col("child_name").alias("name"))
    part = lambda origin, df: df.select(F.lit(origin).alias("origin"), "rule_id", "name", "rse_expression")
    return part("subscription", inv.campaign_cleanup_rules(c.rules, "Placement")).unionByName(
        part("test", inv.placement_test_cleanup_rules(c.rules, blocks))
    )


@registered(
    "subscription_rules",
    """SELECT * FROM (
         SELECT rule_id, '{"id" : ' || rule_id || ' ,  "rse_expression" : ' || rse_expression || ' , "name" : ' || name
                || ' , "state" : ' || state || ' , "stuck_at" : '
                || coalesce(strftime(stuck_at, '%Y-%m-%d %H:%M:%S'), 'None') || '}' AS line
         FROM rules WHERE subscription = 'ProductionNanoAOD') WHERE contains(line, '_Tape')""",
)
def _(c):
    rules = c.rules.withColumn("stuck_at", stamp("stuck_at"))
    return inv.subscription_rules(rules, "ProductionNanoAOD", "_Tape")


@registered(
    "rule_pending_requests",
    f"""WITH {_CDF}
    SELECT ll.rule_id, 'cms' AS scope, ll.name, ll.rse, q.request_id,
           replace(q.external_host, '8446', '8449') || '/fts3/ftsmon/#/job/' || q.external_id AS monitor_url
    FROM ll JOIN requests q ON q.name = ll.name AND q.dest_rse = ll.rse
    WHERE ll.state = 'R'""",
)
def _(c):
    out = inv.rule_pending_requests(locks_named(c), c.requests)
    return out.select("rule_id", "scope", "name", "rse", "request_id", "monitor_url")


@registered(
    "stuck_tape_files",
    """SELECT r.scope, r.name, s.rse, r.adler32, r.bytes, l.rule_id, u.state AS rule_state
       FROM locks l JOIN replicas r ON l.scope = r.scope AND l.name = r.name AND l.rse_id = r.rse_id
       JOIN rules u ON u.rule_id = l.rule_id JOIN rses s ON s.rse_id = l.rse_id
       WHERE r.state IN ('C', 'U') AND s.rse_type = 'TAPE' AND u.state IN ('S', 'U') AND l.state = 'S'
         AND u.error = 'RequestErrMsg.TRANSFER_FAILED:DESTINATION [17] Destination file exists and overwrite is not enabled'""",
)
def _(c):
    return inv.stuck_tape_files(c.locks, c.replicas, c.rules, c.rses)


_STAT = """
    st AS (SELECT r.scope, r.name, s.rse, r.adler32, r.bytes, l.rule_id, u.state AS rule_state
           FROM locks l JOIN replicas r ON l.name = r.name AND l.rse_id = r.rse_id
           JOIN rules u ON u.rule_id = l.rule_id JOIN rses s ON s.rse_id = l.rse_id
           WHERE r.state IN ('C', 'U') AND s.rse_type = 'TAPE' AND u.state IN ('S', 'U') AND l.state = 'S'
             AND u.error IS NOT NULL),
    v AS (SELECT st.*, CASE WHEN g.size IS NULL THEN 'not_found' WHEN g.size <> st.bytes THEN 'size_mismatch'
                 WHEN ltrim(lower(g.checksum), '0') <> ltrim(lower(st.adler32), '0') THEN 'checksum_mismatch'
                 WHEN NOT contains(g.locality, 'NEARLINE') THEN 'not_archived' ELSE 'ok' END AS verdict
          FROM st LEFT JOIN storage_listing g ON g.rse = st.rse AND g.name = st.name)
"""


@registered(
    "tape_stat_check",
    f"""WITH {_STAT}
    SELECT rse, scope, name, rule_id, verdict, CASE WHEN verdict = 'ok' THEN 'A' END AS new_state,
           CASE WHEN verdict = 'ok' AND rule_state = 'U' THEN 'STUCK' END AS rule_action FROM v""",
)
def _(c):
    return inv.tape_stat_check(inv.stuck_tape_files(c.locks, c.replicas, c.rules, c.rses), c.storage_listing)


@registered(
    "tape_stat_summary",
    f"""WITH {_STAT}
    SELECT rse, CAST(count(*) FILTER (verdict = 'ok') AS BIGINT) AS replicas,
           CAST(count(*) FILTER (verdict <> 'ok') AS BIGINT) AS rejected,
           CAST(count(DISTINCT rule_id) FILTER (verdict = 'ok' AND rule_state = 'U') AS BIGINT) AS rules
    FROM v GROUP BY rse""",
)
def _(c):
    stuck = inv.stuck_tape_files(c.locks, c.replicas, c.rules, c.rses)
    return inv.tape_stat_summary(inv.tape_stat_check(stuck, c.storage_listing))


@registered(
    "file_replicas",
    f"""WITH {_CDF}
    SELECT name, string_agg(DISTINCT rse, ',' ORDER BY rse) AS rses,
           string_agg(DISTINCT rse || '=' || state, ',' ORDER BY rse || '=' || state) AS states
    FROM rr WHERE name IN (SELECT name FROM files) GROUP BY name""",
)
def _(c):
    out = inv.file_replicas(c.files.select("name"), replicas_named(c))
    return out.select("name", F.array_join("rses", ",").alias("rses"), F.array_join("states", ",").alias("states"))


@registered(
    "dataset_replica_list",
    """SELECT name, string_agg(DISTINCT rse || ' ' || state, ',' ORDER BY rse || ' ' || state) AS rses
       FROM dataset_replicas GROUP BY name""",
)
def _(c):
    return inv.dataset_replica_list(c.dataset_replicas).select("name", F.array_join("rses", ",").alias("rses"))


@registered(
    "replicas_available_at",
    f"""WITH {_CDF} SELECT name, rse FROM rr WHERE rse = 'T0_AA_S0' AND state = 'A'""",
)
def _(c):
    return inv.replicas_available_at(replicas_named(c), "T0_AA_S0").select("name", "rse")
