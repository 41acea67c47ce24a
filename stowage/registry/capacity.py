"""Registered queries: attributes, usage, weights, quotas, availability, dataset totals."""

from pyspark.sql import functions as F

from ..operators import capacity as cap
from . import registered
from .invalidation import replicas_named


@registered(
    "rse_attributes_wide",
    """SELECT rse, max(value) FILTER (key = 'tier') AS tier, max(value) FILTER (key = 'tape') AS tape,
              CAST(count(DISTINCT key) AS INTEGER) AS n_keys FROM attributes_now GROUP BY rse""",
)
def _(c):
    wide = cap.attributes_wide(c.attributes_now)
    attr = lambda k: F.try_element_at("attrs", F.lit(k)).alias(k)
    return wide.select("rse", attr("tier"), attr("tape"), F.size("attrs").alias("n_keys"))


@registered(
    "rse_select",
    "SELECT rse, tier, region FROM rses WHERE rse_type = 'DISK' AND cms_type = 'real' AND tier < 3 AND tier > 0",
)
def _(c):
    return cap.rse_select(c.rses, "rse_type = 'DISK' AND cms_type = 'real' AND tier < 3 AND tier > 0").select(
        "rse", "tier", "region"
    )


@registered(
    "rses_for_account",
    "SELECT DISTINCT rse FROM attributes_now WHERE key IN ('site_admins', 'rule_approvers') "
    "AND list_contains(string_split(value, ','), 'u1')",
)
def _(c):
    return cap.rses_for_account(c.attributes_now, "u1")


_WIDE = """
    w AS (SELECT rse, max(used) FILTER (source = 'static') AS static, max(used) FILTER (source = 'used') AS used,
                 max(used) FILTER (source = 'expired') AS expired, max(used) FILTER (source = 'unavailable') AS unavailable
          FROM rse_usage GROUP BY rse)
"""


@registered("rse_usage_pivot", f"WITH {_WIDE} SELECT * FROM w WHERE static IS NOT NULL AND used IS NOT NULL AND expired IS NOT NULL")
def _(c):
    return cap.usage_complete(cap.rse_usage_pivot(c.rse_usage))


@registered(
    "share_of_total",
    f"WITH {_WIDE} SELECT rse, static, round(static / CAST(sum(static) OVER () AS DOUBLE), 9) AS share FROM w WHERE static IS NOT NULL",
)
def _(c):
    wide = cap.share_of_total(cap.rse_usage_pivot(c.rse_usage).filter("static IS NOT NULL"))
    return wide.select("rse", "static", F.round("share", 9).alias("share"))


def _weight_sql(select, a, b, e, power):
    return f"""
    WITH {_WIDE},
    k AS (SELECT w.rse, w.static, w.used, w.expired, s.availability_write, coalesce(CAST(s.coefficient AS DOUBLE), 1.0) AS coefficient,
                 w.static - w.used - coalesce(l.min_free, 0) AS free
          FROM w JOIN weight_settings s ON s.rse = w.rse LEFT JOIN rse_limits l ON l.rse = w.rse
          WHERE {select} AND w.static IS NOT NULL AND w.used IS NOT NULL AND w.expired IS NOT NULL AND w.static <> 0),
    t AS (SELECT CAST(sum(static) AS DOUBLE) AS whole FROM k),
    r AS (SELECT k.*, static / whole AS relative_pledge,
                 pow(CASE WHEN NOT availability_write OR free < 0 THEN 0.0
                      ELSE {a}::DOUBLE * (static / whole) + {b}::DOUBLE * (free / CAST(static AS DOUBLE))
                           + {e}::DOUBLE * (expired / CAST(static AS DOUBLE)) END * coefficient, {power}) AS raw FROM k, t),
    x AS (SELECT *, raw / nullif(sum(raw) OVER (), 0) * 100 AS dm_weight FROM r)
    """


_DISK = "s.rse_type = 'DISK' AND s.cms_type = 'real' AND s.tier < 3 AND s.tier > 0"


def _disk_weights(c):
    rses = c.weight_settings.filter("rse_type = 'DISK' AND cms_type = 'real' AND tier < 3 AND tier > 0")
    return cap.dm_weight(
        c.rse_usage, rses.select("rse", "availability_write", "coefficient"), c.rse_limits, 0.35, 0.35, 0.3, True
    )


def _tape_weights(c):
    rses = c.weight_settings.filter("rse_type = 'TAPE' AND cms_type = 'real'")
    return cap.dm_weight(
        c.rse_usage, rses.select("rse", "availability_write", "coefficient"), c.rse_limits, 0.5, 0.5, 0.0, False
    )


@registered(
    "dm_weight",
    _weight_sql(_DISK, 0.35, 0.35, 0.3, 2)
    + " SELECT rse, static, used, expired, free, coefficient, round(relative_pledge, 9) AS relative_pledge, round(dm_weight, 6) AS dm_weight FROM x",
)
def _(c):
    return _disk_weights(c).select(
        "rse", "static", "used", "expired", "free", "coefficient",
        F.round("relative_pledge", 9).alias("relative_pledge"), F.round("dm_weight", 6).alias("dm_weight"),
    )


@registered(
    "dm_weight_report",
    _weight_sql("s.rse_type = 'TAPE' AND s.cms_type = 'real'", 0.5, 0.5, 0.0, 1)
    + """ SELECT rse, 'tape' AS part, round(static / 1e15, 6) AS pledge_pb, round(free / 1e15, 6) AS free_pb,
          round(expired / 1e15, 6) AS expired_pb, round(relative_pledge * 100, 6) AS relative_pledge_pct,
          round(free / CAST(static AS DOUBLE) * 100, 6) AS relative_free_pct,
          round(expired / CAST(static AS DOUBLE) * 100, 6) AS relative_expired_pct, coefficient,
          round(dm_weight, 6) AS dm_weight FROM x""",
)
def _(c):
    return cap.dm_weight_report(_tape_weights(c))


# --- metrics -------------------------------------------------------------------------
def _ts(text):
    return F.lit(text).cast("timestamp_ntz")


@registered(
    "metric_window_scan",
    """SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, name, disk_experiment_use, tape_usable FROM site_metrics
       WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-25 12:00:00'""",
)
def _(c):
    out = cap.metric_window_scan(
        c.site_metrics, _ts("2024-01-10 00:00:00"), _ts("2024-01-25 12:00:00"), ["name", "disk_experiment_use", "tape_usable"]
    )
    return out.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


_LATEST = """
    m AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY ts DESC, event_id) AS rn
                                      FROM site_metrics) WHERE rn = 1)
"""


@registered("latest_metric_per_site", f"WITH {_LATEST} SELECT name, event_id, disk_experiment_use, status FROM m")
def _(c):
    return cap.latest_metric_per_site(c.site_metrics, ["event_id"]).select("name", "event_id", "disk_experiment_use", "status")


_MATCH = """
    disk AS (SELECT * EXCLUDE (p) FROM (
        SELECT m.*, r.rse, row_number() OVER (PARTITION BY m.name ORDER BY CASE WHEN r.rse = m.name THEN 0 WHEN r.rse = m.name || '_Disk' THEN 1 ELSE 2 END) AS p
        FROM m JOIN rses r ON r.rse IN (m.name, m.name || '_Disk', m.name || '_User')) WHERE p = 1),
    hit AS (SELECT *, 'disk' AS kind FROM disk
            UNION ALL SELECT m.*, r.rse, 'tape' FROM m JOIN rses r ON r.rse = m.name || '_Tape')
"""


def _matched(c):
    tape = c.rses.filter("rse_type = 'TAPE'")
    return cap.site_metric_to_rse(cap.latest_metric_per_site(c.site_metrics, ["event_id"]), c.rses, tape)


@registered("site_metric_to_rse", f"WITH {_LATEST}, {_MATCH} SELECT name, rse, kind FROM hit")
def _(c):
    return _matched(c).select("name", "rse", "kind")


_PLAN = f"""{_LATEST}, {_MATCH},
    v AS (SELECT hit.rse, kind, CASE WHEN kind = 'tape' THEN tape_usable * 1e12 ELSE disk_experiment_use * 1e12 + disk_local_use * 1e12 END AS new_static,
                 coalesce(u.used, 0) AS old_static, coalesce(l.min_free, 0) AS old_limit, p.tier
          FROM hit LEFT JOIN rse_usage u ON u.rse = hit.rse AND u.source = 'static' LEFT JOIN rse_limits l ON l.rse = hit.rse
          JOIN rses p ON p.rse = hit.rse WHERE kind = 'tape' OR disk_experiment_use <> 0),
    plan AS (SELECT rse, kind, old_static, new_static, old_limit,
           CASE WHEN kind = 'disk' THEN CAST(floor(new_static * (CASE WHEN tier = 1 THEN 5.0 ELSE 10.0 END::DOUBLE / 100.0::DOUBLE)) AS BIGINT) END AS new_limit
    FROM v WHERE new_static <> old_static OR (kind = 'disk' AND CAST(floor(new_static * (CASE WHEN tier = 1 THEN 5.0 ELSE 10.0 END::DOUBLE / 100.0::DOUBLE)) AS BIGINT) <> old_limit))
"""


@registered("site_capacity_plan", f"WITH {_PLAN} SELECT * FROM plan")
def capacity_plan(c):
    percents = c.rses.filter("tier = 1").select("rse", F.lit(5.0).alias("percent"))
    return cap.site_capacity_plan(_matched(c), c.rse_usage, c.rse_limits, percents)


@registered(
    "local_quota_plan",
    """WITH w AS (SELECT rse, min_free AS quota FROM rse_limits),
    f AS (SELECT w.*, CASE WHEN EXISTS (SELECT 1 FROM local_accounts a WHERE a.account = lower(w.rse) || '_local_users') THEN lower(w.rse) || '_local_users'
                   WHEN EXISTS (SELECT 1 FROM local_accounts a WHERE a.account = lower(w.rse) || '_local') THEN lower(w.rse) || '_local' END AS account FROM w)
    SELECT f.account, f.rse, coalesce(q.quota, 0) AS old_quota, f.quota FROM f
    LEFT JOIN local_quotas q ON q.account = f.account AND q.rse = f.rse
    WHERE f.account IS NOT NULL AND coalesce(q.quota, 0) <> f.quota""",
)
def _(c):
    wanted = c.rse_limits.select("rse", F.col("min_free").alias("quota"))
    return cap.local_quota_plan(wanted, c.local_accounts, c.local_quotas)


@registered(
    "user_quota_plan",
    """SELECT u.account, u.rse, coalesce(l.quota, 0) AS old_quota, CAST(1000 AS BIGINT) AS quota FROM users u
       LEFT JOIN user_limits l ON l.account = u.account AND l.rse = u.rse
       WHERE (l.quota IS NULL OR l.quota = 1000) AND 1000 > coalesce(l.quota, 0)""",
)
def _(c):
    return cap.user_quota_plan(c.users.select("account", "rse"), c.user_limits, 1000)


@registered(
    "user_quota_plan_reset",
    """SELECT u.account, u.rse, coalesce(l.quota, 0) AS old_quota, CAST(5000 AS BIGINT) AS quota FROM users u
       LEFT JOIN user_limits l ON l.account = u.account AND l.rse = u.rse WHERE 5000 > coalesce(l.quota, 0)""",
)
def _(c):
    return cap.user_quota_plan(c.users.select("account", "rse"), c.user_limits, 5000, "reset-all")


_OCC = """
    o AS (SELECT rse, static IS NULL OR used IS NULL OR expired IS NULL OR unavailable IS NULL
                 OR NOT (static - used < 2e9 AND (static - used) * 100.0::DOUBLE / static < 40) AS occupancy_ok FROM w)
"""


def _occupancy(c):
    return cap.occupancy_ok(cap.rse_usage_pivot(c.rse_usage), free_threshold=2e9, percent=40)


@registered("occupancy_ok", f"WITH {_WIDE}, {_OCC} SELECT rse, occupancy_ok FROM o")
def _(c):
    return _occupancy(c)


@registered(
    "tape_output_flag",
    f"""WITH {_WIDE}, {_OCC} SELECT r.rse, coalesce(o.occupancy_ok, true) AS output_tape FROM rses r LEFT JOIN o ON o.rse = r.rse
        WHERE r.rse_type = 'TAPE' AND r.cms_type = 'real' AND r.availability_write""",
)
def _(c):
    return cap.tape_output_flag(c.rses, c.rses.filter("NOT availability_write"), _occupancy(c))


def _availability(c):
    skip = c.rses.filter("cms_type = 'test'")
    return cap.availability_plan(c.site_metrics.select("name", "ts", "status"), c.rses, skip, _occupancy(c))


_SWITCHES = f"""{_WIDE}, {_OCC},
    m AS (SELECT name, status FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY ts DESC, status NULLS FIRST) AS rn FROM site_metrics) WHERE rn = 1),
    d AS (SELECT m.name, m.status, min(r.rse) AS rse FROM m JOIN rses r ON r.rse IN (m.name, m.name || '_Disk') GROUP BY m.name, m.status),
    s AS (SELECT rse, status FROM d UNION ALL SELECT r.rse, m.status FROM m JOIN rses r ON r.rse = m.name || '_Tape'),
    sw AS (SELECT s.rse, coalesce(status IN ('dependable', 'enabled'), false) AS availability_read,
           coalesce(status IN ('dependable', 'enabled'), false) AND (contains(s.rse, '_Tape') OR coalesce(o.occupancy_ok, true)) AS availability_write,
           coalesce(status IN ('dependable', 'enabled'), false) AS availability_delete
    FROM s LEFT JOIN o ON o.rse = s.rse JOIN rses r ON r.rse = s.rse WHERE r.cms_type <> 'test' AND s.rse NOT LIKE 'T3\\_%' ESCAPE '\\')
"""


@registered("availability_plan", f"WITH {_SWITCHES} SELECT * FROM sw")
def _(c):
    return _availability(c)


# --- datasets ------------------------------------------------------------------------
@registered(
    "dataset_summary",
    """SELECT dataset, count(*) AS file_count, CAST(sum(bytes) AS BIGINT) AS bytes, CAST(sum(events) AS BIGINT) AS events,
              CAST(CAST(printf('%.2f', sum(bytes) / CASE WHEN sum(bytes) < 1000000 THEN 1e3 WHEN sum(bytes) < 1000000000 THEN 1e6 ELSE 1e9 END) AS DOUBLE) AS VARCHAR)
              || CASE WHEN sum(bytes) < 1000000 THEN ' KB' WHEN sum(bytes) < 1000000000 THEN ' MB' ELSE ' GB' END AS size
       FROM dataset_files GROUP BY dataset""",
)
def _(c):
    return cap.dataset_summary(c.dataset_files, replicas_named(c))[0]


@registered(
    "dataset_summary_by_rse",
    """SELECT d.dataset, s.rse, count(*) AS file_count, CAST(sum(d.bytes) AS BIGINT) AS bytes, CAST(sum(d.events) AS BIGINT) AS events
       FROM dataset_files d JOIN replicas r ON r.name = d.name JOIN rses s ON s.rse_id = r.rse_id
       WHERE r.state = 'A' GROUP BY d.dataset, s.rse""",
)
def _(c):
    return cap.dataset_summary(c.dataset_files, replicas_named(c))[1]


@registered(
    "block_replica_nodes",
    """SELECT d.dataset AS block, string_agg(DISTINCT s.rse, ',' ORDER BY s.rse) AS rses
       FROM dataset_files d JOIN replicas r ON r.name = d.name JOIN rses s ON s.rse_id = r.rse_id
       WHERE r.state = 'A' GROUP BY d.dataset""",
)
def _(c):
    out = cap.block_replica_nodes(c.contents, replicas_named(c))
    return out.select("block", F.array_join("rses", ",").alias("rses"))


@registered(
    "blocks_in_container",
    "SELECT name AS container, child_name AS block FROM contents WHERE did_type = 'C' AND child_type = 'D'",
)
def _(c):
    return cap.blocks_in_container(c.contents, c.contents.select("name"))


@registered(
    "rse_progress_rollup",
    """SELECT coalesce(d.rse, 'TOTAL') AS rse, count(*) AS blocks, CAST(sum(available_length) AS BIGINT) AS files,
              CAST(sum(length) AS BIGINT) AS files_possible, round(sum(available_length) * 100.0::DOUBLE / sum(length), 6) AS files_pct,
              round(sum(available_bytes) / 1e12, 6) AS tb, round(sum(bytes) / 1e12, 6) AS tb_possible
       FROM dataset_replicas d JOIN rses r ON r.rse = d.rse
       WHERE r.cms_type = 'test' AND contains(d.name, '/NANOAOD') GROUP BY ROLLUP (d.rse) HAVING sum(length) > 0""",
)
def _(c):
    return cap.rse_progress_rollup(c.dataset_replicas, c.rses)


@registered(
    "staging_estimate",
    """WITH b AS (SELECT container, name, max(bytes) AS bytes,
               coalesce(max(available_bytes) FILTER (state = 'AVAILABLE' AND NOT contains(rse, '_Tape')), 0) AS disk FROM dataset_replicas GROUP BY container, name)
    SELECT container, CAST(sum(bytes) AS BIGINT) AS bytes, CAST(sum(bytes) - sum(disk) AS BIGINT) AS not_on_disk,
           CASE WHEN sum(bytes) / 1e12 > 0.00002 THEN 'DATASET' ELSE 'ALL' END AS "grouping" FROM b GROUP BY container""",
)
def _(c):
    return cap.staging_estimate(c.dataset_replicas, limit_tb=0.00002)
