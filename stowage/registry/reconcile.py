"""Registered queries: inventories, plans, accounts, attributes, snapshots."""

from pyspark.sql import functions as F

from ..operators import digests as dig
from ..operators import ranking
from ..operators import reconcile as rec
from ..session import scratch_path
from ..streaming import state as stt
from ..streaming import streams as st
from . import registered

_DIFF = """
    d AS (SELECT coalesce(a.site, b.site) AS site, coalesce(a.block, b.block) AS block,
                 a.n_files AS n_source, b.n_files AS n_catalogue,
                 CASE WHEN b.n_files IS NULL THEN 'not_in_catalogue' WHEN a.n_files IS NULL THEN 'not_in_source'
                      WHEN a.n_files = b.n_files THEN 'complete' ELSE 'incomplete' END AS label
          FROM source_blocks a FULL JOIN catalogue_blocks b ON a.site = b.site AND a.block = b.block)
"""


def _diff(c):
    return rec.site_block_diff(c.source_blocks, c.catalogue_blocks)


@registered("site_block_diff", f"WITH {_DIFF} SELECT * FROM d")
def _(c):
    return _diff(c)


@registered(
    "site_block_diff_summary",
    f"""WITH {_DIFF},
    n AS (SELECT site, count(*) FILTER (label = 'complete') AS complete, count(*) FILTER (label = 'incomplete') AS incomplete,
                 count(*) FILTER (label = 'not_in_catalogue') AS not_in_catalogue,
                 count(*) FILTER (label = 'not_in_source') AS not_in_source FROM d GROUP BY site)
    SELECT *, round(complete * 100.0::DOUBLE / nullif(complete + not_in_catalogue + not_in_source, 0), 6) AS pct_complete,
           round(complete * 100.0::DOUBLE / nullif(complete + not_in_catalogue, 0), 6) AS pct_added FROM n""",
)
def _(c):
    return rec.site_block_diff_summary(_diff(c))


def _block_inventories(c):
    return [
        dig.write_inventory(df, scratch_path(c.spark, "blocks"), "site", "block", ["n_files"], buckets=64)
        for df in (c.source_blocks, c.catalogue_blocks)
    ]


@registered("site_block_diff_digest", f"WITH {_DIFF} SELECT * FROM d WHERE label <> 'complete'")
def _(c):
    return dig.incomplete_blocks(c.spark, *_block_inventories(c))


@registered(
    "site_block_diff_summary_digest",
    f"""WITH {_DIFF},
    n AS (SELECT site, count(*) FILTER (label = 'complete') AS complete, count(*) FILTER (label = 'incomplete') AS incomplete,
                 count(*) FILTER (label = 'not_in_catalogue') AS not_in_catalogue,
                 count(*) FILTER (label = 'not_in_source') AS not_in_source FROM d GROUP BY site)
    SELECT *, round(complete * 100.0::DOUBLE / nullif(complete + not_in_catalogue + not_in_source, 0), 6) AS pct_complete,
           round(complete * 100.0::DOUBLE / nullif(complete + not_in_catalogue, 0), 6) AS pct_added FROM n""",
)
def _(c):
    return dig.block_summary(c.spark, *_block_inventories(c))


@registered(
    "pattern_any_filter",
    "SELECT * FROM source_blocks WHERE contains(block, 'NANOAODSIM') OR contains(block, '/Era3')",
)
def _(c):
    return rec.pattern_any_filter(c.source_blocks, ["NANOAODSIM", "/Era3"], "block")


@registered(
    "select_ignore_filter",
    "SELECT * FROM source_blocks WHERE regexp_matches(block, '^(/C[0-9]+1/.*|/C[0-9]+7/.*)') "
    "AND NOT regexp_matches(block, '^(/.*/RAW)')",
)
def _(c):
    return rec.select_ignore_filter(c.source_blocks, ["/C[0-9]+1/.*", "/C[0-9]+7/.*"], ["/.*/RAW"], "block")


@registered("name_prefix_scan", "SELECT * FROM source_blocks WHERE block LIKE '/C1%'")
def _(c):
    return rec.name_prefix_scan(c.source_blocks, "C1", "block")


_DATASETS = """
    d AS (SELECT *, label <> 'unchanged' AND regexp_matches(name, '^(/C[0-9]+/Era.*)')
                    AND NOT regexp_matches(name, '^(.*/RAW)') AS selected
          FROM (SELECT coalesce(a.site, b.site) AS site, coalesce(a.block, b.block) AS name,
                 a.n_files AS n_source, b.n_files AS n_catalogue,
                 CASE WHEN b.n_files IS NULL THEN 'missing' WHEN a.n_files IS NULL THEN 'to_remove'
                      WHEN a.n_files <> b.n_files THEN 'to_update' ELSE 'unchanged' END AS label
          FROM source_blocks a FULL JOIN catalogue_blocks b ON a.site = b.site AND a.block = b.block))
"""


def _dataset_diff(c):
    name = lambda df: df.withColumnRenamed("block", "name")
    return rec.dataset_list_diff(name(c.source_blocks), name(c.catalogue_blocks), ["/C[0-9]+/Era.*"], [".*/RAW"])


@registered("dataset_list_diff", f"WITH {_DATASETS} SELECT * FROM d")
def _(c):
    return _dataset_diff(c)


@registered(
    "dataset_list_summary",
    f"""WITH {_DATASETS} SELECT site, count(*) AS tot,
        count(*) FILTER (label = 'missing') AS missing, count(*) FILTER (label = 'missing' AND selected) AS missing_selected,
        count(*) FILTER (label = 'to_remove') AS to_remove, count(*) FILTER (label = 'to_remove' AND selected) AS to_remove_selected,
        count(*) FILTER (label = 'to_update') AS to_update, count(*) FILTER (label = 'to_update' AND selected) AS to_update_selected,
        count(*) FILTER (selected) AS selected FROM d GROUP BY site""",
)
def _(c):
    return rec.dataset_list_summary(_dataset_diff(c))


@registered(
    "empty_source_guard",
    """WITH s AS (SELECT * FROM source_blocks WHERE site NOT LIKE 'X%'),
    d AS (SELECT coalesce(a.site, b.site) AS site, coalesce(a.block, b.block) AS block,
                 a.n_files AS n_source, b.n_files AS n_catalogue,
                 CASE WHEN b.n_files IS NULL THEN 'not_in_catalogue' WHEN a.n_files IS NULL THEN 'not_in_source'
                      WHEN a.n_files = b.n_files THEN 'complete' ELSE 'incomplete' END AS label
          FROM s a FULL JOIN catalogue_blocks b ON a.site = b.site AND a.block = b.block)
    SELECT * FROM d WHERE site IN (SELECT site FROM s)""",
)
def _(c):
    # one site's source list is lost
    source = c.source_blocks.filter("site NOT LIKE 'X%'")
    return rec.empty_source_guard(rec.site_block_diff(source, c.catalogue_blocks), source)


@registered(
    "capped_actions",
    f"""WITH {_DIFF} SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY site, label ORDER BY block) AS rn FROM d WHERE label LIKE 'not_in%')
        WHERE rn <= 20""",
)
def _(c):
    return rec.capped_actions(_diff(c).filter("label LIKE 'not_in%'"), 20)


@registered(
    "datasets_at_rse",
    """SELECT r.rse, r.name, r.available_length FROM dataset_replicas r
       WHERE EXISTS (SELECT 1 FROM sync_rules s WHERE s.name = r.name AND s.account = 'sync_' || lower(r.rse)
                     AND s.expires_at IS NULL)""",
)
def _(c):
    return rec.datasets_at_rse(c.sync_rules, c.dataset_replicas)


@registered(
    "block_replica_plan",
    """SELECT *, 'add' AS action FROM (SELECT rse, block, name FROM source_files EXCEPT SELECT rse, block, name FROM catalogue_files)
       UNION ALL SELECT *, 'remove' FROM (SELECT rse, block, name FROM catalogue_files EXCEPT SELECT rse, block, name FROM source_files)""",
)
def _(c):
    return rec.block_replica_plan(c.source_files, c.catalogue_files)


# ordered, as the checking engine does not end this join under a limit in several threads
@registered(
    "replicas_to_recover",
    """SELECT rse, block, name, 'A' AS new_state FROM catalogue_files b WHERE state <> 'A'
       AND EXISTS (SELECT 1 FROM source_files a WHERE a.rse = b.rse AND a.block = b.block AND a.name = b.name) ORDER BY ALL""",
)
def _(c):
    return rec.replicas_to_recover(c.source_files, c.catalogue_files)


_HELD = "SELECT block, name FROM catalogue_files"


def _held(c):
    return c.catalogue_files.select(
        F.col("block").alias("name"), F.col("name").alias("child_name"), F.lit("D").alias("did_type"), F.lit("F").alias("child_type")
    )


@registered("attach_missing", f"SELECT block, name FROM source_files EXCEPT {_HELD}")
def _(c):
    return rec.attach_missing(rec.block_replica_plan(c.source_files, c.catalogue_files), _held(c))


@registered(
    "rule_plan",
    """WITH p AS (SELECT DISTINCT rse, block FROM source_files),
    r AS (SELECT substr(rse_expression, 5) AS rse, name AS block, rule_id FROM sync_rules
          WHERE account = substr('sync_' || lower(substr(rse_expression, 5)), 1, 25))
    SELECT coalesce(p.rse, r.rse) AS rse, coalesce(p.block, r.block) AS block, r.rule_id,
           CASE WHEN r.rule_id IS NULL THEN 'add' ELSE 'delete' END AS action
    FROM p FULL JOIN r ON p.rse = r.rse AND p.block = r.block WHERE r.rule_id IS NULL OR p.rse IS NULL""",
)
def _(c):
    return rec.rule_plan(c.source_files, c.sync_rules)


@registered(
    "repair_from_source",
    f"""SELECT m.block, m.name, f.bytes, f.adler32 FROM (SELECT block, name FROM source_files EXCEPT {_HELD}) m
        LEFT JOIN files f ON f.name = m.name""",
)
def _(c):
    return rec.repair_from_source(c.source_files, _held(c), c.files)


@registered(
    "metadata_for_missing",
    """SELECT m.rse, m.name, f.bytes, f.adler32 FROM
       (SELECT DISTINCT rse, name FROM source_files a WHERE NOT EXISTS
          (SELECT 1 FROM catalogue_files b WHERE a.rse = b.rse AND a.name = b.name)) m LEFT JOIN files f ON f.name = m.name""",
)
def _(c):
    missing = c.source_files.select("rse", "name").distinct().join(c.catalogue_files, ["rse", "name"], "left_anti")
    return rec.metadata_for_missing(missing, c.files).select("rse", "name", "bytes", "adler32")


_ROOTS = ["/store/mc", "/store/data", "/store/hidata"]
_IGNORE = ["/store/data/Era7", "/store/mc/Era1/Parking"]
_IN_ROOTS = """(path LIKE '/store/mc/%' OR path LIKE '/store/data/%' OR path LIKE '/store/hidata/%')
    AND NOT (path LIKE '/store/data/Era7/%' OR path LIKE '/store/mc/Era1/Parking/%')"""


def _dark(c):
    return rec.dark_missing_files(c.storage_paths, c.catalogue_paths, _ROOTS, _IGNORE)


@registered(
    "dark_missing_files",
    f"""SELECT *, 'dark' AS label FROM (SELECT rse, path FROM storage_paths WHERE {_IN_ROOTS}
              EXCEPT SELECT rse, path FROM catalogue_paths WHERE {_IN_ROOTS})
        UNION ALL SELECT *, 'missing' FROM (SELECT rse, path FROM catalogue_paths WHERE {_IN_ROOTS}
              EXCEPT SELECT rse, path FROM storage_paths WHERE {_IN_ROOTS})""",
)
def _(c):
    return _dark(c)


@registered(
    "dark_missing_files_digest",
    f"""SELECT *, 'dark' AS label FROM (SELECT rse, path FROM storage_paths WHERE {_IN_ROOTS}
              EXCEPT SELECT rse, path FROM catalogue_paths WHERE {_IN_ROOTS})
        UNION ALL SELECT *, 'missing' FROM (SELECT rse, path FROM catalogue_paths WHERE {_IN_ROOTS}
              EXCEPT SELECT rse, path FROM storage_paths WHERE {_IN_ROOTS})""",
)
def _(c):
    scope = rec.under_any("path", _ROOTS) & ~rec.under_any("path", _IGNORE)
    listing, dump = (
        dig.write_inventory(dig.in_scope(df, scope), scratch_path(c.spark, "paths"), "rse", "path", buckets=64)
        for df in (c.storage_paths, c.catalogue_paths)
    )
    return dig.dark_missing_by_digest(c.spark, listing, dump)


def _now():
    return F.lit("2001-01-01 00:00:00").cast("timestamp_ntz")


@registered(
    "dark_action_gate",
    """WITH k AS (SELECT rse, path, count(DISTINCT run_at) AS runs, min(run_at) AS first_seen FROM dark_history
               WHERE run_at >= TIMESTAMP '2001-01-01' - INTERVAL 4000 DAY AND run_at <= TIMESTAMP '2001-01-01'
               GROUP BY rse, path),
    ok AS (SELECT * FROM k WHERE runs >= 2 AND first_seen <= TIMESTAMP '2001-01-01' - INTERVAL 200 DAY),
    g AS (SELECT o.rse, CASE WHEN t.last_run < TIMESTAMP '2001-01-01' - INTERVAL 30 DAY THEN 'last run too old'
                             WHEN o.n * 1.0 / t.files > 0.002 THEN 'too many files' ELSE 'allowed' END AS gate
          FROM (SELECT rse, count(*) AS n FROM ok GROUP BY rse) o JOIN scan_totals t ON t.rse = o.rse)
    SELECT ok.rse, ok.path, ok.runs, g.gate FROM ok JOIN g ON g.rse = ok.rse""",
)
def _(c):
    return rec.dark_action_gate(
        c.dark_history,
        c.scan_totals,
        _now(),
        min_runs=2,
        min_age_first_run=200,
        confirmation_window=4000,
        max_age_last_run=30,
        max_fraction=0.002,
    )


@registered(
    "missing_action_gate",
    """SELECT m.rse, m.n, round(m.n * 1.0::DOUBLE / t.files, 9) AS share,
              CASE WHEN t.last_run < TIMESTAMP '2001-01-01' - INTERVAL 3 DAY THEN 'last run too old'
                   WHEN m.n * 1.0 / t.files > 0.01 THEN 'too many files' ELSE 'allowed' END AS gate
       FROM (SELECT rse, count(*) AS n FROM (SELECT DISTINCT rse, path FROM dark_history) GROUP BY rse) m
       JOIN scan_totals t ON t.rse = m.rse""",
)
def _(c):
    return rec.missing_action_gate(c.dark_history.select("rse", "path").distinct(), c.scan_totals, _now())


@registered(
    "unmerged_listing",
    """SELECT rse, path FROM storage_paths WHERE path LIKE '/store/mc/%'
       AND NOT (path LIKE '/store/mc/Era3/%' OR path LIKE '/store/mc/Era11/Parking/%')""",
)
def _(c):
    return rec.unmerged_listing(c.storage_paths, "/store/mc/", ["/store/mc/Era3", "/store/mc/Era11/Parking"])


@registered(
    "identity_diff",
    """SELECT account, identity, 'add' AS action FROM (SELECT account, identity FROM identities_wanted EXCEPT SELECT account, identity FROM identities_now)
       UNION ALL SELECT account, identity, 'delete' FROM (SELECT account, identity FROM identities_now EXCEPT SELECT account, identity FROM identities_wanted)
       WHERE identity NOT LIKE 'SUB=%'""",
)
def _(c):
    return rec.identity_diff(c.identities_now, c.identities_wanted, "X509")


@registered(
    "account_plan",
    """WITH w AS (SELECT DISTINCT 'sync_' || lower(rse) AS account FROM rses WHERE cms_type = 'real')
    SELECT account, 'account' AS lacks FROM w WHERE account NOT IN (SELECT account FROM sync_accounts)
    UNION ALL SELECT account, 'attribute' FROM w WHERE account NOT IN (SELECT account FROM sync_attributes)
    UNION ALL SELECT account, 'identity' FROM w WHERE account NOT IN (SELECT account FROM sync_attributes)""",
)
def _(c):
    return rec.account_plan(c.rses, c.sync_accounts, c.sync_attributes, c.sync_attributes)


@registered(
    "scope_plan",
    """WITH g AS (SELECT account, CASE WHEN account LIKE '%\\_local\\_users' ESCAPE '\\' OR account LIKE '%\\_local' ESCAPE '\\'
                   THEN split_part('group.' || account, '_local', 1)
                   WHEN account LIKE '%\\_group' ESCAPE '\\' THEN split_part('group.' || account, '_group', 1) END AS scope
               FROM accounts WHERE account_type = 'GROUP')
    SELECT account, scope FROM g WHERE scope IS NOT NULL
    EXCEPT SELECT substr(scope, 7), scope FROM scopes WHERE scope LIKE 'group.%'""",
)
def _(c):
    return rec.scope_plan(c.accounts, c.scopes, include_local=True, only_group_suffix=True)


@registered(
    "scope_plan_all",
    """SELECT account, 'group.' || account AS scope FROM accounts WHERE account_type = 'GROUP'
         AND NOT (account LIKE '%\\_local\\_users' ESCAPE '\\' OR account LIKE '%\\_local' ESCAPE '\\')
       EXCEPT SELECT substr(scope, 7), scope FROM scopes WHERE scope LIKE 'group.%'""",
)
def _(c):
    return rec.scope_plan(c.accounts, c.scopes)


@registered(
    "role_attr_diff",
    """WITH have AS (SELECT DISTINCT rse, unnest(string_split(value, ',')) AS account FROM attributes_now
                  WHERE key = 'site_capacity_manager' AND rse IN ('T0_AA_S0', 'T0_AA_S0_Disk')),
    want AS (SELECT rse, account FROM (SELECT DISTINCT account FROM accounts WHERE account IN ('u1', 'u2')),
             (SELECT DISTINCT rse FROM attributes_now WHERE rse IN ('T0_AA_S0', 'T0_AA_S0_Disk')))
    SELECT coalesce(h.rse, w.rse) AS rse, count(*) FILTER (w.rse IS NULL OR h.rse IS NULL) > 0 AS changed,
           count(*) FILTER (h.rse IS NULL) AS to_add, count(*) FILTER (w.rse IS NULL) AS to_drop
    FROM want w FULL JOIN have h ON w.rse = h.rse AND w.account = h.account GROUP BY 1""",
)
def _(c):
    wanted = c.accounts.filter("account IN ('u1', 'u2')")
    return rec.role_attr_diff(c.attributes_now, wanted, ["T0_AA_S0", "T0_AA_S0_Disk"])


@registered(
    "attribute_diff",
    """SELECT w.rse, w.key, w.value, n.value AS old_value, 'set' AS action
       FROM attributes_wanted w LEFT JOIN attributes_now n ON n.rse = w.rse AND n.key = w.key
       WHERE n.value IS NULL OR NOT (n.value = w.value OR (n.value = 'True' AND w.value IN ('1', 'True')))""",
)
def _(c):
    return rec.attribute_diff(c.attributes_wanted, c.attributes_now)


@registered(
    "protocol_diff",
    """SELECT coalesce(w.rse, n.rse) AS rse, coalesce(w.scheme, n.scheme) AS scheme,
              CASE WHEN w.rse IS NULL THEN 'delete' WHEN w.definition = n.definition THEN 'unchanged'
                   WHEN n.rse IS NULL THEN CASE WHEN w.scheme = 'file' THEN 'ignored' ELSE 'add' END
                   WHEN w.scheme = 'file' THEN 'delete' ELSE 'replace' END AS action,
              CAST(coalesce(w.read_priority, 1000000) AS BIGINT) AS position
       FROM protocols_wanted w FULL JOIN protocols_now n ON w.rse = n.rse AND w.scheme = n.scheme""",
)
def _(c):
    return rec.protocol_diff(c.protocols_wanted, c.protocols_now)


# --- snapshots -----------------------------------------------------------------------
@registered(
    "deleted_archive",
    """SELECT scope, name, did_type, bytes, '2024-01-01' AS deleted_at FROM dids_old o
       WHERE NOT EXISTS (SELECT 1 FROM dids_new n WHERE n.name = o.name)
         AND NOT EXISTS (SELECT 1 FROM dids_archive a WHERE a.name = o.name)""",
)
def _(c):
    return rec.deleted_archive(c.dids_old, c.dids_new, c.dids_archive, F.lit("2024-01-01"))


@registered("reuse_violation", "SELECT * FROM dids_new WHERE name IN (SELECT name FROM dids_archive)")
def _(c):
    return rec.reuse_violation(c.dids_new, c.dids_archive)


@registered(
    "immutable_key_change",
    """SELECT account_key, account AS old_key, 'u' || CAST(account_key AS VARCHAR) AS new_key FROM accounts
       WHERE account <> 'u' || CAST(account_key AS VARCHAR)""",
)
def _(c):
    new = c.accounts.select("account_key", F.concat(F.lit("u"), F.col("account_key").cast("string")).alias("account"))
    return rec.immutable_key_change(c.accounts, new, "account", "account_key")


def _delivered(c, seeds, changes, label):
    """Seeds, then the day's changes twice, as files that arrive one after the other."""
    path = scratch_path(c.spark, label)
    for part in (seeds, changes, changes):
        part.write.mode("append").parquet(path)
    return st.read_stream(c.spark, path, "*.parquet", changes.schema, files_a_batch=4)


@registered(
    "did_changes_stream",
    """SELECT scope, name, 'archived' AS outcome, did_type, bytes FROM dids_old o
       WHERE name NOT IN (SELECT name FROM dids_new) AND name NOT IN (SELECT name FROM dids_archive)
       UNION ALL SELECT scope, name, 'deleted', did_type, bytes FROM dids_old
       WHERE name NOT IN (SELECT name FROM dids_new) AND name IN (SELECT name FROM dids_archive)
       UNION ALL SELECT scope, name, CASE WHEN name IN (SELECT name FROM dids_archive) THEN 'refused' ELSE 'added' END, did_type, bytes
       FROM dids_new WHERE name NOT IN (SELECT name FROM dids_old)""",
)
def _(c):
    changes = stt.snapshot_changes(c.dids_old, c.dids_new, ["scope", "name"])
    seeds = stt.seed_changes(c.dids_archive, "archived").unionByName(stt.seed_changes(c.dids_old, "present")).select(*changes.columns)
    out = st.run_once(stt.name_changes(_delivered(c, seeds, changes, "did-changes")))
    return out.select("scope", "name", "outcome", "did_type", "bytes")


@registered(
    "account_changes_stream",
    """SELECT account_key, 'refused' AS outcome, account AS old_key, 'u' || CAST(account_key AS VARCHAR) AS new_key FROM accounts
       WHERE account <> 'u' || CAST(account_key AS VARCHAR)""",
)
def _(c):
    old = c.accounts.select("account_key", "account")
    new = old.select("account_key", F.concat(F.lit("u"), F.col("account_key").cast("string")).alias("account"))
    changes = stt.snapshot_changes(old, new, ["account_key"])
    seeds = stt.seed_changes(old, "present").select(*changes.columns)
    out = st.run_once(stt.key_changes(_delivered(c, seeds, changes, "account-changes"), "account_key", "account"))
    return out.select("account_key", "outcome", "old_key", "new_key")


@registered(
    "did_restore_plan",
    """SELECT scope, name, did_type, CAST(floor((row_number() OVER (PARTITION BY did_type ORDER BY scope, name) - 1) / 100) AS BIGINT) AS batch
       FROM dids_archive WHERE name IN (SELECT name FROM dids_old)""",
)
def _(c):
    return rec.did_restore_plan(c.dids_old, c.dids_archive, batch=100)


# --- ranking -------------------------------------------------------------------------
@registered(
    "block_chunks",
    """SELECT site, name, CAST(floor((row_number() OVER (PARTITION BY site ORDER BY name, block, rse) - 1) / 100) AS BIGINT) AS chunk
       FROM source_files""",
)
def _(c):
    return ranking.block_chunks(c.source_files, ["site"], ["name", "block", "rse"], 100).select("site", "name", "chunk")


@registered(
    "systematic_sample",
    """WITH n AS (SELECT site, block, name, rse, row_number() OVER (PARTITION BY site ORDER BY name, block, rse) - 1 AS position,
                      count(*) OVER (PARTITION BY site) AS total FROM source_files)
    SELECT site, block, name, rse, position, total FROM n
    WHERE position = 0 OR position = total - 1 OR position % 50 = 0
       OR (total > 2 AND position IN (least(floor(0.25 * total), total - 1), least(floor(0.5 * total), total - 1),
                                      least(floor(0.75 * total), total - 1)))""",
)
def _(c):
    return ranking.systematic_sample(c.source_files, ["site"], ["name", "block", "rse"], samples=5, step=50)
