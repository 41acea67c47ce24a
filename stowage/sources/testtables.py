"""Catalogue views over the test tables.

Each view is one SELECT that Spark and the checking engine read alike, so that a query
and its check start from the same rows.  Names are made from keys alone, so no view adds
a join only to build a name.  ``epoch_millis`` is the single word the engines spell
differently.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..session import apply_settings

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def file_name(key: str) -> str:
    """Logical file name of part ``key``."""
    return (
        f"('/store/' || CASE {key} % 4 WHEN 0 THEN 'data' WHEN 1 THEN 'mc' WHEN 2 THEN 'hidata' ELSE 'himc' END"
        f" || '/Era' || CAST({key} % 50 AS STRING) || '/' || CASE WHEN {key} % 5 = 0 THEN 'Parking' ELSE 'Primary' END"
        f" || '/' || CASE {key} % 3 WHEN 0 THEN 'RAW' WHEN 1 THEN 'AOD' ELSE 'GEN-SIM-RAW' END"
        f" || '/v1/' || CAST({key} AS STRING) || '.root')"
    )


def file_bytes(key: str) -> str:
    return f"CAST(1000000 + ({key} * 7919) % 4000037 AS BIGINT)"


def container_name(key: str) -> str:
    return (
        f"('/C' || CAST({key} AS STRING) || '/Era' || CAST({key} % 7 AS STRING) || '-v1/'"
        f" || CASE {key} % 3 WHEN 0 THEN 'RAW' WHEN 1 THEN 'NANOAODSIM' ELSE 'AOD' END)"
    )


def block_name(cust: str, order: str) -> str:
    return f"({container_name(cust)} || '#' || CAST({order} AS STRING))"


VIEWS: dict[str, str] = {
    # --- endpoints: three per site (tape, disk, plain).  A plain projection, so that its
    # size estimate is that of the table and not the product of a join.
    "rses": """
        SELECT s_suppkey AS rse_id, site, site || suffix AS rse,
               CASE WHEN suffix = '_Tape' THEN 'TAPE' ELSE 'DISK' END AS rse_type,
               CAST(k % 4 AS BIGINT) AS tier, country, region,
               CASE WHEN s_suppkey % 7 = 6 THEN 'test' ELSE 'real' END AS cms_type,
               s_suppkey % 11 <> 0 AS availability_write, s_acctbal AS weight_hint
        FROM (SELECT s_suppkey, s_acctbal, k, country, region,
                     'T' || CAST(k % 4 AS STRING) || '_' || country || '_S' || CAST(k AS STRING) AS site,
                     CASE s_suppkey % 3 WHEN 0 THEN '_Tape' WHEN 1 THEN '_Disk' ELSE '' END AS suffix
              FROM (SELECT s_suppkey, s_acctbal, k, chr(65 + CAST(k % 5 AS INT)) || chr(65 + CAST(k % 25 AS INT)) AS country,
                           CASE WHEN k % 5 = 4 THEN NULL ELSE chr(65 + CAST(k % 5 AS INT)) END AS region
                    FROM (SELECT s_suppkey, s_acctbal, CAST(floor(s_suppkey / 3) AS BIGINT) AS k FROM supplier) s) t) u
    """,
    "files": f"""
        SELECT p_partkey AS file_id, 'cms' AS scope, {file_name('p_partkey')} AS name,
               {file_bytes('p_partkey')} AS bytes, CAST(p_size AS BIGINT) * 100 AS events,
               lower(hex({file_bytes('p_partkey')})) AS adler32, p_brand AS brand
        FROM part
    """,
    # container -> dataset, dataset -> file
    "contents": f"""
        SELECT {container_name('o_custkey')} AS name, {block_name('o_custkey', 'o_orderkey')} AS child_name,
               'C' AS did_type, 'D' AS child_type
        FROM orders
        UNION ALL
        SELECT {block_name('o_custkey', 'o_orderkey')} AS name, {file_name('l_partkey')} AS child_name,
               'D' AS did_type, 'F' AS child_type
        FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) t JOIN orders ON l_orderkey = o_orderkey
    """,
    "replicas": f"""
        SELECT 'cms' AS scope, {file_name('l_partkey')} AS name, l_suppkey AS rse_id,
               {file_bytes('l_partkey')} AS bytes, lower(hex({file_bytes('l_partkey')})) AS adler32,
               CASE flag WHEN 3 THEN 'A' WHEN 2 THEN CASE WHEN status = 0 THEN 'U' ELSE 'C' END ELSE 'B' END AS state,
               CASE WHEN flag = 1 THEN epoch_millis(shipped) END AS tombstone
        FROM (SELECT l_partkey, l_suppkey, max(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END) AS flag,
                     max(CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END) AS status, max(l_shipdate) AS shipped
              FROM lineitem GROUP BY l_partkey, l_suppkey) t
    """,
    "locks": f"""
        SELECT 'cms' AS scope, {file_name('l_partkey')} AS name, l_suppkey AS rse_id, l_orderkey AS rule_id, state,
               {file_bytes('l_partkey')} AS bytes
        FROM (SELECT DISTINCT l_partkey, l_suppkey, l_orderkey,
                     CASE WHEN l_linestatus = 'O' THEN 'O' WHEN l_returnflag = 'R' THEN 'R' ELSE 'S' END AS state
              FROM lineitem) t
    """,
    "rules": f"""
        SELECT o_orderkey AS rule_id, 'u' || CAST(o_custkey AS STRING) AS account,
               CASE o_orderpriority WHEN '5-LOW' THEN {file_name('o_orderkey')}
                    WHEN '4-NOT SPECIFIED' THEN {container_name('o_custkey')}
                    ELSE {block_name('o_custkey', 'o_orderkey')} END AS name,
               CASE o_orderpriority WHEN '5-LOW' THEN 'F' WHEN '4-NOT SPECIFIED' THEN 'C' ELSE 'D' END AS did_type,
               CASE o_orderstatus WHEN 'O' THEN 'O' WHEN 'F' THEN 'S'
                    ELSE CASE o_orderpriority WHEN '1-URGENT' THEN 'W' WHEN '2-HIGH' THEN 'R' ELSE 'U' END END AS state,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'User AutoApprove' WHEN '2-HIGH' THEN 'Data Consolidation'
                    ELSE 'Production Output' END AS activity,
               'T' || CAST(o_custkey % 4 AS STRING) || '_' || chr(65 + CAST(o_custkey % 5 AS INT)) || 'B_S'
                   || CAST(o_custkey % 30 AS STRING)
                   || CASE o_orderpriority WHEN '1-URGENT' THEN '_Test' WHEN '2-HIGH' THEN '_Tape_Test'
                      WHEN '3-MEDIUM' THEN '_Tape' ELSE '_Disk' END AS rse_expression,
               CASE WHEN o_orderstatus <> 'O' AND o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')
                    THEN 'RequestErrMsg.TRANSFER_FAILED:DESTINATION [17] Destination file exists and overwrite is not enabled'
                    END AS error,
               o_orderdate AS created_at, o_orderdate AS updated_at,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS stuck_at,
               CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'ProductionNanoAOD' ELSE 'Placement' END AS subscription
        FROM orders
    """,
    # one transfer request per wanted replica
    "requests": f"""
        SELECT 'cms' AS scope, {file_name('l_partkey')} AS name, rse AS dest_rse,
               'r' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) AS request_id,
               'https://transfer' || CAST(first_line AS STRING) || '.example.org:8446' AS external_host,
               'job-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) AS external_id,
               submitted_at
        FROM (SELECT l_partkey, l_suppkey, min(l_linenumber) AS first_line, min(l_shipdate) AS submitted_at
              FROM lineitem GROUP BY l_partkey, l_suppkey) t JOIN rses ON rse_id = l_suppkey
    """,
    # what a storage scan sees: sizes and checksums differ for some files, some are absent
    "storage_listing": f"""
        SELECT 'cms' AS scope, {file_name('l_partkey')} AS name, rse,
               CASE WHEN quantity < 5 THEN CAST(1 AS BIGINT) ELSE {file_bytes('l_partkey')} END AS size,
               CASE WHEN quantity >= 45 THEN 'deadbeef' ELSE '0' || hex({file_bytes('l_partkey')}) END AS checksum,
               CASE WHEN discount > 0.03 THEN 'ONLINE_AND_NEARLINE' ELSE 'ONLINE' END AS locality, modified_at
        FROM (SELECT l_partkey, l_suppkey, max(l_quantity) AS quantity, max(l_discount) AS discount,
                     max(l_shipdate) AS modified_at
              FROM lineitem GROUP BY l_partkey, l_suppkey HAVING max(l_tax) > 0.01) t JOIN rses ON rse_id = l_suppkey
    """,
    # dataset x endpoint with what is there and what should be there
    "dataset_replicas": f"""
        SELECT 'cms' AS scope, {block_name('o_custkey', 'l_orderkey')} AS name, {container_name('o_custkey')} AS container,
               rse, length, bytes, available_length, available_bytes,
               CASE WHEN available_length = length THEN 'AVAILABLE' ELSE 'UNAVAILABLE' END AS state
        FROM (SELECT l_orderkey, l_suppkey, count(*) AS length, CAST(sum({file_bytes('l_partkey')}) AS BIGINT) AS bytes,
                     CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS available_length,
                     CAST(sum(CASE WHEN l_returnflag = 'R' THEN {file_bytes('l_partkey')} ELSE 0 END) AS BIGINT) AS available_bytes
              FROM lineitem GROUP BY l_orderkey, l_suppkey) t
        JOIN orders ON o_orderkey = l_orderkey JOIN rses ON rse_id = l_suppkey
    """,
    # nested containers: nation -> customer containers on top of ``contents``
    "nested_contents": f"""
        SELECT name, child_name, did_type, child_type FROM contents
        UNION ALL
        SELECT '/Nation' || CAST(c_nationkey AS STRING) || '/All-v1/RAW' AS name, {container_name('c_custkey')} AS child_name,
               'C' AS did_type, 'C' AS child_type
        FROM customer
    """,
    # --- two inventories per site: what a source lists and what the catalogue holds ------
    "site_files": f"""
        SELECT coalesce(region, 'X') || '_' || rse_type AS site, rse,
               {block_name('o_custkey', 'l_orderkey')} AS block, {file_name('l_partkey')} AS name,
               l_returnflag AS flag, l_linestatus AS status
        FROM (SELECT DISTINCT l_orderkey, l_partkey, l_suppkey, l_returnflag, l_linestatus FROM lineitem) t
        JOIN orders ON o_orderkey = l_orderkey JOIN rses ON rse_id = l_suppkey
    """,
    "source_files": "SELECT site, rse, block, name FROM site_files WHERE flag <> 'A'",
    "catalogue_files": """
        SELECT site, rse, block, name, CASE WHEN status = 'O' THEN 'A' ELSE 'U' END AS state
        FROM site_files WHERE flag <> 'N' OR status = 'F'
    """,
    "source_blocks": "SELECT site, block, count(*) AS n_files FROM source_files GROUP BY site, block",
    "catalogue_blocks": "SELECT site, block, count(*) AS n_files FROM catalogue_files GROUP BY site, block",
    # rules of the sync accounts, some of them expiring
    "sync_rules": """
        SELECT row_key AS rule_id, name, 'D' AS did_type, 'sync_' || lower(rse) AS account, 'rse=' || rse AS rse_expression,
               CASE WHEN available_length = 0 THEN 'later' END AS expires_at
        FROM (SELECT name || '@' || rse AS row_key, name, rse, length, available_length, bytes FROM dataset_replicas) t
        WHERE bytes > 1500000
    """,
    "storage_paths": f"""
        SELECT rse, {file_name('l_partkey')} AS path
        FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag <> 'A') t JOIN rses ON rse_id = l_suppkey
    """,
    "catalogue_paths": f"""
        SELECT rse, {file_name('l_partkey')} AS path
        FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag <> 'N' OR l_linestatus = 'F') t
        JOIN rses ON rse_id = l_suppkey
    """,
    # runs that saw a path on storage that the catalogue does not hold
    "dark_history": f"""
        SELECT rse, {file_name('k')} AS path, run_at
        FROM (SELECT DISTINCT coalesce(region, 'X') || '_' || rse_type AS rse, l_partkey AS k, l_shipdate AS run_at
              FROM lineitem JOIN rses ON rse_id = l_suppkey) t
    """,
    "scan_totals": f"""
        SELECT rse, count(*) * 40 AS files, max(run_at) AS last_run FROM dark_history GROUP BY rse
    """,
    # --- accounts ------------------------------------------------------------------------
    "accounts": """
        SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN 'team' || CAST(c_custkey AS STRING) || '_group'
                    WHEN c_mktsegment = 'MACHINERY' THEN 'site' || CAST(c_custkey AS STRING) || '_local_users'
                    WHEN c_mktsegment = 'FURNITURE' THEN 'team' || CAST(c_custkey AS STRING)
                    ELSE 'u' || CAST(c_custkey AS STRING) END AS account,
               CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE') THEN 'GROUP' ELSE 'USER' END AS account_type,
               CASE WHEN c_acctbal > 1000 THEN 'mail' || CAST(c_custkey AS STRING) || '@example.org' END AS email,
               c_custkey AS account_key, c_nationkey AS home
        FROM customer
    """,
    "identities_now": """
        SELECT account, CASE WHEN account_type = 'USER' THEN 'SUB=' || account ELSE '/DC=org/CN=' || account END AS identity,
               CASE WHEN account_type = 'USER' THEN 'OIDC' ELSE 'X509' END AS authtype, email
        FROM accounts
        UNION ALL
        SELECT account, '/DC=org/CN=old ' || account, 'X509', NULL FROM accounts WHERE email IS NULL
    """,
    "identities_wanted": """
        SELECT account, '/DC=org/CN=' || account AS identity FROM accounts WHERE email IS NOT NULL
    """,
    "scopes": """
        SELECT 'group.' || account AS scope FROM accounts WHERE account_type = 'GROUP' AND email IS NULL
        UNION ALL SELECT 'user.' || account FROM accounts WHERE account_type = 'USER'
    """,
    "sync_accounts": "SELECT 'sync_' || lower(rse) AS account FROM rses WHERE availability_write",
    "sync_attributes": """
        SELECT 'sync_' || lower(rse) AS account, 'admin' AS key, CASE WHEN tier = 0 THEN 'True' ELSE 'true' END AS value
        FROM rses WHERE weight_hint > 0
    """,
    # --- endpoint attributes --------------------------------------------------------------
    "attributes_wanted": """
        SELECT rse, 'tier' AS key, CAST(tier AS STRING) AS value FROM rses
        UNION ALL SELECT rse, 'country', country FROM rses
        UNION ALL SELECT rse, 'tape', CASE WHEN rse_type = 'TAPE' THEN '1' ELSE '0' END FROM rses
        UNION ALL SELECT rse, rse, 'True' FROM rses
    """,
    "attributes_now": """
        SELECT rse, 'tier' AS key, CASE WHEN weight_hint > 0 THEN CAST(tier AS STRING) ELSE '9' END AS value FROM rses
        UNION ALL SELECT rse, 'country', country FROM rses WHERE availability_write
        UNION ALL SELECT rse, 'tape', 'True' FROM rses
        UNION ALL SELECT rse, rse, 'True' FROM rses WHERE weight_hint > -500
        UNION ALL SELECT rse, site, 'True' FROM rses WHERE rse_type = 'TAPE'
        UNION ALL SELECT rse, 'site_admins', 'u' || CAST(tier AS STRING) || ',u' || CAST(rse_id AS STRING) FROM rses
        UNION ALL SELECT rse, 'site_capacity_manager', 'u1,u2,u' || CAST(rse_id AS STRING) FROM rses WHERE rse_type = 'DISK'
    """,
    "protocols_wanted": """
        SELECT rse, scheme, read_priority, scheme || '://' || lower(rse) || ':' || CAST(1000 + read_priority AS STRING) AS definition
        FROM (SELECT rse, 'root' AS scheme, 3 AS read_priority FROM rses
              UNION ALL SELECT rse, 'davs', 1 FROM rses WHERE rse_type = 'DISK'
              UNION ALL SELECT rse, 'srm', 2 FROM rses WHERE rse_type = 'TAPE'
              UNION ALL SELECT rse, 'file', 4 FROM rses WHERE tier = 1) t
    """,
    "protocols_now": """
        SELECT rse, scheme, CASE WHEN availability_write THEN 3 ELSE 5 END AS read_priority,
               scheme || '://' || lower(rse) || ':' || CASE WHEN availability_write THEN '1003' ELSE '1094' END AS definition
        FROM (SELECT rse, availability_write, 'root' AS scheme FROM rses WHERE tier > 0
              UNION ALL SELECT rse, availability_write, 'gsiftp' FROM rses WHERE rse_type = 'TAPE'
              UNION ALL SELECT rse, availability_write, 'file' FROM rses WHERE tier = 1 AND rse_type = 'DISK') t
    """,
    # --- snapshots of names: yesterday, today, archive of deleted names --------------------
    "dids_old": """
        SELECT scope, name, 'F' AS did_type, bytes FROM files WHERE brand <> 'Brand#1'
    """,
    "dids_new": """
        SELECT scope, name, 'F' AS did_type, bytes FROM files WHERE brand NOT IN ('Brand#2', 'Brand#3')
    """,
    "dids_archive": """
        SELECT scope, name, 'F' AS did_type, bytes FROM files WHERE brand IN ('Brand#1', 'Brand#3', 'Brand#4')
    """,
    # --- space, metrics, links -------------------------------------------------------------
    "space_held": """
        SELECT rse, tier, rse_type, weight_hint, CAST(sum(bytes) AS BIGINT) AS used,
               CAST(sum(CASE WHEN state = 'B' THEN bytes ELSE 0 END) AS BIGINT) AS expired,
               CAST(sum(CASE WHEN state = 'U' THEN bytes ELSE 0 END) AS BIGINT) AS unavailable
        FROM (SELECT rse_id AS replica_rse, bytes, state FROM replicas) r JOIN rses ON rse_id = replica_rse
        GROUP BY rse, tier, rse_type, weight_hint
    """,
    # no static figure for some, and less than what is held for others
    "rse_usage": """
        SELECT rse, 'used' AS source, used FROM space_held
        UNION ALL SELECT rse, 'expired', expired FROM space_held
        UNION ALL SELECT rse, 'unavailable', unavailable FROM space_held WHERE tier <> 3
        UNION ALL SELECT rse, 'static',
                         used * CASE tier WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 1 END
                         - CASE WHEN weight_hint > 5000 THEN 1000000 ELSE 0 END
                  FROM space_held WHERE weight_hint > -500
    """,
    "rse_limits": "SELECT rse, CAST(round(weight_hint * 1000) AS BIGINT) AS min_free FROM rses WHERE weight_hint > 2000",
    "weight_settings": """
        SELECT rse, availability_write, CASE WHEN region = 'A' THEN '0.5' WHEN region = 'C' THEN '2' END AS coefficient,
               rse_type, cms_type, tier
        FROM rses
    """,
    "site_metrics": """
        SELECT site AS name, ts, event_id, value AS disk_experiment_use,
               CASE WHEN value < 20 THEN 0.0 ELSE value END AS disk_local_use, value * 3 AS tape_usable,
               CASE event_type WHEN 'view' THEN 'enabled' WHEN 'click' THEN 'dependable' WHEN 'error' THEN 'blocked' END AS status
        FROM (SELECT event_id, ts, value, event_type, user_id % (SELECT count(*) FROM supplier) AS k FROM events) e
        JOIN rses ON rse_id = k
    """,
    "transfer_events": f"""
        SELECT CASE WHEN event_type = 'error' THEN 'transfer-failed' ELSE 'transfer-done' END AS event_type,
               src_rse, rse AS dst_rse, {file_name('event_id')} AS name, ts, value AS duration,
               'r' || CAST(event_id AS STRING) AS request_id, 'TRANSFER [70] "' || event_type || '"' AS purged_reason
        FROM (SELECT event_id, event_type, ts, value, rse AS src_rse, d
              FROM (SELECT event_id, event_type, ts, value, user_id % (SELECT count(*) FROM supplier) AS s,
                           event_id % (SELECT count(*) FROM supplier) AS d FROM events) e
              JOIN rses ON rse_id = s) t
        JOIN rses ON rse_id = d
    """,
    "links": "SELECT DISTINCT src_rse AS src, dst_rse AS dest FROM transfer_events",
    "distances": """
        SELECT src_rse AS src, dst_rse AS dest,
               CASE WHEN max(duration) > 60 THEN NULL WHEN max(duration) > 30 THEN 13 ELSE 7 END AS distance
        FROM transfer_events WHERE event_type = 'transfer-failed' GROUP BY src_rse, dst_rse
    """,
    # accounts with the endpoint of their home
    "users": """
        SELECT account, account_type, rse, site, country, region, account_key, email
        FROM (SELECT account, account_type, account_key, email, account_key % (SELECT count(*) FROM supplier) AS k FROM accounts) a
        JOIN rses ON rse_id = k
    """,
    "user_limits": """
        SELECT account, rse, CAST(CASE WHEN account_type = 'USER' THEN 1000 ELSE 7000 END AS BIGINT) AS quota
        FROM users WHERE email IS NOT NULL
    """,
    "managers": "SELECT lower(site) AS site, account AS login FROM users",
    "local_accounts": """
        SELECT lower(rse) || CASE WHEN tier = 1 THEN '_local_users' ELSE '_local' END AS account FROM rses WHERE availability_write
        UNION ALL SELECT lower(rse) || '_local' FROM rses WHERE tier = 1
    """,
    "local_quotas": "SELECT lower(rse) || '_local_users' AS account, rse, CAST(5000 AS BIGINT) AS quota FROM rses",
    "dataset_files": """
        SELECT block AS dataset, name, bytes, events
        FROM (SELECT name AS block, child_name AS file FROM contents WHERE did_type = 'D') c JOIN files ON name = file
    """,
    # --- requests, jobs, integrity -----------------------------------------------------------
    "inv_requests": f"""
        SELECT o_orderkey AS id, 'q' || CAST(o_custkey AS STRING) AS request_id, {file_name('o_orderkey')} AS file_name,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'aborted' WHEN '2-HIGH' THEN 'failed' WHEN '3-MEDIUM' THEN 'queued'
                    WHEN '4-NOT SPECIFIED' THEN 'success' ELSE CASE WHEN o_orderstatus = 'O' THEN 'parked' ELSE 'waiting_approval' END END AS status,
               CASE o_orderstatus WHEN 'O' THEN 'global' WHEN 'F' THEN 'local' ELSE 'other' END AS mode,
               CASE WHEN o_orderstatus = 'F' THEN 'T0_AA_S0' END AS rse,
               o_orderpriority = '3-MEDIUM' AS dry_run, o_orderstatus = 'F' AND o_totalprice > 200000 AS last_replicas,
               'Lost files CMSDM-' || CAST(o_custkey % 97 AS STRING) || ' and CMSPROD-' || CAST(o_custkey AS STRING)
                   || CASE WHEN o_orderpriority = '1-URGENT' THEN ' - Request aborted by u' || CAST(o_orderkey AS STRING) ELSE '' END AS reason,
               'file-invalidation-job-' || substr(md5(CAST(o_custkey AS STRING)), 1, 8) || '-x1' AS job_id,
               'u' || CAST(o_custkey % 11 AS STRING) AS request_user,
               CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'boss' END AS approve_user,
               o_orderdate AS submitted_date
        FROM orders
    """,
    "job_logs": f"""
        SELECT 'j' || CAST(o_orderkey AS STRING) AS job,
               CASE WHEN o_orderstatus = 'F' THEN 'start' || chr(10) || 'Would declare file ' || {file_name('o_orderkey')} || ' as bad at [X]' || chr(10)
                         || 'Would invalidate file on DBS: ' || {file_name('o_custkey')} || chr(10)
                         || 'Would invalidate dataset on DBS: ' || {file_name('(o_custkey + 1)')} || chr(10)
                    WHEN o_orderstatus = 'O' THEN 'Declared file ' || {file_name('o_orderkey')} || ' as bad at [X]' || chr(10)
                         || 'Declared file ' || {file_name('o_custkey')} || ' as bad at [X]' || chr(10)
                         || 'Invalidation OK for file: ' || {file_name('o_orderkey')} || chr(10) || 'end'
                    WHEN o_orderpriority = '1-URGENT' THEN 'Error running shell script: Declared file ' || {file_name('o_orderkey')} || ' as bad at'
                    ELSE 'nothing to do' END AS logs
        FROM orders
    """,
    "pods": """
        SELECT 'job' || CAST(o_custkey AS STRING) AS job_name, 'pod' || CAST(o_orderkey AS STRING) AS pod,
               CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS start_time, o_orderdate AS created_at, o_totalprice AS size
        FROM orders
    """,
    # a few requests hold all rows
    "int_replicas": f"""
        SELECT 'i' || CAST(l_linenumber AS STRING) AS request_id, 'cms' AS scope, {file_name('l_partkey')} AS lfn,
               'T1_R' || CAST(supp AS STRING) AS rse, 'root://r' || CAST(supp AS STRING) || '/f' AS pfn, status
        FROM (SELECT DISTINCT l_linenumber, l_partkey,
                     CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN NULL ELSE l_suppkey END AS supp,
                     CASE WHEN l_returnflag = 'R' THEN 'OK' WHEN l_returnflag = 'A' THEN CASE WHEN l_linestatus = 'O' THEN 'CORRUPTED' ELSE 'OK' END
                          WHEN l_linestatus = 'F' THEN 'pending' ELSE 'ERROR' END AS status
              FROM lineitem) t
    """,
    "int_requests": """
        SELECT DISTINCT 'i' || CAST(l_linenumber AS STRING) AS request_id,
               CASE WHEN l_linenumber < 4 THEN 'u1' ELSE 'u2' END AS requested_by,
               CASE WHEN l_linenumber = 7 THEN 'FAILED' ELSE 'COMPLETED' END AS status
        FROM lineitem
    """,
    "int_checked": f"""
        SELECT CASE WHEN l_quantity > 20 THEN 'i' ELSE 'j' END || CAST(l_linenumber AS STRING) AS request_id,
               CASE WHEN max(CASE l_linestatus WHEN 'O' THEN 1 ELSE 0 END) = 1 THEN 'cms:' ELSE '' END || {file_name('l_partkey')} AS filename, {file_name('l_partkey')} AS lfn,
               CASE WHEN max(l_discount) > 0.08 THEN 'no replicas' END AS error,
               'T1_R' || CAST(max(l_suppkey) AS STRING) AS rse1, 'T2_R' || CAST(min(l_suppkey) AS STRING) AS rse2
        FROM lineitem GROUP BY l_quantity > 20, l_linenumber, l_partkey
    """,
    # access paths tried in order; content is one byte so that its checksum has a closed form
    "attempts": f"""
        SELECT {file_name('l_partkey')} AS lfn, 'T1_S' || l_linestatus AS rse, l_orderkey * 100000 + l_suppkey AS pos,
               'root://h' || CAST(l_orderkey AS STRING) || l_linestatus || '/' || CAST(l_suppkey AS STRING)
                   || {file_name('l_partkey')} AS pfn, copied, letter,
               CASE WHEN l_linestatus = 'O' THEN CASE letter WHEN 'A' THEN '00420042' WHEN 'N' THEN '004f004f' ELSE '00530053' END
                    ELSE '004f004f' END AS adler32
        FROM (SELECT l_partkey, l_linestatus, l_orderkey, l_suppkey, max(l_tax) > 0.05 AS copied,
                     CASE max(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END) WHEN 1 THEN 'A' WHEN 2 THEN 'N' ELSE 'R' END AS letter
              FROM lineitem GROUP BY l_partkey, l_linestatus, l_orderkey, l_suppkey) t
    """,
    "submissions": f"""
        SELECT 's' || CAST(o_custkey AS STRING) AS request_id,
               CASE o_orderpriority WHEN '5-LOW' THEN '  ' WHEN '1-URGENT' THEN 'cms:' || {file_name('o_custkey')} ELSE {file_name('o_orderkey')} END
               || CASE WHEN o_orderpriority = '2-HIGH' AND o_totalprice > 450000 THEN '.txt' ELSE '' END AS line
        FROM orders
    """,
}


# Spark reads a view over tables that are dealt by the key that its steps share, so that one shuffle serves them all.
# The rows are the same, and so is the text that the checking engine reads.
DEALT = {"contents": {"lineitem": "l_orderkey"}, "locks": {"lineitem": "l_orderkey"}}


def _spark_text(sql: str) -> str:
    return re.sub(r"epoch_millis\((\w+)\)", r"unix_millis(CAST(\1 AS TIMESTAMP))", sql)


def _check_text(sql: str) -> str:
    return sql.replace("epoch_millis(", "epoch_ms(")


_WORD = re.compile(r"\b[a-z_]\w*\b")


def _mentioned(sql: str, names) -> list[str]:
    """``names`` used as relations in ``sql`` (after FROM or JOIN, or in a comma list there)."""
    found = re.findall(r"\b(?:FROM|JOIN)\s+([a-z_]\w*)", sql)
    return sorted({w for w in found if w in names})


def check_sql(sql: str) -> str:
    """``sql`` with the views it needs put in front."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in _mentioned(text, VIEWS):
            if name not in needed:
                visit(VIEWS[name])
                needed.append(name)

    visit(sql)
    if not needed:
        return sql
    views = ",\n".join(f"{name} AS ({_check_text(VIEWS[name]).strip()})" for name in needed)
    body = sql.strip()
    if re.match(r"(?i)with\b(?!\s+recursive)", body):
        return f"WITH {views},\n{body[4:].strip()}"
    return f"WITH {views}\n{body}"


class Catalogue:
    """Lazy access to tables and views: ``Catalogue(spark, sf_dir).replicas``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = apply_settings(spark)
        self.sf_dir = sf_dir.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._frames:
            if name in VIEWS:
                self._frames[name] = self.sql(VIEWS[name], DEALT.get(name, {}))
            elif name in TABLES:
                self._frames[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                raise AttributeError(f"no table or view {name!r}")
        return self._frames[name]

    def sql(self, sql: str, dealt: dict[str, str] | None = None) -> DataFrame:
        """Run a SELECT over tables and views by their plain names; those in ``dealt`` are dealt by that column."""
        deps = _mentioned(sql, set(VIEWS) | set(TABLES))
        text = _spark_text(sql)
        for dep in deps:
            text = re.sub(rf"\b(FROM|JOIN)(\s+){dep}\b", rf"\1\2{{{dep}}}", text)
        frames = {dep: getattr(self, dep) for dep in deps}
        frames |= {dep: frames[dep].repartition(by) for dep, by in (dealt or {}).items()}
        return self.spark.sql(text, **frames)
