"""Registered queries: invalidation requests, job logs, integrity results, checks."""

import pandas as pd
from pyspark.sql import functions as F

from ..functions import names as N
from ..operators import integrity as itg
from ..operators import quality as q
from ..operators import records as recs
from ..operators import requests as rq
from ..session import drop_path, scratch_path
from ..streaming import streams as st
from ..streaming import upserts as up
from . import registered
from .invalidation import stamp

_PRIORITY = """CASE status WHEN 'aborted' THEN 0 WHEN 'failed' THEN 1 WHEN 'in_progress' THEN 2 WHEN 'queued' THEN 3
    WHEN 'waiting_approval' THEN 4 WHEN 'success' THEN 5 ELSE 6 END"""


@registered(
    "invalidation_request_filters",
    """SELECT id, request_id, file_name, status FROM inv_requests WHERE status = 'aborted' AND request_user = 'u3'
       AND regexp_matches(file_name, 'Era[0-9]/') AND regexp_matches(reason, 'CMSDM-[0-9]+')""",
)
def _(c):
    out = rq.invalidation_request_filters(
        c.inv_requests, status="aborted", request_user="u3", file_regex="Era[0-9]/", reason_regex="CMSDM-[0-9]+"
    )
    return out.select("id", "request_id", "file_name", "status")


@registered("status_priority_sort", f"SELECT id, status, CAST({_PRIORITY} AS INTEGER) AS status_priority FROM inv_requests")
def _(c):
    return rq.status_priority_sort(c.inv_requests, "id").select("id", "status", "status_priority")


_GROUPS = f"""
    g AS (SELECT request_id, status, mode, rse, dry_run, last_replicas, request_user, approve_user, job_id,
                 CASE WHEN instr(reason, '- Request aborted') > 0 THEN substr(reason, 1, instr(reason, '- Request aborted') - 1) ELSE reason END AS truncated_reason,
                 count(*) AS total_objects, min(submitted_date) AS submitted_at, CAST({_PRIORITY} AS INTEGER) AS status_priority
          FROM inv_requests GROUP BY ALL)
"""


def _groups(c):
    return rq.invalidation_request_groups(c.inv_requests)


@registered(
    "invalidation_request_groups",
    f"WITH {_GROUPS} SELECT * REPLACE (strftime(submitted_at, '%Y-%m-%d %H:%M:%S') AS submitted_at) FROM g",
)
def _(c):
    return _groups(c).withColumn("submitted_at", stamp("submitted_at"))


@registered(
    "page_of_requests",
    f"""WITH {_GROUPS} SELECT request_id, status, total_objects FROM g
        ORDER BY status_priority, submitted_at, total_objects DESC, request_id, truncated_reason LIMIT 10 OFFSET 20""",
)
def _(c):
    return rq.page_of_requests(_groups(c), 3).select("request_id", "status", "total_objects")


@registered("raw_flag", "SELECT request_id, bool_or(contains(file_name, '/RAW/')) AS contains_raw FROM inv_requests GROUP BY 1")
def _(c):
    return rq.raw_flag(c.inv_requests)


_FIRST = """
    f AS (SELECT request_id, file_name, row_number() OVER (PARTITION BY request_id ORDER BY file_name) AS n FROM inv_requests),
    p AS (SELECT request_id, string_agg(file_name, ',' ORDER BY file_name) AS preview FROM f WHERE n <= 10 GROUP BY 1)
"""


@registered("preview_n", f"WITH {_FIRST} SELECT * FROM p")
def _(c):
    return rq.preview_n(c.inv_requests).withColumn("preview", F.array_join("preview", ","))


@registered(
    "request_ticket_facts",
    f"""WITH {_FIRST},
    t AS (SELECT request_id, count(*) AS n_files, bool_or(contains(file_name, '/RAW/')) AS contains_raw,
                 arg_min(request_user, file_name) AS request_user, arg_min(mode, file_name) AS mode,
                 arg_min(reason, file_name) AS reason FROM inv_requests GROUP BY 1)
    SELECT t.request_id, n_files, contains_raw, request_user, mode, preview,
           array_to_string(regexp_extract_all(reason, '(CMS(?:PROD|TRANSF|DM|TZ)\\-[0-9]+)', 1), ',') AS tickets
    FROM t JOIN p ON p.request_id = t.request_id""",
)
def _(c):
    return rq.request_ticket_facts(c.inv_requests).select(
        "request_id", "n_files", "contains_raw", "request_user", "mode",
        F.array_join("preview", ",").alias("preview"), F.array_join("tickets", ",").alias("tickets"),
    )


def _submitted(c):
    return c.files.select(F.concat(F.lit(" cms:"), "name").alias("file_name"))


_REAL = "r AS (SELECT file_name, min(status) AS status FROM inv_requests WHERE NOT dry_run GROUP BY 1)"


@registered(
    "new_request_files",
    f"WITH {_REAL} SELECT f.name AS file_name, r.status FROM files f LEFT JOIN r ON r.file_name = f.name",
)
def _(c):
    new, held = rq.new_request_files(_submitted(c), c.inv_requests)
    return new.withColumn("status", F.lit(None).cast("string")).unionByName(held)


@registered(
    "latest_pod_log",
    """SELECT job_name, pod, size FROM (SELECT *, row_number() OVER (PARTITION BY job_name
       ORDER BY coalesce(start_time, created_at) DESC, pod) AS n FROM pods) WHERE n = 1""",
)
def _(c):
    return rq.latest_pod_log(c.pods).select("job_name", "pod", "size")


_PARSED = r"""
    l AS (SELECT job, logs, contains(logs, 'Would declare file') AS dry FROM job_logs WHERE NOT contains(logs, 'Error running shell script')),
    u AS (SELECT job, dry, 'catalogue' AS target, unnest(regexp_extract_all(logs, CASE WHEN dry THEN 'Would declare file' ELSE 'Declared file' END || ' (/[\w/\-]+.root) as bad at', 1)) AS name FROM l
          UNION ALL SELECT job, dry, 'bookkeeping', unnest(regexp_extract_all(logs, CASE WHEN dry THEN 'Would invalidate file on DBS:' ELSE 'Invalidation OK for file:' END || ' (/[\w/\-]+.root)\s', 1)) FROM l
          UNION ALL SELECT job, dry, t, unnest(regexp_extract_all(logs, CASE WHEN dry THEN 'Would invalidate dataset on DBS:' ELSE 'Invalidation OK for dataset:' END || ' (/[\w/\-]+.root)\s', 1)) FROM l, (VALUES ('catalogue'), ('bookkeeping')) v(t)),
    p AS (SELECT DISTINCT job, dry AS dry_run, target, name FROM u)
"""


@registered("job_log_parse", f"WITH {_PARSED} SELECT * FROM p".replace("(VALUES ('catalogue'), ('bookkeeping')) v(t)", "(SELECT unnest(['catalogue', 'bookkeeping']) AS t) v"))
def _(c):
    return rq.job_log_parse(c.job_logs)


@registered(
    "job_outcome_merge",
    f"""WITH {_PARSED}
    SELECT q.job, q.file_name, 'success' AS status,
           CASE WHEN bool_or(target = 'catalogue') AND bool_or(target = 'bookkeeping') THEN 'global'
                WHEN bool_or(target = 'catalogue') THEN 'catalogue_only' ELSE 'bookkeeping_only' END AS mode, bool_or(dry_run) AS dry_run
    FROM (SELECT 'j' || CAST(id AS VARCHAR) AS job, file_name FROM inv_requests) q JOIN p ON p.job = q.job AND p.name = q.file_name GROUP BY 1, 2""".replace(
        "(VALUES ('catalogue'), ('bookkeeping')) v(t)", "(SELECT unnest(['catalogue', 'bookkeeping']) AS t) v"
    ),
)
def _(c):
    files = c.inv_requests.select(F.concat(F.lit("j"), F.col("id").cast("string")).alias("job"), "file_name")
    return rq.job_outcome_merge(files, rq.job_log_parse(c.job_logs))


# --- integrity -----------------------------------------------------------------------
_STATUS = """CASE WHEN corrupted = n THEN 'FULLY_CORRUPTED' WHEN corrupted > 0 THEN 'PARTIALLY_CORRUPTED' WHEN ok = n THEN 'FULLY_OK'
    WHEN ok > 0 THEN 'OK' WHEN pending > 0 THEN 'PENDING' WHEN error > 0 THEN 'ERROR' ELSE 'UNKNOWN' END"""
_FILES = """
    f AS (SELECT request_id, lfn, min(scope) AS scope, count(*) AS n, count(*) FILTER (status = 'OK') AS ok,
                 count(*) FILTER (status = 'CORRUPTED') AS corrupted, count(*) FILTER (status = 'ERROR') AS error,
                 count(*) FILTER (status = 'pending') AS pending,
                 string_agg(DISTINCT coalesce(rse, '') || '/' || status, ',' ORDER BY coalesce(rse, '') || '/' || status) AS records
          FROM int_replicas GROUP BY 1, 2)
"""


@registered(
    "integrity_file_status",
    f"""WITH {_FILES} SELECT request_id, lfn, scope, n AS replica_count, ok AS OK, corrupted AS CORRUPTED, error AS ERROR, pending,
        {_STATUS} AS file_status FROM f""",
)
def _(c):
    return itg.integrity_file_status(c.int_replicas)


@registered(
    "integrity_files_view",
    f"WITH {_FILES} SELECT request_id, lfn, {_STATUS} AS file_status, records FROM f",
)
def _(c):
    record = lambda r: F.concat_ws("/", F.coalesce(r["rse"], F.lit("")), r["status"])
    return itg.integrity_files_view(c.int_replicas).select(
        "request_id", "lfn", "file_status",
        F.array_join(F.array_sort(F.array_distinct(F.transform("replicas", record))), ",").alias("records"),
    )


@registered(
    "integrity_request_summary",
    """SELECT request_id, count(DISTINCT lfn) AS lfn_count, count(*) AS replica_count, count(*) FILTER (status = 'OK') AS OK,
              count(*) FILTER (status = 'CORRUPTED') AS CORRUPTED, count(*) FILTER (status = 'ERROR') AS ERROR,
              count(*) FILTER (status = 'pending') AS pending FROM int_replicas GROUP BY 1""",
)
def _(c):
    return itg.integrity_request_summary(c.int_replicas)


@registered("lfns_per_rse", "SELECT DISTINCT coalesce(rse, 'UNKNOWN_RSE') AS rse, lfn FROM int_replicas")
def _(c):
    return itg.lfns_per_rse(c.int_replicas)


@registered(
    "lfns_per_rse_text",
    """WITH r AS (SELECT DISTINCT coalesce(rse, 'UNKNOWN_RSE') AS rse, lfn FROM int_replicas)
    SELECT DISTINCT rse, 0 AS part, rse AS line FROM r UNION ALL SELECT rse, 1, lfn FROM r UNION ALL SELECT DISTINCT rse, 2, '' FROM r""",
)
def _(c):
    return itg.lfns_per_rse_text(c.int_replicas)


@registered(
    "integrity_verdict_counts",
    "SELECT count(*) FILTER (status = 'OK') AS passed, count(*) FILTER (status <> 'OK') AS failed FROM int_replicas",
)
def _(c):
    return itg.integrity_verdict_counts(c.int_replicas)


@registered(
    "integrity_request_filters",
    """SELECT request_id, lfn, rse, status FROM int_replicas WHERE status = 'CORRUPTED'
       AND request_id IN (SELECT request_id FROM int_requests WHERE status = 'COMPLETED' AND requested_by = 'u2')""",
)
def _(c):
    out = itg.integrity_request_filters(c.int_requests, c.int_replicas, status="COMPLETED", user="u2", replica_status="CORRUPTED")
    return out.select("request_id", "lfn", "rse", "status")


def _results(c):
    replica = lambda rse, status: F.struct(
        F.col(rse).alias("rse"), F.concat(F.lit("root://"), rse).alias("pfn"), F.lit(status).cast("string").alias("status")
    )
    return c.int_checked.select(
        "request_id", "filename", "error", F.array(replica("rse1", "OK"), replica("rse2", None)).alias("replicas")
    )


@registered(
    "job_result_json",
    """SELECT request_id, NULL::VARCHAR AS log_error, filename, error, 'OK' AS first_status FROM int_checked WHERE error IS NULL
       UNION ALL SELECT request_id, 'no result list in log', NULL, NULL, NULL FROM int_checked WHERE error IS NOT NULL""",
)
def _(c):
    # one log per checked file: noise, an earlier list, the result as JSON, a trailing line
    log = F.when(
        F.col("error").isNull(),
        F.concat(F.lit("INFO start\n[1, 2]\n  "), F.to_json(F.array(F.struct("filename", "error", "replicas"))), F.lit("\nbye")),
    ).otherwise("INFO start\nno results\n")
    out = itg.job_result_json(_results(c).select("request_id", log.alias("logs")))
    return out.select("request_id", "log_error", "filename", "error", F.col("replicas")[0]["status"].alias("first_status"))


_UPSERT = """WITH kept AS (SELECT o.* FROM int_replicas o WHERE NOT (o.status = 'pending' AND EXISTS
             (SELECT 1 FROM int_checked r WHERE r.request_id = o.request_id AND r.lfn = o.lfn))),
    n AS (SELECT request_id, 'cms' AS scope, lfn, NULL AS rse, NULL AS pfn, 'ERROR' AS status FROM int_checked WHERE error IS NOT NULL
          UNION ALL SELECT request_id, 'cms', lfn, rse1, 'root://' || rse1, 'OK' FROM int_checked WHERE error IS NULL
          UNION ALL SELECT request_id, 'cms', lfn, rse2, 'root://' || rse2, 'ERROR' FROM int_checked WHERE error IS NULL)
    SELECT request_id, scope, lfn, rse, pfn, status FROM kept
    UNION ALL SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM kept k WHERE k.request_id = n.request_id AND k.lfn = n.lfn
                                                AND k.rse IS NOT DISTINCT FROM n.rse)"""


@registered(
    "integrity_upsert",
    _UPSERT,
)
def _(c):
    return itg.integrity_upsert(c.int_replicas, _results(c))


@registered("integrity_upsert_stream", _UPSERT)
def _(c):
    """Results that arrive in batches, each delivered twice, go into a stored table."""
    path = scratch_path(c.spark, "integrity")
    old = c.int_replicas.select("request_id", "scope", "lfn", "rse", "pfn", "status")
    replicas = up.UpsertTable(f"{path}/table", "lfn", ", ".join(f"{n} {t}" for n, t in old.dtypes), buckets=32, placed=True)
    replicas.create(old)
    results = _results(c)
    results.write.parquet(f"{path}/results")
    c.spark.read.schema(results.schema).parquet(f"{path}/results").write.mode("append").parquet(f"{path}/results")
    stream = st.read_stream(c.spark, f"{path}/results", "*.parquet", results.schema, files_a_batch=6)
    name = itg.split_scope("filename")["name"]
    sink = up.upsert_sink(stream, replicas, name, itg.integrity_upsert, several=True)
    sink.option("checkpointLocation", f"{path}/progress").trigger(availableNow=True).start().awaitTermination()
    # what has arrived is in the table's log
    drop_path(c.spark, f"{path}/results")
    replicas.fold(c.spark, results.schema, name, itg.integrity_upsert)
    return replicas.stored(c.spark)


@registered(
    "first_good_pfn",
    """SELECT lfn, rse, coalesce(arg_min(pfn, pos) FILTER (copied), arg_max(pfn, pos)) AS pfn,
              CASE WHEN bool_or(copied) THEN NULL ELSE 'ERROR' END AS status FROM attempts GROUP BY 1, 2""",
)
def _(c):
    return itg.first_good_pfn(c.attempts.select("lfn", "rse", "pos", "pfn", "copied"))


def _content(c):
    return c.attempts.withColumn("content", F.encode("letter", "UTF-8"))


_SUM = "CASE letter WHEN 'A' THEN '00420042' WHEN 'N' THEN '004f004f' ELSE '00530053' END"


def _reject_r():
    """Content check of the example: files made of the letter R do not decode."""

    def run(frames):
        for frame in frames:
            status = frame["content"].map(lambda b: "CORRUPTED" if b == b"R" else "OK")
            yield pd.DataFrame({"lfn": frame["lfn"], "rse": frame["rse"], "pfn": frame["pfn"], "status": status})

    return run


@registered(
    "payload_check_job",
    f"""WITH g AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lfn, rse ORDER BY pos) AS n FROM attempts WHERE copied) WHERE n = 1)
    SELECT lfn, rse, pfn, CASE WHEN {_SUM} <> adler32 OR letter = 'R' THEN 'CORRUPTED' ELSE 'OK' END AS status FROM g
    UNION ALL SELECT lfn, rse, arg_max(pfn, pos), 'ERROR' FROM attempts GROUP BY 1, 2 HAVING NOT bool_or(copied)""",
)
def _(c):
    return itg.payload_check_job(c.attempts, _content(c), _reject_r())


@registered(
    "checksum_invalidations",
    f"""SELECT lfn, rse, 'Checksum mismatch' AS reason FROM (SELECT *, row_number() OVER (PARTITION BY lfn, rse ORDER BY pos) AS n FROM attempts)
        WHERE n = 1 AND NOT (copied AND {_SUM} = adler32)""",
)
def _(c):
    return itg.checksum_invalidations(c.attempts, _content(c))


_ADLER = """
    b AS (SELECT doc_id, octet_length(encode(text)) AS n,
                 list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: CAST('0x' || x AS INTEGER)) AS bytes FROM documents),
    s AS (SELECT doc_id, n, list_sum(bytes) AS s, list_sum(list_transform(bytes, lambda x, i: CAST(x AS BIGINT) * (n - i + 1))) AS w FROM b)
    SELECT CAST(doc_id AS VARCHAR) AS lfn,
           lpad(lower(to_hex(CAST((w + n) % 65521 * 65536 + (s + 1) % 65521 AS BIGINT))), 8, '0') AS computed FROM s
"""


@registered("payload_checksum", f"WITH {_ADLER}")
def _(c):
    docs = c.documents.select(F.col("doc_id").cast("string").alias("lfn"), F.encode("text", "UTF-8").alias("content"))
    return itg.payload_checksum(docs)


@registered("chunk_checksum", f"WITH {_ADLER}")
def _(c):
    # each text in pieces of 1000 bytes
    docs = c.documents.select(F.col("doc_id").cast("string").alias("lfn"), F.encode("text", "UTF-8").alias("data"))
    sizes = docs.select("lfn", F.octet_length("data").cast("bigint").alias("size"))
    starts = F.explode(F.sequence(F.lit(0), F.octet_length("data") - 1, F.lit(1000)))
    pieces = docs.filter(F.octet_length("data") > 0).select("lfn", "data", starts.alias("at"))
    pieces = pieces.select("lfn", F.col("at").cast("bigint").alias("at"), F.substring("data", F.col("at") + 1, F.lit(1000)).alias("content"))
    return itg.chunk_checksum(pieces, sizes).select("lfn", "computed")


@registered(
    "non_root_results",
    """SELECT request_id || ':' || line AS filename, CASE WHEN NOT ends_with(line, '.root') THEN 'The LFN provided is not a .root file.' END AS error
       FROM submissions""",
)
def _(c):
    return itg.non_root_results(c.submissions.select(F.concat_ws(":", "request_id", "line").alias("filename")))


# --- checks --------------------------------------------------------------------------
@registered(
    "name_schema_check",
    r"""SELECT name, array_to_string(list_filter([
          CASE WHEN NOT regexp_matches(account, '^[a-z0-9\-_]{1,25}$') THEN 'account' END,
          CASE WHEN activity NOT IN ('Data Consolidation', 'Production Output', 'User AutoApprove') THEN 'activity' END,
          CASE WHEN NOT (regexp_matches(name, '^/[a-zA-Z0-9\-_]{1,99}/[a-zA-Z0-9.\-_]{1,199}/[A-Z0-9\-]{1,99}$')
                      OR regexp_matches(name, '^/[a-zA-Z0-9\-_]{1,99}/[a-zA-Z0-9.\-_]{1,199}/[A-Z0-9\-]{1,99}#[a-zA-Z0-9.\-_]{1,100}$')
                      OR regexp_matches(name, '^/store/[A-Za-z0-9][A-Za-z0-9.\-_/]{1,493}$')) THEN 'name' END,
          CASE WHEN NOT regexp_matches(rse_expression, '^T[0-3]_[A-Z]{2}((_[A-Za-z0-9]+)+)$') THEN 'rse_expression' END,
          CASE WHEN state NOT IN ('A', 'U', 'C', 'B', 'D', 'S') THEN 'state' END], lambda x: x IS NOT NULL), ',') AS violations FROM rules""",
)
def _(c):
    kinds = {"account": "account", "activity": "activity", "name": "name", "rse_expression": "rse", "state": "replica_state"}
    out = q.name_schema_check(c.rules, kinds)
    return out.select("name", F.array_join("violations", ",").alias("violations"))


@registered(
    "did_schema_check",
    r"""SELECT scope, name, type, array_to_string(list_filter([
          CASE WHEN NOT regexp_matches(name, '^/[a-zA-Z0-9\-_]{1,99}/[a-zA-Z0-9.\-_]{1,199}/[A-Z0-9\-]{1,99}(#[a-zA-Z0-9.\-_]{1,100})?$')
                AND NOT regexp_matches(name, '^/store/[A-Za-z0-9][A-Za-z0-9.\-_/]{1,493}$') THEN 'name' END,
          CASE WHEN type = 'CONTAINER' AND contains(name, '#') OR type = 'DATASET' AND NOT contains(name, '#')
                 OR type = 'FILE' AND name NOT LIKE '/store/%' THEN 'name_of_type' END,
          CASE WHEN NOT (scope LIKE 'cms%' OR contains(scope, 'logs') OR regexp_matches(scope, '(user\.[a-z0-9\-_]{1,20})$')) THEN 'scope' END],
          lambda x: x IS NOT NULL), ',') AS violations
       FROM (SELECT CASE state WHEN 'O' THEN 'cms' WHEN 'S' THEN 'user.' || account WHEN 'U' THEN 'some logs' ELSE 'other' END AS scope, name,
                    CASE did_type WHEN 'C' THEN 'CONTAINER' WHEN 'D' THEN CASE WHEN state = 'W' THEN 'FILE' ELSE 'DATASET' END ELSE 'FILE' END AS type FROM rules)""",
)
def _(c):
    dids = c.rules.select(
        F.expr("CASE state WHEN 'O' THEN 'cms' WHEN 'S' THEN 'user.' || account WHEN 'U' THEN 'some logs' ELSE 'other' END").alias("scope"),
        "name",
        F.expr(
            "CASE did_type WHEN 'C' THEN 'CONTAINER' WHEN 'D' THEN CASE WHEN state = 'W' THEN 'FILE' ELSE 'DATASET' END ELSE 'FILE' END"
        ).alias("type"),
    )
    return q.did_schema_check(dids).withColumn("violations", F.array_join("violations", ","))


@registered(
    "namespace_check",
    """SELECT name, scope, CASE WHEN name LIKE '/store/user/managed/%' THEN CASE WHEN scope NOT LIKE 'user.%' THEN 'only user scopes allowed'
              WHEN name NOT LIKE '/store/user/managed/' || substr(scope, 6) || '/%' THEN 'not allowed for this user' END
         WHEN name LIKE '/store/user%' THEN 'unmanaged user file'
         WHEN scope LIKE 'user.%' THEN 'not allowed for this user'
         WHEN scope = 'logs' THEN 'logs outside /store/logs' END AS namespace_error
       FROM (SELECT CASE did_type WHEN 'D' THEN '/store/user/managed/' || account || '/f' WHEN 'C' THEN '/store/user/' || account || '/f' ELSE '/store/mc/f' END AS name,
                    CASE state WHEN 'O' THEN 'cms' WHEN 'S' THEN 'user.' || account WHEN 'U' THEN 'user.u1' ELSE 'logs' END AS scope FROM rules)""",
)
def _(c):
    dids = c.rules.selectExpr(
        "CASE did_type WHEN 'D' THEN '/store/user/managed/' || account || '/f' WHEN 'C' THEN '/store/user/' || account || '/f' ELSE '/store/mc/f' END AS name",
        "CASE state WHEN 'O' THEN 'cms' WHEN 'S' THEN 'user.' || account WHEN 'U' THEN 'user.u1' ELSE 'logs' END AS scope",
        "'FILE' AS type",
    )
    return q.namespace_check(dids, "managed").drop("type")


@registered(
    "nested_payload_check",
    """SELECT rule_id, array_to_string(list_filter([CASE WHEN error IS NULL THEN 'adler32' END, CASE WHEN stuck_at IS NULL THEN 'bytes' END],
       lambda x: x IS NOT NULL), ',') AS missing FROM rules""",
)
def _(c):
    record = F.struct(
        F.lit("cms").alias("scope"), "name", F.when(F.col("stuck_at").isNotNull(), 1).alias("bytes"), F.col("error").alias("adler32")
    )
    out = q.nested_payload_check(c.rules.select("rule_id", record.alias("record")), "add_replica")
    return out.select("rule_id", F.array_join("missing", ",").alias("missing"))


_RSE = r"^T[0-3]_[A-Z]{2}((_[A-Za-z0-9]+)+)$"
_RECORD_NAME = r"""(regexp_matches(name, '^/[a-zA-Z0-9\-_]{1,99}/[a-zA-Z0-9.\-_]{1,199}/[A-Z0-9\-]{1,99}$')
    OR regexp_matches(name, '^/[a-zA-Z0-9\-_]{1,99}/[a-zA-Z0-9.\-_]{1,199}/[A-Z0-9\-]{1,99}#[a-zA-Z0-9.\-_]{1,100}$')
    OR regexp_matches(name, '^/store/[A-Za-z0-9][A-Za-z0-9.\-_/]{1,493}$'))"""


@registered(
    "record_violations",
    f"""WITH r AS (SELECT rule_id, name, CAST(rule_id % 7 AS INT) AS k, CASE WHEN rule_id % 5 = 0 THEN lower(rse_expression) ELSE rse_expression END AS rse FROM rules)
    SELECT rule_id, '$.rse' AS path, 'does not match' AS violation FROM r WHERE NOT regexp_matches(rse, '{_RSE}')
    UNION ALL SELECT rule_id, '$.dids[' || i || '].name', 'does not match' FROM r, (VALUES (0), (1)) v(i) WHERE NOT {_RECORD_NAME} AND NOT (i = 1 AND k = 1)
    UNION ALL SELECT rule_id, '$.dids[1].name', 'is missing' FROM r WHERE k = 1
    UNION ALL SELECT rule_id, '$.dids[0].bytes', 'type is not integer' FROM r WHERE k = 2
    UNION ALL SELECT rule_id, '$.dids[1].extra', 'is unknown' FROM r WHERE k = 3
    UNION ALL SELECT rule_id, '$.dids[1].rules', 'fewer than 1 items' FROM r WHERE k = 4
    UNION ALL SELECT rule_id, '$.dids[0].rules[0].dids', 'is missing' FROM r WHERE k = 5
    UNION ALL SELECT rule_id, '$.dids[0].rules[0].grouping', 'is none of the values' FROM r WHERE k = 5
    UNION ALL SELECT rule_id, '$', 'is no JSON' FROM r WHERE k = 6 AND rse IS NULL""",
)
def _(c):
    """Attachments made from rules, each seventh kind with another fault deep inside."""
    k = F.col("rule_id") % 7
    when = lambda n, value: F.when(k == n, value)
    rule = F.struct(F.lit(1).alias("copies"), F.lit("tier=1").alias("rse_expression"), F.lit("SOME").alias("grouping"))
    empty = F.array().cast("array<struct<copies:int,rse_expression:string,grouping:string>>")
    did = lambda **more: F.struct(F.lit("cms").alias("scope"), *(v.alias(n) for n, v in more.items()))
    first = did(name=F.col("name"), bytes=when(2, F.lit("1")), size=F.lit(None).cast("int"), extra=F.lit(None).cast("int"), rules=when(5, F.array(rule)))
    second = did(name=F.when(k != 1, F.col("name")), bytes=F.lit(None).cast("string"), size=F.lit(None).cast("int"), extra=when(3, F.lit(1)), rules=when(4, empty))
    rse = F.when(F.col("rule_id") % 5 == 0, F.lower("rse_expression")).otherwise(F.col("rse_expression"))
    record = F.to_json(F.struct(F.lit("cms").alias("scope"), "name", rse.alias("rse"), F.array(first, second).alias("dids")))
    return recs.record_violations(c.rules.select("rule_id", record.alias("record")).select("rule_id", "record"), recs.ATTACHMENT).select("rule_id", "path", "violation")


@registered(
    "request_validation",
    """SELECT id, array_to_string(list_filter([
          CASE WHEN mode = 'global' AND coalesce(rse, '') <> '' THEN 'rse must be empty in global mode' END,
          CASE WHEN mode = 'local' AND coalesce(rse, '') = '' THEN 'rse is required in local mode' END,
          CASE WHEN last_replicas AND mode <> 'local' THEN 'last replicas only in local mode' END,
          CASE WHEN status = 'aborted' THEN 'scope in file names' END], lambda x: x IS NOT NULL), '; ') AS errors
       FROM (SELECT id, status, CASE WHEN status = 'queued' THEN 'global' WHEN status = 'failed' THEN 'local' ELSE mode END AS mode, rse, last_replicas FROM inv_requests)""",
)
def _(c):
    rows = c.inv_requests.withColumn(
        "mode", F.when(F.col("status") == "queued", "global").when(F.col("status") == "failed", "local").otherwise(F.col("mode"))
    ).withColumn("file_content", F.when(F.col("status") == "aborted", F.concat(F.lit("cms:"), "file_name")).otherwise(F.col("file_name")))
    return q.request_validation(rows).select("id", F.array_join("errors", "; ").alias("errors"))


@registered(
    "integrity_submission_check",
    """WITH l AS (SELECT request_id, nullif(trim(line), '') AS line FROM submissions),
    t AS (SELECT request_id, count(line) AS n, count(DISTINCT line) AS d, coalesce(bool_or(NOT ends_with(line, '.root')), false) AS other FROM l GROUP BY 1)
    SELECT request_id, n AS n_lines, array_to_string(list_filter([CASE WHEN n > d THEN 'duplicate names' END, CASE WHEN n = 0 THEN 'no names' END,
           CASE WHEN n > 12 THEN 'too many names' END, CASE WHEN other THEN 'not .root files' END], lambda x: x IS NOT NULL), ',') AS errors FROM t""",
)
def _(c):
    return q.integrity_submission_check(c.submissions, limit=12).withColumn("errors", F.array_join("errors", ","))


@registered(
    "did_level_check",
    """WITH n AS (SELECT account, CASE WHEN contains(name, '.') THEN 'file' WHEN contains(name, '#') THEN 'dataset' ELSE 'container' END AS level FROM rules)
    SELECT account AS request_id, min(level) AS level, count(DISTINCT level) = 1 AS same_level FROM n GROUP BY 1""",
)
def _(c):
    return q.did_level_check(c.rules.select(F.col("account").alias("request_id"), "name"))


@registered(
    "invalidation_mode_check",
    """WITH r AS (SELECT id, CASE mode WHEN 'local' THEN 'site-invalidation' WHEN 'global' THEN 'global' ELSE 'integrity-validation' END AS mode,
                CASE WHEN status = 'failed' THEN NULL ELSE reason END AS reason, CASE WHEN status = 'queued' THEN 'X' ELSE rse END AS rse,
                status = 'aborted' AS erase, last_replicas OR status = 'parked' AS last_replicas,
                CASE WHEN status = 'success' THEN 'dataset' ELSE 'file' END AS level, status <> 'waiting_approval' AS same_level FROM inv_requests)
    SELECT id, array_to_string(list_filter([
        CASE WHEN last_replicas AND mode <> 'site-invalidation' THEN 'last replicas only in site mode' END,
        CASE WHEN reason IS NULL AND mode <> 'integrity-validation' THEN 'reason is required' END,
        CASE WHEN NOT same_level THEN 'names must be of one level' END,
        CASE WHEN mode = 'integrity-validation' AND level <> 'file' THEN 'integrity mode needs files' END,
        CASE WHEN erase AND mode <> 'global' THEN 'no erase in this mode' END,
        CASE WHEN mode = 'site-invalidation' AND rse IS NULL THEN 'rse is required in site mode' END,
        CASE WHEN mode = 'global' AND rse IS NOT NULL THEN 'rse only in site mode' END], lambda x: x IS NOT NULL), '; ') AS errors FROM r""",
)
def _(c):
    runs = c.inv_requests.selectExpr(
        "id",
        "CASE mode WHEN 'local' THEN 'site-invalidation' WHEN 'global' THEN 'global' ELSE 'integrity-validation' END AS mode",
        "CASE WHEN status = 'failed' THEN NULL ELSE reason END AS reason",
        "CASE WHEN status = 'queued' THEN 'X' ELSE rse END AS rse",
        "status = 'aborted' AS erase",
        "last_replicas OR status = 'parked' AS last_replicas",
        "CASE WHEN status = 'success' THEN 'dataset' ELSE 'file' END AS level",
        "status <> 'waiting_approval' AS same_level",
    )
    return q.invalidation_mode_check(runs).select("id", F.array_join("errors", "; ").alias("errors"))


@registered(
    "unique_dataset_name",
    """SELECT request_id AS upload_id, min('/P' || mode || '/' || status || '-v1/USER') AS dataset,
              count(DISTINCT '/P' || mode || '/' || status || '-v1/USER') = 1 AS ok FROM inv_requests GROUP BY 1""",
)
def _(c):
    path = F.concat(F.lit("/store/group/x/"), "status", F.lit("/P"), "mode", F.lit("/MINI/v1/"), "file_name")
    uploads = c.inv_requests.select(F.col("request_id").alias("upload_id"), path.alias("path"))
    return q.unique_dataset_name(uploads, N.dataset_from_path("path", "/store/group/x"))


@registered(
    "probe_consistency",
    """SELECT rse, count(*) AS probes, count(DISTINCT definition) = 1 AS ok FROM
       (SELECT rse, scheme || definition AS definition FROM protocols_wanted UNION ALL
        SELECT rse, scheme || definition FROM protocols_now) GROUP BY 1""",
)
def _(c):
    rows = c.protocols_wanted.select("rse", "scheme", "definition").unionByName(
        c.protocols_now.select("rse", "scheme", "definition")
    )
    return q.probe_consistency(rows, ["scheme", "definition"])
