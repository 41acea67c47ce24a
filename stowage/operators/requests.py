"""Invalidation requests: filters, groups, tickets, job logs, outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import first_line_before, strip_scope_prefix, ticket_ids
from .ranking import latest_per_key, top_n_per_key

# Order of request states in reports; others come last.
STATUS_ORDER = ("aborted", "failed", "in_progress", "queued", "waiting_approval", "success")
GROUP_COLUMNS = ("request_id", "status", "mode", "rse", "dry_run", "last_replicas", "request_user", "approve_user", "job_id")
# Lines a job prints, by kind of run.
LOG_FILE = r" (/[\w/\-]+.root)"
LOG_PATTERNS = {
    True: (
        f"Would declare file{LOG_FILE} as bad at",
        rf"Would invalidate file on DBS:{LOG_FILE}\s",
        rf"Would invalidate dataset on DBS:{LOG_FILE}\s",
    ),
    False: (
        f"Declared file{LOG_FILE} as bad at",
        rf"Invalidation OK for file:{LOG_FILE}\s",
        rf"Invalidation OK for dataset:{LOG_FILE}\s",
    ),
}
LOG_DRY_RUN, LOG_BROKEN = "Would declare file", "Error running shell script"


# --- filters and order ---------------------------------------------------------------
def invalidation_request_filters(
    requests: DataFrame,
    request_id: str | None = None,
    job_id: str | None = None,
    status: str | None = None,
    file_regex: str | None = None,
    reason_regex: str | None = None,
    request_user: str | None = None,
    approve_user: str | None = None,
) -> DataFrame:
    exact = {
        "request_id": request_id,
        "job_id": job_id,
        "status": status,
        "request_user": request_user,
        "approve_user": approve_user,
    }
    for col, value in exact.items():
        if value:
            requests = requests.filter(F.col(col) == value)
    for col, regex in (("file_name", file_regex), ("reason", reason_regex)):
        if regex:
            requests = requests.filter(F.col(col).rlike(regex))
    return requests


def status_priority(status: Column | str = "status") -> Column:
    status = F.col(status) if isinstance(status, str) else status
    out = F.when(status == STATUS_ORDER[0], 0)
    for i, name in enumerate(STATUS_ORDER[1:], 1):
        out = out.when(status == name, i)
    return out.otherwise(len(STATUS_ORDER))


def status_priority_sort(requests: DataFrame, *then: str) -> DataFrame:
    return requests.withColumn("status_priority", status_priority()).orderBy("status_priority", *then)


def invalidation_request_groups(requests: DataFrame) -> DataFrame:
    """Requests grouped by what they share, with the reason cut at the abort mark: count,
    first date and state order, in report order."""
    groups = (
        requests.withColumn("truncated_reason", first_line_before("reason"))
        .groupBy(*GROUP_COLUMNS, "truncated_reason")
        .agg(F.count(F.lit(1)).alias("total_objects"), F.min("submitted_date").alias("submitted_at"))
    )
    return groups.withColumn("status_priority", status_priority()).orderBy(
        "status_priority", "submitted_at", F.desc("total_objects"), "request_id", "truncated_reason"
    )


def page_of_requests(ordered: DataFrame, page: int, grouped: bool = True) -> DataFrame:
    """Page ``page`` (from 1) of an ordered frame: 10 groups or 50 single rows."""
    size = 10 if grouped else 50
    return ordered.offset((page - 1) * size).limit(size)


# --- new requests and tickets --------------------------------------------------------
def raw_flag(requests: DataFrame) -> DataFrame:
    return requests.groupBy("request_id").agg(F.bool_or(F.col("file_name").contains("/RAW/")).alias("contains_raw"))


def preview_n(requests: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` names of each request, one row per request."""
    first = top_n_per_key(requests.select("request_id", "file_name"), ["request_id"], [F.col("file_name")], n)
    return first.groupBy("request_id").agg(F.array_sort(F.collect_list("file_name")).alias("preview"))


def request_ticket_facts(requests: DataFrame) -> DataFrame:
    """What a ticket says about a request: counts, who, why, mode, raw flag, the first ten
    names, linked ticket ids.  User, reason and mode come from its first file by name."""
    facts = requests.groupBy("request_id").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.min_by(F.struct("request_user", "reason", "mode", "rse", "dry_run"), "file_name").alias("_first"),
        F.bool_or(F.col("file_name").contains("/RAW/")).alias("contains_raw"),
    )
    return (
        facts.select("request_id", "n_files", "contains_raw", "_first.*")
        .withColumn("tickets", ticket_ids("reason"))
        .join(preview_n(requests), "request_id")
    )


def new_request_files(submitted: DataFrame, existing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Submitted file names split into new ones and those in a request that is not a dry
    run, the latter with that request's state (the smallest by name if several)."""
    names = submitted.select(strip_scope_prefix("file_name").alias("file_name"))
    real = existing.filter(~F.col("dry_run")).groupBy("file_name").agg(F.min("status").alias("status"))
    return names.join(real, "file_name", "left_anti"), names.join(real, "file_name")


# --- jobs ----------------------------------------------------------------------------
def latest_pod_log(pods: DataFrame) -> DataFrame:
    """Newest run of each job by start time, by creation time where it never started."""
    when = F.coalesce("start_time", "created_at")
    return latest_per_key(pods.withColumn("_when", when), ["job_name"], ["_when"], ["pod"]).drop("_when")


def job_log_parse(logs: DataFrame) -> DataFrame:
    """(job, logs) -> one row per name and list it stands in.

    ``target`` is ``catalogue`` (declared bad) or ``bookkeeping`` (invalidated there); a
    dataset invalidated in the bookkeeping counts for both.  A broken job gives nothing.
    """
    dry = F.col("logs").contains(LOG_DRY_RUN)
    found = lambda i: F.when(dry, F.regexp_extract_all("logs", F.lit(LOG_PATTERNS[True][i]))).otherwise(
        F.regexp_extract_all("logs", F.lit(LOG_PATTERNS[False][i]))
    )
    tagged = lambda names, target: F.transform(names, lambda n: F.struct(F.lit(target).alias("target"), n.alias("name")))
    rows = F.concat(
        tagged(found(0), "catalogue"),
        tagged(found(1), "bookkeeping"),
        tagged(found(2), "catalogue"),
        tagged(found(2), "bookkeeping"),
    )
    return (
        logs.filter(~F.col("logs").contains(LOG_BROKEN))
        .select("job", dry.alias("dry_run"), F.explode(rows).alias("r"))
        .select("job", "dry_run", "r.target", "r.name")
        .distinct()
    )


def job_outcome_merge(requests: DataFrame, parsed: DataFrame) -> DataFrame:
    """Requested files (job, file_name) with the mode in which they succeeded:
    ``catalogue_only``, ``bookkeeping_only`` or ``global``."""
    seen = parsed.groupBy("job", F.col("name").alias("file_name")).agg(
        F.bool_or(F.col("target") == "catalogue").alias("c"),
        F.bool_or(F.col("target") == "bookkeeping").alias("b"),
        F.bool_or("dry_run").alias("dry_run"),
    )
    mode = F.when(F.col("c") & F.col("b"), "global").when(F.col("c"), "catalogue_only").otherwise("bookkeeping_only")
    return requests.select("job", "file_name").join(seen, ["job", "file_name"]).select(
        "job", "file_name", F.lit("success").alias("status"), mode.alias("mode"), "dry_run"
    )
