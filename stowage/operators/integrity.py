"""Results of file-integrity checks: ingest, per-file status, reports, checksums."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import split_scope

OK, CORRUPTED, ERROR, PENDING = "OK", "CORRUPTED", "ERROR", "pending"
STATES = (OK, CORRUPTED, ERROR, PENDING)
RESULT_SCHEMA = "array<struct<filename:string,error:string,replicas:array<struct<rse:string,pfn:string,status:string>>>>"
_ADLER = 65521


# --- reports -------------------------------------------------------------------------
def _counts() -> list[Column]:
    return [F.count_if(F.col("status") == s).alias(s) for s in STATES]


def file_status(total: Column, ok: Column, corrupted: Column, error: Column, pending: Column) -> Column:
    """One status from the replica counts of a file."""
    return (
        F.when(total == 0, "UNKNOWN")
        .when(corrupted == total, "FULLY_CORRUPTED")
        .when(corrupted > 0, "PARTIALLY_CORRUPTED")
        .when(ok == total, "FULLY_OK")
        .when(ok > 0, "OK")
        .when(pending > 0, "PENDING")
        .when(error > 0, "ERROR")
        .otherwise("UNKNOWN")
    )


def _per_file(replicas: DataFrame, *more: Column) -> DataFrame:
    counted = replicas.groupBy("request_id", "lfn").agg(
        F.min("scope").alias("scope"), F.count(F.lit(1)).alias("replica_count"), *_counts(), *more
    )
    status = file_status(*[F.col(c) for c in ("replica_count", OK, CORRUPTED, ERROR, PENDING)])
    return counted.withColumn("file_status", status)


def integrity_file_status(replicas: DataFrame) -> DataFrame:
    """Status and counts per request and file."""
    return _per_file(replicas)


def integrity_request_summary(replicas: DataFrame) -> DataFrame:
    """Files, replicas and counts per status of each request.

    Two aggregates: the first, by request and file, spreads a request of any size over all
    tasks; the second only adds its sums.
    """
    per_file = replicas.groupBy("request_id", "lfn").agg(F.count(F.lit(1)).alias("replica_count"), *_counts())
    return per_file.groupBy("request_id").agg(
        F.count(F.lit(1)).alias("lfn_count"),
        F.sum("replica_count").alias("replica_count"),
        *[F.sum(s).alias(s) for s in STATES],
    )


def integrity_files_view(replicas: DataFrame) -> DataFrame:
    """Per file the status, the counts and the sorted set of its replica records, in one
    aggregate.  A file has at most one record per endpoint and access path, so the set is
    small."""
    return _per_file(replicas, F.array_sort(F.collect_set(F.struct("rse", "pfn", "status"))).alias("replicas"))


def lfns_per_rse(replicas: DataFrame) -> DataFrame:
    """Distinct (endpoint, file) in report order: one row per line under its endpoint."""
    return (
        replicas.select(F.coalesce("rse", F.lit("UNKNOWN_RSE")).alias("rse"), "lfn").distinct().orderBy("rse", "lfn")
    )


def lfns_per_rse_text(replicas: DataFrame) -> DataFrame:
    """The same as printed lines: the endpoint, its files, an empty line before the next
    endpoint.  ``line_no`` orders the lines of one endpoint without gathering them."""
    rows = replicas.select(F.coalesce("rse", F.lit("UNKNOWN_RSE")).alias("rse"), "lfn").distinct()
    heads = rows.select("rse").distinct()
    line = lambda df, part, text: df.select("rse", F.lit(part).alias("part"), text.alias("line"))
    return (
        line(heads, 0, F.col("rse"))
        .unionByName(line(rows, 1, F.col("lfn")))
        .unionByName(line(heads, 2, F.lit("")))
        .orderBy("rse", "part", "line")
    )


def integrity_verdict_counts(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count_if(F.col("status") == OK).alias("passed"),
        F.count_if(~F.coalesce(F.col("status") == OK, F.lit(False))).alias("failed"),
    )


def integrity_request_filters(
    requests: DataFrame,
    replicas: DataFrame,
    status: str | None = None,
    user: str | None = None,
    lfn: str | None = None,
    replica_status: str | None = None,
) -> DataFrame:
    """Replica rows of the requests that pass the given filters."""
    if status:
        requests = requests.filter(F.col("status") == status)
    if user:
        requests = requests.filter(F.col("requested_by") == user)
    if lfn:
        replicas = replicas.filter(F.col("lfn") == lfn)
    if replica_status:
        replicas = replicas.filter(F.col("status") == replica_status)
    return replicas.join(requests.select("request_id"), "request_id", "left_semi")


# --- ingest --------------------------------------------------------------------------
def job_result_json(logs: DataFrame) -> DataFrame:
    """Last log line that starts with ``[``, read as the result list: one row per file.

    A log without such a line, or with one that is no list, gives one row with the error.
    """
    lines = F.filter(F.transform(F.split("logs", r"\r\n|\n|\r"), lambda x: F.trim(x)), lambda x: x.startswith("["))
    last = F.try_element_at(lines, F.lit(-1))
    parsed = logs.withColumn("_line", last).withColumn("_list", F.from_json("_line", RESULT_SCHEMA))
    error = F.when(F.col("_line").isNull(), "no result list in log").when(F.col("_list").isNull(), "result is not a list")
    return parsed.select("request_id", error.alias("log_error"), F.explode_outer("_list").alias("r")).select(
        "request_id", "log_error", "r.filename", "r.error", "r.replicas"
    )


def integrity_upsert(old: DataFrame, results: DataFrame) -> DataFrame:
    """Replica table after the results of jobs (request_id, filename, error, replicas).

    Pending rows of reported files go.  A file-level error makes one ERROR row, otherwise
    there is one row per endpoint.  Rows that exist stay, so a second run changes nothing.
    Results with a column ``batch`` (number from 0) are those of several batches: the table is
    the one that the batches make one after the other.

    Old rows and results are dealt once, by file of a request, or by the columns ``bucket`` and ``_part`` where the frames
    carry them (which must follow from the file's name, and are handed on); all the rest happens within those groups.
    """
    cols = ["request_id", "scope", "lfn", "rse", "pfn", "status"]
    place = [c for c in ("bucket", "_part") if c in old.columns]
    file = [*place, "request_id", "lfn"]
    number = F.col("batch") if "batch" in results.columns else F.lit(0)
    blank = lambda kind="string": F.lit(None).cast(kind)
    found = F.transform("replicas", lambda r: F.struct(r["rse"].alias("rse"), r["pfn"].alias("pfn"), F.coalesce(r["status"], F.lit(ERROR)).alias("status")))
    reported = (
        results.filter(F.coalesce(F.col("filename") != "", F.lit(False)))
        .withColumn("_did", split_scope("filename"))
        .select(
            *place, "request_id", "_did.scope", F.col("_did.name").alias("lfn"), number.cast("bigint").alias("batch"),
            blank().alias("rse"), blank().alias("pfn"), F.when(F.col("error").isNotNull(), ERROR).alias("status"),
            F.when(F.col("error").isNull(), found).alias("found"),
        )
    )
    # old rows are those of a batch before all others
    before = old.select(*place, *cols, F.lit(-1).cast("bigint").alias("batch"), blank(reported.schema["found"].dataType).alias("found"))
    dealt = before.unionByName(reported).repartition(*(place or file))
    is_old = F.col("batch") < 0
    own = F.array(F.struct("rse", "pfn", "status"))
    each = F.explode(F.when(is_old | F.col("status").isNotNull(), own).otherwise(F.col("found"))).alias("r")
    last = F.max("batch").over(Window.partitionBy(*file))
    rows = dealt.withColumn("last", last).select(*file, "scope", "batch", "last", each).select(*file, "scope", "batch", "last", "r.*")
    # a name that is null is that of no other row: it keeps old rows apart from new ones
    named = F.col("request_id").isNotNull() & F.col("lfn").isNotNull()
    rows = rows.withColumn("apart", is_old & ~named)
    key = [*file, "rse", "apart"]
    place_in_batch = F.row_number().over(Window.partitionBy(*key, "batch").orderBy("scope", "pfn", "status"))
    one = rows.withColumn("n", place_in_batch).filter(is_old | (F.col("n") == 1))
    # a pending row goes with the next report of its file; of the others the first batch's stay, an old row before all
    gone = F.col("status").eqNullSafe(PENDING) & named & (F.col("last") > F.col("batch"))
    first = F.min("batch").over(Window.partitionBy(*key))
    return one.filter(~gone).withColumn("first", first).filter(F.col("batch") == F.col("first")).select(*cols, *place)


# --- checks on content ---------------------------------------------------------------
def first_good_pfn(attempts: DataFrame) -> DataFrame:
    """(lfn, rse, pos, pfn, copied, ...) -> the first copied path decides; if none was, the
    last path with status ERROR.  One aggregate: a hot file sends one row per task."""
    rest = [c for c in attempts.columns if c not in ("lfn", "rse", "pos", "copied")]
    picked = attempts.groupBy("lfn", "rse").agg(
        F.min_by(F.struct(*rest), F.when(F.col("copied"), F.col("pos"))).alias("good"),
        F.max_by("pfn", "pos").alias("last"),
    )
    return picked.select(
        "lfn",
        "rse",
        F.coalesce("good.pfn", "last").alias("pfn"),
        *[F.col(f"good.{c}").alias(c) for c in rest if c != "pfn"],
        F.when(F.col("good").isNull(), ERROR).alias("status"),
    )


# The functions sent to Python workers are built inside others, so they travel with the
# plan and the workers need no copy of this package.
def _adler():
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            content = frame.pop("content")
            frame["computed"] = [None if c is None else f"{zlib.adler32(c):08x}" for c in content]
            yield frame

    return run


def payload_checksum(payloads: DataFrame) -> DataFrame:
    """Adler-32 of ``content`` per row as ``computed``; the other columns stay.

    Spark has no built-in for it, so the bytes go through Arrow batches to zlib.  Rows hold
    whole files; for large files use ``chunk_checksum``.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in payloads.schema if f.name != "content")
    return payloads.mapInPandas(_adler(), f"{schema}, computed string")


def _adler_sums():
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            value = [zlib.adler32(c) for c in frame["content"]]
            n = frame["content"].map(len)
            low = pd.Series([v & 0xFFFF for v in value], index=frame.index, dtype="int64")
            high = pd.Series([v >> 16 for v in value], index=frame.index, dtype="int64")
            # plain and weighted byte sums of the chunk on its own
            sums = {"s": (low - 1) % _ADLER, "w": (high - n) % _ADLER}
            yield pd.DataFrame({"lfn": frame["lfn"], "at": frame["at"], "n": n, **sums})

    return run


def chunk_checksum(chunks: DataFrame, sizes: DataFrame) -> DataFrame:
    """Adler-32 of files given as chunks (lfn, at, content), ``at`` the byte offset.

    Chunks are summed apart and combined by plain sums, since the bytes behind a chunk only
    scale its byte sum.  No file has to fit in one task, whatever its size.  ``sizes`` is
    (lfn, size); every row of it comes out, with ``reason`` where chunks are missing or
    overlap and there is no checksum.  An empty file has the checksum of no bytes.
    """
    sums = chunks.select("lfn", "at", "content").mapInPandas(_adler_sums(), "lfn string, at long, n long, s long, w long")
    behind = (F.col("size") - F.col("at") - F.col("n")) % _ADLER
    total = (
        sizes.select("lfn", "size")
        .join(sums, "lfn", "left")
        .groupBy("lfn", "size")
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
            F.coalesce(F.sum("s"), F.lit(0)).alias("s"),
            F.coalesce(F.sum((F.col("w") + F.col("s") * behind) % _ADLER), F.lit(0)).alias("w"),
        )
    )
    whole = F.col("n") == F.col("size")
    low, high = (F.col("s") + 1) % _ADLER, (F.col("w") + F.col("size")) % _ADLER
    computed = F.lpad(F.lower(F.hex(high * 65536 + low)), 8, "0")
    reason = F.concat(F.lit("chunks hold "), F.col("n"), F.lit(" of "), F.coalesce(F.col("size").cast("string"), F.lit("unknown")), F.lit(" bytes"))
    return total.select("lfn", F.when(whole, computed).alias("computed"), F.when(~F.coalesce(whole, F.lit(False)), reason).alias("reason"))


ContentCheck = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def _check_with(content_check: ContentCheck | None):
    """Checksum and content check in one pass, so content crosses to Python once and does
    not come back."""
    columns = ["lfn", "rse", "pfn", "status"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            computed = [None if c is None else f"{zlib.adler32(c):08x}" for c in frame["content"]]
            unread = frame["content"].isna()
            fine = pd.Series(computed, index=frame.index, dtype="object") == frame["adler32"]
            yield frame[unread].assign(status=ERROR)[columns]
            yield frame[~fine & ~unread].assign(status=CORRUPTED)[columns]
            good = frame[fine]
            if content_check is None:
                yield good.assign(status=OK)[columns]
            elif len(good):
                for out in content_check(iter([good[["lfn", "rse", "pfn", "content"]]])):
                    yield out[columns]

    return run


def payload_check_job(attempts: DataFrame, contents: DataFrame, content_check: ContentCheck | None = None) -> DataFrame:
    """One row per file and endpoint: checksum first, content only if that is not wrong.

    ``attempts`` is (lfn, rse, pos, pfn, copied, adler32); ``contents`` (pfn, content).  The
    path is chosen on the small table, and only chosen content is read.  ``content_check``
    maps frames of lfn, rse, pfn, content to lfn, rse, pfn, status.  A chosen path whose
    content is missing or null has status ERROR: it was not read, so it is not corrupted.
    """
    decided = first_good_pfn(attempts.select("lfn", "rse", "pos", "pfn", "copied", "adler32"))
    failed = decided.filter("status IS NOT NULL").select("lfn", "rse", "pfn", "status")
    chosen = decided.filter("status IS NULL").drop("status").join(contents.select("pfn", "content"), "pfn", "left")
    schema = "lfn string, rse string, pfn string, status string"
    return failed.unionByName(chosen.mapInPandas(_check_with(content_check), schema))


def non_root_results(lfns: DataFrame) -> DataFrame:
    """Names that are not ``.root`` files become file-level errors before any check."""
    name = F.element_at(F.split("filename", ":", 2), -1)
    return lfns.select("filename", F.when(~name.endswith(".root"), "The LFN provided is not a .root file.").alias("error"))


def checksum_invalidations(attempts: DataFrame, contents: DataFrame) -> DataFrame:
    """Replicas to declare bad after a checksum pass: the first access path decides, and a
    path that could not be copied, or has no content, counts as not intact."""
    first = attempts.groupBy("lfn", "rse").agg(F.min_by(F.struct("pfn", "copied", "adler32"), "pos").alias("f"))
    first = first.select("lfn", "rse", "f.*")
    copied = first.filter("copied").join(contents.select("pfn", "content"), "pfn", "left")
    bad = copied.mapInPandas(_check_with(None), "lfn string, rse string, pfn string, status string").filter(
        F.col("status").isin(CORRUPTED, ERROR)
    )
    return (
        bad.select("lfn", "rse")
        .unionByName(first.filter("NOT coalesce(copied, false)").select("lfn", "rse"))
        .withColumn("reason", F.lit("Checksum mismatch"))
    )
