"""Checks of names and records against the catalogue's rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import did_level

# Patterns, enumerations and lengths of catalogue fields.
_DATASET = r"/[a-zA-Z0-9\-_]{1,99}/[a-zA-Z0-9\.\-_]{1,199}/[A-Z0-9\-]{1,99}"
PATTERNS = {
    "account": r"^[a-z0-9-_]{1,25}$",
    # not anchored as a whole: "cms" at the start or "logs" anywhere is enough
    "scope": r"^(cms)|(logs)|(user\.[a-z0-9-_]{1,20})$|(group\.[a-z0-9-_]{1,19})$",
    "dataset": rf"^{_DATASET}$",
    "block": rf"^{_DATASET}#[a-zA-Z0-9\.\-_]{{1,100}}$",
    "lfn": r"^/store/[A-Za-z0-9][A-Za-z0-9\.\-\_/]{1,493}$",
    "rse": r"^T[0-3]_[A-Z]{2}((_[A-Za-z0-9]+)+)$",
    "rse_attribute": r"([A-Za-z0-9\._-]+[=<>][A-Za-z0-9_-]+)",
    "default_rse_attribute": r"([A-Z0-9]+([_-][A-Za-z0-9]+)*)",
    "date": r"((Mon)|(Tue)|(Wed)|(Thu)|(Fri)|(Sat)|(Sun))[,]\s\d{2}\s(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)\s\d{4}\s(0\d|1\d|2[0-3])(\:)(0\d|1\d|2\d|3\d|4\d|5\d)(\:)(0\d|1\d|2\d|3\d|4\d|5\d)\s(UTC)",
    "adler32": r"^[a-fA-F\d]{8}$",
    "md5": r"^[a-fA-F\d]{32}$",
    "uuid": r"^(\{){0,1}[0-9a-fA-F]{8}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{12}(\}){0,1}$",
    "account_attribute": r"^[a-zA-Z0-9-_\\/\\.]{1,30}$",
}
PATTERNS["name"] = "|".join(PATTERNS[k] for k in ("dataset", "block", "lfn"))
ENUMS = {
    "account_type": ("USER", "GROUP", "SERVICE"),
    "did_type": ("DATASET", "CONTAINER", "FILE", "F"),
    "collection_type": ("DATASET", "CONTAINER"),
    "replica_state": (
        "AVAILABLE", "UNAVAILABLE", "COPYING", "BEING_DELETED", "BAD", "SOURCE", "A", "U", "C", "B", "D", "S",
    ),
    "grouping": ("DATASET", "NONE", "ALL"),
    "notify": ("Y", "C", "N", "P"),
    "activity": (
        "Data Brokering", "Data Consolidation", "Data rebalancing", "Debug", "Express", "Functional Test",
        "Group Subscriptions", "Production Input", "Production Output", "Analysis Input", "Analysis Output",
        "Staging", "T0 Export", "T0 Tape", "Upload/Download (Job)", "Upload/Download (User)", "User AutoApprove",
        "User Subscriptions", "Data Challenge", "Analysis TapeRecall", "Manual Transfers",
    ),
}
MAX_LENGTHS = {"comment": 250, "metadata": 3999}
# Keys each kind of record must carry.
REQUIRED = {
    "rule": ("dids", "copies", "rse_expression"),
    "collection": ("scope", "name", "type"),
    "did": ("scope", "name", "type"),
    "attachment": ("dids",),
    "add_replica": ("scope", "name", "bytes", "adler32"),
    "delete_replica": ("scope", "name"),
    "cache_add_replicas": ("files", "rse", "lifetime", "operation"),
    "cache_delete_replicas": ("files", "rse", "operation"),
    "distance": ("src_rse_id", "dest_rse_id", "ranking"),
}


def field_ok(kind: str, col: Column | str) -> Column:
    """True where a value fits its kind; a missing value fits."""
    col = F.col(col) if isinstance(col, str) else col
    if kind in PATTERNS:
        test = col.rlike(PATTERNS[kind])
    elif kind in ENUMS:
        test = col.isin(*ENUMS[kind])
    else:
        test = F.length(col) <= MAX_LENGTHS[kind]
    return F.coalesce(test, F.lit(True))


def _flags(tests: Mapping[str, Column]) -> Column:
    """Sorted array of the names of failed tests."""
    return F.array_sort(F.array_compact(F.array(*[F.when(~ok, F.lit(name)) for name, ok in tests.items()])))


def name_schema_check(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Add ``violations``: columns whose value does not fit its kind (column -> kind)."""
    return df.withColumn("violations", _flags({col: field_ok(kind, col) for col, kind in kinds.items()}))


def did_schema_check(dids: DataFrame) -> DataFrame:
    """Checks of a DID (scope, name, type): fields, and the name pattern of its type."""
    kind, name = F.col("type"), F.col("name")
    by_type = (
        F.when(kind == "CONTAINER", name.rlike(PATTERNS["dataset"]))
        .when(kind == "DATASET", name.rlike(PATTERNS["block"]))
        .when(kind.isin("FILE", "F"), name.rlike(PATTERNS["lfn"]))
    )
    tests = {
        "scope": field_ok("scope", "scope"),
        "name": field_ok("name", "name"),
        "type": field_ok("did_type", "type"),
        "name_of_type": F.coalesce(by_type, F.lit(True)),
    }
    return dids.withColumn("violations", _flags(tests))


def namespace_check(dids: DataFrame, managed: str) -> DataFrame:
    """Files of user and group scopes must lie below ``/store/<kind>/<managed>/<account>/``,
    nothing else may; log files lie below /store/logs/.  Adds ``namespace_error``."""
    name, scope = F.col("name"), F.col("scope")
    error = F.when(F.col("type") != "FILE", F.lit(None).cast("string"))
    for kind in ("user", "group"):
        root = f"/store/{kind}"
        own = F.concat(F.lit(f"{root}/{managed}/"), F.regexp_replace(scope, rf"^{kind}\.", ""), F.lit("/"))
        error = (
            error.when(name.startswith(root) & ~name.startswith(f"{root}/{managed}/"), f"unmanaged {kind} file")
            .when(name.startswith(f"{root}/{managed}") & ~scope.startswith(f"{kind}."), f"only {kind} scopes allowed")
            .when(scope.startswith(f"{kind}.") & ~name.startswith(own), f"not allowed for this {kind}")
        )
    error = error.when((scope == "logs") & ~name.startswith("/store/logs/"), "logs outside /store/logs")
    return dids.withColumn("namespace_error", error)


def nested_payload_check(records: DataFrame, kind: str, record: str = "record") -> DataFrame:
    """Add ``missing``: required keys of a struct column that are absent or null.  The
    members of an attachment are checked in place."""
    fields = set(records.schema[record].dataType.fieldNames())
    at = lambda key: F.col(f"{record}.{key}")
    present = {key: at(key).isNotNull() if key in fields else F.lit(False) for key in REQUIRED[kind]}
    tests = dict(present)
    if "dids" in fields and kind == "attachment":
        tests["dids.name"] = ~F.coalesce(
            F.exists(at("dids"), lambda d: d["name"].isNull() | d["scope"].isNull()), F.lit(False)
        )
    return records.withColumn("missing", _flags(tests))


# --- requests ------------------------------------------------------------------------
def _errors(tests: Sequence[tuple[str, Column]]) -> Column:
    return F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(text)) for text, bad in tests]))


def request_validation(requests: DataFrame) -> DataFrame:
    """Errors of invalidation requests (mode, rse, last_replicas, file_content)."""
    mode, has_rse = F.col("mode"), F.coalesce(F.col("rse") != "", F.lit(False))
    tests = [
        ("rse must be empty in global mode", (mode == "global") & has_rse),
        ("rse is required in local mode", (mode == "local") & ~has_rse),
        ("last replicas only in local mode", F.col("last_replicas") & (mode != "local")),
        ("scope in file names", F.col("file_content").contains("cms:/")),
    ]
    return requests.withColumn("errors", _errors(tests))


def integrity_submission_check(lines: DataFrame, limit: int = 20) -> DataFrame:
    """Errors per submission (request_id, line): duplicates, none, too many, not .root.

    Lines are counted per request and name first, so a submission of any size spreads."""
    name = F.trim("line")
    per_name = (
        lines.select("request_id", name.alias("line"))
        .withColumn("line", F.when(F.col("line") != "", F.col("line")))
        .groupBy("request_id", "line")
        .agg(F.count("line").alias("n"))
    )
    bare = F.when(F.col("line").contains(":"), F.regexp_replace("line", "^[^:]*:", "")).otherwise(F.col("line"))
    per_request = per_name.groupBy("request_id").agg(
        F.sum("n").alias("n"),
        F.bool_or(F.col("n") > 1).alias("twice"),
        F.coalesce(F.bool_or(~bare.endswith(".root")), F.lit(False)).alias("other"),
    )
    tests = [
        ("duplicate names", F.col("twice")),
        ("no names", F.col("n") == 0),
        ("too many names", F.col("n") > limit),
        ("not .root files", F.col("other")),
    ]
    return per_request.select("request_id", F.col("n").alias("n_lines"), _errors(tests).alias("errors"))


def did_level_check(names: DataFrame) -> DataFrame:
    """Level of each request's names and whether they agree."""
    level = did_level("name")
    return names.groupBy("request_id").agg(
        F.min(level).alias("level"), (F.min(level) == F.max(level)).alias("same_level")
    )


def invalidation_mode_check(runs: DataFrame) -> DataFrame:
    """Errors in the options of runs: mode, reason, rse, erase, last_replicas, level,
    same_level.  The modes with rules of their own are site-invalidation and
    integrity-validation."""
    mode = F.col("mode")
    site, integrity = mode == "site-invalidation", mode == "integrity-validation"
    has_rse = F.coalesce(F.col("rse") != "", F.lit(False))
    no_reason = ~F.coalesce(F.col("reason") != "", F.lit(False))
    tests = [
        ("last replicas only in site mode", F.col("last_replicas") & ~site),
        ("reason is required", no_reason & ~integrity),
        ("names must be of one level", ~F.col("same_level")),
        ("integrity mode needs files", integrity & (F.col("level") != "file")),
        ("no erase in this mode", F.col("erase") & (site | integrity)),
        ("rse is required in site mode", site & ~has_rse),
        ("rse only in site mode", ~site & ~integrity & has_rse),
    ]
    return runs.withColumn("errors", _errors(tests))


def unique_dataset_name(files: DataFrame, dataset: Column) -> DataFrame:
    """Dataset name of each upload (upload_id, path) and whether all paths agree."""
    named = files.withColumn("_dataset", dataset)
    return named.groupBy("upload_id").agg(
        F.min("_dataset").alias("dataset"),
        F.coalesce(
            (F.min("_dataset") == F.max("_dataset")) & (F.count("_dataset") == F.count(F.lit(1))), F.lit(False)
        ).alias("ok"),
    )


def probe_consistency(probes: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Whether all probes of an endpoint gave the same information.  Minimum and maximum
    of the record are enough; nothing distinct has to be gathered."""
    record = F.struct(*fields)
    return probes.groupBy("rse").agg(F.count(F.lit(1)).alias("probes"), (F.min(record) == F.max(record)).alias("ok"))
