"""Access traces from job reports, touches, transfer failures, nested records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of every trace.
EVENT_VERSION = "API_1.21.6"
# Processing sites whose storage bears another name.
SITE_STORAGE = {
    "T1_US_FNAL": "T1_US_FNAL_Disk",
    "T1_DE_KIT": "T1_DE_KIT_Disk",
    "T1_ES_PIC": "T1_ES_PIC_Disk",
    "T1_RU_JINR": "T1_RU_JINR_Disk",
    "T1_FR_CCIN2P3": "T1_FR_CCIN2P3_Disk",
    "T1_UK_RAL": "T1_UK_RAL_Disk",
    "T1_IT_CNAF": "T1_IT_CNAF_Disk",
    "T2_CH_CERN_HLT": "T2_CH_CERN",
    "T2_CH_CERNBOX": "T2_CH_CERN",
    "T3_UK_SGrid_Oxford": "T2_UK_London_IC",
}


def access_traces(
    reports: DataFrame,
    site_storage: Mapping[str, str] = SITE_STORAGE,
    account: str = "",
    subject: str = "",
    now: Column | None = None,
) -> DataFrame:
    """Job reports -> one trace per input file that was not read by fallback.

    All nested work is done inside the row: the inputs of all steps are flattened, fallback
    indexes taken out, the rest looked up in the file list, and only then exploded.  The
    site is that of the last step that names one; a report without site or file gives
    nothing.  Works on batch and streaming frames alike.
    """
    now = F.unix_timestamp(F.current_timestamp()) if now is None else now
    indexes = F.flatten(F.transform("steps", lambda s: F.coalesce(s["input"], F.array())))
    numbers = F.filter(F.transform(indexes, lambda i: i["lfn"]), lambda n: n.isNotNull())
    good = F.filter(numbers, lambda n: ~F.array_contains(F.coalesce("fallbackFiles", F.array().cast("array<bigint>")), n))
    lfns = F.when(
        F.array_contains("LFNArrayRef", "lfn"),
        F.transform(good, lambda n: F.try_element_at("LFNArray", (n + 1).cast("int"))),
    )
    sites = F.filter(F.transform("steps", lambda s: s["site"]), lambda s: s.isNotNull())
    site = F.try_element_at(sites, F.lit(-1))
    mapped = F.lit(None).cast("string")
    for name, storage in site_storage.items():
        mapped = F.when(F.col("_site") == name, storage).otherwise(mapped)
    ts = F.coalesce("meta_data.ts", now)
    stamp = F.when(ts != 0, ts).otherwise(now)
    return (
        reports.withColumn("_site", site)
        .filter(F.col("_site") != "")
        .withColumn("filename", F.explode(lfns))
        .select(
            F.lit(EVENT_VERSION).alias("eventVersion"),
            F.lit("DONE").alias("clientState"),
            F.lit("cms").alias("scope"),
            F.lit("get").alias("eventType"),
            F.lit(subject).alias("usrdn"),
            F.lit(account).alias("account"),
            "filename",
            F.coalesce(mapped, F.col("_site")).alias("remoteSite"),
            F.concat(F.lit("cms:"), "filename").alias("DID"),
            ts.alias("file_read_ts"),
            F.coalesce("meta_data.jobtype", F.lit("unknown")).alias("jobtype"),
            F.coalesce("meta_data.wn_name", F.lit("unknown")).alias("wn_name"),
            stamp.alias("timestamp"),
            stamp.alias("traceTimeentryUnix"),
        )
    )


def touch_traces(names: DataFrame, replicas: DataFrame) -> DataFrame:
    """One touch record as JSON per available replica of the listed files."""
    held = replicas.filter("state = 'A'").join(names.select("name"), "name", "left_semi")
    frame = F.struct(
        F.lit("touch").alias("eventType"),
        F.lit("DONE").alias("clientState"),
        F.lit(None).cast("string").alias("account"),
        F.col("rse").alias("localSite"),
        F.col("rse").alias("remoteSite"),
        F.col("scope"),
        F.col("name").alias("filename"),
    )
    return held.select("name", "rse", F.to_json(frame, {"ignoreNullFields": "false"}).alias("trace"))


def event_failures(
    events: DataFrame,
    start: Column,
    end: Column,
    src: str | None = None,
    dst: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Failed transfers in the window, newest first, as printed lines.

    ``limit`` (a screenful) applies after all filters, so it never hides a
    failure in favour of a success.
    """
    keep = (F.col("event_type") == "transfer-failed") & (F.col("ts") >= start) & (F.col("ts") <= end)
    if src:
        keep &= F.col("src_rse") == src
    if dst:
        keep &= F.col("dst_rse") == dst
    fields = ["src_rse", "dst_rse", "name", "purged_reason", "request_id"]
    line = F.concat_ws(" ", *[F.coalesce(F.replace(c, F.lit('"'), F.lit("")), F.lit("")) for c in fields])
    rows = events.filter(keep).select("ts", "request_id", line.alias("line")).orderBy(F.desc("ts"), "request_id")
    return rows.limit(limit) if limit is not None else rows


# --- nested records ------------------------------------------------------------------
def flatten_records(df: DataFrame, nested: str, parent: Sequence[str], prefix: str = "", outer: bool = False) -> DataFrame:
    """One row per element of the array of structs ``nested`` with the named parent columns;
    element fields get ``prefix``."""
    rows = df.select(*parent, (F.explode_outer if outer else F.explode)(nested).alias("_e"))
    fields = df.schema[nested].dataType.elementType.fieldNames()
    return rows.select(*parent, *[F.col("_e").getField(f).alias(prefix + f) for f in fields])


def transition_history(requests: DataFrame) -> DataFrame:
    """One row per state change of a request, the last one flagged current."""
    rows = requests.select("request", F.size("transitions").alias("_n"), F.posexplode("transitions").alias("position", "t"))
    return rows.select("request", "position", (F.col("position") == F.col("_n") - 1).alias("current"), "t.*")


def open_blocks_excluded(datasets: DataFrame) -> DataFrame:
    """Subscriptions of closed blocks: (dataset, blocks array<struct(name, is_open,
    subscriptions array)>) -> block and its first subscription."""
    blocks = datasets.select("dataset", F.explode("blocks").alias("b")).filter("b.is_open <> 'y'")
    return blocks.select("dataset", F.col("b.name").alias("block"), F.try_element_at("b.subscriptions", F.lit(1)).alias("s")).select(
        "dataset", "block", "s.*"
    )


def archive_host_groups(urls: DataFrame, chunk: int = 500) -> DataFrame:
    """URLs by host: (host, chunk, paths), at most ``chunk`` paths a row, so that one busy
    host is many rows.

    Every URL comes out: one without scheme and host, or a null one, under the host ``https://``.
    """
    from .ranking import block_chunks

    url = F.coalesce("url", F.lit(""))
    parts = urls.select(
        F.concat(F.lit("https://"), F.regexp_extract(url, r"^\w+://([^/?#]*)", 1)).alias("host"),
        F.regexp_extract(url, r"^(?:\w+://[^/?#]*)?([^?#]*)", 1).alias("path"),
        "url",
    )
    packed = block_chunks(parts, ["host"], ["path", "url"], chunk)
    return packed.groupBy("host", "chunk").agg(F.array_sort(F.collect_list("path")).alias("paths"))
