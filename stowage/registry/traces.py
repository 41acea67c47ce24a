"""Registered queries: access traces, touches, failures, nested records and streams."""

from pyspark.sql import functions as F

from ..operators import traces as tr
from ..sources.testtables import file_name
from ..streaming import state as stt
from ..streaming import streams as st
from . import registered
from .invalidation import replicas_named

_EVENT_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def _reports(events):
    """Job reports from events: three files, two steps, fallback on errors."""
    name = lambda key: F.expr(file_name(key))
    step = lambda site, *idx: F.struct(site.alias("site"), F.array(*[F.struct(i.cast("bigint").alias("lfn")) for i in idx]).alias("input"))
    kind = F.col("event_type")
    site = F.when(kind == "view", "T1_US_FNAL").when(kind.isin("click", "error"), "T2_XX_Site").when(kind == "signup", "T2_CH_CERN_HLT")
    return events.select(
        F.col("event_id").alias("report_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.struct(
            F.unix_timestamp(F.col("ts").cast("timestamp")).alias("ts"),
            F.when(kind == "view", "analysis").alias("jobtype"),
            F.concat(F.lit("wn"), F.col("user_id").cast("string")).alias("wn_name"),
        ).alias("meta_data"),
        F.array(name("event_id"), name("user_id"), name("(event_id + user_id)")).alias("LFNArray"),
        F.when(F.col("value") < 2, F.array(F.lit("pfn"))).otherwise(F.array(F.lit("pfn"), F.lit("lfn"))).alias("LFNArrayRef"),
        F.when(kind == "error", F.array(F.lit(1).cast("bigint"))).otherwise(F.array().cast("array<bigint>")).alias("fallbackFiles"),
        F.array(step(site, F.lit(0), F.lit(1)), step(F.lit(None).cast("string"), F.lit(2), F.lit(None))).alias("steps"),
    )


_TRACES = f"""
    e AS (SELECT event_id, event_type, value, 'wn' || user_id AS wn_name, epoch_us(ts) // 1000000 AS file_read_ts,
                 unnest([{file_name('event_id')}, {file_name('user_id')}, {file_name('(event_id + user_id)')}]) AS filename,
                 unnest([0, 1, 2]) AS i FROM events),
    t AS (SELECT filename, CASE event_type WHEN 'view' THEN 'T1_US_FNAL_Disk' WHEN 'signup' THEN 'T2_CH_CERN' ELSE 'T2_XX_Site' END AS "remoteSite",
                 'cms:' || filename AS "DID", file_read_ts, CASE WHEN event_type = 'view' THEN 'analysis' ELSE 'unknown' END AS jobtype, wn_name,
                 file_read_ts AS "timestamp"
          FROM e WHERE event_type IN ('view', 'click', 'error', 'signup') AND value >= 2 AND NOT (event_type = 'error' AND i = 1))
    SELECT * FROM t
"""
_TRACE_COLUMNS = ["filename", "remoteSite", "DID", "file_read_ts", "jobtype", "wn_name", "timestamp"]


@registered("access_traces", f"WITH {_TRACES}")
def _(c):
    return tr.access_traces(_reports(c.events)).select(*_TRACE_COLUMNS)


def _event_stream(c):
    return st.read_stream(c.spark, c.sf_dir, "events.parquet", _EVENT_SCHEMA)


@registered("access_traces_stream", f"WITH {_TRACES}")
def _(c):
    # overlapping polls: every report arrives twice
    events = _event_stream(c)
    twice = _reports(events.withColumn("_again", F.explode(F.array(F.lit(1), F.lit(2)))))
    return st.run_once(st.access_traces_stream(twice)).select(*_TRACE_COLUMNS)


@registered(
    "touch_traces",
    """SELECT r.name, s.rse, '{"eventType":"touch","clientState":"DONE","account":null,"localSite":"' || s.rse || '","remoteSite":"' || s.rse
              || '","scope":"cms","filename":"' || r.name || '"}' AS trace
       FROM replicas r JOIN rses s ON s.rse_id = r.rse_id WHERE r.state = 'A' AND r.name IN (SELECT name FROM files)""",
)
def _(c):
    return tr.touch_traces(c.files.select("name"), replicas_named(c))


@registered(
    "event_failures",
    """SELECT request_id, src_rse || ' ' || dst_rse || ' ' || name || ' ' || replace(purged_reason, '"', '') || ' ' || request_id AS line
       FROM transfer_events WHERE event_type = 'transfer-failed' AND ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-25'
       ORDER BY ts DESC, request_id LIMIT 500""",
)
def _(c):
    at = lambda text: F.lit(text).cast("timestamp_ntz")
    return tr.event_failures(c.transfer_events, at("2024-01-05"), at("2024-01-25"), limit=500).drop("ts")


@registered(
    "event_failures_all",
    """SELECT request_id, src_rse || ' ' || dst_rse || ' ' || name || ' ' || replace(purged_reason, '"', '') || ' ' || request_id AS line
       FROM transfer_events WHERE event_type = 'transfer-failed' AND ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-25'""",
)
def _(c):
    at = lambda text: F.lit(text).cast("timestamp_ntz")
    return tr.event_failures(c.transfer_events, at("2024-01-05"), at("2024-01-25")).drop("ts")


_WINDOWS = """
    w AS (SELECT date_trunc('hour', ts) AS window_start, src_rse, dst_rse, count(*) AS failures FROM transfer_events
          WHERE event_type = 'transfer-failed' GROUP BY 1, 2, 3)
"""
_SHOW = "strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start"


def _shown(df):
    return df.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@registered("failure_windows", f"WITH {_WINDOWS} SELECT {_SHOW}, src_rse, dst_rse, failures FROM w")
def _(c):
    events = c.transfer_events.withColumn("ts", F.col("ts").cast("timestamp"))
    return _shown(st.failure_stream(events))


def _transfer_stream(c):
    """The transfer events as a stream, with endpoint names from the static table."""
    n = c.supplier.agg(F.count(F.lit(1)).alias("n")).scalar()
    name = c.rses.select("rse_id", "rse")
    ends = _event_stream(c).select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(F.col("event_type") == "error", "transfer-failed").otherwise("transfer-done").alias("event_type"),
        (F.col("user_id") % n).alias("s"),
        (F.col("event_id") % n).alias("d"),
    )
    src, dst = name.toDF("s", "src_rse"), name.toDF("d", "dst_rse")
    return ends.join(src, "s").join(dst, "d").select("ts", "event_type", "src_rse", "dst_rse")


@registered(
    "failure_stream",
    f"""WITH {_WINDOWS} SELECT {_SHOW}, src_rse, dst_rse, failures FROM w
        WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM transfer_events WHERE event_type = 'transfer-failed') - INTERVAL 1 HOUR""",
)
def _(c):
    # a window appears once the watermark (newest failure less one hour) has passed its end
    return _shown(st.run_once(st.failure_stream(_transfer_stream(c))))


@registered("failure_stream_complete", f"WITH {_WINDOWS} SELECT {_SHOW}, src_rse, dst_rse, failures FROM w")
def _(c):
    return _shown(st.complete_windows(st.failure_stream(_transfer_stream(c)), ["src_rse", "dst_rse"]))


def _latest_sql(name: str) -> str:
    return f"""SELECT name, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, tie, value FROM (
        SELECT {name} AS name, ts, event_id AS tie, value, row_number() OVER (PARTITION BY {name} ORDER BY ts DESC, event_id) AS n FROM events)
        WHERE n = 1 AND ts + INTERVAL 24 HOUR >= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR"""


def _metrics(events, name):
    return events.select(name.alias("name"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("tie"), "value")


def _seconds():
    return F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts")


def _user():
    return F.concat(F.lit("T2_"), F.col("user_id").cast("string"))


@registered("metric_latest_stream", _latest_sql("event_type"))
def _(c):
    changes = stt.metric_latest_stream(_metrics(_event_stream(c), F.col("event_type")), "value", "tie")
    return stt.current(st.run_once(changes, "update", ["name"])).select("name", _seconds(), "tie", "value")


@registered("metric_expiry_stream", _latest_sql("'T2_' || user_id"))
def _(c):
    """Sites that fell silent a day before the newest report leave."""
    changes = stt.metric_latest_stream(_metrics(_event_stream(c), _user()), "value", "tie")
    return stt.current(st.run_once(changes, "update", ["name"])).select("name", _seconds(), "tie", "value")


@registered("metric_latest", _latest_sql("'T2_' || user_id"))
def _(c):
    return stt.metric_latest(_metrics(c.events, _user()), "value", "tie").select("name", _seconds(), "tie", "value")


def _samples(events):
    kind = F.when(F.col("event_type") == "view", "counter").when(F.col("event_type") == "click", "gauge").otherwise("timer")
    return events.select(F.col("ts").cast("timestamp").alias("ts"), kind.alias("kind"), F.col("event_type").alias("stat"), "value", "event_id")


_SAMPLES = """
    s AS (SELECT date_trunc('hour', ts) AS window_start, CASE event_type WHEN 'view' THEN 'counter' WHEN 'click' THEN 'gauge' ELSE 'timer' END AS kind,
                 event_type AS stat, ts, value, event_id FROM events),
    g AS (SELECT window_start, kind, stat, round(sum(value) FILTER (kind = 'counter'), 6) AS total, arg_max(value, struct_pack(a := ts, b := event_id)) FILTER (kind = 'gauge') AS last,
                 count(*) FILTER (kind = 'timer') AS timings, round(avg(value) FILTER (kind = 'timer'), 6) AS mean FROM s GROUP BY 1, 2, 3)
"""


def _rounded(df):
    return _shown(df).withColumn("total", F.round("total", 6)).withColumn("mean", F.round("mean", 6))


@registered("counter_gauge_timer", f"WITH {_SAMPLES} SELECT {_SHOW}, kind, stat, total, last, timings, mean FROM g")
def _(c):
    return _rounded(st.counter_gauge_timer(_samples(c.events), "event_id"))


@registered(
    "counter_gauge_timer_stream",
    f"""WITH {_SAMPLES} SELECT {_SHOW}, kind, stat, total, last, timings, mean FROM g
        WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
)
def _(c):
    return _rounded(st.run_once(st.counter_gauge_timer(_samples(_event_stream(c)), "event_id")))


# --- nested records ------------------------------------------------------------------
@registered(
    "flatten_records",
    """SELECT o_orderkey AS id, o_orderpriority AS priority, unnest(['a', 'b']) AS "node.name", unnest([o_custkey, o_custkey + 1]) AS "node.size" FROM orders""",
)
def _(c):
    node = lambda n, v: F.struct(F.lit(n).alias("name"), v.alias("size"))
    nested = c.orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("priority"),
        F.array(node("a", F.col("o_custkey")), node("b", F.col("o_custkey") + 1)).alias("nodes"),
    )
    return tr.flatten_records(nested, "nodes", ["id", "priority"], "node.")


@registered(
    "transition_history",
    """SELECT o_orderkey AS request, CAST(unnest([0, 1, 2]) AS INTEGER) AS position, unnest([false, false, true]) AS current,
              unnest(['new', o_orderstatus, o_orderpriority]) AS "Status" FROM orders""",
)
def _(c):
    step = lambda v: F.struct(v.alias("Status"))
    rows = c.orders.select(
        F.col("o_orderkey").alias("request"),
        F.array(step(F.lit("new")), step(F.col("o_orderstatus")), step(F.col("o_orderpriority"))).alias("transitions"),
    )
    return tr.transition_history(rows)


@registered(
    "open_blocks_excluded",
    """SELECT name AS dataset, child_name AS block, 'T1' AS node, did_type AS kind FROM contents WHERE contains(name, 'AOD')
       UNION ALL SELECT name, child_name || '-2', 'T1', did_type FROM contents WHERE NOT contains(name, 'AOD')""",
)
def _(c):
    subs = F.array(F.struct(F.lit("T1").alias("node"), F.col("did_type").alias("kind")), F.struct(F.lit("T2").alias("node"), F.col("did_type").alias("kind")))
    aod = F.col("name").contains("AOD")
    flag = lambda is_open: F.when(is_open, "y").otherwise("n")
    block = lambda name, is_open: F.struct(name.alias("name"), flag(is_open).alias("is_open"), subs.alias("subscriptions"))
    blocks = F.array(block(F.col("child_name"), ~aod), block(F.concat("child_name", F.lit("-2")), aod))
    return tr.open_blocks_excluded(c.contents.select(F.col("name").alias("dataset"), blocks.alias("blocks")))


@registered(
    "archive_host_groups",
    r"""SELECT host, n // 20 AS chunk, string_agg(path, ',' ORDER BY path) AS paths FROM (
        SELECT *, row_number() OVER (PARTITION BY host ORDER BY path, url) - 1 AS n FROM (
          SELECT 'https://' || regexp_extract(url, '^\w+://([^/?#]*)', 1) AS host, regexp_extract(url, '^\w+://[^/?#]*([^?#]*)', 1) AS path, url FROM pages))
        GROUP BY 1, 2""",
)
def _(c):
    return tr.archive_host_groups(c.pages.select("url"), chunk=20).withColumn("paths", F.array_join("paths", ","))
