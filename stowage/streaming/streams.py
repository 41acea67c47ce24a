"""The polls of the operators as streams.

Each function takes a streaming frame (or a batch one) and returns a frame; ``run_once``
drives a query over what is there and stops.  State is bounded by a watermark wherever the
semantics allow one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.traces import access_traces
from ..session import scratch_path

# Fixed value: look-back of the trace poll.
TRACE_LOOKBACK = "12 minutes"


def read_stream(spark: SparkSession, folder: str, name: str, schema, files_a_batch: int | None = None) -> DataFrame:
    """Parquet files of ``folder`` that match ``name`` as a stream, oldest first."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", name)
    if files_a_batch:
        reader = reader.option("maxFilesPerTrigger", files_a_batch)
    return reader.parquet(folder)


def access_traces_stream(reports: DataFrame, **options) -> DataFrame:
    """Traces without the repeats that overlapping polls bring.

    ``reports`` has a ``report_id`` and an event time ``ts``; a repeat of a report within the
    look-back is dropped before it is exploded, and its state is let go after it.
    """
    once = (
        reports.withWatermark("ts", TRACE_LOOKBACK).dropDuplicatesWithinWatermark(["report_id"])
        if reports.isStreaming
        else reports.dropDuplicates(["report_id"])
    )
    return access_traces(once, **options)


def failure_stream(events: DataFrame, window: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Failed transfers per link and tumbling window.

    On a stream, in append mode: a window is given out once, when the watermark (newest failure less ``late``) has passed its
    end; windows the stream ends in are not given out, and rows older than the watermark are left out.  ``complete_windows``
    gives them all.
    """
    failed = events.filter("event_type = 'transfer-failed'")
    if events.isStreaming:
        failed = failed.withWatermark("ts", late)
    return (
        failed.groupBy(F.window("ts", window).alias("w"), "src_rse", "dst_rse")
        .agg(F.count(F.lit(1)).alias("failures"))
        .select(F.col("w.start").alias("window_start"), "src_rse", "dst_rse", "failures")
    )


def counter_gauge_timer(samples: DataFrame, tie: str, window: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Samples (ts, kind, stat, value, ``tie``) per window: counters summed, gauges last (of equal times the one with the
    greatest ``tie``), timers counted and averaged.

    On a stream windows are given out as by ``failure_stream``.
    """
    if samples.isStreaming:
        samples = samples.withWatermark("ts", late)
    of = lambda kind: F.col("kind") == kind
    grouped = samples.groupBy(F.window("ts", window).alias("w"), "kind", "stat").agg(
        F.sum(F.when(of("counter"), F.col("value"))).alias("total"),
        F.max_by("value", F.when(of("gauge"), F.struct("ts", tie))).alias("last"),
        F.count_if(of("timer")).alias("timings"),
        F.avg(F.when(of("timer"), F.col("value"))).alias("mean"),
    )
    return grouped.select(F.col("w.start").alias("window_start"), "kind", "stat", "total", "last", "timings", "mean")


def complete_windows(windows: DataFrame, keys: list[str]) -> DataFrame:
    """All windows of a finished stream: run in update mode, the newest form of each window.  Runs the stream.

    ``windows`` comes from ``failure_stream`` or ``counter_gauge_timer``.  Nothing is held back for a watermark that will
    not come; only rows that were older than the watermark when they arrived are missing.
    """
    return run_once(windows, "update", ["window_start", *keys])


def run_once(stream: DataFrame, mode: str = "append", keys: list[str] | None = None) -> DataFrame:
    """Run a stream over everything available and return what it wrote.

    Output and progress go to the shared folder.  In update mode every batch is written
    with its number and the newest row per ``keys`` is returned.
    """
    spark = stream.sparkSession
    out, progress = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-progress")
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", progress).trigger(availableNow=True)
    if mode == "append":
        query = writer.format("parquet").option("path", out).start()
    else:

        def keep(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

        query = writer.foreachBatch(keep).start()
    query.awaitTermination()
    written = spark.read.schema(_with_batch(stream, mode)).parquet(out)
    if mode == "append":
        return written
    rest = [c for c in written.columns if c not in keys and c != "batch"]
    return written.groupBy(*keys).agg(*[F.max_by(c, "batch").alias(c) for c in rest])


def _with_batch(stream: DataFrame, mode: str):
    return stream.schema if mode == "append" else T.StructType([*stream.schema.fields, T.StructField("batch", T.LongType())])
