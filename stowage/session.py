"""Session settings, and a place for checkpoints and scratch output that every executor can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are written for.  Everything else is left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more exchange after the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A task that groups what it scans holds nearly all rows of its split: its memory follows the split.
    "spark.sql.files.maxPartitionBytes": "32m",
    # A job's shuffle files go when it ends: a query that stores its steps then holds those of one step, not of all.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def build_session(app_name: str = "stowage", master: str | None = None, **conf: str) -> SparkSession:
    """A session with ``SETTINGS``; ``conf`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {"spark.cleaner.referenceTracking.cleanCheckpoints": "true", **SETTINGS}
    for key, value in {**settings, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put those ``SETTINGS`` that nobody has set on a session made elsewhere."""
    present = spark.conf.getAll
    for key, value in SETTINGS.items():
        if key not in present:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """A folder all executors share: the one that ``spark.checkpoint.dir`` names.

    Where the setting is missing, a folder in the warehouse is used: the other place that
    driver and executors share.  The session's part is removed when its JVM ends.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        sc.setCheckpointDir(named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch")
        own = sc._jvm.org.apache.hadoop.fs.Path(sc.getCheckpointDir())
        own.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(own)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch path."""
    own = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    own.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(own, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives lost executors.  Runs a job.

    Spark removes it once nothing refers to it, where
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on (``build_session`` sets it).
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def keep_table(df: DataFrame, label: str) -> DataFrame:
    """Write as Parquet in the shared folder and read again: later plans know its size.  Runs a job."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
