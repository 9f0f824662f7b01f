"""Session set-up and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "postpulse", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators are written for.

    Shuffle partitions are left to the cluster's own setting; AQE coalesces or splits them.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # The older type has no statistics, so that files could not be skipped by time.
        .config("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Checkpoint folder of the session: ``spark.checkpoint.dir`` where the cluster sets it.

    Only a local master may fall back to a temporary folder, because executors on other
    machines could not read it.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="postpulse-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, so that reuse does not recompute it and
    a lost executor does not lose it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
