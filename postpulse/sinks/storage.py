"""Parquet storage: partitioned writes, compaction, retention, saved vocabularies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from postpulse.config import StorageConfig
from postpulse.session import scratch_path
from postpulse.sinks.files import Files

MODES = {"append": "append", "overwrite": "overwrite", "error": "errorifexists"}
DISTINCT_LIMIT = 100


def with_date_hour(posts: DataFrame) -> DataFrame:
    return posts.withColumns({"date": F.to_date("timestamp"), "hour": F.hour("timestamp")})


def _partitioned(df: DataFrame, columns: Sequence[str], compression: str) -> DataFrameWriter:
    """Rows of a partition meet in few tasks, or every task would write a file into every
    partition. The rebalance splits partitions that hold far more rows than others."""
    if columns:
        df = df.hint("rebalance", *[F.col(c) for c in columns])
    writer = df.write.option("compression", compression)
    return writer.partitionBy(*columns) if columns else writer


def save_tweets(posts: DataFrame, path: str, cfg: StorageConfig = StorageConfig()) -> bool:
    """Write posts by date and hour; nothing is written for an empty frame."""
    if posts.isEmpty():
        return False
    columns = cfg.partition_columns if cfg.partitioning_enabled else ()
    _partitioned(with_date_hour(posts), columns, cfg.compression).mode("append").parquet(path)
    return True


def pick_partition_cols(df: DataFrame, candidates: Sequence[str]) -> list[str]:
    """Candidates with more than one and fewer than ``DISTINCT_LIMIT`` distinct values, NULL not counted."""
    present = [c for c in candidates if c in df.columns]
    return _few_valued(df, present, df.agg(*_sketches(present)).first()) if present else []


def _sketches(columns: Sequence[str]) -> list[Column]:
    return [F.approx_count_distinct(c, 0.02).alias(f"distinct_{c}") for c in columns]


def _few_valued(df: DataFrame, columns: Sequence[str], rough: Mapping[str, int]) -> list[str]:
    """Those of ``columns`` that may partition. A sketch, which is off by a few percent, rules out columns with twice the limit; the others are counted
    exactly, and have so few values that tasks send almost nothing."""
    few = [c for c in columns if rough[f"distinct_{c}"] < 2 * DISTINCT_LIMIT]
    if not few:
        return []
    exact = df.agg(*[F.count_distinct(c).alias(c) for c in few]).first()
    return [c for c in few if 1 < exact[c] < DISTINCT_LIMIT]


def partition_col_report(df: DataFrame, candidates: Sequence[str]) -> DataFrame | None:
    """(position, column, distinct_count, eligible) of each candidate that exists, in one scan; counts are exact.

    Each row gives a column and a value for each candidate; distinct ones are found in the tasks first, and a column with many values
    is counted by many tasks.
    """
    present = [c for c in candidates if c in df.columns]
    if not present:
        return None
    names = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for i, c in enumerate(present)])
    values = df.select(F.inline(names)).distinct()
    counted = values.groupBy("position", "column").agg(F.count("value").alias("distinct_count"))
    # An empty table has a row for each candidate, too.
    entries = [(i, c) for i, c in enumerate(present)]
    listed = df.sparkSession.createDataFrame(entries, "position int, column string")
    return listed.join(counted, ["position", "column"], "left").select(
        "position", "column", F.coalesce("distinct_count", F.lit(0)).cast("bigint").alias("distinct_count")
    ).withColumn("eligible", (F.col("distinct_count") > 1) & (F.col("distinct_count") < DISTINCT_LIMIT))


def save_table(
    df: DataFrame,
    base_path: str,
    table: str,
    mode: str = "append",
    partition_cols: Sequence[str] | None = None,
    cfg: StorageConfig = StorageConfig(),
) -> str:
    """Save below ``base_path/table``; the path, or nothing for an empty frame.

    Partition columns that are not given are chosen by their number of distinct values.
    Overwriting a partitioned table replaces only the partitions that the rows fall into.

    The plan of ``df`` runs once: its rows are staged in the shared folder, and counted on the way. What is asked of them later reads the staged files.
    """
    spark, path = df.sparkSession, f"{base_path.rstrip('/')}/{table}"
    staging, seen = scratch_path(spark, "staged"), Observation()
    choose = partition_cols is None and cfg.partitioning_enabled
    candidates = [c for c in cfg.partition_columns if c in df.columns] if choose else []
    df.observe(seen, F.count("*").alias("rows"), *_sketches(candidates)).write.parquet(staging)
    try:
        if not seen.get["rows"]:
            return ""
        staged = spark.read.schema(df.schema).parquet(staging)
        columns = _few_valued(staged, candidates, seen.get) if choose else [c for c in partition_cols or () if c in df.columns]
        writer = _partitioned(staged, columns, cfg.compression)
        if columns:
            writer = writer.option("partitionOverwriteMode", "dynamic")
        writer.mode(MODES[mode]).parquet(path)
    finally:
        Files(spark).delete(staging)
    return path


def partition_overwrite(df: DataFrame, path: str, columns: Sequence[str], compression: str = "snappy") -> None:
    """Replace the partitions that ``df`` has rows for, and leave the others alone."""
    writer = _partitioned(df, columns, compression).option("partitionOverwriteMode", "dynamic")
    writer.mode("overwrite").parquet(path)


def append_single(df: DataFrame, path: str, compression: str = "snappy") -> None:
    """Append to an unpartitioned table: new part files, no rewrite of the old ones."""
    df.write.option("compression", compression).mode("append").parquet(path)


def compact_dataset(
    spark: SparkSession,
    source: str,
    target: str,
    rows_per_file: int = 100_000,
    partition_cols: Sequence[str] = (),
    compression: str = "snappy",
) -> None:
    """Rewrite into few files of at most ``rows_per_file`` rows. AQE sizes the tasks."""
    df = spark.read.parquet(source)
    df = df.hint("rebalance", *[F.col(c) for c in partition_cols]) if partition_cols else df.hint("rebalance")
    writer = df.write.option("compression", compression).option("maxRecordsPerFile", rows_per_file)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.mode("errorifexists").parquet(target)


def retention_filter(df: DataFrame, as_of: str, retention_days: int = 30, date_col: str = "date") -> DataFrame:
    """Rows whose date is not older than the retention time."""
    return df.where(F.col(date_col) >= F.date_sub(F.to_date(F.lit(as_of)), retention_days))


def expired_dates(df: DataFrame, as_of: str, retention_days: int = 30, date_col: str = "date") -> DataFrame:
    """Dates (partitions) that retention would drop, with their rows."""
    return (
        df.where(F.col(date_col) < F.date_sub(F.to_date(F.lit(as_of)), retention_days))
        .groupBy(date_col)
        .agg(F.count("*").alias("row_count"))
    )


def write_run(df: DataFrame, path: str, run_id: str, compression: str = "snappy", ts_col: str = "timestamp") -> None:
    """A stage's output, kept apart by run. Repeating a run replaces all of its own rows.

    Rows with a time lie in a partition for each ``date``, few files each, in the order of time: statistics of row groups and pages tell
    which parts of a file a range of time touches. The plan of ``df`` runs once.
    """
    folder = f"{path.rstrip('/')}/run_id={_escaped(run_id)}"
    if ts_col in df.columns and "date" not in df.columns:
        placed = df.withColumn("date", F.to_date(ts_col)).hint("rebalance", F.col("date"))
        writer = placed.sortWithinPartitions("date", ts_col).write.partitionBy("date")
    else:
        writer = df.write
    writer.option("compression", compression).option("partitionOverwriteMode", "static").mode("overwrite").parquet(folder)


def read_run(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """The rows of a run, with ``date`` where it was added."""
    return spark.read.parquet(f"{path.rstrip('/')}/run_id={_escaped(run_id)}")


def _escaped(value: str) -> str:
    """A partition value in a folder's name, as Spark writes it."""
    return "".join(f"%{ord(c):02X}" if c < " " or c in "\"#%'*/:=?\\{[]^\x7f" else c for c in value)


def write_summary_json(summary: DataFrame, path: str) -> None:
    summary.write.mode("overwrite").json(path)


def save_model(model: DataFrame, path: str) -> None:
    """A fitted vocabulary."""
    model.write.mode("overwrite").parquet(path)


def load_model(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
