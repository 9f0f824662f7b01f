"""Reads of stored Parquet tables, with the predicates that prune them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_parquet(
    spark: SparkSession, path: str, condition: Column | None = None, columns: Sequence[str] | None = None
) -> DataFrame:
    """A file or a directory. A path that does not exist raises."""
    df = spark.read.parquet(path)
    if condition is not None:
        df = df.where(condition)
    return project_columns(df, columns) if columns else df


def project_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def in_time_range(df: DataFrame, start: str | None = None, end: str | None = None, ts_col: str = "timestamp") -> DataFrame:
    """``start <= timestamp <= end``. Where the table has a ``date`` column the same range is
    asked of it too, because partitions are not pruned by the timestamp alone."""
    dated = "date" in df.columns
    if start is not None:
        df = df.where(F.col(ts_col) >= F.lit(start).cast("timestamp_ntz"))
        if dated:
            df = df.where(F.col("date") >= F.to_date(F.lit(start)))
    if end is not None:
        df = df.where(F.col(ts_col) <= F.lit(end).cast("timestamp_ntz"))
        if dated:
            df = df.where(F.col("date") <= F.to_date(F.lit(end)))
    return df


def has_any_hashtag(hashtags: Column, wanted: Sequence[str]) -> Column:
    """Whether any of ``wanted`` is among the tags, regardless of case and leading sign."""
    names = [w.lower().lstrip("#") for w in wanted]
    return F.coalesce(
        F.exists(hashtags, lambda tag: F.ltrim(F.lower(tag), F.lit("#")).isin(*names)), F.lit(False)
    )


def query_data(
    df: DataFrame,
    start: str | None = None,
    end: str | None = None,
    hashtags: Sequence[str] | None = None,
    min_engagement: float = 0,
) -> DataFrame:
    """Stored posts by time, hashtags and engagement score."""
    df = in_time_range(df, start, end)
    if hashtags:
        df = df.where(has_any_hashtag(F.col("hashtags"), hashtags))
    if min_engagement > 0:
        df = df.where(F.col("engagement_score") >= min_engagement)
    return df


def dataset_stats(df: DataFrame) -> DataFrame:
    """Rows, files, megabytes, columns and partition columns behind a scan of files. Files without rows are not counted.

    No column is read: the rows of a file are counted by its footer, and the partition columns are those that its path names.
    """
    path = F.col("_metadata.file_path")
    named = F.filter(F.regexp_extract_all(path, F.lit("([^/=]+)=[^/]*/"), F.lit(1)), lambda c: c.isin(*df.columns))
    files = df.groupBy(path.alias("file"), F.col("_metadata.file_size").alias("bytes"), F.array_join(named, ",").alias("parts")).agg(
        F.count("*").alias("n")
    )
    return files.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count("*").alias("num_files"),
        F.coalesce(F.sum("bytes") / (1024 * 1024), F.lit(0.0)).alias("total_size_mb"),
        F.coalesce(F.max("parts"), F.lit("")).alias("partition_columns"),
    ).withColumns(
        {
            "num_columns": F.lit(len(df.columns)).cast("bigint"),
            "columns": F.lit(",".join(df.columns)),
        }
    )
