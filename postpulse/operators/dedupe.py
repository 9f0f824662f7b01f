"""Exact duplicates by content hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedupe_by_hash(
    df: DataFrame, hash_col: str = "content_hash", order: Sequence[str] = ("timestamp", "tweet_id", "matched_source")
) -> DataFrame:
    """Keep the earliest row of each hash, rows without a time last.

    For a rank limited like this Spark keeps one row per hash in each task before the shuffle
    (WindowGroupLimit), so a hash shared by a large part of the table, such as that of all
    blank posts, does not gather in one task.
    """
    first = Window.partitionBy(hash_col).orderBy(*[F.asc_nulls_last(c) for c in order if c in df.columns])
    return df.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") == 1).drop("_rank")


def dedupe_report(df: DataFrame, hash_col: str = "content_hash") -> DataFrame:
    """Rows before and after removing duplicates, and rows removed."""
    groups = df.groupBy(hash_col).agg(F.count("*").alias("_n"))
    totals = groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_before"), F.count("*").alias("rows_after")
    )
    return totals.withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))
