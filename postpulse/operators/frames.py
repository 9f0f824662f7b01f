"""Helpers shared by operators: bounded broadcasts and rows in global order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postpulse.session import cut_lineage

BROADCAST_ROWS = 200_000


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` where its row count is bounded by a small enough ``max_rows``;
    otherwise leave the join strategy to the optimizer."""
    return F.broadcast(df) if max_rows <= BROADCAST_ROWS else df


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan of fewer splits than the cluster has cores, such as one small file. A
    scan of many splits is left as it is, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def totals_of(df: DataFrame, *aggregates: Column) -> Column:
    """Global aggregates of ``df`` as one struct: a scalar subquery, which runs once and
    leaves no join in the plan that uses it."""
    return df.agg(F.struct(*aggregates).alias("totals")).scalar()


def with_totals(df: DataFrame, *aggregates: Column) -> DataFrame:
    """Add global aggregates of ``df`` to each of its rows."""
    return df.withColumn("_totals", totals_of(df, *aggregates)).select("*", "_totals.*").drop("_totals")


def with_ordinal(df: DataFrame, order: Sequence[Column], name: str = "ordinal", total: str = "total_rows") -> DataFrame:
    """Add each row's 0-based position in the order, and the number of rows.

    Rows are range-partitioned and sorted, so that many equal leading keys still spread over
    tasks by the later ones. The sorted rows are materialised once: partition sizes give the
    offset of each partition, and the position inside it is the running row id.
    """
    placed = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order))
    row_id = F.monotonically_increasing_id()
    local = placed.select(
        "*",
        F.spark_partition_id().alias("_part"),
        row_id.bitwiseAND(F.lit((1 << 33) - 1)).alias("_pos"),
    )
    # One row per partition.
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = local.groupBy("_part").agg(F.count("*").alias("_size")).select(
        "_part",
        F.coalesce(F.sum("_size").over(ahead), F.lit(0)).alias("_ahead"),
        F.sum("_size").over(whole).alias(total),
    )
    return (
        local.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_pos") + F.col("_ahead"))
        .drop("_part", "_pos", "_ahead")
    )
