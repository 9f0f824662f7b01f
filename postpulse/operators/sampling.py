"""Reduction of long series to a bounded number of points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postpulse.config import SamplingConfig
from postpulse.functions.timebuckets import bucket_spine, from_micros, with_bucket
from postpulse.operators.frames import broadcast_if_small, with_ordinal
from postpulse.session import cut_lineage


def random_key(key: Column, seed: int) -> Column:
    """Pseudo-random sort key that depends only on the seed and the row's own key."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def sample_random(df: DataFrame, k: int, key: str = "tweet_id", order: str = "timestamp", seed: int = 42) -> DataFrame:
    """Exactly ``min(k, n)`` rows, uniformly chosen and repeatable, in time order. Each task
    keeps only its own best k candidates."""
    return df.orderBy(random_key(F.col(key), seed), key).limit(k).orderBy(order, key)


def sample_reservoir(df: DataFrame, k: int, key: str = "tweet_id", order: str = "timestamp", seed: int = 7) -> DataFrame:
    """Uniform k-subset. The k smallest random keys are a reservoir that merges over tasks."""
    return sample_random(df, k, key, order, seed)


def sample_systematic(df: DataFrame, k: int, key: str = "tweet_id", order: str = "timestamp") -> DataFrame:
    """Every (n // k)-th row in time order, the first k of them; all rows when n <= k.

    Only the two ordering columns are sorted. ``key`` is unique, so the at most k chosen
    keys then pick the full rows.
    """
    placed = with_ordinal(df.select(order, key), [F.col(order), F.col(key)])
    step = F.greatest(F.lit(1), F.floor(F.col("total_rows") / k)).cast("bigint")
    chosen = placed.where(
        (F.col("total_rows") <= k) | ((F.pmod("ordinal", step) == 0) & (F.col("ordinal") < step * k))
    ).select(key)
    return df.join(broadcast_if_small(chosen, k), key, "left_semi")


def adaptive_minutes(rows: int) -> int:
    """Bucket width for a series of that many rows."""
    for above, minutes in ((10_000, 60), (5_000, 30), (2_000, 15), (1_000, 10)):
        if rows > above:
            return minutes
    return 5


def downsample_time(df: DataFrame, ts_col: str = "timestamp", width_minutes: int | None = None) -> DataFrame:
    """Mean of every numeric column per bucket, empty buckets included with NULL means."""
    if ts_col not in df.columns:
        raise ValueError(f"time-based sampling needs the column {ts_col}")
    width = width_minutes or adaptive_minutes(df.count())
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    means = with_bucket(df, width, ts_col).groupBy("bucket").agg(*[F.avg(c).alias(c) for c in numeric])
    # At most one row per bucket; read twice below.
    means = cut_lineage(means)
    filled = bucket_spine(means, width).join(means, "bucket", "left")
    return filled.select(from_micros(F.col("bucket"), dict(df.dtypes)[ts_col]).alias(ts_col), *numeric)


def sample_data(df: DataFrame, cfg: SamplingConfig = SamplingConfig(), key: str = "tweet_id") -> DataFrame:
    """``df`` itself up to ``max_points`` rows, else its sample by the configured method."""
    rows = df.count()
    if rows <= cfg.max_points:
        return df
    if cfg.method == "systematic":
        return sample_systematic(df, cfg.max_points, key)
    if cfg.method == "reservoir":
        return sample_reservoir(df, cfg.max_points, key)
    if cfg.method == "time_based":
        return downsample_time(df, width_minutes=adaptive_minutes(rows))
    return sample_random(df, cfg.max_points, key, seed=cfg.seed)


def order_by_time(df: DataFrame, *tie_breakers: str) -> DataFrame:
    return df.orderBy("timestamp", *tie_breakers)


def latest_windows(windows: DataFrame, n: int = 5) -> DataFrame:
    """The last windows of a signals table, newest first."""
    return (
        windows.select("timestamp", "composite_signal", "avg_sentiment", "tweet_count")
        .orderBy(F.desc("timestamp"))
        .limit(n)
    )
