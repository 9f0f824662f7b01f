"""Small result tables for dashboards and run reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postpulse.functions.timebuckets import micros
from postpulse.operators.frames import totals_of

DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
SERIES = {
    "composite": ("composite_signal",),
    "sentiment": ("avg_sentiment", "sentiment_ci_lower", "sentiment_ci_upper"),
    "volume": ("tweet_count",),
    "engagement": ("like_count", "retweet_count", "reply_count"),
}


def signals_by_hour_day(df: DataFrame, value_col: str = "composite_signal") -> DataFrame:
    """Mean by weekday and hour: seven rows, Monday first, and columns ``h00`` to ``h23``."""
    spark = df.sparkSession
    weekdays = spark.range(7).select(
        F.col("id").cast("int").alias("day_number"),
        F.element_at(F.array(*[F.lit(d) for d in DAY_NAMES]), (F.col("id") + 1).cast("int")).alias("day"),
    )
    hours = [f"h{h:02d}" for h in range(24)]
    means = (
        df.where(F.col("timestamp").isNotNull())
        .select(
            F.weekday("timestamp").alias("day_number"),
            F.concat(F.lit("h"), F.date_format("timestamp", "HH")).alias("hour"),
            value_col,
        )
        .groupBy("day_number")
        .pivot("hour", hours)
        .agg(F.avg(value_col))
    )
    return weekdays.join(means, "day_number", "left").select(
        F.col("day_number").cast("bigint").alias("day_number"), "day", *hours
    ).orderBy("day_number")


def signal_summary(df: DataFrame, value_col: str = "composite_signal") -> DataFrame:
    """One row: count, strength, volatility, share of positive values, moments and quartiles.

    Quartiles are exact and meant for a window table, whose rows the calendar bounds.
    """
    value = F.col(value_col)
    summary = df.agg(
        F.count("*").alias("signal_windows"),
        F.avg(F.abs(value)).alias("avg_signal_strength"),
        F.stddev_samp(value).alias("signal_volatility"),
        (F.try_divide(F.count_if(value > 0).cast("double"), F.count("*")) * 100).alias("positive_signal_percentage"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.percentile(value, [0.25, 0.5, 0.75]).alias("_quartiles"),
    )
    quartiles = {name: F.get("_quartiles", F.lit(i)) for i, name in enumerate(("q25", "median", "q75"))}
    return summary.withColumns(quartiles).drop("_quartiles")


def signal_histogram(df: DataFrame, value_col: str = "composite_signal", bins: int = 50) -> DataFrame:
    """Counts of equal-width bins between minimum and maximum; the last bin is closed. Empty
    bins are listed with 0."""
    values = df.where(F.col(value_col).isNotNull())
    bounds = totals_of(values, F.min(value_col).alias("low"), F.max(value_col).alias("high"))
    low = bounds.getField("low")
    width = (bounds.getField("high") - low) / bins
    # Without a spread everything falls into the first bin.
    place = F.coalesce(F.floor(F.try_divide(F.col(value_col) - low, width)), F.lit(0))
    counted = (
        values.select(F.least(place, F.lit(bins - 1)).cast("bigint").alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("n"))
    )
    every_bin = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return every_bin.join(counted, "bin", "left").select(
        "bin",
        (low + F.col("bin") * width).alias("bin_start"),
        (low + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def hashtag_distribution(posts: DataFrame, k: int = 20) -> DataFrame:
    """The k most used hashtags, without the leading sign and regardless of case."""
    return (
        posts.select(F.explode("hashtags").alias("raw"))
        .select(F.ltrim(F.lower("raw"), F.lit("#")).alias("hashtag"))
        .groupBy("hashtag")
        .agg(F.count("*").alias("posts"))
        .orderBy(F.desc("posts"), "hashtag")
        .limit(k)
    )


def stage_counts(**stages: DataFrame) -> DataFrame:
    """Rows per stage of a run, in the order given. Runs that write their stages should read
    the written tables, or the counters that ``plans.full_run`` observes while writing."""
    frames = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(i).alias("position"), F.lit(name).alias("stage"), "row_count")
        for i, (name, df) in enumerate(stages.items())
    ]
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame)
    return union


def panel_series(windows: DataFrame) -> DataFrame:
    """Dashboard series in long form: (timestamp, panel, series, value)."""
    present = [(p, c) for p, cols in SERIES.items() for c in cols if c in windows.columns]
    panel_of = F.element_at(
        F.create_map(*[F.lit(x) for p, c in present for x in (c, p)]), F.col("series")
    )
    wide = windows.select("timestamp", *[F.col(c).cast("double").alias(c) for _, c in present])
    return wide.unpivot("timestamp", [c for _, c in present], "series", "value").select(
        "timestamp", panel_of.alias("panel"), "series", "value"
    )


def recent_window(windows: DataFrame, hours: int = 24, as_of: str | None = None) -> DataFrame:
    """Rows of the last ``hours`` before ``as_of`` (by default the newest row)."""
    columns = [
        c for c in ("timestamp", "composite_signal", "avg_sentiment", "weighted_sentiment", "tweet_count")
        if c in windows.columns
    ]
    span = hours * 3_600_000_000
    at = micros(F.col("timestamp"))
    if as_of is not None:
        return windows.where(at >= micros(F.lit(as_of).cast("timestamp")) - span).select(*columns)
    return windows.where(at >= windows.agg(F.max(at)).scalar() - span).select(*columns)
