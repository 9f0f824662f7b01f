"""Signals per post and per time window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postpulse.config import Settings, SignalConfig
from postpulse.functions import scores
from postpulse.functions.timebuckets import bucket_spine, from_micros, micros, whole_days, with_bucket
from postpulse.operators import moments
from postpulse.operators.engagement import normalize_data
from postpulse.operators.frames import with_totals
from postpulse.session import cut_lineage

MEANS = ("sentiment_signal", "urgency_signal", "market_focus_signal")
SUMS = (
    "weighted_sentiment", "technical_mention_signal", "has_nifty_hashtag", "has_sensex_hashtag",
    "like_count", "retweet_count", "reply_count",
)
# Weight of each standardised component.
COMPOSITE_WEIGHTS = {
    "avg_sentiment": 0.4,
    "sentiment_volume": 0.2,
    "urgency_signal": 0.1,
    "technical_mention_signal": 0.1,
    "engagement_total": 0.1,
    "market_focus_signal": 0.1,
}


def individual_signals(posts: DataFrame, time_decay: bool = True) -> DataFrame:
    """Signals of each cleaned post. ``engagement_score`` weighs sentiment where the column
    exists, else the proxy from raw counts does."""
    signal = scores.sentiment_signal(F.col("sentiment_score"))
    proxy = scores.engagement_proxy(F.col("like_count"), F.col("retweet_count"), F.col("reply_count"))
    added = {"sentiment_signal": signal}
    if "engagement_score" in posts.columns:
        added["weighted_sentiment"] = signal * F.col("engagement_score")
    else:
        added |= {"engagement_proxy": proxy, "weighted_sentiment": signal * proxy}
    added |= {
        "urgency_signal": scores.urgency_signal(
            F.col("exclamation_count"), F.col("question_count"), F.col("uppercase_ratio")
        ),
        "market_focus_signal": scores.market_focus_signal(F.col("market_term_count")),
        "technical_mention_signal": scores.technical_mention_signal(F.col("content_clean")),
        "has_nifty_hashtag": scores.hashtag_flag(F.col("hashtags"), "nifty"),
        "has_sensex_hashtag": scores.hashtag_flag(F.col("hashtags"), "sensex"),
    }
    scored = posts.withColumns(added)
    return add_time_decay(scored) if time_decay else scored


def add_time_decay(posts: DataFrame) -> DataFrame:
    """1 at the newest post, falling to 0 a day earlier."""
    age_days = (F.col("_newest") - micros(F.col("timestamp"))) / F.lit(86_400e6)
    return (
        with_totals(posts, F.max(micros(F.col("timestamp"))).alias("_newest"))
        .withColumn(
            "time_decay",
            F.when(F.col("timestamp").isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - age_days))),
        )
        .drop("_newest")
    )


def _is_whole(kind: str) -> bool:
    return kind in ("tinyint", "smallint", "int", "bigint")


def _ordered_sum(value: Column) -> Column:
    """A sum that does not depend on the order of rows: in decimals, as long as all values fit."""
    exact = value.try_cast("decimal(28,12)")
    fits = F.count_if(value.isNotNull() & exact.isNull()) == 0
    return F.coalesce(F.when(fits, F.try_sum(exact)).cast("double"), F.sum(value))


def _ordered_mean(value: Column) -> Column:
    """A mean that does not depend on the order of rows, as ``_ordered_sum``."""
    exact = value.try_cast("decimal(28,14)")
    fits = F.count_if(value.isNotNull() & exact.isNull()) == 0
    return F.coalesce(F.when(fits, F.try_avg(exact)).cast("double"), F.avg(value))


def total_columns(signals: DataFrame) -> list[Column]:
    """Means, sums and row count of a window, the same in every run over the same posts."""
    kinds = dict(signals.dtypes)
    means = [(F.avg(c) if _is_whole(kinds[c]) else _ordered_mean(F.col(c))).alias(c) for c in MEANS]
    sums = [(F.sum(c) if _is_whole(kinds[c]) else _ordered_sum(F.col(c))).alias(c) for c in SUMS]
    return [*means, *sums, F.count("*").alias("tweet_count")]


def window_totals(signals: DataFrame, window_minutes: int = 60, origin: int | None = None) -> DataFrame:
    """Means, sums and row count of every bucket that has posts, keyed by ``bucket``.

    Where the first post must be known before any bucket is, the numbers that are summed are stored, so that posts are scored once.
    """
    if origin is None and not whole_days(window_minutes):
        signals = cut_lineage(signals.select("timestamp", *MEANS, *SUMS).where(F.col("timestamp").isNotNull()))
    return with_bucket(signals, window_minutes, origin=origin).groupBy("bucket").agg(*total_columns(signals))


def gap_fill_windows(windows: DataFrame, window_minutes: int = 60) -> DataFrame:
    """Add the empty buckets in between: sums and counts 0, means NULL."""
    spine = bucket_spine(windows, window_minutes)
    filled = spine.join(windows, "bucket", "left")
    return filled.withColumns(
        {
            c: F.coalesce(F.col(c), F.lit(0).cast(kind))
            for c, kind in windows.dtypes
            if c in SUMS or c == "tweet_count"
        }
    )


def derived_window_metrics(windows: DataFrame) -> DataFrame:
    strength = F.abs(F.col("sentiment_signal"))
    return windows.withColumns(
        {
            "sentiment_strength": strength,
            "engagement_total": F.col("like_count") + F.col("retweet_count") + F.col("reply_count"),
            "avg_sentiment": F.col("sentiment_signal"),
            "sentiment_volume": strength * F.col("tweet_count"),
        }
    )


def aggregate_signals(signals: DataFrame, window_minutes: int = 60) -> DataFrame:
    """Gap-free window table.

    The bucket totals are as many rows as there are windows between the first and the last
    post. They are materialised, because the range of the gaps and the statistics of the
    composite both read them again, and would repeat the scan of all posts.
    """
    totals = cut_lineage(window_totals(signals, window_minutes))
    kind = dict(signals.dtypes)["timestamp"]
    windows = derived_window_metrics(gap_fill_windows(totals, window_minutes))
    rest = [c for c in windows.columns if c != "bucket"]
    return windows.select(from_micros(F.col("bucket"), kind).alias("timestamp"), *rest)


def confidence_intervals(windows: DataFrame, confidence: float = 0.95) -> DataFrame:
    lower, upper = scores.wilson_bounds(F.col("sentiment_signal"), F.col("tweet_count"), confidence)
    return windows.withColumns({"sentiment_ci_lower": lower, "sentiment_ci_upper": upper}).withColumn(
        "sentiment_ci_width", F.col("sentiment_ci_upper") - F.col("sentiment_ci_lower")
    )


def standardise(windows: DataFrame, stats: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Add ``<column>_z`` by the states in the one row of ``stats``."""
    known = F.struct(*columns).alias("stats")
    scaled = {
        f"{c}_z": (F.col(c) - F.col(f"_stats.{c}.mean")) / (moments.deviation(F.col(f"_stats.{c}")) + F.lit(1e-10)) for c in columns
    }
    return windows.withColumn("_stats", stats.select(known).scalar()).withColumns(scaled).drop("_stats")


def zscore_components(windows: DataFrame, columns: tuple[str, ...] = tuple(COMPOSITE_WEIGHTS)) -> DataFrame:
    """Add ``<column>_z``: distance from the mean over windows in sample standard deviations."""
    return standardise(windows, moments.moments(windows, columns), columns)


def composite_signal(windows: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Weighted sum of standardised components, bounded by tanh; NULL for an empty window. ``stats`` holds the states of the
    components where they are known already."""
    present = {c: w for c, w in COMPOSITE_WEIGHTS.items() if c in windows.columns}
    terms = [F.col(f"{c}_z") * w for c, w in present.items()]
    scaled = zscore_components(windows, tuple(present)) if stats is None else standardise(windows, stats, tuple(present))
    return scaled.withColumn("composite_signal", F.tanh(sum(terms[1:], terms[0]))).drop(*[f"{c}_z" for c in present])


def day_states(totals: DataFrame) -> DataFrame:
    """``date``, ``windows`` and the states of the composite's components over the windows of each day that have posts.

    Days merge to the states of the whole table with ``merged_states``, so a run that renews some days
    needs only the states of the others.
    """
    columns = tuple(COMPOSITE_WEIGHTS)
    dated = derived_window_metrics(totals).withColumn("date", F.to_date("timestamp"))
    states = moments.group_states(dated, columns, F.col("date"), [F.col("timestamp")], "date")
    # A window with posts has an engagement total, so its state counts the windows.
    return states.withColumn("windows", F.col("engagement_total.n"))


def merged_states(days: DataFrame, all_windows: int) -> DataFrame:
    """One row with the states over ``all_windows`` windows: those of ``days``, and empty ones, whose sums are 0 and whose means are NULL."""
    columns = tuple(COMPOSITE_WEIGHTS)
    whole = moments.merged(days.drop("windows"), columns, "date")
    gaps = F.lit(all_windows) - F.col("engagement_total.n")
    zeros = moments.state(gaps, F.lit(0.0), F.lit(0.0))
    filled = {c: moments.merge(F.col(c), zeros) for c in ("technical_mention_signal", "engagement_total")}
    return whole.select(*[filled.get(c, F.col(c)).alias(c) for c in columns])


def finish_windows(windows: DataFrame, cfg: SignalConfig = SignalConfig(), stats: DataFrame | None = None) -> DataFrame:
    return composite_signal(confidence_intervals(windows, cfg.confidence), stats)


def generate_signals(cleaned: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Cleaned posts to the finished window table."""
    cfg = settings.signals
    posts = normalize_data(cleaned) if cfg.normalize_engagement else cleaned
    signals = individual_signals(posts, time_decay=False)
    return finish_windows(aggregate_signals(signals, cfg.window_minutes), cfg)
