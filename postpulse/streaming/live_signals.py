"""Window signals from a stream of raw posts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postpulse.config import Settings
from postpulse.functions.timebuckets import MINUTE, origin_of
from postpulse.operators import cleaning, signals
from postpulse.sinks import signal_store
from postpulse.sources.jsonl import flatten_tweets


def windowed_stream(posts: DataFrame, settings: Settings = Settings(), delay: str = "2 hours", first_day: str = "1970-01-01") -> DataFrame:
    """Totals per window of a (streaming) posts table. Windows whose width does not divide a day count from midnight of ``first_day``, which is the
    first day of the posts in a batch.

    Repeated deliveries of a post are dropped by id. Content duplicates need all of history
    and stay with the batch run. Scores depend on their own row only, so they come first: what
    the removal of repeats shuffles is then a few numbers of each post instead of its text.
    """
    width = f"{settings.signals.window_minutes} minutes"
    shift = origin_of(first_day, settings.signals.window_minutes) % (settings.signals.window_minutes * MINUTE)
    timed = posts.where(F.col("timestamp").isNotNull())
    scored = signals.individual_signals(cleaning.featurise(timed, settings), time_decay=False)
    fresh = (
        scored.select("tweet_id", "timestamp", *signals.MEANS, *signals.SUMS)
        .withWatermark("timestamp", delay)
        .dropDuplicatesWithinWatermark(["tweet_id"])
    )
    totals = fresh.groupBy(F.window("timestamp", width, startTime=f"{shift} microseconds").alias("w")).agg(*signals.total_columns(fresh))
    return totals.select(F.col("w.start").alias("timestamp"), *[c for c in totals.columns if c != "w"])


def start_stream_signals(
    raw: DataFrame, output: str, checkpoint: str, settings: Settings = Settings(), delay: str = "2 hours", first_day: str = "1970-01-01"
) -> StreamingQuery:
    """Append closed windows to a Parquet table; stops when the input present now is read."""
    return (
        windowed_stream(flatten_tweets(raw), settings, delay, first_day)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_stream_composite(
    raw: DataFrame, base: str, checkpoint: str, settings: Settings = Settings(), delay: str = "2 hours", name: str = "stream",
    first_day: str = "1970-01-01",
) -> StreamingQuery:
    """Keep published signals beside the stream; ``signal_store.read_signals`` gives the finished windows.

    Each micro-batch adds its closed windows to their days and publishes these days as a new version, with the number of the batch. A batch
    that was published before a crash is not published again, and one that was not is written anew.
    """

    origin = origin_of(first_day, settings.signals.window_minutes)

    def merge(batch: DataFrame, batch_id: int) -> None:
        signal_store.add_windows(batch.sparkSession, base, batch, settings, writer=name, batch_id=batch_id, origin=origin)

    return (
        windowed_stream(flatten_tweets(raw), settings, delay, first_day)
        .writeStream.outputMode("append")
        .foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
