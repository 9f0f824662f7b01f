"""Raw feed: one JSON object per line, to flat posts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postpulse.schemas import RAW, TWEETS


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines of text to ``raw`` structs plus the original ``line``. Blank lines, lines that
    are not valid JSON and lines that are no object are skipped."""
    text = F.trim(F.col(column))
    valid = lines.where(F.startswith(text, F.lit("{")) & F.try_parse_json(text).isNotNull())
    # A later filter on a field would be moved below a projection, where it would parse each line once more.
    return valid.select(F.col(column).alias("line"), F.explode(F.array(F.from_json(text, RAW))).alias("raw"))


def ingest_jsonl(spark: SparkSession, path: str) -> DataFrame:
    return parse_lines(spark.read.text(path)).select("raw.*", "line")


def stream_jsonl(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return parse_lines(reader.text(path)).select("raw.*", "line")


def _text(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def _number(column: str) -> Column:
    return F.coalesce(F.col(column).try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))


def _list(column: str) -> Column:
    return F.coalesce(F.col(column), F.array().cast("array<string>"))


def flatten_tweets(raw: DataFrame) -> DataFrame:
    """Nested objects to the posts table, with defaults for what is missing or null."""
    flat = raw.select(
        _text("id").alias("tweet_id"),
        _text("user.username").alias("username"),
        _text("user.id").alias("user_id"),
        _text("content").alias("content"),
        F.try_to_timestamp("date").alias("timestamp"),
        _text("lang").alias("language"),
        _list("hashtags").alias("hashtags"),
        # An object's username, or the element itself where it is a plain name.
        F.transform(
            _list("mentionedUsers"),
            lambda m: F.when(F.startswith(m, F.lit("{")), F.get_json_object(m, "$.username")).otherwise(m),
        ).alias("mentions"),
        _list("urls").alias("urls"),
        _number("replyCount").alias("reply_count"),
        _number("retweetCount").alias("retweet_count"),
        _number("likeCount").alias("like_count"),
        _number("quoteCount").alias("quote_count"),
        _number("viewCount").alias("view_count"),
        _text("sourceLabel").alias("source"),
        F.coalesce(F.size("media"), F.lit(0)).cast("bigint").alias("media_count"),
        F.coalesce(F.col("possiblySensitive").try_cast("boolean"), F.lit(False)).alias("is_sensitive"),
        F.col("inReplyToTweetId").isNotNull().alias("is_reply"),
        F.current_timestamp().alias("collected_at"),
        F.col("line").alias("raw_data"),
    )
    return flat.select(*[F.col(f.name).cast(f.dataType) for f in TWEETS.fields])
