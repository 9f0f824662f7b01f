"""Explicit schemas of the raw feed and of the posts table."""

from __future__ import annotations

from pyspark.sql import types as T

# Counts and flags are read as text, so that "12" or 12.7 in the feed is coerced later
# instead of spoiling the line. Array elements stay JSON text: mentions come as objects
# or as plain names.
RAW = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField(
            "user",
            T.StructType([T.StructField("username", T.StringType()), T.StructField("id", T.StringType())]),
        ),
        T.StructField("content", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("hashtags", T.ArrayType(T.StringType())),
        T.StructField("mentionedUsers", T.ArrayType(T.StringType())),
        T.StructField("urls", T.ArrayType(T.StringType())),
        T.StructField("replyCount", T.StringType()),
        T.StructField("retweetCount", T.StringType()),
        T.StructField("likeCount", T.StringType()),
        T.StructField("quoteCount", T.StringType()),
        T.StructField("viewCount", T.StringType()),
        T.StructField("sourceLabel", T.StringType()),
        T.StructField("media", T.ArrayType(T.StringType())),
        T.StructField("possiblySensitive", T.StringType()),
        T.StructField("inReplyToTweetId", T.StringType()),
    ]
)

TWEETS = T.StructType(
    [
        T.StructField("tweet_id", T.StringType()),
        T.StructField("username", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("language", T.StringType()),
        T.StructField("hashtags", T.ArrayType(T.StringType())),
        T.StructField("mentions", T.ArrayType(T.StringType())),
        T.StructField("urls", T.ArrayType(T.StringType())),
        T.StructField("reply_count", T.LongType()),
        T.StructField("retweet_count", T.LongType()),
        T.StructField("like_count", T.LongType()),
        T.StructField("quote_count", T.LongType()),
        T.StructField("view_count", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("media_count", T.LongType()),
        T.StructField("is_sensitive", T.BooleanType()),
        T.StructField("is_reply", T.BooleanType()),
        T.StructField("collected_at", T.TimestampType()),
        T.StructField("raw_data", T.StringType()),
    ]
)

ENGAGEMENT = ("reply_count", "retweet_count", "like_count", "quote_count", "view_count")
COUNTS = ENGAGEMENT + ("media_count",)
