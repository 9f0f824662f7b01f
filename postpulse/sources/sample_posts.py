"""Posts made from given tables: an event gives time, author and counts, a document its text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postpulse.operators.frames import spread

# Opening sentence by event number modulo 8.
OPENINGS = (
    "Nifty looking BULLISH today! buy the rally",
    "Bearish signals on Sensex, sell?",
    "strong support and resistance near breakout",
    "profit or loss in this market?! trade carefully",
    "RSI and MACD pattern, volume up",
    "portfolio investment down, crash fears",
    "Nothing to report",
    "STOCK GAIN POSITIVE RISE",
)
# Hashtags by event number modulo 6; NULL where missing.
TAGS = ("#Nifty50,#Stocks", "#Sensex", "#BankNifty,#Intraday", None, "#Market", "#Market")


def make_tweets(events: DataFrame, documents: DataFrame) -> DataFrame:
    """One post per event. The document that shares the event's number, if any, is appended
    in full, so that every document is part of exactly one post. Of the other posts, some are blank."""
    n = F.col("event_id")

    def pick(values: tuple, modulus: int) -> Column:
        chosen = F.lit(None).cast("string")
        for i, value in enumerate(values):
            chosen = F.when(n % modulus == i, F.lit(value)).otherwise(chosen)
        return chosen

    def part(condition: Column, text: Column | str) -> Column:
        return F.when(condition, text if isinstance(text, Column) else F.lit(text)).otherwise("")

    number = n.cast("string")
    content = F.concat(
        pick(OPENINGS, 8),
        part(n % 4 == 0, F.concat(F.lit(" https://ex.co/p"), number)),
        part(n % 8 == 1, " @desk #Nifty50"),
        part(n % 20 == 7, " नमस्ते दुनिया"),
        part(n % 25 == 3, " 😀"),
        part(n % 40 == 11, " cafÃ© &amp; “bar”"),
        part(n % 50 == 21, " cafe\u0301 ﬁrst"),
        part(n % 2 == 0, F.concat(F.lit(" t"), number)),
        F.lit(" "),
        F.coalesce("text", F.lit("")),
    )
    return events.join(documents.select("doc_id", "text", "lang"), n == F.col("doc_id"), "left").select(
        number.alias("tweet_id"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("username"),
        F.when((n % 50 != 0) | F.col("text").isNotNull(), content).alias("content"),
        F.col("ts").alias("timestamp"),
        F.coalesce("lang", F.lit("en")).alias("language"),
        F.split(pick(TAGS, 6), ",").alias("hashtags"),
        (n % 20).alias("reply_count"),
        (n * 3 % 50).alias("retweet_count"),
        (n * 7 % 100).alias("like_count"),
        (n % 5).alias("quote_count"),
        (n * 13 % 9900 + 100).alias("view_count"),
    )


def read_tweets(spark: SparkSession, folder: str) -> DataFrame:
    return make_tweets(
        spread(spark.read.parquet(f"{folder}/events.parquet")), spark.read.parquet(f"{folder}/documents.parquet")
    )


def raw_lines(tweets: DataFrame, *kept: Column) -> DataFrame:
    """The posts as lines of the raw feed, one JSON object each, in a column ``value`` after those ``kept``."""
    return tweets.select(
        *kept,
        F.to_json(
            F.struct(
                F.col("tweet_id").cast("bigint").alias("id"),
                F.struct(
                    F.col("username"), F.regexp_extract("username", r"(\d+)$", 1).cast("bigint").alias("id")
                ).alias("user"),
                "content",
                F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("date"),
                F.col("language").alias("lang"),
                "hashtags",
                F.array(F.struct(F.lit("desk").alias("username"))).alias("mentionedUsers"),
                F.col("reply_count").alias("replyCount"),
                F.col("retweet_count").alias("retweetCount"),
                F.col("like_count").alias("likeCount"),
                F.col("quote_count").alias("quoteCount"),
                F.col("view_count").alias("viewCount"),
            )
        ).alias("value")
    )


def request_log(events: DataFrame) -> DataFrame:
    """Events read as a request log: errors are failures, the value is the response time."""
    return events.select(
        F.col("event_id").alias("request_id"),
        F.col("user_id").alias("client"),
        "ts",
        (F.col("event_type") != "error").alias("ok"),
        F.col("value").alias("response_time"),
    )
