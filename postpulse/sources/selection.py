"""Which posts of a stored corpus a collection run takes: by source, since a day, up to caps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postpulse.config import SelectionConfig
from postpulse.functions.timebuckets import micros
from postpulse.session import cut_lineage
from postpulse.sources.tables import has_any_hashtag

# Widths in microseconds by which the time of a source's last post within its cap is narrowed down.
STEPS = (3_600_000_000, 1_000_000, 1)
# Stands for a missing time: older than any other.
NEVER = -(1 << 63)


def since_day(as_of: str, hours: int) -> Column:
    """First day of the look-back; the range starts at its midnight."""
    return F.to_date(F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(hours=F.lit(hours))).cast("timestamp_ntz")


def select_hashtag(posts: DataFrame, hashtag: str, as_of: str, hours: int = 24) -> DataFrame:
    return posts.where(has_any_hashtag(F.col("hashtags"), [hashtag]) & (F.col("timestamp") >= since_day(as_of, hours)))


def matches_term(term: str) -> Column:
    return F.contains(F.lower("content"), F.lit(term.lower())) & (F.col("language") == "en")


def select_term(posts: DataFrame, term: str, as_of: str, hours: int = 24) -> DataFrame:
    return posts.where(matches_term(term) & (F.col("timestamp") >= since_day(as_of, hours)))


def language_filter(posts: DataFrame, languages: tuple[str, ...] = ("en", "hi")) -> DataFrame:
    return posts.where(F.col("language").isin(*languages))


def union_sources(posts: DataFrame, cfg: SelectionConfig, as_of: str, hours: int) -> DataFrame:
    """One row per post and matching source, in one scan. Hashtags are numbered before terms.
    A post that several sources return stays several rows."""
    sources = [(f"hashtag:{h.lower().lstrip('#')}", has_any_hashtag(F.col("hashtags"), [h])) for h in cfg.hashtags]
    sources += [(f"term:{t.lower()}", matches_term(t)) for t in cfg.search_terms]
    labels = [
        F.when(F.coalesce(found, F.lit(False)), F.struct(F.lit(i).alias("source_no"), F.lit(name).alias("source")))
        for i, (name, found) in enumerate(sources)
    ]
    return (
        posts.where(F.col("timestamp") >= since_day(as_of, hours))
        .withColumn("_source", F.explode(F.array_compact(F.array(*labels))))
        .select("*", "_source.source_no", F.col("_source.source").alias("matched_source"))
        .drop("_source")
    )


def newest_first() -> list[Column]:
    return [F.desc("timestamp"), F.asc("tweet_id")]


def source_cap(cfg: SelectionConfig) -> Column:
    return F.when(
        F.startswith(F.col("matched_source"), F.lit("hashtag:")), F.lit(cfg.max_tweets_per_hashtag)
    ).otherwise(F.lit(cfg.max_tweets_per_hashtag // 2))


def cap_edges(keys: DataFrame) -> DataFrame:
    """``matched_source``, ``edge`` and ``left`` of each source with more posts than its cap: the time of the last post within it, and how many
    of those at this very time still are.

    ``keys`` holds the source, time (``at``) and cap of each post. Posts are counted by hour, and inside the hour in which a source
    reaches its cap by second, and so on: tasks count before they send, and no post is ranked against another.
    """
    rest, edges = keys.withColumn("left", F.col("cap").cast("bigint")), None
    for width in STEPS:
        step = F.floor(F.col("at") / width) if width > 1 else F.col("at")
        rest = rest.withColumn("step", step.cast("bigint"))
        counts = rest.groupBy("matched_source", "step").agg(F.count("*").alias("n"), F.max("left").alias("left"))
        newer = Window.partitionBy("matched_source").orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, -1)
        placed = counts.withColumn("before", F.coalesce(F.sum("n").over(newer), F.lit(0)))
        # Where the cap is met exactly, the next older step would still be within it by nothing.
        inside = (F.col("before") < F.col("left")) & (F.col("before") + F.col("n") >= F.col("left"))
        edges = placed.where(inside).select("matched_source", F.col("step").alias("edge"), (F.col("left") - F.col("before")).alias("left"))
        # One row for each source.
        rest = rest.drop("left").join(F.broadcast(edges.withColumnRenamed("edge", "step")), ["matched_source", "step"])
    return edges


def cap_per_source(matched: DataFrame, cfg: SelectionConfig) -> DataFrame:
    """The newest posts of each source, up to its cap; of posts of one time those with the smallest ids.

    Sources, times and ids are stored first. They give the time at which each source reaches its cap, whatever the cap, and the ids that are within it at this
    time. Posts newer than that stay where they are; only those of this very time are ranked.
    """
    at = F.coalesce(micros(F.col("timestamp")), F.lit(NEVER))
    keys = cut_lineage(matched.select("matched_source", at.alias("at"), "tweet_id", source_cap(cfg).alias("cap")))
    edges = cut_lineage(cap_edges(keys))
    few = F.broadcast(edges)
    by_id = Window.partitionBy("matched_source").orderBy("tweet_id")
    last = keys.join(few, "matched_source").where(F.col("at") == F.col("edge")).withColumn("_n", F.row_number().over(by_id))
    # How many posts of each id are taken at the edge: more than one only of repeated rows.
    taken = last.where(F.col("_n") <= F.col("left")).groupBy("matched_source", "tweet_id").agg(F.count("*").alias("_times"))
    timed = matched.withColumn("_at", at).join(few.withColumnRenamed("matched_source", "_source"), F.col("matched_source") == F.col("_source"), "left")
    newer = timed.where(F.col("edge").isNull() | (F.col("_at") > F.col("edge"))).where(source_cap(cfg) > 0)
    repeats = Window.partitionBy("matched_source", "tweet_id").orderBy("_at")
    chosen = taken.select(F.col("matched_source").alias("_s"), F.col("tweet_id").alias("_t"), "_times")
    same = F.col("matched_source").eqNullSafe(F.col("_s")) & F.col("tweet_id").eqNullSafe(F.col("_t"))
    at_edge = timed.where(F.col("_at") == F.col("edge")).join(chosen, same).withColumn("_n", F.row_number().over(repeats))
    return newer.select(*matched.columns).unionByName(at_edge.where(F.col("_n") <= F.col("_times")).select(*matched.columns))


def stop_at_target(capped: DataFrame, min_tweets: int) -> DataFrame:
    """Whole sources in order, until enough posts are collected."""
    counts = capped.groupBy("source_no").agg(F.count("*").alias("n"))
    # One row per configured source.
    before = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
    taken = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).where(F.col("before") < min_tweets)
    return capped.join(F.broadcast(taken.select("source_no")), "source_no", "left_semi")


def collect_posts(
    posts: DataFrame, as_of: str, hours: int | None = None, cfg: SelectionConfig = SelectionConfig()
) -> DataFrame:
    """A collection run over a stored corpus."""
    capped = cap_per_source(union_sources(posts, cfg, as_of, cfg.time_window_hours if hours is None else hours), cfg)
    # Bounded by the caps, and read twice: for the counts and for the rows.
    return stop_at_target(cut_lineage(capped), cfg.min_tweets_target).drop("source_no")
