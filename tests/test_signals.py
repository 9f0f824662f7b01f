"""Scores, windows, intervals and the composite."""

from __future__ import annotations

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from postpulse.config import Settings, SignalConfig
from postpulse.operators import dedupe, engagement, signals

POSTS = (
    "tweet_id string, timestamp timestamp, content_clean string, sentiment_score long, like_count long, retweet_count long, "
    "reply_count long, exclamation_count long, question_count long, uppercase_ratio double, market_term_count long, "
    "hashtags array<string>"
)


def posts(spark, times, score=lambda i: i % 3 - 1, tags=lambda i: ["#Nifty50"]):
    rows = [
        (str(i), pd.Timestamp(t).to_pydatetime() if t else None, "rsi high" if i % 2 else "plain", score(i), i, 2 * i, 3,
         i % 2, i % 4, 0.5 if i % 5 == 0 else 0.1, i % 7, tags(i))
        for i, t in enumerate(times)
    ]
    return spark.createDataFrame(rows, POSTS)


def hourly(n):
    return [f"2024-01-01 00:05:00"] + [str(pd.Timestamp("2024-01-01 00:05:00") + pd.Timedelta(minutes=37 * i)) for i in range(1, n)]


def test_individual_signals(spark):
    df = signals.individual_signals(posts(spark, hourly(40), tags=lambda i: [["#SENSEX", None], None, []][i % 3]))
    rows = {int(r.tweet_id): r for r in df.collect()}
    assert all(r.sentiment_signal in (-1, 0, 1) and 0 <= r.time_decay <= 1 for r in rows.values())
    assert rows[2].weighted_sentiment == pytest.approx((2 + 8 + 9) / 100)
    assert rows[5].urgency_signal == pytest.approx(0.5 + 0.3 + 0.2)
    assert rows[6].market_focus_signal == pytest.approx(math.tanh(0.6))
    assert (rows[1].technical_mention_signal, rows[2].technical_mention_signal) == (1, 0)
    assert [rows[i].has_sensex_hashtag for i in range(3)] == [1, 0, 0]
    assert rows[39].time_decay == 1


def test_engagement_score_is_used_where_it_exists(spark):
    df = posts(spark, hourly(3)).withColumn("engagement_score", F.lit(0.25))
    out = signals.individual_signals(df)
    assert "engagement_proxy" not in out.columns
    assert {r.weighted_sentiment for r in out.collect()} == {-0.25, 0.0, 0.25}


@pytest.mark.parametrize("minutes", [60, 7, 1441])
def test_windows_match_pandas_resample(spark, minutes):
    times = ["2024-01-01 00:05:00", "2024-01-01 00:06:59", "2024-01-01 09:30:00", "2024-01-02 23:59:59", None]
    scored = signals.individual_signals(posts(spark, times))
    got = signals.aggregate_signals(scored, minutes).orderBy("timestamp").toPandas()
    local = scored.toPandas().dropna(subset=["timestamp"]).set_index("timestamp").sort_index()
    want = local.resample(f"{minutes}min")["sentiment_signal"].agg(["mean", "size"])
    assert list(got.timestamp) == list(want.index)
    assert list(got.tweet_count) == list(want["size"])
    assert got.sentiment_signal.astype(float).fillna(9).tolist() == pytest.approx(want["mean"].fillna(9).tolist())
    empty = got[got.tweet_count == 0]
    assert (empty.like_count == 0).all() and (empty.weighted_sentiment == 0).all() and empty.urgency_signal.isna().all()
    assert got.tweet_count.sum() == 4


def test_rows_of_one_bucket_and_one_row(spark):
    one = signals.generate_signals(posts(spark, ["2024-01-01 00:05:00"])).collect()
    assert len(one) == 1 and one[0].composite_signal is None and one[0].tweet_count == 1
    assert signals.generate_signals(posts(spark, ["2024-01-01 00:05:00"] * 5)).first().tweet_count == 5


def test_no_dated_posts_give_no_windows(spark):
    assert signals.generate_signals(posts(spark, [None, None])).count() == 0


def test_wilson_interval(spark):
    df = spark.createDataFrame(
        [(0, None), (10, 1.0), (10, -1.0), (50, 0.2), (4, 3.0)], "tweet_count long, sentiment_signal double"
    )
    rows = {(r.tweet_count, r.sentiment_signal): r for r in signals.confidence_intervals(df).collect()}
    empty = rows[(0, None)]
    assert (empty.sentiment_ci_lower, empty.sentiment_ci_upper, empty.sentiment_ci_width) == (0, 0, 0)
    for (n, mean), r in rows.items():
        if n and mean <= 1:
            assert -1 - 1e-9 <= r.sentiment_ci_lower <= mean + 1e-9 <= r.sentiment_ci_upper + 2e-9 <= 1 + 3e-9
    z = 1.959963984540054
    assert rows[(10, 1.0)].sentiment_ci_lower == pytest.approx(2 * (1 / (1 + z * z / 10)) - 1)


def test_composite(spark):
    out = signals.generate_signals(posts(spark, hourly(60))).toPandas()
    filled = out.dropna(subset=["composite_signal"])
    assert filled.composite_signal.between(-1, 1).all() and filled.composite_signal.std() > 0
    expected = 0
    for column, weight in signals.COMPOSITE_WEIGHTS.items():
        value = out[column].astype(float)
        expected = expected + weight * (value - value.mean()) / (value.std() + 1e-10)
    assert filled.composite_signal.tolist() == pytest.approx([math.tanh(v) for v in expected.dropna()])
    assert (filled.sentiment_ci_lower <= filled.avg_sentiment + 1e-9).all()


@pytest.mark.parametrize("scale", [1e-12, 1e-9, 1e-3, 1e6, 1e12, 1e15])
@pytest.mark.parametrize("timed", [True, False])
def test_z_scores_at_any_scale(spark, scale, timed):
    values = [1.0, 3.0, 2.0, 7.0, None, 7.0, 1.5]
    rows = [(pd.Timestamp("2024-01-01") + pd.Timedelta(hours=9 * i), None if v is None else v * scale) for i, v in enumerate(values)]
    df = spark.createDataFrame([(t.to_pydatetime(), v) for t, v in rows], "timestamp timestamp, value double").repartition(3)
    out = signals.zscore_components(df if timed else df.drop("timestamp"), ("value",)).collect()
    given = pd.Series([v * scale for v in values if v is not None])
    want = [(v - given.mean()) / (given.std() + 1e-10) for v in given]
    assert sorted(r.value_z for r in out if r.value_z is not None) == pytest.approx(sorted(want))
    assert [r.value_z for r in out if r.value is None] == [None]


def test_large_offsets_and_constants(spark):
    df = spark.createDataFrame([(1e9 + i, 5.0, 1.0 if i == 0 else None) for i in range(5)], "a double, b double, c double")
    out = signals.zscore_components(df, ("a", "b", "c")).sort("a").collect()
    assert [r.a_z for r in out] == pytest.approx([(i - 2) / math.sqrt(2.5) for i in range(5)])
    assert {r.b_z for r in out} == {0.0} and {r.c_z for r in out} == {None}


def test_states_merge_to_those_of_all_rows(spark):
    times = hourly(300)
    totals = signals.window_totals(signals.individual_signals(posts(spark, times), False))
    totals = totals.withColumn("timestamp", F.timestamp_micros("bucket")).drop("bucket").cache()
    first, last = totals.agg(F.min("timestamp"), F.max("timestamp")).first()
    every = int((last - first).total_seconds() // 3600) + 1
    merged = signals.merged_states(signals.day_states(totals), every).first()
    windows = signals.aggregate_signals(signals.individual_signals(posts(spark, times), False)).toPandas()
    for c in signals.COMPOSITE_WEIGHTS:
        values = windows[c].astype(float).dropna()
        assert merged[c].n == len(values) and merged[c].mean == pytest.approx(values.mean())
        assert math.sqrt(merged[c].m2 / (merged[c].n - 1)) == pytest.approx(values.std())


def test_windows_do_not_depend_on_the_order_of_rows(spark):
    times = [f"2024-01-01 0{i % 4}:15:00" for i in range(997)]
    df = signals.individual_signals(posts(spark, times), False).cache()
    runs = [
        sorted(map(tuple, signals.finish_windows(signals.aggregate_signals(df.repartition(n, F.xxhash64("tweet_id", F.lit(n))))).collect()))
        for n in (2, 7, 13)
    ]
    assert runs[0] == runs[1] == runs[2]
    huge = signals.window_totals(df.withColumn("weighted_sentiment", F.lit(1e30))).collect()
    assert all(r.weighted_sentiment == pytest.approx(1e30 * r.tweet_count) for r in huge)


def test_spine_of_buckets(spark):
    from postpulse.functions import timebuckets as tb

    df = spark.createDataFrame([(0,), (10 * tb.MINUTE * 9999,)], "bucket bigint")
    spine = tb.bucket_spine(df, 10)
    assert spine.count() == 10_000 and spine.agg(F.max("bucket")).first()[0] == 10 * tb.MINUTE * 9999
    assert spine.rdd.getNumPartitions() > 1 and "SinglePartition" not in spine._jdf.queryExecution().executedPlan().toString()
    assert tb.bucket_spine(df.limit(0), 10).count() == 0
    with pytest.raises(ValueError, match="stray"):
        tb.bucket_spine(spark.createDataFrame([(0,), (8000 * 365 * tb.DAY,)], "bucket bigint"), 10)


def test_normalize(spark):
    df = spark.createDataFrame(
        [(i, 10 * i, 5, 0, i - 2) for i in range(5)],
        "reply_count long, retweet_count long, like_count long, quote_count long, view_count long",
    )
    rows = engagement.normalize_data(df).orderBy("reply_count").collect()
    assert [r.reply_count_normalized for r in rows] == [0, 0.25, 0.5, 0.75, 1]
    assert all(r.like_count_normalized is None and r.quote_count_normalized is None for r in rows)
    assert all(r.engagement_score is None for r in rows)
    with pytest.raises(ValueError):
        engagement.normalize_data(df.select("reply_count", "like_count"))


def test_normalized_engagement_run(spark, data):
    from postpulse.checks.queries import cleaned

    settings = Settings(signals=SignalConfig(normalize_engagement=True))
    default = signals.generate_signals(cleaned(spark, data))
    scored = signals.generate_signals(cleaned(spark, data), settings)
    assert scored.count() == default.count()


def test_dedupe_with_a_hot_hash(spark):
    df = spark.range(0, 20000, 1, 16).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("content_hash"),
        F.timestamp_micros((F.lit(20000) - F.col("id")) * 1000).alias("timestamp"),
        F.col("id").cast("string").alias("tweet_id"),
    )
    out = dedupe.dedupe_by_hash(df)
    assert out.count() == 10001
    assert out.where("content_hash = 'hot'").first().tweet_id == "19998"
    assert tuple(dedupe.dedupe_report(df).first()) == (20000, 10001, 9999)
    # Copies are dropped in each task before the shuffle.
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.count("Exchange hashpartitioning") == 1


def test_window_totals_shuffle_once_and_combine_first(spark, data):
    from postpulse.checks.queries import posts as given_posts
    from postpulse.operators.cleaning import add_clean_text, add_features, fill_missing

    df = fill_missing(add_features(add_clean_text(given_posts(spark, data))))
    plan = signals.window_totals(signals.individual_signals(df, False))._jdf.queryExecution().executedPlan().toString()
    assert "partial_avg" in plan and plan.count("Exchange hashpartitioning(bucket") == 1


def test_windows_of_odd_widths_score_posts_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def score(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    rows = spark.range(100).selectExpr("timestamp_micros(id * 61000000) AS timestamp", *[f"CAST(id AS DOUBLE) AS {c}" for c in signals.MEANS + signals.SUMS])
    totals = signals.window_totals(rows.mapInPandas(score, rows.schema), 7)
    assert totals.agg(F.sum("tweet_count")).first()[0] == 100 and totals.agg(F.min("bucket")).first()[0] == 0
    before = seen.value
    assert before == 100
    # Widths that divide a day ask for no first post, and store nothing.
    assert signals.window_totals(rows, 60).count() == 2
