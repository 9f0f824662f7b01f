"""Samples, global order and report tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from postpulse.config import SamplingConfig
from postpulse.operators import reports, sampling
from postpulse.operators.frames import spread, with_ordinal


def series(spark, n, parts=5, same_time=False):
    at = F.lit(0) if same_time else (F.col("id") * 7919 % 100_003) * 60_000_000
    return spark.range(0, n, 1, parts).select(
        F.timestamp_micros(at.cast("bigint")).alias("timestamp"), F.format_string("p%06d", "id").alias("tweet_id"),
        F.col("id").alias("value"),
    )


@pytest.mark.parametrize("same_time", [False, True])
def test_ordinals_are_the_global_order(spark, same_time):
    df = series(spark, 5000, same_time=same_time)
    got = with_ordinal(df, [F.col("timestamp"), F.col("tweet_id")]).toPandas().sort_values("ordinal")
    want = df.toPandas().sort_values(["timestamp", "tweet_id"])
    assert got.ordinal.tolist() == list(range(5000))
    assert got.tweet_id.tolist() == want.tweet_id.tolist()
    assert set(got.total_rows) == {5000}


@pytest.mark.parametrize("n, k", [(100, 100), (101, 100), (1057, 100), (99, 100), (0, 10)])
def test_systematic(spark, n, k):
    df = series(spark, n)
    got = sorted(r.tweet_id for r in sampling.sample_systematic(df, k).collect())
    local = df.toPandas().sort_values(["timestamp", "tweet_id"])
    want = local if n <= k else local.iloc[list(range(0, n, n // k))[:k]]
    assert got == sorted(want.tweet_id)


def test_random_samples(spark):
    df = series(spark, 1000)
    first, again = (sampling.sample_random(df, 50).toPandas() for _ in range(2))
    assert first.equals(again) and first.timestamp.is_monotonic_increasing and first.tweet_id.nunique() == 50
    other = sampling.sample_reservoir(df, 50).toPandas()
    assert set(other.tweet_id) != set(first.tweet_id) and len(other) == 50
    assert sampling.sample_random(df, 2000).count() == 1000


def test_sample_data_by_method(spark):
    df = series(spark, 300)
    assert sampling.sample_data(df, SamplingConfig(max_points=300)).count() == 300
    for method in ("systematic", "random", "reservoir", "something else"):
        assert sampling.sample_data(df, SamplingConfig(max_points=20, method=method)).count() == 20
    means = sampling.sample_data(df, SamplingConfig(max_points=20, method="time_based"))
    assert means.columns == ["timestamp", "value"]
    with pytest.raises(ValueError):
        sampling.downsample_time(df.drop("timestamp"))


def test_downsample_matches_pandas(spark):
    df = series(spark, 200)
    got = sampling.downsample_time(df).orderBy("timestamp").toPandas()
    want = df.toPandas().set_index("timestamp")[["value"]].resample("5min").mean()
    assert got.timestamp.tolist() == want.index.tolist()
    assert got.value.astype(float).fillna(-1).tolist() == pytest.approx(want.value.fillna(-1).tolist())


@pytest.mark.parametrize("rows, minutes", [(1000, 5), (1001, 10), (2001, 15), (5001, 30), (10_000, 30), (10_001, 60)])
def test_adaptive_width(rows, minutes):
    assert sampling.adaptive_minutes(rows) == minutes


def test_heatmap_has_every_day_and_hour(spark):
    df = spark.sql(
        "SELECT timestamp'2024-01-01 03:10:00' AS timestamp, 1.0D AS composite_signal "
        "UNION ALL SELECT timestamp'2024-01-08 03:50:00', 2.0D UNION ALL SELECT timestamp'2024-01-07 23:00:00', 5.0D"
    )
    rows = reports.signals_by_hour_day(df).collect()
    assert [r.day for r in rows] == list(reports.DAY_NAMES)
    assert len(rows[0]) == 26 and rows[0].h03 == 1.5 and rows[6].h23 == 5.0 and rows[2].h00 is None


def test_histogram(spark):
    df = series(spark, 1000).withColumn("composite_signal", F.col("value").cast("double"))
    rows = reports.signal_histogram(df).orderBy("bin").collect()
    assert len(rows) == 50 and sum(r.n for r in rows) == 1000 and rows[-1].n == 20
    constant = reports.signal_histogram(df.withColumn("composite_signal", F.lit(1.0))).orderBy("bin").collect()
    assert constant[0].n == 1000


def test_summary_matches_pandas(spark):
    df = series(spark, 37).withColumn("composite_signal", F.sin("value"))
    row, local = reports.signal_summary(df).first(), df.toPandas().composite_signal
    assert row.q25 == pytest.approx(local.quantile(0.25)) and row["median"] == pytest.approx(local.median())
    assert row["std"] == pytest.approx(local.std()) and row.signal_windows == 37
    assert row.positive_signal_percentage == pytest.approx((local > 0).mean() * 100)


def test_hashtags_and_recent_rows(spark):
    df = spark.createDataFrame([(["#A", "#b"],), (["a"],), (None,)], "hashtags array<string>")
    assert [tuple(r) for r in reports.hashtag_distribution(df).collect()] == [("a", 2), ("b", 1)]
    windows = spark.range(100).select(
        F.timestamp_micros(F.col("id") * 3_600_000_000).alias("timestamp"), F.col("id").alias("tweet_count")
    )
    assert reports.recent_window(windows, 24).count() == 25
    assert reports.recent_window(windows, 2, as_of="1970-01-04 00:00:00").count() == 30


def test_stage_counts(spark):
    rows = reports.stage_counts(raw=spark.range(5), clean=spark.range(3)).orderBy("position").collect()
    assert [(r.stage, r.row_count) for r in rows] == [("raw", 5), ("clean", 3)]


def test_spread_leaves_wide_scans_alone(spark):
    assert spread(spark.range(0, 10, 1, 1)).rdd.getNumPartitions() == 4
    wide = spark.range(0, 10, 1, 16)
    assert spread(wide) is wide
