"""Sinks: what is written, where, and what is left alone."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from postpulse.config import StorageConfig
from postpulse.sinks import retention, signal_store, storage
from postpulse.sources import tables

COLUMNS = "tweet_id string, timestamp timestamp, engagement_score double"


@pytest.fixture()
def posts(spark):
    return spark.range(200).select(
        F.col("id").cast("string").alias("tweet_id"),
        F.timestamp_micros(F.lit(1704067200000000) + F.col("id") * 1_800_000_000).alias("timestamp"),
        (F.col("id") / 200).alias("engagement_score"),
        (F.col("id") % 3).alias("group"),
    )


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def files(path):
    return [p for p in Path(path).rglob("*.parquet")]


def test_save_tweets_round_trip(spark, posts, tmp_path):
    path = str(tmp_path / "tweets")
    assert storage.save_tweets(posts, path)
    back = spark.read.parquet(path)
    assert rows(back.select(posts.columns)) == rows(posts)
    assert (Path(path) / "date=2024-01-02" / "hour=5").is_dir()
    assert len(files(path)) == 100
    assert all(".snappy" in f.name for f in files(path))
    assert not storage.save_tweets(posts.limit(0), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def test_unpartitioned_posts(spark, posts, tmp_path):
    storage.save_tweets(posts, str(tmp_path / "flat"), StorageConfig(partitioning_enabled=False))
    assert not list((tmp_path / "flat").glob("date=*"))


def test_reads_prune_partitions_and_push_filters(spark, posts, tmp_path):
    path = str(tmp_path / "tweets")
    storage.save_tweets(posts, path)
    stored = tables.scan_parquet(spark, path)
    found = tables.query_data(stored, "2024-01-02 06:00:00", "2024-01-02 09:00:00", min_engagement=0.1)
    plan = found.select("tweet_id")._jdf.queryExecution().executedPlan().toString()
    pruned = plan.split("PartitionFilters: [")[1].split("]")[0]
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "date" in pruned and "GreaterThanOrEqual(timestamp," in pushed and "IsNotNull(engagement_score)" in pushed
    assert "group" not in plan.split("ReadSchema:")[1]
    assert found.count() == 7
    with pytest.raises(AnalysisException):
        tables.scan_parquet(spark, str(tmp_path / "missing"))


def test_save_modes(spark, posts, tmp_path):
    base = str(tmp_path)
    storage.save_table(posts, base, "t", "error", [])
    with pytest.raises(AnalysisException):
        storage.save_table(posts, base, "t", "error", [])
    storage.save_table(posts, base, "t", "append", [])
    assert spark.read.parquet(f"{base}/t").count() == 400
    storage.save_table(posts.limit(5), base, "t", "overwrite", [])
    assert spark.read.parquet(f"{base}/t").count() == 5
    assert storage.save_table(posts.limit(0), base, "u") == ""


def test_overwrite_replaces_only_its_partitions(spark, posts, tmp_path):
    path = storage.save_table(posts, str(tmp_path), "t", "overwrite", ["group", "absent"])
    storage.save_table(posts.where("group = 1").limit(2), str(tmp_path), "t", "overwrite", ["group"])
    counts = {r["group"]: r["count"] for r in spark.read.parquet(path).groupBy("group").count().collect()}
    assert counts == {0: 67, 1: 2, 2: 66}


def test_partition_columns_by_cardinality(spark):
    n = F.col("id")
    df = spark.range(5000).select(
        F.lit(1).alias("one"), (n % 2).alias("two"), (n % 99).alias("n99"), (n % 100).alias("n100"), n.alias("many"),
        F.when(n % 2 == 0, n % 4).alias("with_null"), F.lit(None).cast("int").alias("none"),
    )
    names = ["one", "two", "n99", "n100", "many", "with_null", "none", "absent"]
    assert storage.pick_partition_cols(df, names) == ["two", "n99", "with_null"]
    report = {r["column"]: r.distinct_count for r in storage.partition_col_report(df, names).collect()}
    assert report == {"one": 1, "two": 2, "n99": 99, "n100": 100, "many": 5000, "with_null": 2, "none": 0}
    assert storage.pick_partition_cols(df, ["absent"]) == []
    assert storage.pick_partition_cols(df, ["many"]) == []


def test_append_leaves_old_files(spark, posts, tmp_path):
    path = str(tmp_path / "t")
    storage.append_single(posts, path)
    before = {f.name: f.stat().st_mtime_ns for f in files(path)}
    storage.append_single(posts, path)
    after = {f.name: f.stat().st_mtime_ns for f in files(path)}
    assert before.items() < after.items() and spark.read.parquet(path).count() == 400


def test_compaction(spark, posts, tmp_path):
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    posts.repartition(20).write.parquet(source)
    storage.compact_dataset(spark, source, target)
    assert len(files(target)) < 20 and rows(spark.read.parquet(target)) == rows(posts)
    small = str(tmp_path / "c")
    storage.compact_dataset(spark, source, small, rows_per_file=30, partition_cols=["group"])
    assert {p.name for p in Path(small).glob("group=*")} == {"group=0", "group=1", "group=2"}
    assert all(spark.read.parquet(str(f)).count() <= 30 for f in files(small))


def test_retention(spark, posts):
    dated = storage.with_date_hour(posts)
    kept = storage.retention_filter(dated, "2024-01-04 12:00:00", 2)
    assert {str(r.date) for r in kept.select("date").distinct().collect()} == {"2024-01-02", "2024-01-03", "2024-01-04", "2024-01-05"}
    gone = storage.expired_dates(dated, "2024-01-04 12:00:00", 2)
    assert [(str(r.date), r.row_count) for r in gone.collect()] == [("2024-01-01", 48)]


def test_runs_are_kept_apart_and_repeatable(spark, posts, tmp_path):
    path = str(tmp_path / "runs")
    for run, n in (("a", 5), ("b", 3), ("a", 4)):
        storage.write_run(posts.limit(n), path, run)
    counts = {r.run_id: r["count"] for r in spark.read.parquet(path).groupBy("run_id").count().collect()}
    assert counts == {"a": 4, "b": 3}


def test_summary_json(spark, tmp_path):
    storage.write_summary_json(spark.sql("select 3 as n, 0.5D as share"), str(tmp_path / "s"))
    lines = [f.read_text() for f in (tmp_path / "s").glob("*.json")]
    assert json.loads("".join(lines)) == {"n": 3, "share": 0.5}


def test_dataset_stats(spark, posts, tmp_path):
    path = str(tmp_path / "t")
    posts.repartition(3).write.parquet(path)
    row = tables.dataset_stats(spark.read.parquet(path)).first()
    size = sum(f.stat().st_size for f in files(path)) / 1024**2
    assert (row.total_rows, row.num_files, row.num_columns) == (200, 3, 4)
    assert row.total_size_mb == pytest.approx(size)


def test_stats_read_footers_and_name_partitions(spark, posts, tmp_path):
    path = str(tmp_path / "by=odd" / "t")
    storage.save_tweets(posts, path)
    stats = tables.dataset_stats(spark.read.parquet(path))
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan
    row = stats.first()
    assert (row.total_rows, row.num_files, row.partition_columns) == (200, 100, "date,hour")
    assert row.total_size_mb == pytest.approx(sum(f.stat().st_size for f in files(path)) / 1024**2)
    assert tables.dataset_stats(spark.read.parquet(path).limit(0)).first().partition_columns == ""


def test_full_and_incremental_runs(spark, data, tmp_path):
    from postpulse.checks.queries import AS_OF, posts as given_posts
    from postpulse.plans import full_run

    counts = full_run.run_full(spark, given_posts(spark, data), str(tmp_path), "r1", AS_OF, hours=720)
    for stage, folder in (("collected", "raw"), ("cleaned", "processed"), ("windows", "signals")):
        assert spark.read.parquet(f"{tmp_path}/{folder}").count() == counts[stage] > 0
    assert spark.read.json(f"{tmp_path}/analysis/r1").first().signal_windows == counts["windows"]
    path = str(tmp_path / "incremental")
    first = rows(full_run.run_incremental(given_posts(spark, data), path, AS_OF, 24))
    assert rows(full_run.run_incremental(given_posts(spark, data), path, AS_OF, 24)) == first
    # A day whose posts are gone leaves the table.
    full_run.run_incremental(given_posts(spark, data), path, AS_OF, 48)
    kept = given_posts(spark, data).where("CAST(timestamp AS DATE) = DATE '2024-01-30'")
    again = full_run.run_incremental(kept, path, AS_OF, 48)
    assert {str(r.date) for r in again.select("date").distinct().collect()} == {"2024-01-30"}


def test_incremental_composite_equals_a_full_run(spark, data, tmp_path):
    """Days scored one run after the other finish as if they had been scored together."""
    from postpulse.checks.queries import AS_OF, posts as given_posts
    from postpulse.config import Settings
    from postpulse.plans import full_run

    settings, path = Settings(deduplicate=False), str(tmp_path / "store")
    df = given_posts(spark, data).where("timestamp >= TIMESTAMP_NTZ '2024-01-26'").cache()
    whole = {r.timestamp: r for r in full_run.posts_to_signals(df, settings).collect()}
    for day in (27, 28, 29, 30, 31, 29):
        full_run.run_incremental(df, path, f"2024-01-{day} 23:59:59", 24, settings)
    out = {r.timestamp: r for r in full_run.run_incremental(df, path, AS_OF, 1, settings).collect()}
    assert out.keys() == whole.keys()
    for at, r in out.items():
        for c in ("tweet_count", "composite_signal", "sentiment_ci_lower", "sentiment_ci_width", "weighted_sentiment"):
            assert r[c] == (None if whole[at][c] is None else pytest.approx(whole[at][c], rel=1e-12, abs=1e-12)), c


def test_a_save_runs_its_input_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(500).selectExpr("id", "id % 3 AS date", "id AS hour").mapInArrow(count, "id bigint, date bigint, hour bigint")
    path = storage.save_table(df, str(tmp_path), "t", "append")
    assert seen.value == 500 and {p.name for p in Path(path).glob("*=*")} == {"date=0", "date=1", "date=2"}
    assert spark.read.parquet(path).count() == 500
    assert storage.save_table(df.where("id < 0"), str(tmp_path), "none") == "" and seen.value == 1000
    assert not (tmp_path / "none").exists()


def test_files_of_a_run_are_pruned(spark, data, tmp_path):
    """Dates choose folders, and times of a day choose files, by their statistics."""
    rows = spark.range(20_000).selectExpr("id", "timestamp_micros(1704067200000000 + id * 60000000) AS timestamp")
    storage.write_run(rows.repartition(8), str(tmp_path / "runs"), "r 1:a")
    back = spark.read.parquet(str(tmp_path / "runs"))
    assert {r.run_id for r in back.select("run_id").distinct().collect()} == {"r 1:a"}
    found = tables.in_time_range(storage.read_run(spark, str(tmp_path / "runs"), "r 1:a"), "2024-01-03 06:00:00", "2024-01-03 07:00:00")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "date" in plan.split("PartitionFilters: [")[1].split("]")[0] and "timestamp" in plan.split("PushedFilters: [")[1].split("]")[0]
    assert found.count() == 61
    import pyarrow.parquet as pq

    spans = []
    for file in files(tmp_path / "runs"):
        times = pq.read_table(file).column("timestamp").to_pylist()
        stats = pq.read_metadata(file).row_group(0).column(1).statistics
        assert times == sorted(times) and (stats.min, stats.max) == (times[0], times[-1])
        spans.append((times[0], times[-1]))
    spans.sort()
    assert len(spans) == 14 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    storage.write_run(rows.limit(5), str(tmp_path / "runs"), "r 1:a")
    assert spark.read.parquet(str(tmp_path / "runs")).count() == 5


def test_retention_of_all_tiers(spark, tmp_path):
    base = str(tmp_path)
    days = spark.range(400).selectExpr("id", "date_sub(DATE '2025-01-31', CAST(id AS INT)) AS date")
    days.coalesce(1).write.partitionBy("date").parquet(f"{base}/raw")
    days.coalesce(1).withColumn("run_id", F.lit("r1")).write.partitionBy("run_id", "date").parquet(f"{base}/processed")
    days.coalesce(1).write.partitionBy("date").parquet(f"{base}/signals")
    for i in range(13):
        storage.save_model(spark.range(1), f"{base}/models/model_202501{i + 10}_000000")
    (tmp_path / "raw" / "date=unknown").mkdir()
    kept = {"raw": 31, "processed": 91, "signals": 181}
    report = retention.apply_retention(spark, base, "2025-01-31 12:00:00")
    counts = {r.tier: r.n for r in report.groupBy("tier").agg(F.count("*").alias("n")).collect()}
    assert counts == {t: 400 - n for t, n in kept.items()} | {"models": 3}
    assert all(r.files == 1 and r.bytes > 0 for r in report.where("tier != 'models'").collect())
    # Nothing goes without being asked for.
    assert all(spark.read.parquet(f"{base}/{t}").count() == 400 for t in kept)
    retention.apply_retention(spark, base, "2025-01-31", delete=True)
    assert {t: spark.read.parquet(f"{base}/{t}").count() for t in kept} == kept
    assert sorted(p.name for p in (tmp_path / "models").iterdir() if p.name.startswith("model")) == [f"model_202501{i + 10}_000000" for i in range(3, 13)]
    assert (tmp_path / "raw" / "date=unknown").exists()
    assert retention.apply_retention(spark, base, "2025-01-31", delete=True).count() == 0
    assert retention.apply_retention(spark, str(tmp_path / "nowhere"), "2025-01-31", delete=True).count() == 0


def test_days_leave_the_signal_store(spark, data, tmp_path):
    from postpulse.checks.queries import AS_OF, posts as given_posts
    from postpulse.plans import full_run

    store = str(tmp_path / "store")
    before = full_run.run_incremental(given_posts(spark, data), store, AS_OF, 96)
    assert signal_store.drop_days(spark, store, "2024-01-29") == ["2024-01-27", "2024-01-28"]
    left = signal_store.read_signals(spark, store)
    assert {str(r.date) for r in left.select("date").distinct().collect()} == {"2024-01-29", "2024-01-30"}
    assert before.count() > left.count() and signal_store.drop_days(spark, store, "2024-01-29") == []
