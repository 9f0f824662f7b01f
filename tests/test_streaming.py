"""The stream against the batch over the same posts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from postpulse.checks.queries import posts
from postpulse.config import Settings, SignalConfig
from postpulse.operators import cleaning, signals
from postpulse.plans import full_run
from postpulse.sinks import files, signal_store, versioned
from postpulse.sources import jsonl
from postpulse.sources.sample_posts import raw_lines
from postpulse.streaming import live_signals

TOTALS = ["timestamp", *signals.MEANS, *signals.SUMS, "tweet_count"]


@pytest.fixture(scope="module")
def feed(spark, data, tmp_path_factory):
    """Five files in time order; the fourth part is delivered twice."""
    path = tmp_path_factory.mktemp("feed")
    df = posts(spark, data).orderBy("timestamp").coalesce(1).cache()
    number = F.col("tweet_id").cast("int")
    for i in range(5):
        part = df.where((number >= 200 * i) & (number < 200 * (i + 1)))
        sent = part.unionByName(part) if i == 3 else part
        raw_lines(sent).coalesce(1).write.text(str(path / f"part{i}"))
    return str(path / "part*")


def batch(spark, data):
    df = posts(spark, data).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    ready = cleaning.fill_missing(cleaning.add_features(cleaning.add_clean_text(df)))
    totals = signals.window_totals(signals.individual_signals(ready, time_decay=False))
    return totals.withColumn("timestamp", F.timestamp_micros("bucket"))


def keyed(df, columns):
    return {
        r["timestamp"]: tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(columns).collect()
    }


def test_closed_windows_equal_the_batch(spark, data, feed, tmp_path):
    raw = jsonl.stream_jsonl(spark, feed, files_per_trigger=1)
    query = live_signals.start_stream_signals(raw, str(tmp_path / "out"), str(tmp_path / "state"))
    query.awaitTermination(300)
    got, want = keyed(spark.read.parquet(str(tmp_path / "out")), TOTALS), keyed(batch(spark, data), TOTALS)
    missing = sorted(set(want) - set(got))
    assert got.items() <= want.items() and 0 < len(missing) <= 4
    assert min(missing) > max(got)


def test_no_text_reaches_the_state(spark, feed):
    totals = live_signals.windowed_stream(jsonl.flatten_tweets(jsonl.stream_jsonl(spark, feed)))
    lines = totals._jdf.queryExecution().analyzed().toString().splitlines()
    # Operators are listed from the last to the first: repeats, watermark, the columns kept, then the scores.
    repeats = next(i for i, line in enumerate(lines) if "Deduplicate" in line)
    assert not any("content" in line for line in lines[: repeats + 3])
    assert any("content" in line for line in lines[repeats + 3 :])


def test_composite_is_rebuilt_from_stored_windows(spark, data, feed, tmp_path):
    raw = jsonl.stream_jsonl(spark, feed, files_per_trigger=2)
    store = str(tmp_path / "store")
    live_signals.start_stream_composite(raw, store, str(tmp_path / "state")).awaitTermination(300)
    out = signal_store.read_signals(spark, store)
    last = out.agg(F.max("timestamp")).first()[0]
    closed = batch(spark, data).where(F.col("timestamp") <= F.lit(last)).drop("bucket")
    want = signal_store.finish_totals(closed)
    columns = ["timestamp", "composite_signal", "tweet_count", "sentiment_ci_lower"]
    assert keyed(out, columns) == keyed(want, columns)
    # Versions are the batches that closed windows; a version once opened stays readable.
    tables = versioned.VersionedTables(spark, store)
    assert len(tables.versions()) > 1
    first = signal_store.read_signals(spark, store, version=1)
    assert 0 < first.count() < out.count()


def test_odd_widths_count_from_the_first_day(spark, data, feed, tmp_path):
    """Windows of 7 minutes are those of the batch, in the stream and in incremental runs."""
    settings = Settings(signals=SignalConfig(window_minutes=7), deduplicate=False)
    raw = jsonl.stream_jsonl(spark, feed, files_per_trigger=5)
    given = posts(spark, data)
    first = str(given.agg(F.min("timestamp")).first()[0])
    live_signals.start_stream_signals(raw, str(tmp_path / "out"), str(tmp_path / "state"), settings, first_day=first).awaitTermination(300)
    scored = full_run.scored_posts(given.withColumn("timestamp", F.col("timestamp").cast("timestamp")), settings)
    want = keyed(signals.window_totals(scored, 7).withColumn("timestamp", F.timestamp_micros("bucket")), TOTALS)
    got = keyed(spark.read.parquet(str(tmp_path / "out")), TOTALS)
    assert got.items() <= want.items() and len(got) > 0.9 * len(want)
    store, last = str(tmp_path / "store"), given.where("timestamp >= TIMESTAMP_NTZ '2024-01-27'")
    for day in ("28 23:59:59", "30 23:59:59"):
        out = full_run.run_incremental(last, store, f"2024-01-{day}", 47, settings)
    whole = full_run.posts_to_signals(last, settings)
    columns = ["timestamp", "tweet_count", "like_count", "composite_signal"]
    assert keyed(out, columns) == keyed(whole, columns)


def test_a_batch_is_published_once(spark, data, tmp_path, monkeypatch):
    """A crash before publishing leaves readers at the old version, and the batch is written again; one after it changes nothing."""
    store, totals = str(tmp_path / "store"), batch(spark, data).drop("bucket").cache()
    days = [r[0] for r in totals.select(F.to_date("timestamp")).distinct().sort(F.to_date("timestamp")).collect()]
    early, late = totals.where(F.to_date("timestamp") <= F.lit(days[9])), totals.where(F.to_date("timestamp") > F.lit(days[9]))
    signal_store.add_windows(spark, store, early, writer="s", batch_id=0)
    before = signal_store.read_signals(spark, store)
    opened = before.count()
    put = files.Files.write_new
    monkeypatch.setattr(files.Files, "write_new", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        signal_store.add_windows(spark, store, late, writer="s", batch_id=1)
    # The data is there, but no version names it.
    assert signal_store.read_signals(spark, store).count() == opened
    monkeypatch.setattr(files.Files, "write_new", put)
    signal_store.add_windows(spark, store, late, writer="s", batch_id=1)
    again = signal_store.add_windows(spark, store, late, writer="s", batch_id=1)
    assert again.number == 2 and again.notes["batch of s"] == "1"
    got = signal_store.read_signals(spark, store)
    columns = ["timestamp", "composite_signal", "tweet_count"]
    assert keyed(got, columns) == keyed(signal_store.finish_totals(totals), columns)
    # A reader of the version before still sees that version whole.
    assert before.count() == opened and keyed(before, columns) == keyed(signal_store.finish_totals(early), columns)
    tables = versioned.VersionedTables(spark, store)
    assert tables.expire(keep=1, grace_hours=0) == 1 and keyed(signal_store.read_signals(spark, store), columns) == keyed(got, columns)


def test_only_changed_days_are_written(spark, data, tmp_path):
    store, totals = str(tmp_path / "store"), batch(spark, data).drop("bucket").cache()
    first = signal_store.add_windows(spark, store, totals)
    day = sorted(first.parts["totals"])[3]
    second = signal_store.replace_days(spark, store, totals.where(F.to_date("timestamp") == day).limit(2), [day])
    changed = {k for k, folder in second.parts["totals"].items() if first.parts["totals"][k] != folder}
    assert changed == {day} and second.number == 2
    with pytest.raises(ValueError):
        signal_store.replace_days(spark, store, totals, [day])
    with pytest.raises(ValueError):
        signal_store.add_windows(spark, store, totals, Settings(signals=SignalConfig(window_minutes=30)))


def test_two_writers(spark, tmp_path):
    """The slower of two writers onto the same version learns of it, and publishes nothing."""
    tables = versioned.VersionedTables(spark, str(tmp_path / "t"))
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    start = tables.version()
    tables.publish({"t": df}, "k", ["a", "b"], onto=start)
    with pytest.raises(versioned.PublishConflict):
        tables.publish({"t": df.where("k = 'a'")}, "k", ["a"], onto=start)
    tables.publish({"t": df.where("false")}, "k", ["b"])
    assert [tuple(r) for r in tables.read("t").collect()] == [("a", 1)] and tables.versions() == [1, 2]
    assert tables.read("t", keys=["b"]).count() == 0 and tables.read("t", tables.version(1), ["b"]).first().v == 2


def test_lines_are_parsed_once_for_all_fields(spark, feed):
    """A filter on a field of the raw feed does not parse the line again."""
    flat = jsonl.flatten_tweets(jsonl.ingest_jsonl(spark, feed)).where(F.col("timestamp").isNotNull())
    plan = flat.select("tweet_id", "timestamp", "content")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and plan.count("parseJson") == 1
