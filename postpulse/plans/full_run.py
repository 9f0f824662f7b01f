"""Whole runs: stored corpus to cleaned posts, signals and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from postpulse.config import Settings
from postpulse.functions.timebuckets import from_micros
from postpulse.operators.cleaning import clean_dataframe, featurise
from postpulse.operators.dedupe import dedupe_by_hash
from postpulse.operators.reports import signal_summary
from postpulse.operators.signals import aggregate_signals, finish_windows, generate_signals, individual_signals, window_totals
from postpulse.session import cut_lineage
from postpulse.sinks import signal_store, storage, term_store
from postpulse.sources.selection import collect_posts, since_day


def scored_posts(posts: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Signals of the cleaned posts without duplicates.

    Scores depend on their own row only, so they are computed before duplicates are removed:
    what that shuffles is then a few numbers and the hash of each post instead of its text.
    """
    scored = individual_signals(featurise(posts, settings), time_decay=False)
    return dedupe_by_hash(scored) if settings.deduplicate else scored


def posts_to_signals(posts: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Raw posts to the finished window table in one go."""
    if settings.signals.normalize_engagement:
        # The range of the counts is that of the posts without duplicates.
        return generate_signals(cut_lineage(clean_dataframe(posts, settings)), settings)
    windows = aggregate_signals(scored_posts(posts, settings), settings.signals.window_minutes)
    return finish_windows(windows, settings.signals)


def run_full(
    spark: SparkSession, posts: DataFrame, base_path: str, run_id: str, as_of: str,
    hours: int | None = None, settings: Settings = Settings(),
) -> dict[str, int]:
    """Collect, clean, score, store, and learn the vocabulary. Each stage reads what the one before it wrote, and
    its rows are counted while they are written."""
    base = base_path.rstrip("/")
    compression = settings.storage.compression

    def write(stage: str, df: DataFrame) -> tuple[DataFrame, int]:
        seen = Observation(f"{stage}-{run_id}")
        storage.write_run(df.observe(seen, F.count("*").alias("n")), f"{base}/{stage}", run_id, compression)
        # Without the date that the write adds.
        return storage.read_run(spark, f"{base}/{stage}", run_id).select(*df.columns), seen.get["n"]

    raw, n_raw = write("raw", collect_posts(posts, as_of, hours, settings.selection))
    cleaned, n_cleaned = write("processed", clean_dataframe(raw, settings))
    windows, n_windows = write("signals", generate_signals(cleaned, settings))
    storage.write_summary_json(signal_summary(windows), f"{base}/analysis/{run_id}")
    # Terms of the run's days, added to those of the days stored before.
    term_store.replace_days(spark, f"{base}/models", cleaned, cfg=settings.tfidf)
    vocabulary = term_store.load_vocabulary(spark, f"{base}/models", settings.tfidf)
    return {"collected": n_raw, "cleaned": n_cleaned, "windows": n_windows, "terms": vocabulary.count()}


def incremental_posts(posts: DataFrame, as_of: str, hours: int = 1) -> DataFrame:
    """Posts of the look-back. Like collection it starts at a day's midnight, so a repeated
    run covers whole days, and their stored partitions can be replaced."""
    return posts.where(
        (F.col("timestamp") >= since_day(as_of, hours)) & (F.col("timestamp") <= F.lit(as_of).cast("timestamp_ntz"))
    )


def run_incremental(posts: DataFrame, path: str, as_of: str, hours: int = 1, settings: Settings = Settings()) -> DataFrame:
    """Score the look-back, publish its days in the signal store at ``path``, also those that no longer have posts, and give the
    finished windows of all stored days. Duplicates are found within the look-back. Windows whose width does not divide a day count from the first day of
    the first run, in all later runs too."""
    spark = posts.sparkSession
    kind = dict(posts.dtypes)["timestamp"]
    scored = scored_posts(incremental_posts(posts, as_of, hours), settings)
    days = F.explode(F.sequence(F.to_date(since_day(as_of, hours)), F.to_date(F.lit(as_of))))
    # One row for each day of the look-back.
    dates = [str(r.date) for r in spark.range(1).select(days.alias("date")).collect()]
    origin = signal_store.origin(spark, path, dates[0], settings)
    totals = window_totals(scored, settings.signals.window_minutes, origin)
    totals = totals.select(from_micros(F.col("bucket"), kind).alias("timestamp"), *[c for c in totals.columns if c != "bucket"])
    signal_store.replace_days(spark, path, totals, dates, settings, origin)
    return signal_store.read_signals(spark, path, settings)
