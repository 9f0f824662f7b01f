"""Window totals of all days, and the states by which their composite is standardised, published together.

The composite of a window depends on all windows, so it is not stored. Stored are the totals of windows with posts, and for each day the mergeable
states of its components. A run renews some days of both; reading merges the states of all days in their order and
finishes the windows in one narrow pass. Composites of windows from different runs are therefore comparable, and equal to those of one run over all days.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postpulse.config import Settings
from postpulse.functions.timebuckets import MINUTE, from_micros, micros, origin_of
from postpulse.operators import signals
from postpulse.session import cut_lineage
from postpulse.sinks.versioned import Version, VersionedTables

TOTALS, STATES = "totals", "states"


def _publish(store: VersionedTables, totals: DataFrame, days: Iterable[str], before: Version, notes: dict[str, str]) -> Version:
    dated = totals.withColumn("date", F.to_date("timestamp"))
    # A day's states are sums over its few windows, written next to them.
    return store.publish({TOTALS: dated, STATES: signals.day_states(totals)}, "date", days, notes, before)


def _layout(settings: Settings, before: Version, origin: int) -> dict[str, str]:
    """The width and origin of windows, which may not change within a store."""
    notes = {"window_minutes": str(settings.signals.window_minutes), "origin": str(origin)}
    for name, value in notes.items():
        if before.notes.get(name, value) != value:
            raise ValueError(f"the store holds windows with {name} {before.notes[name]}, not {value}")
    return notes


def origin(spark: SparkSession, base: str, first_day: str, settings: Settings = Settings()) -> int:
    """Where the windows of the store count from: for a new one, from midnight of ``first_day``."""
    known = VersionedTables(spark, base).version().notes.get("origin")
    return origin_of(first_day, settings.signals.window_minutes) if known is None else int(known)


def replace_days(
    spark: SparkSession, base: str, totals: DataFrame, days: Iterable[str], settings: Settings = Settings(), origin: int = 0
) -> Version:
    """Put the windows of ``totals`` (with ``timestamp``) in the place of all windows of ``days``, also of days without any."""
    store = VersionedTables(spark, base)
    before = store.version()
    return _publish(store, cut_lineage(totals), days, before, _layout(settings, before, origin))


def add_windows(
    spark: SparkSession, base: str, totals: DataFrame, settings: Settings = Settings(), writer: str = "", batch_id: int | None = None,
    origin: int = 0,
) -> Version:
    """Add new windows to their days. A batch of a writer that the store has is not added again."""
    store = VersionedTables(spark, base)
    before = store.version()
    notes, note = _layout(settings, before, origin), f"batch of {writer}"
    if batch_id is not None:
        if int(before.notes.get(note, -1)) >= batch_id:
            return before
        notes[note] = str(batch_id)
    fresh = cut_lineage(totals)
    # One row for each day of the new windows.
    days = [str(r.date) for r in fresh.select(F.to_date("timestamp").alias("date")).distinct().collect()]
    if not days:
        return before
    if TOTALS in before.parts:
        fresh = fresh.unionByName(store.read(TOTALS, before, days).drop("date"))
    return _publish(store, fresh, days, before, notes)


def drop_days(spark: SparkSession, base: str, before: str) -> list[str]:
    """Publish a version without the days before ``before``, and name these. Their files go when the versions that hold them expire."""
    store = VersionedTables(spark, base)
    own = store.version()
    old = [d for d in own.parts.get(TOTALS, {}) if d < before[:10]]
    if old:
        store.publish({t: store.read(t, own, []) for t in (TOTALS, STATES)}, "date", old, onto=own)
    return sorted(old)


def read_signals(spark: SparkSession, base: str, settings: Settings = Settings(), version: int | None = None) -> DataFrame:
    """Finished windows of a published version, the latest by default, with their ``date``."""
    store = VersionedTables(spark, base)
    own = store.version(version)
    return finish_totals(store.read(TOTALS, own).drop("date"), settings, store.read(STATES, own)).withColumn("date", F.to_date("timestamp"))


def finish_totals(totals: DataFrame, settings: Settings = Settings(), states: DataFrame | None = None) -> DataFrame:
    """Gap filling, derived metrics, intervals and composite of stored window totals; ``states`` are those of their days, if known."""
    cfg, kind = settings.signals, dict(totals.dtypes)["timestamp"]
    keyed = totals.withColumn("bucket", micros(F.col("timestamp"))).drop("timestamp")
    windows = signals.derived_window_metrics(signals.gap_fill_windows(keyed, cfg.window_minutes))
    rest = [c for c in windows.columns if c != "bucket"]
    windows = windows.select(from_micros(F.col("bucket"), kind).alias("timestamp"), *rest)
    if states is None:
        return signals.finish_windows(windows, cfg)
    low, high = keyed.agg(F.min("bucket"), F.max("bucket")).first()
    every = 0 if low is None else (high - low) // (cfg.window_minutes * MINUTE) + 1
    return signals.finish_windows(windows, cfg, signals.merged_states(states, every))
