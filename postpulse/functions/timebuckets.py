"""Fixed-width time buckets on epoch microseconds."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY = 86_400_000_000
MINUTE = 60_000_000
#: More buckets than a century of minutes has.
MOST_BUCKETS = 60_000_000


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def from_micros(value: Column, like: str = "timestamp") -> Column:
    """Back to a timestamp of the type that ``DataFrame.dtypes`` names."""
    return F.timestamp_micros(value).cast(like)


def whole_days(width_minutes: int) -> bool:
    """Whether the width divides a day, so that buckets are the same for every first day."""
    return DAY % (width_minutes * MINUTE) == 0


def with_bucket(df: DataFrame, width_minutes: int, ts_col: str = "timestamp", name: str = "bucket", origin: int | None = None) -> DataFrame:
    """Add the start of each row's bucket, in epoch microseconds. Rows without time are left out.

    Buckets count from ``origin`` (epoch microseconds), or from midnight of the first day. Where the width divides a day that is the
    same for every day, and the data need not be read to find the first one.
    """
    dated = df.where(F.col(ts_col).isNotNull())
    at = micros(F.col(ts_col))
    width = width_minutes * MINUTE
    if origin is not None:
        start = F.lit(origin)
    elif whole_days(width_minutes):
        start = F.lit(0)
    else:
        first = dated.agg(F.min(at)).scalar()
        start = first - F.pmod(first, F.lit(DAY))
    return dated.withColumn(name, at - F.pmod(at - start, F.lit(width)))


def origin_of(day: str, width_minutes: int) -> int:
    """Midnight (UTC) of a day in epoch microseconds, from which windows of this width count; 0 where every day is the same."""
    return 0 if whole_days(width_minutes) else (date.fromisoformat(day[:10]) - date(1970, 1, 1)).days * DAY


def bucket_spine(buckets: DataFrame, width_minutes: int, name: str = "bucket", most: int = MOST_BUCKETS) -> DataFrame:
    """Every bucket between the first and the last one, made in all tasks at once.

    Only the two ends are read first, so ``buckets`` should be a stored table. A range of more than ``most`` buckets raises: it comes from stray
    times, such as the year 9999, and would be nothing but gaps.
    """
    width = width_minutes * MINUTE
    low, high = buckets.agg(F.min(name), F.max(name)).first()
    if low is None:
        return buckets.sparkSession.range(0).select(F.col("id").alias(name))
    if (high - low) // width >= most:
        days = (high - low) // DAY
        raise ValueError(f"windows of {width_minutes} minutes over {days} days are more than {most}: drop posts with stray times first")
    return buckets.sparkSession.range(low, high + 1, width).select(F.col("id").alias(name))
