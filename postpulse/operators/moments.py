"""Count, mean and sum of squared deviations as states that merge in a fixed order.

A state is built by adding values one at a time, in the order of their rows, and states of groups are merged in the order of
their keys. The same rows therefore give the same bits however they are spread over tasks, and values of any magnitude keep their
relative precision, as nothing but differences from a running mean is squared.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Groups of a frame that has no time to group by.
GROUPS = 1024


def state(n: Column, mean: Column, m2: Column) -> Column:
    return F.struct(n.cast("bigint").alias("n"), mean.cast("double").alias("mean"), m2.cast("double").alias("m2"))


def empty() -> Column:
    return state(F.lit(0), F.lit(0.0), F.lit(0.0))


def add(to: Column, value: Column) -> Column:
    """One more value; NULL changes nothing."""
    n = to["n"] + 1
    off = value - to["mean"]
    mean = to["mean"] + off / n
    return F.when(value.isNull(), to).otherwise(state(n, mean, to["m2"] + off * (value - mean)))


def merge(a: Column, b: Column) -> Column:
    """The state of the values of both."""
    n = F.greatest(a["n"] + b["n"], F.lit(1))
    off = b["mean"] - a["mean"]
    both = state(
        a["n"] + b["n"], a["mean"] + off * (b["n"] / n), a["m2"] + b["m2"] + off * off * (a["n"] * (b["n"] / n))
    )
    return F.when(b["n"] == 0, a).when(a["n"] == 0, b).otherwise(both)


def deviation(of: Column) -> Column:
    """Sample standard deviation; NULL for fewer than two values."""
    return F.when(of["n"] > 1, F.sqrt(of["m2"] / F.greatest(of["n"] - 1, F.lit(1))))


def _folded(step: Callable[[Column, Column], Column], column: str) -> Column:
    return F.aggregate("_rows", empty(), lambda s, row: step(s, row[column])).alias(column)


def group_states(df: DataFrame, columns: Sequence[str], group: Column, order: Sequence[Column], name: str = "day") -> DataFrame:
    """One row for each group, with a state for each of ``columns``. Groups should be small, as a day of windows is."""
    rows = F.array_sort(F.collect_list(F.struct(*[c.alias(f"_{i}") for i, c in enumerate(order)], *[F.col(c).cast("double").alias(c) for c in columns])))
    listed = df.groupBy(group.alias(name)).agg(rows.alias("_rows"))
    return listed.select(name, *[_folded(add, c) for c in columns])


def merged(states: DataFrame, columns: Sequence[str], name: str = "day") -> DataFrame:
    """One row: the states of all groups, merged in the order of their names."""
    rows = F.array_sort(F.collect_list(F.struct(name, *columns)))
    return states.agg(rows.alias("_rows")).select(*[_folded(merge, c) for c in columns])


def moments(df: DataFrame, columns: Sequence[str], ts_col: str = "timestamp") -> DataFrame:
    """One row with the state of each column, grouped by day where there is a time, else by content."""
    if ts_col in df.columns:
        states = group_states(df, columns, F.to_date(ts_col), [F.col(ts_col)])
    else:
        states = group_states(df, columns, F.pmod(F.xxhash64(*columns), F.lit(GROUPS)), [])
    return merged(states, columns)
