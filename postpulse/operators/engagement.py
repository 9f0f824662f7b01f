"""Min-max normalisation of engagement counts and the combined score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postpulse.operators.frames import with_totals
from postpulse.schemas import ENGAGEMENT

# Weight of each normalised count.
WEIGHTS = {
    "reply_count": 0.2, "retweet_count": 0.3, "like_count": 0.3, "quote_count": 0.1, "view_count": 0.1,
}


def minmax_normalize(df: DataFrame, columns: tuple[str, ...] = ENGAGEMENT) -> DataFrame:
    """Add ``<column>_normalized`` in [0, 1]; NULL where the column is constant or never positive."""
    present = [c for c in columns if c in df.columns]
    bounded = with_totals(
        df, *[F.min(c).alias(f"_min_{c}") for c in present], *[F.max(c).alias(f"_max_{c}") for c in present]
    )
    scaled = {
        f"{c}_normalized": F.when(
            F.col(f"_max_{c}") > 0,
            F.try_divide((F.col(c) - F.col(f"_min_{c}")).cast("double"), F.col(f"_max_{c}") - F.col(f"_min_{c}")),
        )
        for c in present
    }
    helpers = [f"_{side}_{c}" for side in ("min", "max") for c in present]
    return bounded.withColumns(scaled).drop(*helpers)


def engagement_score(df: DataFrame) -> DataFrame:
    """Weighted sum of the five normalised counts, all of which must be there."""
    missing = [c for c in WEIGHTS if f"{c}_normalized" not in df.columns]
    if missing:
        raise ValueError(f"engagement_score needs normalised columns of {missing}")
    terms = [F.col(f"{c}_normalized") * w for c, w in WEIGHTS.items()]
    return df.withColumn("engagement_score", sum(terms[1:], terms[0]))


def normalize_data(df: DataFrame) -> DataFrame:
    return engagement_score(minmax_normalize(df))
