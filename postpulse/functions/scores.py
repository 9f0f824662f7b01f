"""Per-post scores and interval statistics as column expressions."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

from postpulse.functions import lexicon as lx
from postpulse.functions.features import any_word_present


def sentiment_signal(score: Column) -> Column:
    return F.signum(score).cast("bigint")


def engagement_proxy(like: Column, retweet: Column, reply: Column) -> Column:
    return (like + retweet * 2 + reply * 3) / F.lit(100.0)


def urgency_signal(exclamations: Column, questions: Column, uppercase: Column) -> Column:
    return exclamations * 0.5 + questions * 0.3 + F.when(uppercase > 0.3, 0.2).otherwise(0.0)


def market_focus_signal(terms: Column) -> Column:
    return F.tanh(terms / F.lit(10.0))


def technical_mention_signal(text: Column) -> Column:
    return any_word_present(text, lx.TECHNICAL_PHRASES).cast("bigint")


def hashtag_flag(hashtags: Column, needle: str) -> Column:
    found = F.exists(hashtags, lambda tag: F.contains(F.lower(tag), F.lit(needle)))
    return F.coalesce(found, F.lit(False)).cast("bigint")


def normal_quantile(confidence: float) -> float:
    return NormalDist().inv_cdf((1 + confidence) / 2)


def wilson_bounds(mean_signal: Column, n: Column, confidence: float = 0.95) -> tuple[Column, Column]:
    """Wilson interval of a mean in [-1, 1] read as a share of positive posts; (0, 0) for n = 0."""
    z = normal_quantile(confidence)
    # greatest() and least() would pass over a NULL.
    share = F.when(
        mean_signal.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), (mean_signal + 1) / 2))
    )
    count = F.nullif(n.cast("double"), F.lit(0.0))
    spread = 1 + z * z / count
    centre = (share + z * z / (2 * count)) / spread
    half = z * F.sqrt(share * (1 - share) / count + z * z / (4 * count * count)) / spread
    empty = n == 0
    lower = F.when(empty, 0.0).otherwise(2 * (centre - half) - 1)
    upper = F.when(empty, 0.0).otherwise(2 * (centre + half) - 1)
    return lower, upper
