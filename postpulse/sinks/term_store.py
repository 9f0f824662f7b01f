"""Term statistics of each day, which add up to a vocabulary; each published version is a model that a later run can load.

The statistics of a vocabulary are sums over posts, so those of a day are counted once and stored. A run renews its own days; the vocabulary of
all stored days is then one sum over rows of (day, term), without the posts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postpulse.config import TfidfConfig
from postpulse.functions.lexicon import ENGLISH_STOP_WORDS
from postpulse.operators.tfidf import choose_terms, term_counts
from postpulse.session import cut_lineage
from postpulse.sinks.versioned import Version, VersionedTables

TERMS, POSTS = "terms", "posts"
#: The day of posts without a time.
UNDATED = "undated"


def replace_days(
    spark: SparkSession, base: str, posts: DataFrame, text_col: str = "content_clean", cfg: TfidfConfig = TfidfConfig(),
    stop_words: tuple[str, ...] = ENGLISH_STOP_WORDS,
) -> Version:
    """Put the statistics of the days of ``posts`` in the place of those stored for these days."""
    store = VersionedTables(spark, base)
    before, terms = store.version(), str(cfg.ngram_range)
    if before.notes.get("ngram_range", terms) != terms:
        raise ValueError(f"the store holds n-grams of {before.notes['ngram_range']}, not {terms}")
    day = F.coalesce(F.to_date("timestamp").cast("string"), F.lit(UNDATED))
    dated = posts.select(day.alias("day"), text_col)
    # A post gives one row for each of its terms, and one without a term if it has none.
    counts = term_counts(dated, text_col, "day", cfg, stop_words)
    stats = counts.where("term IS NOT NULL").groupBy("day", "term").agg(F.count("*").alias("doc_freq"), F.sum("n").alias("term_freq"))
    sizes = cut_lineage(dated.groupBy("day").agg(F.count("*").alias("n_docs")))
    # One row for each day.
    days = [r.day for r in sizes.select("day").collect()]
    return store.publish({TERMS: stats, POSTS: sizes}, "day", days, {"ngram_range": terms}, before)


def load_vocabulary(spark: SparkSession, base: str, cfg: TfidfConfig = TfidfConfig(), version: int | None = None) -> DataFrame:
    """The vocabulary over all days of a published version, the latest by default; as ``fit_vocabulary`` of all their posts."""
    store = VersionedTables(spark, base)
    own = store.version(version)
    stats = store.read(TERMS, own).groupBy("term").agg(F.sum("doc_freq").alias("doc_freq"), F.sum("term_freq").alias("term_freq"))
    return choose_terms(stats, store.read(POSTS, own).agg(F.coalesce(F.sum("n_docs"), F.lit(0))), cfg)
