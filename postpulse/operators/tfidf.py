"""Term statistics and TF-IDF weights as long tables.

A post is one row, so its terms are counted inside the row. Only totals per term, or per
post, are ever shuffled; (post, term) pairs are not.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postpulse.config import TfidfConfig
from postpulse.functions.lexicon import ENGLISH_STOP_WORDS, TOKEN
from postpulse.operators.frames import BROADCAST_ROWS, broadcast_if_small
from postpulse.session import cut_lineage


def tokenize(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def remove_stop_words(tokens: Column, stop_words: tuple[str, ...] = ENGLISH_STOP_WORDS) -> Column:
    return F.filter(tokens, lambda token: ~token.isin(*stop_words))


def ngrams(tokens: Column, ngram_range: tuple[int, int] = (1, 2)) -> Column:
    """All n-grams of ``tokens``, which should be a stored column, as it is read repeatedly."""
    low, high = ngram_range
    runs, wanted = tokens, []
    for n in range(1, high + 1):
        if n > 1:
            count = F.greatest(F.size(tokens) - (n - 1), F.lit(0))
            runs = F.zip_with(
                F.slice(runs, F.lit(1), count),
                F.slice(tokens, F.lit(n), count),
                lambda head, last: F.concat_ws(" ", head, last),
            )
        if n >= low:
            wanted.append(runs)
    return F.concat(*wanted)


def _grams(ngram_range: tuple[int, int], only: Sequence[str] | None = None, terms: Sequence[str] | None = None) -> Callable[[pa.Array], Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]]:
    """A function of texts that gives, for each length, the n-grams of words that blanks part, and row, n-gram and count of each distinct one of a row.
    With ``only``, n-grams that hold any other word are left out; with ``terms``, all others than these.

    It is defined here so that it travels to the workers by value and needs no package there.
    """
    low, high = ngram_range
    if terms is not None:
        only = sorted({word for term in terms for word in term.split(" ")})
    wanted, wanted_grams = (None if given is None else pa.array(given, pa.string()) for given in (only, terms))

    def found_in(texts: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
        lists = pc.split_pattern(pc.fill_null(texts, ""), " ")
        found = lists.flatten().dictionary_encode()
        row, code, names = np.repeat(np.arange(len(texts)), pc.list_value_length(lists)), found.indices.to_numpy().astype(np.int64), found.dictionary
        # An empty text splits into one empty word.
        some = pc.binary_length(names).to_numpy()[code] > 0
        row, code = row[some], code[some]
        usual = np.ones(len(code), bool) if wanted is None else pc.is_in(names, value_set=wanted).to_numpy(zero_copy_only=False)[code]
        # Where n-grams start, and which one does so there.
        starts, at = np.flatnonzero(usual), code.copy()
        grams, gram = names, code[starts]
        for n in range(1, high + 1):
            if n > 1:
                at[starts] = gram
                starts = starts[starts < len(row) - n + 1]
                starts = starts[(row[starts] == row[starts + n - 1]) & usual[starts + n - 1]]
                key = pa.array(at[starts] * len(names) + code[starts + n - 1]).dictionary_encode()
                pair = key.dictionary.to_numpy()
                gram = key.indices.to_numpy().astype(np.int64)
                # The n-gram before, and the word after it.
                grams = pc.binary_join_element_wise(grams.take(pa.array(pair // len(names))), names.take(pa.array(pair % len(names))), " ")
            if n >= low:
                pairs, times = np.unique(row[starts] * max(1, len(grams)) + gram, return_counts=True)
                if wanted_grams is not None:
                    kept = pc.is_in(grams, value_set=wanted_grams).to_numpy(zero_copy_only=False)[pairs % max(1, len(grams))]
                    pairs, times = pairs[kept], times[kept]
                yield grams, pairs // max(1, len(grams)), pairs % max(1, len(grams)), times

    return found_in


def gram_counts(words: Column, ngram_range: tuple[int, int] = (1, 2), terms: Sequence[str] | None = None) -> Column:
    """The distinct n-grams of words that blanks part, with their counts; with ``terms``, of these alone.

    Expressions over arrays of strings copy and compare every term; here a batch of rows works on numbers, and only distinct terms are spelled.
    """

    found_in = _grams(ngram_range, terms=terms)

    @F.arrow_udf("array<struct<term:string,n:bigint>>")
    def count(texts: pa.Array) -> pa.Array:
        levels = list(found_in(texts))
        row = np.concatenate([r for _, r, _, _ in levels])
        order = np.argsort(row, kind="stable")
        terms = pa.concat_arrays([grams.take(pa.array(gram)) for grams, _, gram, _ in levels]).take(pa.array(order))
        times = np.concatenate([t for _, _, _, t in levels])[order]
        ends = np.searchsorted(row[order], np.arange(len(texts) + 1)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([terms, pa.array(times.astype(np.int64))], ["term", "n"]))

    return count(words)


def _words(text_col: str, stop_words: tuple[str, ...]) -> Column:
    """The words that are no stop words, parted by blanks, which no word holds."""
    return F.array_join(remove_stop_words(tokenize(F.col(text_col)), stop_words), " ").alias("_words")


def _pairs(listed: DataFrame, id_col: str) -> DataFrame:
    return listed.select(id_col, F.explode_outer("_grams").alias("_entry")).select(id_col, "_entry.term", "_entry.n")


def term_counts(
    posts: DataFrame,
    text_col: str = "content_clean",
    id_col: str = "tweet_id",
    cfg: TfidfConfig = TfidfConfig(),
    stop_words: tuple[str, ...] = ENGLISH_STOP_WORDS,
) -> DataFrame:
    """(id, term, n) for every distinct term of a post; posts without terms keep one row
    with a NULL term. No shuffle: the terms of a row are counted inside it."""
    return _pairs(posts.select(id_col, gram_counts(_words(text_col, stop_words), cfg.ngram_range).alias("_grams")), id_col)


def term_stats(counts: DataFrame) -> DataFrame:
    """Posts containing each term, and its occurrences in all posts."""
    return (
        counts.where(F.col("term").isNotNull())
        .groupBy("term")
        .agg(F.count("*").alias("doc_freq"), F.sum("n").alias("term_freq"))
    )


def post_stats(
    posts: DataFrame,
    text_col: str = "content_clean",
    cfg: TfidfConfig = TfidfConfig(),
    stop_words: tuple[str, ...] = ENGLISH_STOP_WORDS,
    only: Sequence[str] | None = None,
) -> DataFrame:
    """``term_stats`` of ``term_counts``, for which no row is made of each term of each post: a batch of posts is summed up at once."""

    found_in = _grams(cfg.ngram_range, only)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for grams, _, gram, times in found_in(batch.column(0)):
                posts_with = np.bincount(gram, minlength=len(grams))
                there = np.flatnonzero(posts_with)
                columns = [grams, pa.array(posts_with), pa.array(np.bincount(gram, times, len(grams)).astype(np.int64))]
                yield pa.RecordBatch.from_arrays([c.take(pa.array(there)) for c in columns], ["term", "doc_freq", "term_freq"])

    parts = posts.select(_words(text_col, stop_words)).mapInArrow(sums, "term string, doc_freq bigint, term_freq bigint")
    return parts.groupBy("term").agg(F.sum("doc_freq").alias("doc_freq"), F.sum("term_freq").alias("term_freq"))


def idf(doc_freq: Column, n_docs: Column) -> Column:
    return F.log((n_docs + 1) / (doc_freq + 1)) + 1


def fit_vocabulary(
    posts: DataFrame,
    text_col: str = "content_clean",
    id_col: str = "tweet_id",
    cfg: TfidfConfig = TfidfConfig(),
    stop_words: tuple[str, ...] = ENGLISH_STOP_WORDS,
) -> DataFrame:
    """The fitted model: at most ``max_features`` rows (term, doc_freq, term_freq, idf, n_docs).

    Terms rank by occurrences; equal ones alphabetically. Where single words are terms, they are counted first: a run of words occurs at most as
    often as each of its words, so once ``max_features`` words are in, runs that hold a rarer word than all of these can't be. Most runs
    occur once or twice, and are not sent.
    """
    n_docs = posts.agg(F.count("*"))
    low, high = cfg.ngram_range
    if low > 1 or high < 2:
        return choose_terms(post_stats(posts, text_col, cfg, stop_words), n_docs, cfg)
    single = cut_lineage(post_stats(posts, text_col, replace(cfg, ngram_range=(1, 1)), stop_words))
    usual = _frequent_words(single, n_docs, cfg)
    runs = post_stats(posts, text_col, replace(cfg, ngram_range=(2, high)), stop_words, usual)
    return choose_terms(single.unionByName(runs), n_docs, cfg)


def _few(terms: DataFrame) -> list[str] | None:
    """The terms, or nothing where there are too many to be sent to all tasks."""
    found = [r.term for r in terms.select("term").limit(BROADCAST_ROWS + 1).collect()]
    return found if len(found) <= BROADCAST_ROWS else None


def _frequent_words(single: DataFrame, n_docs: DataFrame, cfg: TfidfConfig) -> list[str] | None:
    """The words at least as frequent as the last of ``max_features`` terms that are words; nothing where any word may be part of a term."""
    n, least = choose_terms(single, n_docs, cfg).agg(F.count("*"), F.min("term_freq")).first()
    return _few(single.where(F.col("term_freq") >= least)) if n and n >= cfg.max_features else None


def choose_terms(stats: DataFrame, n_docs: DataFrame, cfg: TfidfConfig = TfidfConfig()) -> DataFrame:
    """The vocabulary from the statistics of all terms, and the one value of ``n_docs``."""
    kept = (
        stats.where(F.col("doc_freq") >= cfg.min_df)
        .withColumn("n_docs", n_docs.scalar())
        .where(F.col("doc_freq") <= cfg.max_df * F.col("n_docs"))
        .orderBy(F.desc("term_freq"), "term")
        .limit(cfg.max_features)
    )
    return kept.select("term", "doc_freq", "term_freq", idf(F.col("doc_freq"), F.col("n_docs")).alias("idf"), "n_docs")


def _weights(
    posts: DataFrame, model: DataFrame, text_col: str, id_col: str, cfg: TfidfConfig,
    stop_words: tuple[str, ...], how: str, dealt: bool = False,
) -> DataFrame:
    """Weights of the terms of each post that the model has; ``dealt`` brings the rows of an id together."""
    terms = _few(model) if cfg.max_features <= BROADCAST_ROWS else None
    listed = posts.select(id_col, gram_counts(_words(text_col, stop_words), cfg.ngram_range, terms).alias("_grams"))
    counts = _pairs(listed.repartition(id_col) if dealt else listed, id_col)
    vocabulary = broadcast_if_small(model.select("term", "idf"), cfg.max_features)
    return counts.join(vocabulary, "term", how).select(id_col, "term", (F.col("n") * F.col("idf")).alias("weight"))


def tfidf_vectors(
    posts: DataFrame,
    model: DataFrame,
    text_col: str = "content_clean",
    id_col: str = "tweet_id",
    cfg: TfidfConfig = TfidfConfig(),
    stop_words: tuple[str, ...] = ENGLISH_STOP_WORDS,
) -> DataFrame:
    """(id, term, tfidf), each post scaled to length 1. ``id_col`` is unique, so a window
    holds at most ``max_features`` rows.

    Lists of the model's terms are dealt by id, one for each post; the pairs that they hold then stay where they are.
    """
    weights = _weights(posts, model, text_col, id_col, cfg, stop_words, "inner", dealt=True)
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(id_col)))
    return weights.select(id_col, "term", (F.col("weight") / norm).alias("tfidf"))


def tfidf_row_stats(
    posts: DataFrame,
    model: DataFrame,
    text_col: str = "content_clean",
    id_col: str = "tweet_id",
    cfg: TfidfConfig = TfidfConfig(),
    stop_words: tuple[str, ...] = ENGLISH_STOP_WORDS,
) -> DataFrame:
    """Sum, mean and population deviation over all vocabulary dimensions of each post,
    zeros included, from the non-zero weights alone."""
    weights = _weights(posts, model, text_col, id_col, cfg, stop_words, "left")
    per_post = weights.groupBy(id_col).agg(
        F.coalesce(F.sum("weight"), F.lit(0.0)).alias("_sum"),
        F.coalesce(F.sum(F.col("weight") * F.col("weight")), F.lit(0.0)).alias("_squares"),
    )
    total = F.coalesce(F.try_divide(F.col("_sum"), F.sqrt("_squares")), F.lit(0.0))
    squares = F.when(F.col("_squares") > 0, 1.0).otherwise(0.0)
    sized = per_post.withColumns({"_width": model.agg(F.count("*")).scalar(), "tfidf_sum": total})
    mean = F.coalesce(F.try_divide(F.col("tfidf_sum"), F.col("_width")), F.lit(0.0))
    spread = F.coalesce(F.try_divide(squares, F.col("_width")), F.lit(0.0)) - mean * mean
    return sized.select(
        id_col, "tfidf_sum", mean.alias("tfidf_mean"),
        F.sqrt(F.greatest(spread, F.lit(0.0))).alias("tfidf_std"),
    )

