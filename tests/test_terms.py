"""Term statistics and TF-IDF against a dense computation in numpy."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from postpulse.config import TfidfConfig
from postpulse.functions.lexicon import ENGLISH_STOP_WORDS
from postpulse.operators import tfidf
from postpulse.sinks.storage import load_model, save_model

TEXTS = [
    "nifty up strong rally nifty", "the and of", "", "nifty rally down", "market rally market nifty up",
    "sensex नमस्ते दुनिया rally", "a b c", "rally", "nifty strong rally sensex", "single_term rally nifty strong",
]


def frame(spark, texts):
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "tweet_id string, content_clean string")


def grams(text):
    words = [w for w in re.findall(r"\w\w+", text) if w not in ENGLISH_STOP_WORDS]
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def dense(texts, cfg):
    counts = [Counter(grams(t)) for t in texts]
    df, tf = Counter(), Counter()
    for c in counts:
        df.update(c.keys())
        tf.update(c)
    kept = [t for t in df if df[t] >= cfg.min_df and df[t] <= cfg.max_df * len(texts)]
    kept = sorted(kept, key=lambda t: (-tf[t], t))[: cfg.max_features]
    idf = {t: np.log((1 + len(texts)) / (1 + df[t])) + 1 for t in kept}
    matrix = np.array([[c[t] * idf[t] for t in kept] for c in counts]).reshape(len(texts), len(kept))
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return kept, idf, np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


@pytest.mark.parametrize("cfg", [TfidfConfig(), TfidfConfig(max_features=3), TfidfConfig(max_df=0.5), TfidfConfig(min_df=1)])
def test_tfidf_matches_dense(spark, cfg):
    # Python's \w leaves out marks, as the token pattern does.
    posts = frame(spark, TEXTS)
    kept, idf, matrix = dense(TEXTS, cfg)
    model = tfidf.fit_vocabulary(posts, cfg=cfg).cache()
    rows = {r.term: r for r in model.collect()}
    assert set(rows) == set(kept)
    assert all(rows[t].idf == pytest.approx(idf[t]) and rows[t].n_docs == len(TEXTS) for t in kept)
    vectors = {(r.tweet_id, r.term): r.tfidf for r in tfidf.tfidf_vectors(posts, model, cfg=cfg).collect()}
    want = {(str(i), t): matrix[i, j] for i in range(len(TEXTS)) for j, t in enumerate(kept) if matrix[i, j]}
    assert vectors == pytest.approx(want)
    stats = {r.tweet_id: r for r in tfidf.tfidf_row_stats(posts, model, cfg=cfg).collect()}
    assert len(stats) == len(TEXTS)
    for i in range(len(TEXTS)):
        assert stats[str(i)].tfidf_sum == pytest.approx(matrix[i].sum())
        assert stats[str(i)].tfidf_mean == pytest.approx(matrix[i].mean())
        assert stats[str(i)].tfidf_std == pytest.approx(matrix[i].std(), abs=1e-7)


def test_term_counts_and_ranges(spark):
    posts = frame(spark, ["bb aa bb cc", "xx"])
    unigrams = tfidf.term_counts(posts, cfg=TfidfConfig(ngram_range=(1, 1)))
    assert {(r.tweet_id, r.term): r.n for r in unigrams.collect()} == {("0", "aa"): 1, ("0", "bb"): 2, ("0", "cc"): 1, ("1", "xx"): 1}
    longer = tfidf.term_counts(posts, cfg=TfidfConfig(ngram_range=(2, 3)))
    assert {r.term for r in longer.collect() if r.term} == {"bb aa", "aa bb", "bb cc", "bb aa bb", "aa bb cc"}
    # A post without terms keeps a row.
    assert longer.where("tweet_id = '1'").first().term is None


def test_empty_vocabulary(spark):
    posts = frame(spark, ["the", ""])
    model = tfidf.fit_vocabulary(posts)
    assert model.count() == 0
    assert {tuple(r)[1:] for r in tfidf.tfidf_row_stats(posts, model).collect()} == {(0.0, 0.0, 0.0)}


def test_stored_model_is_reused(spark, tmp_path):
    posts = frame(spark, TEXTS)
    save_model(tfidf.fit_vocabulary(posts), str(tmp_path / "model"))
    other = frame(spark, ["nifty nifty unseen words"])
    vectors = tfidf.tfidf_vectors(other, load_model(spark, str(tmp_path / "model"))).collect()
    assert [(r.term, r.tfidf) for r in vectors] == [("nifty", 1.0)]


def test_only_term_totals_are_shuffled(spark):
    posts = frame(spark, TEXTS)
    stats = tfidf.term_stats(tfidf.term_counts(posts))._jdf.queryExecution().executedPlan().toString()
    assert stats.count("Exchange hashpartitioning") == 1 and "partial_sum" in stats
    model = tfidf.fit_vocabulary(posts)
    vectors = tfidf.tfidf_vectors(posts, model)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in vectors
    # Texts are dealt by id below the listing of terms, and the pairs above it stay in place.
    assert vectors.count("Exchange hashpartitioning(tweet_id") == 1
    assert vectors.index("Window") < vectors.index("Generate") < vectors.index("Exchange hashpartitioning(tweet_id")


def test_hot_term(spark):
    posts = spark.range(3000).select(
        F.col("id").cast("string").alias("tweet_id"),
        F.concat(F.lit("hot hot "), F.when(F.col("id") % 3 == 0, "rare").otherwise("often")).alias("content_clean"),
    )
    rows = {r.term: (r.doc_freq, r.term_freq) for r in tfidf.term_stats(tfidf.term_counts(posts)).collect()}
    assert rows["hot"] == (3000, 6000) and rows["rare"] == (1000, 1000) and rows["hot often"] == (2000, 2000)


def test_vocabulary_of_days_adds_up(spark, data, tmp_path):
    from postpulse.checks.queries import cleaned
    from postpulse.sinks import term_store, versioned

    base = str(tmp_path / "models")
    posts = cleaned(spark, data).select("tweet_id", "timestamp", "content_clean").cache()
    posts = posts.union(spark.createDataFrame([("x", None, "market market undated"), ("y", None, "")], posts.schema)).cache()
    late = F.to_date("timestamp") >= "2024-01-12"
    whole = sorted(map(tuple, tfidf.fit_vocabulary(posts).collect()))
    first = term_store.replace_days(spark, base, posts.where(~late | F.col("timestamp").isNull()))
    part = sorted(map(tuple, term_store.load_vocabulary(spark, base).collect()))
    term_store.replace_days(spark, base, posts.where(late))
    # A day that is run again doesn't count twice.
    again = posts.where("to_date(timestamp) = DATE '2024-01-15'")
    last = term_store.replace_days(spark, base, again)
    assert sorted(map(tuple, term_store.load_vocabulary(spark, base).collect())) == whole != part
    assert sorted(map(tuple, term_store.load_vocabulary(spark, base, version=first.number).collect())) == part
    assert last.number == 3 and versioned.VersionedTables(spark, base).versions() == [1, 2, 3]
    with pytest.raises(ValueError):
        term_store.replace_days(spark, base, again, cfg=TfidfConfig(ngram_range=(1, 3)))
    # A loaded model weighs posts as a fitted one.
    model = term_store.load_vocabulary(spark, base)
    rows = lambda m: sorted(map(tuple, tfidf.tfidf_vectors(again, m).collect()))
    assert rows(model) == rows(tfidf.fit_vocabulary(posts))


@pytest.mark.parametrize("cfg", [TfidfConfig(max_features=m, ngram_range=r, min_df=1) for m in (2, 5, 400) for r in ((1, 1), (1, 3), (2, 3))])
def test_runs_of_rare_words_are_left_out_before_they_are_sent(spark, cfg, monkeypatch):
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{min(int(x), 60)}" for x in rng.exponential(8, n)) for n in rng.integers(0, 40, 60)] + ["", "aa aa aa aa aa aa bb"]
    posts = frame(spark, texts).repartition(3)
    sent = []
    plain = tfidf.post_stats
    monkeypatch.setattr(tfidf, "post_stats", lambda *a: sent.append(plain(*a)) or sent[-1])
    model = [tuple(r)[:3] for r in tfidf.fit_vocabulary(posts, cfg=cfg).collect()]
    every = tfidf.term_stats(tfidf.term_counts(posts, cfg=cfg)).where("doc_freq <= 0.95 * 62").collect()
    assert model == sorted(map(tuple, every), key=lambda r: (-r[2], r[0]))[: cfg.max_features]
    if cfg.ngram_range == (1, 3) and cfg.max_features < 10:
        # Of some thousand distinct runs a few reach the shuffle.
        assert len(sent) == 2 and 0 < sent[1].count() < sum(" " in r.term for r in every) / 10


def test_weights_list_only_terms_of_the_model(spark):
    posts = frame(spark, [*TEXTS, None])
    terms = ["nifty", "strong rally"]
    listed = posts.select("tweet_id", F.explode_outer(tfidf.gram_counts(F.col("content_clean"), terms=terms)).alias("e")).select("tweet_id", "e.*")
    every = {tuple(r) for r in tfidf.term_counts(posts).collect() if r.term in terms}
    rows = [tuple(r) for r in listed.collect()]
    assert {r for r in rows if r[1]} == every and len(every) == 7
    # A post without any keeps its row.
    assert {r[0] for r in rows} == {str(i) for i in range(len(TEXTS) + 1)}
