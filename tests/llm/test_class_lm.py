"""The class language model: probabilities, learned classes, scores by the plain formula, held-out gain."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from postpulse.llm import class_lm, queries
from postpulse.llm.common import keyed, stored

SCHEMA = "doc_id bigint, text string"


def fitted(docs, **options):
    texts = keyed(docs)
    counts = stored(class_lm.word_counts(texts), "words")
    return class_lm.fit_tables(counts, texts, **options), {r.word: r.n for r in counts.collect()}


def grammar(spark, n=400, words=40):
    """Sentences that alternate between two kinds of words, every second of either kind rare."""
    rng = random.Random(8)
    kinds = [[f"{'ab'[k]}{i:02d}x" for i in range(words)] for k in range(2)]
    pick = lambda k: kinds[k][min(int(rng.expovariate(0.15)), words - 1)]
    rows = [(i, " ".join(pick(j % 2) for j in range(30))) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3), kinds


def test_words_get_the_class_of_their_neighbours(spark):
    docs, kinds = grammar(spark)
    model, counts = fitted(docs, top=8, classes=4)
    # All words but the eight most frequent are moved in the second step.
    classes = [Counter(model.own[model.table[w.encode()]] for w in kind if counts.get(w, 0) >= 10) for kind in kinds]
    assert not set(classes[0]) & set(classes[1]) and sum(classes[0].values()) > 15
    assert len(model.table) == len(counts) - 1


@pytest.mark.parametrize("local", [0, 7, 30, 150_000])
def test_probabilities_sum_to_one(spark, local):
    docs, _ = grammar(spark, 60)
    model, counts = fitted(docs, top=5, local=local, classes=3)
    assert len(model.table) <= local
    for before in (class_lm.END, 3, len(model.own) - 1):
        assert (10 ** (model.move[model.own[before], model.own] + model.emit)).sum() == pytest.approx(1)
    # Inside a shape: its words, and one place for a word that was never seen.
    inside = Counter()
    for word, n in counts.items():
        if word is not None and word.encode() not in model.table:
            inside[class_lm.shape_of(word.encode())] += n + 1
    for shape in range(class_lm.SHAPES):
        assert inside[shape] + 1 == pytest.approx(10 ** model.places[shape])


@pytest.mark.parametrize("local", [0, 12, 150_000])
def test_scores_follow_the_formula(spark, local):
    docs, _ = grammar(spark, 80)
    extra = spark.createDataFrame([(900, None), (901, ""), (902, "never seen words, a00x a01x"), (903, "a00x")], SCHEMA)
    teaches = F.col("doc_id") % 7 != 2
    got = {r.doc_id: r for r in class_lm.score(docs.union(extra), teaches, top=5, local=local, classes=3).collect()}
    given = docs.union(extra).where(teaches)
    model, counts = fitted(given, top=5, local=local, classes=3)
    for doc, text in docs.limit(20).union(extra).collect():
        units, value = [class_lm.END], 0.0
        for word in [*class_lm.words_of(text), None]:
            unit = class_lm.END if word is None else model.table.get(word, class_lm.shape_of(word))
            value += model.move[model.own[units[-1]], model.own[unit]] + model.emit[unit]
            if unit < class_lm.SHAPES:
                value += np.log10(counts.get(word.decode(), 0) + 1) - model.places[unit]
            units.append(unit)
        assert got[doc].score == pytest.approx(value)


def test_frequent_words_are_a_count_and_up(spark):
    rng = random.Random(1)
    rows = [(f"w{i}", rng.choice([1, 1, 2, 3, 5, 8, 900])) for i in range(500)]
    words = spark.createDataFrame(rows, "word string, n bigint")
    for most in (0, 10, 80, 300, 500):
        got = class_lm.frequent_words(words, most)
        assert len(got) <= most and got == sorted(got, key=lambda r: (-r[1], r[0]))
        least = min((n for _, n in got), default=901)
        assert len(got) == sum(n >= least for _, n in rows)
    assert class_lm.frequent_words(words.limit(0), 5) == []


def test_query_on_held_out_rows(spark, data):
    folder = data.replace("sf0.001", "sf0.01")
    got = queries.QUERIES["op5_lm_scoring"](spark, folder).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in got)
    held = [r for r in got if r.held_out]
    gain = sum(r.score - r.base_score for r in held) / sum(r.n_tokens for r in held)
    assert gain > 0.1
    # Words far down the list have learned classes, not those of their shapes.
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model, _ = fitted(docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2))
    words = list(model.table)[10_000:12_000]
    assert len(words) == 2000 and all(model.table[w] == class_lm.FIRST_WORD + 10_000 + i for i, w in enumerate(words))
    assert sum(model.own[model.table[w]] != model.own[class_lm.shape_of(w)] for w in words) > 500


def test_one_move_is_the_best_one():
    """The parallel step picks the class that the likelihood picks."""
    rng = np.random.default_rng(2)
    pairs = rng.integers(0, 50, (5, 5)).astype(float)
    sides = rng.integers(0, 9, (20, 10)).astype(float)
    now = rng.integers(0, 5, 20)
    for i in range(20):
        pairs[now[i]] += sides[i, 5:]
        pairs[:, now[i]] += sides[i, :5]
    got = class_lm.best_class(sides, now, pairs)

    def likelihood(i, k):
        table = pairs.copy()
        table[now[i]] -= sides[i, 5:]
        table[:, now[i]] -= sides[i, :5]
        table = np.maximum(table, 0)
        size = sides[i].sum() / 2
        into, out = table.sum(0), table.sum(1)
        into[k] += size
        out[k] += size
        new = table.copy()
        gain = class_lm._xlogx(table[k] + sides[i, 5:]).sum() - class_lm._xlogx(table[k]).sum()
        gain += class_lm._xlogx(table[:, k] + sides[i, :5]).sum() - class_lm._xlogx(table[:, k]).sum()
        return class_lm._xlogx(new).sum() + gain - class_lm._xlogx(into).sum() - class_lm._xlogx(out).sum()

    assert [int(np.argmax([likelihood(i, k) for k in range(5)])) for i in range(20)] == got.tolist()


def test_words_beyond_the_broadcast_ones_are_learned(spark):
    """How many words every task holds changes neither the classes nor the scores: the others get theirs through joins."""
    docs, _ = grammar(spark, 90)
    extra = spark.createDataFrame(
        [(900, None), (901, ""), (902, "never seen words, a00x a01x"), (903, "b39x a39x b38x b38x new a38x"), (903, "b39x a39x b38x b38x new a38x"), (None, "a37x b36x")], SCHEMA
    )
    given, teaches = docs.union(extra), F.col("doc_id") % 7 != 2
    model, counts = fitted(given.where(teaches), top=5, classes=3, held=20)
    whole, _ = fitted(given.where(teaches), top=5, classes=3)
    assert 5 <= len(model.table) <= 20 < len(whole.table) == len(counts) - 1
    assert all(model.own[i] == whole.own[whole.table[w]] for w, i in model.table.items())
    # Words outside the table are moved away from the class of their shape, so shapes hold unseen words only.
    assert any(whole.own[i] != whole.own[class_lm.shape_of(w)] for w, i in whole.table.items() if w not in model.table)
    assert model.move == pytest.approx(whole.move) and not model.places.any()
    want, got = ({(r.doc_id, r.n_tokens): r for r in class_lm.score(given, teaches, top=5, classes=3, held=n).collect()} for n in (150_000, 20))
    assert got.keys() == want.keys() and len(got) == 95
    for key, r in want.items():
        assert tuple(got[key])[:4] == tuple(r)[:4] and tuple(got[key])[4:] == pytest.approx(tuple(r)[4:])
