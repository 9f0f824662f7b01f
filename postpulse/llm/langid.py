"""Language of documents: multinomial logistic regression over TF-IDF of character 1- to 3-grams.

N-grams of lower-cased letters (all else is a blank) are hashed into ``DIMS`` buckets. Document frequencies are
counted over all labelled rows. Weights are learned by follow-the-regularised-leader with an elastic net, on at
most ``SAMPLE_PER_LANG`` rows of each language (those with the smallest hash of their id), and the softmax is calibrated by a
temperature fitted on a fifth of this sample which the weights have not seen.

Defined results: NULL text and text without a letter are ``und`` with score 0; without any labelled row
every text is ``und``; equal rows each get their own row; empty input gives no rows; rows with a NULL label or id teach nothing.
Only ``doc_id``, ``text`` and, for learning, ``lang`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postpulse.llm.common import keep_where, map_texts, release

BITS = 15
DIMS = 1 << BITS
SAMPLE_PER_LANG = 1000
UNKNOWN = "und"
#: Letters of the first plane; code points beyond it are looked up one by one.
LETTERS = np.array([chr(c).isalpha() for c in range(1 << 16)])
MIX = np.uint64(0x9E3779B97F4A7C15)


def letters_of(text: str) -> np.ndarray:
    """Lower-case code points, each run of other characters as one 0, with a 0 at both ends."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    keep = LETTERS[np.minimum(codes, 0xFFFF)]
    high = np.flatnonzero(codes > 0xFFFF)
    if len(high):
        keep[high] = [chr(c).isalpha() for c in codes[high]]
    codes = np.concatenate(([0], np.where(keep, codes, 0), [0])).astype(np.uint64)
    return codes[np.concatenate(([True], (codes[1:] != 0) | (codes[:-1] != 0)))]


def term_counts(text: str | None) -> np.ndarray | None:
    """Occurrences of each bucket, or nothing for a text without letters."""
    codes = letters_of(text) if text else ()
    if len(codes) < 3:
        return None
    grams = [codes, codes[:-1] * np.uint64(0x1000003) + codes[1:] + np.uint64(7)]
    grams.append(grams[1][:-1] * np.uint64(0x1000193) + codes[2:])
    buckets = (np.concatenate(grams) * MIX) >> np.uint64(64 - BITS)
    return np.bincount(buckets.astype(np.int64), minlength=DIMS)


def weigh(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and their weights of unit length."""
    at = np.flatnonzero(counts)
    x = np.log1p(counts[at]) * idf[at]
    norm = np.sqrt(x @ x)
    return at, x / norm if norm else x


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, counts: np.ndarray) -> np.ndarray:
        at, x = weigh(counts, self.idf)
        return x @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = term_counts(text) if self.langs else None
        if counts is None:
            return UNKNOWN, 0.0
        p = softmax(self.logits(counts) / self.temperature)
        best = int(p.argmax())
        return self.langs[best], float(p[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(
    rows: list[tuple[str, np.ndarray, np.ndarray]], df: np.ndarray, n_docs: int, epochs: int = 3,
    alpha: float = 0.5, beta: float = 1.0, l1: float = 0.01, l2: float = 0.01,
) -> Model:
    """Weights by follow-the-regularised-leader over rows of (language, buckets, counts), then the temperature."""
    langs = sorted({r[0] for r in rows})
    model = Model(langs, np.log((1 + n_docs) / (1 + df)) + 1, np.zeros((DIMS, len(langs))), np.zeros(len(langs)))
    if not rows:
        return model
    order = np.random.default_rng(0).permutation(len(rows))
    data = []
    for i in order:
        lang, at, counts = rows[i]
        x = np.log1p(counts) * model.idf[at]
        norm = np.sqrt(x @ x)
        data.append((langs.index(lang), np.append(at, np.int32(DIMS)), np.append(x / norm if norm else x, 1.0)))
    held, fit = data[: len(data) // 5], data[len(data) // 5 :]
    z, n = np.zeros((DIMS + 1, len(langs))), np.zeros((DIMS + 1, len(langs)))

    def weights(at):
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - l1, 0)
        return -shrunk / ((beta + np.sqrt(n[at])) / alpha + l2)

    for _ in range(epochs):
        for label, at, x in fit:
            w = weights(at)
            p = softmax(x @ w)
            p[label] -= 1
            g = x[:, None] * p
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    full = weights(np.arange(DIMS + 1))
    model.weights, model.bias = full[:-1], full[-1]
    if held:
        scores = np.array([x @ full[at] for _, at, x in held])
        labels = np.array([label for label, _, _ in held])
        grid = np.geomspace(0.05, 10, 60)
        loss = [-np.log(softmax(scores / t)[np.arange(len(labels)), labels] + 1e-300).mean() for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
    return model


def fit(labelled: DataFrame, per_lang: int = SAMPLE_PER_LANG) -> Model:
    """Model from rows of doc_id, text and lang."""
    rows = labelled.select("doc_id", "text", "lang").where("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(DIMS, np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                counts = term_counts(text)
                if counts is not None:
                    total += counts > 0
                    n += 1
        at = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": np.append(at, -1), "n": np.append(total[at], n)})

    found = rows.select("text").mapInPandas(frequencies, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    df, n_docs = np.zeros(DIMS), 0
    for r in found.collect():  # at most one row per bucket
        if r.bucket < 0:
            n_docs = r.n
        else:
            df[r.bucket] = r.n
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    picked = rows.select("doc_id", "lang").withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= per_lang)
    # At most ``per_lang`` ids of each language.
    sample = rows.join(F.broadcast(picked.select("doc_id").distinct()), "doc_id", "left_semi")

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, lang, text in zip(batch["doc_id"], batch["lang"], batch["text"]):
                counts = term_counts(text)
                if counts is not None:
                    at = np.flatnonzero(counts)
                    out.append((doc, lang, at.astype(np.int32), counts[at].astype(np.int32)))
            yield pd.DataFrame(out, columns=["doc_id", "lang", "at", "counts"])

    taken = sample.select("doc_id", "lang", "text").mapInPandas(
        features, "doc_id bigint, lang string, at array<int>, counts array<int>"
    ).toArrow()
    model = train(rows_of(taken), df, n_docs)
    # The driver goes on to other work: what the sample took is given back.
    del taken
    release()
    return model


def rows_of(sample: pa.Table) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """Language, buckets and counts of each row by id, as views into one copy of the sample."""
    sample = sample.sort_by([("doc_id", "ascending"), ("lang", "ascending")]).combine_chunks()
    if not len(sample):
        return []
    at, counts = (sample[name].chunk(0) for name in ("at", "counts"))
    bounds = at.offsets.to_numpy()
    flat = [column.values.to_numpy() for column in (at, counts)]
    return [(lang, *[values[i:j] for values in flat]) for lang, i, j in zip(sample["lang"].to_pylist(), bounds, bounds[1:])]


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(texts: list) -> tuple:
        return tuple(zip(*[shared.value.predict(text) for text in texts])) or ([], [])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_texts(rows, make, {"lang_pred": ("string", pa.string()), "score": ("double", pa.float64())})


def keep_recognised(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """``docs`` whose language is recognised with a score of ``least`` or more; all columns are kept as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(text: str | None) -> bool:
        lang, score = shared.value.predict(text)
        return lang != UNKNOWN and score >= least

    return keep_where(docs, keep)
