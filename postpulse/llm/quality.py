"""Quality of texts: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader.

Words are runs of letters and digits, and runs of other marks; a word that repeats the one before it becomes the same mark whatever the word.
Words and pairs of neighbouring words are hashed into ``DIMS`` buckets. A text is the vector of log(1 + occurrences), of unit length, and its score the logistic function of a sparse dot product with the
weights, so scoring is one narrow pass with the weights broadcast.

Weights are learned from at most about ``SAMPLE`` labelled documents, taken by a hash of their id with an equal share of every label,
so that neither the labelled table nor a label gathers in a task: only hashed counts of this sample reach the driver.

Defined results: NULL and empty texts have no features and get the score of the bias; without a labelled row every score is 0.5;
labels that are NULL or neither 0 nor 1, and rows without an id, teach nothing; a document with several labels teaches each distinct one once;
equal rows get a row each; an empty table gives no rows. Only ``doc_id`` and ``text`` are read, and of the labels ``doc_id`` and ``quality``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postpulse.llm.common import map_texts, tidied

BITS = 18
DIMS = 1 << BITS
#: Bound of the labelled documents that are learned from.
SAMPLE = 8000
THRESHOLD = 0.3
#: Words remembered by a task.
MEMORY = 150_000

WORDS = re.compile(r"\w+|[^\w\s]+")
#: Stands for a word that repeats the one before it.
REPEAT = np.uint64(0x27D4EB2F165667C5)
#: Fixed odd factors of the hash of a pair.
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)


class Hashes(dict):
    """64-bit hashes of words; recent ones are remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) > MEMORY:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word.encode(errors="replace"))
        return value


HASHES = Hashes()


def forget() -> None:
    """Workers outlive their tasks, and hold a copy of this module each."""
    HASHES.clear()


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text in ascending order, and their values."""
    words = WORDS.findall(text) if text else []
    own = np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))
    again = np.flatnonzero(own[1:] == own[:-1]) + 1
    own[again] = REPEAT
    grams = np.concatenate((own * FACTORS[0], (own[:-1] * FACTORS[1] ^ own[1:]) * FACTORS[0]))
    at, n = np.unique((grams >> np.uint64(64 - BITS)).astype(np.int64), return_counts=True)
    x = np.log1p(n)
    norm = np.sqrt(x @ x)
    return at, x / norm if norm else x


@dataclass
class Model:
    weights: np.ndarray
    bias: float = 0.0

    def score(self, at: np.ndarray, x: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-(x @ self.weights[at] + self.bias))))


def train(
    rows: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = 4,
    alpha: float = 3.0, beta: float = 1.0, l1: float = 0.1, l2: float = 0.01,
) -> Model:
    """Weights by follow-the-regularised-leader over rows of (label, buckets, values), in an order fixed by a seed."""
    z, n = np.zeros(DIMS + 1), np.zeros(DIMS + 1)

    def weights(at) -> np.ndarray:
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - l1, 0)
        return -shrunk / ((beta + np.sqrt(n[at])) / alpha + l2)

    rows = [(label, np.append(at, DIMS), np.append(x, 1.0)) for label, at, x in rows]
    rng = np.random.default_rng(0)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            label, at, x = rows[i]
            w = weights(at)
            g = (1 / (1 + np.exp(-(x @ w))) - label) * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
    full = weights(np.arange(DIMS + 1))
    return Model(full[:-1], float(full[-1]))


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, label and text of about ``sample`` labelled documents, the same ones in every run."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    known = known.where("doc_id IS NOT NULL AND label IN (0, 1)").distinct()
    share = sample / max(known.count(), 1)
    # Half of the 64-bit hashes are negative: shares are of the upper 32 bits.
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("sample")), 32) < int(min(share, 1.0) * (1 << 32))
    # About ``sample`` rows, whatever the number of labels.
    picked = F.broadcast(known.where(draw))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("text IS NOT NULL")
    return texts.join(picked, "doc_id").select("doc_id", "label", "text")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Model of ``labels.quality`` from the texts of ``docs``."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(text) for text in batch.column(2).to_pylist()]
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.list_(pa.int32()), pa.list_(pa.float32())))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], ["doc_id", "label", "at", "x"])

    schema = "doc_id bigint, label int, at array<int>, x array<float>"
    # Repeated rows of a document teach once.
    taken = labelled_sample(docs, labels, sample).mapInArrow(tidied(hashed, forget), schema).toArrow().combine_chunks()
    order, seen, rows = taken.sort_by([("doc_id", "ascending"), ("label", "ascending")]), set(), []
    for r in order.to_batches():
        for doc, label, at, x in zip(*[r.column(i) for i in range(4)]):
            at, x = at.values.to_numpy(), x.values.to_numpy().astype(np.float64)
            key = (doc.as_py(), label.as_py(), at.tobytes())
            if key not in seen:
                seen.add(key)
                rows.append((label.as_py(), at, x))
    return train(rows)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score (likelihood of label 1) and predicted label of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(texts: list) -> tuple[list, list]:
        scores = [shared.value.score(*features(text)) for text in texts]
        return scores, [int(s >= threshold) for s in scores]

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_texts(rows, make, {"score": ("double", pa.float64()), "predicted": ("int", pa.int32())}, done=forget)
