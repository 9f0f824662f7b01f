"""Importance resampling of documents towards a target text collection, on hashed word n-grams.

Features of a text are its words and its pairs of neighbouring words (joined by one blank), each hashed by CRC-32 into ``buckets``. The
gain of a bucket is the log ratio of its smoothed share in the target to that in the corpus; a document's weight is the mean
gain of its features. Gumbel noise on top of the weight, and a cut at the highest scores, draws without replacement in proportion
to the importance.

Counts of the corpus come by segment deduplication: texts are cut into lines at line feeds, which separate words too. Equal lines are
counted first, so that the features of a line are hashed once and multiplied by its occurrences; pairs of words across the end of a line are
added from the first and last words of neighbouring lines, blank lines skipped. Tasks add up buckets before they send, so the shuffles carry distinct lines and
at most ``buckets`` rows of each task.

Defined results: NULL and empty texts, and those without words, have no features, weight 0, and are drawn only with ``min_words`` 0; an
empty target or corpus leaves the smoothing only; equal scores go to the smaller id, a missing id comes last; repeated rows are
documents of their own; an empty table gives no rows. Only ``doc_id`` and ``text`` (of the target: ``text``) are read.
"""

from __future__ import annotations

import math
import zlib
from array import array
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postpulse.llm.common import free_name, stored
from postpulse.operators.frames import with_ordinal

BUCKETS = 10_000
SEED = 7
PERCENT = 25
MIN_WORDS = 20
#: Words remembered by a task.
MEMORY = 200_000
#: Longest word, with its blank, whose pairs are hashed by table.
LONGEST = 48

#: Letters and digits of ASCII in lower case, line feeds and all other bytes beyond ASCII as they are, the rest blank.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or c == 10 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def folded(text: str | None) -> bytes:
    return text.encode(errors="replace").translate(FOLD) if text else b""


def _zero_bytes(longest: int) -> np.ndarray:
    """What n zero bytes make of each byte of a CRC register, as [n, byte, value]."""
    one = np.array([zlib.crc32(b"\0", v ^ 0xFFFFFFFF) ^ 0xFFFFFFFF for v in range(256)], np.uint32)
    rows = [np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)]
    out = []
    for _ in range(longest + 1):
        out.append(rows)
        rows = [(r >> np.uint32(8)) ^ one[r & np.uint32(255)] for r in rows]
    return np.array(out)


class WordHasher:
    """CRC-32 of words and of pairs; the CRC of a pair follows from those of its words, so that no pair is put together."""

    def __init__(self, memory: int = MEMORY):
        self.memory, self.after = memory, _zero_bytes(LONGEST).ravel()
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.words: list[bytes] = []
        self.own, self.blank, self.size = array("I"), array("I"), array("I")

    def codes(self, words: list[bytes]) -> np.ndarray:
        """Number of each word; numbers hold until the next call."""
        if len(self.known) > self.memory:
            self.clear()
        known = self.known
        for word in set(words).difference(known):
            known[word] = len(self.words)
            self.words.append(word)
            self.own.append(zlib.crc32(word))
            self.blank.append(zlib.crc32(b" " + word))
            self.size.append(len(word) + 1)
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def single(self, codes: np.ndarray) -> np.ndarray:
        return np.frombuffer(self.own, np.uint32)[codes] if len(codes) else np.empty(0, np.uint32)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(left):
            return np.empty(0, np.uint32)
        crc, size = np.frombuffer(self.own, np.uint32)[left], np.frombuffer(self.size, np.uint32)[right].astype(np.int64)
        long = np.flatnonzero(size > LONGEST)
        at = np.minimum(size, LONGEST) * 1024
        out = np.frombuffer(self.blank, np.uint32)[right].copy()
        for k in range(4):
            out ^= self.after[at + k * 256 + ((crc >> np.uint32(8 * k)) & np.uint32(255))]
        for i in long.tolist():
            out[i] = zlib.crc32(b" " + self.words[right[i]], int(crc[i]))
        return out


def _line_features(buckets: int):
    """Bucket counts of lines (column 0) that occur n times (column 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, hasher = np.zeros(buckets, np.int64), WordHasher()
        for batch in batches:
            split = [folded(line).split() for line in batch.column(0).to_pylist()]
            sizes = np.array([len(s) for s in split], np.int64)
            times = np.repeat(batch.column(1).to_numpy(), sizes)
            codes = hasher.codes([w for s in split for w in s])
            inside = np.ones(len(codes), bool)
            inside[np.cumsum(sizes)[sizes > 0] - 1] = False
            at = np.flatnonzero(inside)
            np.add.at(total, hasher.single(codes) % buckets, times)
            np.add.at(total, hasher.pairs(codes[at], codes[at + 1]) % buckets, times[at])
        yield _bucket_batch(total)

    return run


def _border_features(buckets: int):
    """Bucket counts of the pairs of words across line ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, hasher = np.zeros(buckets, np.int64), WordHasher()
        for batch in batches:
            words, skip = [], []
            for text in batch.column(0).to_pylist():
                for line in folded(text).split(b"\n"):
                    first = line.split(None, 1)
                    if first:
                        words += (first[0], line.rsplit(None, 1)[-1])
                skip.append(len(words))
            codes = hasher.codes(words)
            # The last word of a line, and the first one of the next line of the same text.
            last, following = codes[1:-1:2], codes[2::2]
            same = np.ones(len(last), bool)
            ends = np.array(skip, np.int64) // 2 - 1
            same[ends[(ends >= 0) & (ends < len(last))]] = False
            np.add.at(total, hasher.pairs(last[same], following[same]) % buckets, 1)
        yield _bucket_batch(total)

    return run


def _bucket_batch(total: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])


def feature_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Occurrences of all features of the column ``text`` in each bucket."""
    lines = texts.select(F.explode(F.split("text", "\n")).alias("line")).groupBy("line").agg(F.count("*").alias("n"))
    within = lines.mapInArrow(_line_features(buckets), "bucket int, n bigint")
    across = texts.select("text").where(F.contains("text", F.lit("\n"))).mapInArrow(_border_features(buckets), "bucket int, n bigint")
    out = np.zeros(buckets, np.int64)
    for r in within.union(across).groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row for each bucket at most
        out[r.bucket] = r.n
    return out


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of smoothed shares in thousandths, rounded down."""
    corpus, aim = float(raw.sum() + len(raw)), float(target.sum() + len(target))
    pairs = zip(raw.astype(float).tolist(), target.astype(float).tolist())
    return np.array([math.floor(1000 * math.log((t + 1) * corpus / ((s + 1) * aim))) for s, t in pairs], np.int64)


def noise(doc: int | None, seed: int = SEED) -> int:
    """Gumbel noise of a document in thousandths, the same in every run."""
    h = int(sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score_documents(docs: DataFrame, gains: np.ndarray, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)
    names = ["doc_id", "n_words", "n_features", "weight", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain, hasher = shared.value, WordHasher()
        for batch in batches:
            split = [folded(text).split() for text in batch.column(1).to_pylist()]
            sizes = np.array([len(s) for s in split], np.int64)
            codes = hasher.codes([w for s in split for w in s])
            value = gain[hasher.single(codes) % len(gain)]
            value[:-1] += gain[hasher.pairs(codes[:-1], codes[1:]) % len(gain)]
            ends = np.cumsum(sizes)
            # A pair across two texts is none: the last word of each counts alone.
            last = ends[sizes > 0] - 1
            value[last] = gain[hasher.single(codes[last]) % len(gain)]
            upto = np.concatenate(([0], np.cumsum(value)))
            count = np.maximum(2 * sizes - 1, 0)
            weight = np.where(count > 0, (upto[ends] - upto[ends - sizes]) // np.maximum(count, 1), 0)
            drawn = np.array([noise(doc, seed) for doc in batch.column(0).to_pylist()], np.int64)
            columns = [pa.array(c, pa.int64()) for c in (sizes, count, weight, weight + drawn)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    schema = ", ".join(f"{n} bigint" for n in names)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, schema)


def draw(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """Add ``rank`` to the drawn rows: the highest scores among those of ``min_words`` or more, ``percent`` of a hundred of them.

    ``scored`` should be a stored table. Only numbers are sorted, in range partitions.
    """
    fit = F.col("n_words") >= min_words
    placed = with_ordinal(scored.where(fit), [F.desc("score"), F.asc_nulls_last("doc_id")], "_at", "_all")
    ranked = placed.withColumn("rank", F.when(F.col("_at") < F.floor(F.col("_all") * percent / 100), F.col("_at") + 1))
    return ranked.drop("_at", "_all").union(scored.where(~fit).withColumn("rank", F.lit(None).cast("bigint")))


def importance_resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED, buckets: int = BUCKETS
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank (NULL for those not drawn) of each row of ``docs``."""
    gains = bucket_gains(feature_counts(docs, buckets), feature_counts(target, buckets))
    return draw(stored(score_documents(docs, gains, seed), "scored"), percent, min_words)


def keep_drawn(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents with all their columns. Rows of one id stay together: all are kept if one is drawn."""
    ranked = importance_resample(docs, target, **options)
    name = free_name(docs, "_drawn_id")
    ids = ranked.where(F.col("rank").isNotNull()).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids[name]), "left_semi")
