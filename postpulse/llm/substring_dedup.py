"""Removal of words in passages of ``window`` words or more that occur in an earlier document.

Passages are found with compressed FM-indexes over shards of the corpus. So that a document meets only shards that can hold
its passages, shards are dealt by content: of every window the smallest hash of its 8-word grams is an anchor, and all
windows with the same anchor form a region of some 70 words around it. Equal windows have the same anchor, so they meet
in its shard.

1. Regions are listed as hashes. Anchors of a single document are done with.
2. A region that occurs as it is in an earlier document is removed as a whole; of equal ones, only the first goes on.
3. Where an anchor has regions that differ, their texts go to the anchor's shard. There they are indexed, and streamed through
   the index: backward search over the wavelet matrix gives for each region the stretches that match an earlier document
   (matching statistics of at least ``window``).
4. An anchor with more than ``HOT`` different regions would make a shard of its own; its windows are compared one by one by
   hash instead, in a sum that tasks prepare before they send.

Defined results: NULL and empty texts have no words; texts of fewer words than a window keep all; rows equal in id and text are
one document for the search and a row each in the result; a document without an id keeps all and takes from none; an empty table gives no rows. Only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postpulse.llm.common import map_texts, stored, tidied
from postpulse.llm.fm_index import FMIndex, matching_windows
from postpulse.llm.jaccard import FACTORS, WordHashes

WINDOW = 50
#: Words of a gram, as a power of two.
GRAM = 8
#: Words of a shard.
SHARD = 400_000
HOT = 20_000
#: Bytes of passages sent on at once.
SLICE = 2 << 20

HASHES = WordHashes()


def forget() -> None:
    """Workers outlive their tasks, and hold a copy of this module each."""
    HASHES.clear()


def words_of(text: str | None) -> list[bytes]:
    return text.encode(errors="replace").split() if text else []


def hashes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))


def regions_of(own: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first word and number of words of each region of a text with the word hashes ``own``."""
    if len(own) < window:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    grams, size = own, 1
    while size < GRAM:
        grams = (grams[:-size] * FACTORS[0] + grams[size:]) * FACTORS[1]
        grams ^= grams >> np.uint64(31)
        size *= 2
    span = window - GRAM + 1
    low, at, width = grams, np.arange(len(grams)), 1
    while width < span:
        # The leftmost smallest gram of twice the width, or of just the span.
        step = min(width, span - width)
        other = low[step:] < low[: len(low) - step]
        at = np.where(other, at[step:], at[: len(at) - step])
        low = np.minimum(low[step:], low[: len(low) - step])
        width += step
    first = np.flatnonzero(np.diff(at, prepend=-1))
    last = np.append(first[1:], len(at)) - 1
    return grams[at[first]], first, last - first + window


def _regions(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, counts = [], []
            for text in batch.column(2):
                own = hashes_of(words_of(text.as_py()))
                anchors, first, size = regions_of(own, window)
                digests = [xxhash.xxh3_64_intdigest(own[a : a + n]) for a, n in zip(first.tolist(), size.tolist())]
                parts.append((anchors, first, size, np.array(digests, np.uint64)))
                counts.append(len(first))
            spots = pa.array(np.repeat(np.arange(len(counts)), counts))
            joined = [np.concatenate([p[i] for p in parts]) if parts else np.empty(0, np.int64) for i in range(4)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(spots), batch.column(1).take(spots), pa.array(joined[0].view(np.int64)),
                    pa.array(joined[1].astype(np.int32)), pa.array(joined[2].astype(np.int32)), pa.array(joined[3].view(np.int64)),
                ],
                ["doc", "tx", "anchor", "start", "size", "digest"],
            )

    return tidied(run, forget)


REGION = "doc bigint, tx bigint, anchor bigint, start int, size int, digest bigint"


PIECE = "doc bigint, tx bigint, anchor bigint, digest bigint, start int, words string"


def _texts(window: int):
    """Texts of the asked regions of each document; of hot ones the hashes of all windows.

    Batches hold doc, tx, text, and what is asked as lists of numbers: anchor, digest, start, size and hot.
    """
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
    names = [part.split()[0] for part in PIECE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, held = [], 0
            ends = batch.column(3).offsets.to_numpy()
            asked = [batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in range(3, 8)]
            for i, (doc, tx) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                words = words_of(batch.column(2)[i].as_py())
                rows = list(zip(*[a[ends[i] - ends[0] : ends[i + 1] - ends[0]].tolist() for a in asked]))
                own = hashes_of(words) if any(r[4] for r in rows) else None
                for anchor, digest, start, size, hot in rows:
                    if hot:
                        for at in range(start, start + size - window + 1):
                            out.append((doc, tx, anchor, xxhash.xxh3_64_intdigest(own[at : at + window]) - (1 << 63), at, None))
                        held += 8 * size
                    else:
                        out.append((doc, tx, anchor, digest, start, b" ".join(words[start : start + size]).decode()))
                        held += len(out[-1][-1])
                if held > SLICE:
                    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out), kinds)], names)
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out), kinds)], names)

    return tidied(run, forget)


def search_shard(group: pd.DataFrame, window: int) -> pd.DataFrame:
    """Stretches of each region that occur under a smaller document: anchor, digest, lo, hi."""
    split = [w.encode().split() for w in group["words"]]
    sizes = np.array([len(s) for s in split], np.int64)
    hashes = np.concatenate([hashes_of(s) for s in split])
    symbols = np.unique(hashes, return_inverse=True)[1] + 1
    starts = np.cumsum(sizes + 1) - sizes - 1
    text = np.zeros(int(sizes.sum()) + len(sizes), np.int64)
    inside = np.ones(len(text), bool)
    inside[starts + sizes] = False
    text[inside] = symbols
    docs = np.unique(group["doc"].to_numpy(), return_inverse=True)[1].astype(np.int32)
    # No match is longer than a region.
    index = FMIndex(text, np.repeat(docs, sizes + 1), int(sizes.max()))
    found = matching_windows(index, text, starts, sizes, docs, window)
    at = [f[0] for f in found]
    return pd.DataFrame(
        {
            "anchor": group["anchor"].to_numpy()[at], "digest": group["digest"].to_numpy()[at],
            "lo": [f[1] for f in found], "hi": [f[2] for f in found],
        }
    )


def repeated_spans(docs: DataFrame, window: int = WINDOW, hot: int = HOT, shard: int = SHARD) -> DataFrame:
    """doc, tx (hash of the text), lo, hi: word ranges that occur in a document with a smaller id; ranges may overlap."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc"), F.xxhash64("text").alias("tx"), "text").where("doc_id IS NOT NULL")
    every = stored(texts.mapInArrow(_regions(window), REGION), "regions")
    shared = every.groupBy("anchor").agg(F.min("doc").alias("a"), F.max("doc").alias("b")).where("a < b").select("anchor")
    rows = stored(every.join(shared, "anchor", "left_semi"), "shared")
    owners = stored(rows.groupBy("anchor", "digest").agg(F.min("doc").alias("owner")), "owners")
    whole = rows.join(owners, ["anchor", "digest"]).where("doc > owner").select(
        "doc", "tx", F.col("start").alias("lo"), (F.col("start") + F.col("size")).alias("hi")
    )
    # Anchors with different regions, of which at least two documents are the first owners.
    mixed = owners.groupBy("anchor").agg(F.count("*").alias("n"), F.min("owner").alias("a"), F.max("owner").alias("b")).where("a < b")
    asked = rows.join(owners, ["anchor", "digest"]).where("doc = owner").join(mixed, "anchor").select(
        "doc", "tx", "anchor", "digest", "start", "size", (F.col("n") > hot).alias("hot")
    )
    listed = F.collect_list(F.struct("anchor", "digest", "start", "size", "hot"))
    wanted = asked.groupBy("doc", "tx").agg(listed.alias("asked"))
    # One list of numbers for each field.
    wanted = wanted.select("doc", "tx", F.struct(*[F.col(f"asked.{c}").alias(c) for c in ("anchor", "digest", "start", "size", "hot")]).alias("asked"))
    cut = texts.join(wanted, ["doc", "tx"]).dropDuplicates(["doc", "tx"]).select("doc", "tx", "text", "asked.*")
    pieces = stored(cut.mapInArrow(_texts(window), PIECE), "pieces")
    cold = pieces.where("words IS NOT NULL")
    # One passage for each region; it stands for all its places in the owner.
    passages = cold.groupBy("anchor", "digest", "doc").agg(F.first("words").alias("words"))
    total = cold.agg(F.count("*")).first()[0]
    shards = max(1, total * 3 * window // (2 * shard))
    found = passages.groupBy(F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard")).applyInPandas(
        lambda group: search_shard(group, window), "anchor bigint, digest bigint, lo int, hi int"
    )
    partly = cold.join(found, ["anchor", "digest"]).select(
        "doc", "tx", (F.col("start") + F.col("lo")).alias("lo"), (F.col("start") + F.col("hi")).alias("hi")
    )
    single = pieces.where("words IS NULL")
    least = single.groupBy("anchor", "digest").agg(F.min("doc").alias("owner"))
    by_hash = single.join(least, ["anchor", "digest"]).where("doc > owner").select(
        "doc", "tx", F.col("start").alias("lo"), (F.col("start") + window).alias("hi")
    )
    return whole.union(partly).union(by_hash)


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, spans of removed words and the kept text (words joined by one blank) of each row."""
    spans = repeated_spans(docs, window).groupBy("doc", "tx").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    spans = spans.select("doc", "tx", F.col("spans.lo").alias("lo"), F.col("spans.hi").alias("hi"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("_tx"), "text")
    joined = rows.join(spans, (rows["doc_id"] == spans["doc"]) & (rows["_tx"] == spans["tx"]), "left").select("doc_id", "text", "lo", "hi")

    def make(texts: list, firsts: list, ends: list) -> tuple[list, list, list, list]:
        totals, removed, spans, kept = [], [], [], []
        for text, lo, hi in zip(texts, firsts, ends):
            words, ranges, gone = words_of(text), [], None
            if lo:
                marks = np.zeros(len(words) + 1, np.int64)
                np.add.at(marks, lo, 1)
                np.add.at(marks, hi, -1)
                gone = np.cumsum(marks)[:-1] > 0
                edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
                ranges = [{"lo": int(a), "hi": int(b)} for a, b in edges.reshape(-1, 2)]
            totals.append(len(words))
            removed.append(0 if gone is None else int(gone.sum()))
            spans.append(ranges)
            kept.append(b" ".join(words if gone is None else [w for w, g in zip(words, gone) if not g]).decode())
        return totals, removed, spans, kept

    ranges = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
    fields = {
        "n_words": ("bigint", pa.int64()), "n_removed": ("bigint", pa.int64()),
        "spans": ("array<struct<lo:int,hi:int>>", ranges), "kept": ("string", pa.string()),
    }
    return map_texts(joined, make, fields, done=forget)
