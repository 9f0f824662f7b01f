"""Benchmark passages in documents, found by one Aho-Corasick automaton over normalised text.

Words are runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z in lower case. Every
``window`` consecutive words of a benchmark item form a pattern; an item with fewer words is one pattern.
Text and patterns are joined with single blanks, so that a pattern with a blank on both sides can only match
whole words. Hits are mapped back to code-point offsets of the original text.

The patterns of a benchmark are broadcast in blocks of at most ``block_patterns``; documents are scanned
once for each block, and one block holds several thousand items.

Defined results: NULL and empty texts have no words and no hits; equal rows each get their own result; an
empty benchmark or empty documents give no hits or no rows; items without words match nothing; a NULL item
id is listed as ``null``. Of the input only ``doc_id``, ``text`` and ``item_id``, ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postpulse.llm.common import keep_where, map_texts

WINDOW = 10
BLOCK_PATTERNS = 50_000

#: Lower-cases A-Z and turns every byte that is no word byte into a blank. Bytes of UTF-8 beyond ASCII belong to words.
FOLD = bytes(b if chr(b).isalnum() or b > 127 else 32 for b in bytes(range(256)).lower())

ITEMS = ("array<string>", pa.list_(pa.string()))
SO_FAR = {"hits": ("array<int>", pa.list_(pa.int32())), "items": ITEMS}
FOUND = {
    "n_words": ("bigint", pa.int64()), "n_hit": ("bigint", pa.int64()), "items": ITEMS,
    "spans": ("array<struct<start:int,end:int>>", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
}


def words_of(text: str | None) -> list[bytes]:
    return text.encode(errors="replace").translate(FOLD).split() if text else []


def patterns(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per distinct pattern, with the ids of its items."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = set()
            for item, text in zip(batch["item"], batch["text"]):
                words = words_of(text)
                for i in range(max(1, len(words) - window + 1) if words else 0):
                    out.add((b" ".join(words[i : i + window]).decode("latin-1"), item))
            yield pd.DataFrame(sorted(out), columns=["pattern", "item"])

    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), "text")
    return items.mapInPandas(cut, "pattern string, item string").groupBy("pattern").agg(F.collect_set("item").alias("items"))


def _spans(text: str, hit: np.ndarray) -> list[tuple[int, int]]:
    """Code-point ranges of the runs of hit words."""
    raw = np.frombuffer(text.encode(errors="replace"), np.uint8)
    folded = np.frombuffer(raw.tobytes().translate(FOLD), np.uint8) != 32
    edges = np.diff(np.concatenate(([0], folded.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    runs = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
    first, last = np.flatnonzero(runs == 1), np.flatnonzero(runs == -1) - 1
    return [(int(points[starts[a]]), int(points[ends[b]])) for a, b in zip(first, last)]


def _machine(block: list[tuple[str, list[str]]]) -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for pattern, items in block:
        machine.add_word(f" {pattern} ", (len(pattern) + 2, items))
    machine.make_automaton()
    return machine


def _scanner(shared):
    """Adds what one block of patterns finds to the hits and items so far."""
    machines = []

    def scan(texts: list, before: list, known: list) -> tuple[list, list]:
        if not machines:
            machines.append(_machine(shared.value))
        hits, names = [], []
        for text, found, items in zip(texts, before, known):
            seen, words = set(items), words_of(text)
            if words:
                line = f" {b' '.join(words).decode('latin-1')} "
                ends = None
                for end, (length, own) in machines[0].iter(line):
                    if ends is None:
                        ends = np.cumsum([len(w) + 1 for w in words])
                    last = int(np.searchsorted(ends, end))
                    first = int(np.searchsorted(ends, end - length + 1, side="right"))
                    found += (first, last + 1)
                    seen.update(own)
            hits.append(found)
            names.append(sorted(seen))
        return hits, names

    return scan


def _finish(texts: list, hits: list, items: list) -> tuple[list, list, list, list]:
    totals, counts, spans = [], [], []
    for text, found in zip(texts, hits):
        words = words_of(text)
        hit = np.zeros(len(words), bool)
        for a, b in zip(found[0::2], found[1::2]):
            hit[a:b] = True
        totals.append(len(words))
        counts.append(int(hit.sum()))
        spans.append([{"start": a, "end": b} for a, b in _spans(text, hit)] if found else [])
    return totals, counts, items, spans


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_patterns: int = BLOCK_PATTERNS
) -> DataFrame:
    """Words, hit words, items and spans of each document."""
    scanned = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text",
        F.array().cast("array<int>").alias("hits"), F.array().cast("array<string>").alias("items"),
    )
    for shared in _blocks(patterns(benchmark, window), block_patterns):
        scanned = map_texts(scanned, _scanner(shared), SO_FAR, passed=2)
    return map_texts(scanned, _finish, FOUND)


def _blocks(found: DataFrame, size: int) -> Iterator:
    """Broadcasts of at most ``size`` patterns. They arrive partition by partition; the driver holds one block at a time."""
    block: list[tuple[str, list[str]]] = []
    for row in found.toLocalIterator():
        block.append((row.pattern, list(row["items"])))
        if len(block) == size:
            yield found.sparkSession.sparkContext.broadcast(block)
            block = []
    if block:
        yield found.sparkSession.sparkContext.broadcast(block)


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_patterns: int = BLOCK_PATTERNS
) -> DataFrame:
    """``docs`` without the documents that contain a pattern; all columns are kept as they are."""
    for shared in _blocks(patterns(benchmark, window), block_patterns):
        docs = keep_where(docs, _clean(shared))
    return docs


def _clean(shared):
    """Whether no pattern occurs in a text."""
    machines = []

    def clean(text: str | None) -> bool:
        if not machines:
            machines.append(_machine(shared.value))
        words = words_of(text)
        return not words or next(machines[0].iter(f" {b' '.join(words).decode('latin-1')} "), None) is None

    return clean
