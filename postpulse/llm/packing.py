"""Best-fit packing of tokenised documents into sequences of a fixed length.

Documents become token ids, each followed by a separator id; longer ones are cut into pieces of ``capacity``
tokens, the last may be shorter. Only the number of pieces of each length matters for packing, so the plan is
made over the histogram of lengths (at most ``capacity`` rows) and applied to the pieces by their rank among
those of equal length.

Plan: Martello-Toth dominance first. A set holding the largest open piece is fixed for good where it provably
dominates every other set with this piece: it fills the sequence exactly, no second piece fits, or no three pieces fit and its partner
is the largest that fits. The rest goes by best fit in descending length, all pieces of a length at a time.

Defined results: NULL text counts as empty and still yields its separator; equal rows are packed separately; empty
input gives no rows; a NULL id stays NULL. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import bisect
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postpulse.llm.common import tidied
from postpulse.session import cut_lineage

CAPACITY = 4096
SEPARATOR = 1
#: Chunks whose ids each worker keeps.
MEMORY = 400_000
PUNCTUATION = ".,;:!?|%&$*#"
#: Bytes of text encoded at once.
SLICE = 6 << 20


class ChunkEncoder:
    """Ids of whole texts, put together from the ids of their chunks between white space.

    The tokenizer drops white space and never joins characters across it, so chunks can be encoded alone.
    A run of punctuation after a letter or digit is a token group of its own as well. Ids of chunks are remembered.
    """

    def __init__(self, path: str, memory: int = MEMORY):
        from tokenizers import Tokenizer

        self.tokenizer, self.memory, self.known = Tokenizer.from_file(path), memory, {"": b""}
        self.closes = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.closes[[n for token, n in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True

    def _learn(self, bodies: list[str]) -> None:
        """Words of letters are encoded many at a time, and told apart by the marks at word ends."""
        plain, known = [x for x in bodies if x.isalpha()], self.known
        lines = [plain[i : i + 200] for i in range(0, len(plain), 200)]
        odd = [x for x in bodies if not x.isalpha()]
        for words, found in zip(lines, self.tokenizer.encode_batch_fast([" ".join(w) for w in lines], add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            ends = (np.flatnonzero(self.closes[ids]) + 1).tolist()
            if len(ends) == len(words) and ends[-1] == len(ids):
                data = ids.tobytes()
                known.update(zip(words, (data[4 * a : 4 * b] for a, b in zip([0, *ends], ends))))
            else:
                odd += words
        for word, found in zip(odd, self.tokenizer.encode_batch_fast(odd, add_special_tokens=False)):
            known[word] = np.array(found.ids, "<u4").tobytes()

    def chunks(self, chunks: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each chunk."""
        if len(self.known) > self.memory:
            self.known = {"": b""}
        known, parts = self.known, {}
        for chunk in chunks:
            if chunk not in known:
                body = chunk.rstrip(PUNCTUATION)
                if not body[-1:].lower()[-1:].isalnum():
                    body = chunk
                folded = body.lower() if body.isascii() and "<|" not in body else body
                parts[chunk] = folded, chunk[len(body) :]
        self._learn([x for x in {x for pair in parts.values() for x in pair} if x not in known])
        for chunk, (body, tail) in parts.items():
            known[chunk] = known[body] + known[tail]
        return [known[c] for c in chunks]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text."""
        lists = pc.utf8_split_whitespace(texts)
        spots = np.flatnonzero(pc.match_substring_regex(texts, "[\x1c-\x1f]").to_numpy(zero_copy_only=False))
        if len(spots):  # white space for Arrow and Python, but not for the tokenizer
            split = lists.to_pylist()
            for i in spots:
                split[i] = re.split(r"[^\S\x1c-\x1f]+", texts[i].as_py())
            lists = pa.array(split, pa.list_(pa.string()))
        coded = lists.flatten().dictionary_encode()
        values = self.chunks(coded.dictionary.to_pylist())
        lengths = np.array([len(v) // 4 for v in values], np.int64)
        ids, codes = np.frombuffer(b"".join(values), "<u4"), coded.indices.to_numpy(zero_copy_only=False)
        if not len(codes):
            return [ids] * len(texts)
        each = lengths[codes]
        ends = np.cumsum(each)
        firsts = (np.cumsum(lengths) - lengths)[codes]
        placed = ids[np.repeat(firsts - (ends - each), each) + np.arange(ends[-1])]
        bounds = np.concatenate(([0], ends))[lists.offsets.to_numpy()]
        return np.split(placed, bounds[1:-1])


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """One encoder for each worker process; its memory outlives a task."""
    if path not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of the documents: doc_id, piece, start, length, ids_crc32, and their ids if asked for."""
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    end = np.array([SEPARATOR], "<u4")
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in batches:
            texts, at = pc.fill_null(batch.column(1), ""), 0
            sizes = np.cumsum(pc.binary_length(texts).to_numpy())
            while at < len(texts):
                # A few megabytes at a time, so that what is held follows the longest text and not the batch.
                to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + SLICE, side="right")))
                rows = []
                for doc, ids in zip(batch.column(0)[at:to].to_pylist(), encode(texts[at:to])):
                    ids = np.append(ids, end)
                    for n, first in enumerate(range(0, len(ids), capacity)):
                        own = ids[first : first + capacity]
                        rows.append((doc, n, first, len(own), zlib.crc32(own.tobytes())) + (own.tolist(),) * with_ids)
                columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names)
                at = to

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + with_ids]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(tidied(cut), schema)


@dataclass
class Group:
    """Equal sequences: how many, and what each holds as (length, times)."""

    count: int
    items: list[tuple[int, int]] = field(default_factory=list)
    used: int = 0


def reduce_by_dominance(left: dict[int, int], capacity: int) -> list[Group]:
    """Take dominating sets out of ``left`` (pieces of each length) and return them."""
    fixed, lengths = [], sorted(k for k, n in left.items() if n)

    def take(times: int, *items: int) -> None:
        fixed.append(Group(times, [(x, 1) for x in items] if len(set(items)) > 1 or len(items) == 1 else [(items[0], 2)], sum(items)))
        for x in items:
            left[x] -= times
            if not left[x]:
                del left[x]
                lengths.pop(bisect.bisect_left(lengths, x))

    # Sequences filled exactly by one or two pieces.
    for x in list(lengths):
        if x == capacity and left.get(x):
            take(left[x], x)
        elif 2 * x == capacity and left.get(x, 0) > 1:
            take(left[x] // 2, x, x)
        elif 2 * x < capacity and left.get(x) and left.get(capacity - x):
            take(min(left[x], left[capacity - x]), x, capacity - x)
    # The largest piece, while two more can't join it; its best single partner then dominates.
    while lengths:
        big = lengths[-1]
        left[big] -= 1
        others = lengths if left[big] else lengths[:-1]
        room = capacity - big
        fits = bisect.bisect_right(others, room)
        two = (others[0] * 2 if left[others[0]] > 1 else others[0] + others[1] if len(others) > 1 else room + 1) if others else room + 1
        partner = others[fits - 1] if fits else None
        left[big] += 1
        if partner is None:
            take(left[big], big)
        elif two > room:
            take(left[big] // 2 if partner == big else min(left[big], left[partner]), big, partner)
        else:
            break
    return fixed


def best_fit(left: dict[int, int], capacity: int) -> list[Group]:
    """Best fit in descending length over counted pieces."""
    rooms: dict[int, list[Group]] = {}
    order: list[int] = []

    def put(group: Group) -> None:
        room = capacity - group.used
        if room not in rooms:
            bisect.insort(order, room)
            rooms[room] = []
        rooms[room].append(group)

    for length in sorted(left, reverse=True):
        n = left[length]
        while n:
            at = bisect.bisect_left(order, length)
            if at < len(order):
                room = order[at]
                group = rooms[room].pop()
                if not rooms[room]:
                    del rooms[room]
                    order.pop(at)
            else:
                room, group = capacity, Group(-(-n // (capacity // length)))
            each = min(room // length, n)
            times = min(group.count, n // each)
            if times < group.count and room < capacity:
                put(Group(group.count - times, list(group.items), group.used))
            put(Group(times, group.items + [(length, each)], group.used + each * length))
            n -= times * each
    return [g for groups in rooms.values() for g in groups]


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> pd.DataFrame:
    """Slots for the pieces of each length: those ranked from ``first`` on, ``each`` to a sequence, from sequence
    ``sequence`` on at ``offset``."""
    left = {k: n for k, n in histogram.items() if n}
    rows, taken, sequence = [], dict.fromkeys(left, 0), 0
    for group in reduce_by_dominance(left, capacity) + best_fit(left, capacity):
        offset = 0
        for length, each in group.items:
            rows.append((length, taken[length], each, sequence, offset))
            taken[length] += group.count * each
            offset += each * length
        sequence += group.count
    return pd.DataFrame(rows, columns=["length", "first", "each", "sequence", "offset"], dtype="int64").sort_values(
        ["length", "first"], ignore_index=True
    )


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces."""
    spark = cut.sparkSession
    # Partitions of a checkpoint stay as they are, so that ranks can be taken by partition.
    cut = cut_lineage(cut).withColumn("_part", F.spark_partition_id())
    counts = cut.groupBy("_part", "length").agg(F.count("*").alias("_n"))
    ahead = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("_part", "length", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_base"))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    slots = spark.sparkContext.broadcast(plan(histogram, capacity))
    within = Window.partitionBy("_part", "length").orderBy(F.col("doc_id").asc_nulls_last(), "piece")
    ranked = cut.join(bases, ["_part", "length"]).withColumn("_rank", F.col("_base") + F.row_number().over(within) - 1)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = slots.value
        # Ranks stay below 2**48, lengths below 2**15.
        starts = (table["length"].to_numpy() << 48) + table["first"].to_numpy()
        for batch in batches:
            slot = np.searchsorted(starts, (batch["length"].to_numpy() << 48) + batch["_rank"].to_numpy(), side="right") - 1
            own = table.iloc[slot]
            beyond = batch["_rank"].to_numpy() - own["first"].to_numpy()
            each = own["each"].to_numpy()
            out = batch.drop(columns=["_part", "_base", "_rank"])
            out["sequence_id"] = own["sequence"].to_numpy() + beyond // each
            out["offset"] = own["offset"].to_numpy() + beyond % each * batch["length"].to_numpy()
            yield out[[*names, "sequence_id", "offset"]]

    names = [c for c in cut.columns if c != "_part"]
    kinds = dict(cut.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in names) + ", sequence_id bigint, offset bigint"
    return ranked.mapInPandas(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack ``docs``."""
    return pack(pieces(docs, tokenizer, capacity, with_ids), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The token ids of each sequence, from pieces packed with their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
