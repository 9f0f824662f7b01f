"""Similarity join of documents on the Jaccard index of their word shingles, as classes of linked documents.

The method is T-occurrence search: two sets of sizes a and b reach the similarity t when they share at least
T = ceil(t / (1 + t) * (a + b)) shingles, so a document is found by reading inverted lists and keeping those that occur
often enough. Lists are split as DivideSkip does: the long ones are set aside and probed by binary search, the short ones are merged.

1. Documents with equal sets form one class by their digest; one document of each, the smallest, goes on.
2. The lengths of inverted lists are counted, over all documents, for the shingles whose hash lies in the lowest ``UNIVERSE`` of
   its range. Shingles are ordered by that length; those without a count follow, and the ``LONG_LISTS`` longest (a
   bound on what is broadcast) come last. The order only steers the work: any order finds every link.
3. Of a set of n shingles, only the first n - ceil(t * n) + 1 in this order are merged: two similar sets share one of
   these. A document with that many shingles of its own needs no search at all. The remaining lists give connected families,
   a superset of the links, without listing pairs.
4. A family is searched in blocks: each block of documents is indexed, and each block of the family is streamed through it.
   Inside, lists beyond the merge threshold are probed, and documents which are linked already are not compared again,
   so a block pair gives at most a spanning forest.
5. Components of these exact links are the classes.

Defined results: a document without words or text has no shingles and is alone; one with fewer words than a shingle has its
whole sequence as one; repeated rows give a row each; a document without an id takes no part in the search, and gets the
class of documents with an equal set, else none. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postpulse.llm.common import KeyFilter, free_name, map_texts, release, shuffle_partitions, stored, tidied

WIDTH = 4
PERCENT = 85
LONG_LISTS = 200_000
#: Shingles that occur in fewer sets are never long.
LEAST_LONG = 32
#: Share of the shingles whose lists are counted; well above the share 1 - t that is merged.
UNIVERSE = 0.35
#: Words whose hashes a worker remembers.
MEMORY = 150_000
#: Documents of a block.
BLOCK = 1500

TABLE = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Fixed odd factors of the rolling sum over word hashes.
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


class WordHashes(dict):
    """64-bit hashes of words; recent ones are remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > MEMORY:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


HASHES = WordHashes()


def forget() -> None:
    """Workers outlive their tasks, and hold a copy of this module each."""
    HASHES.clear()


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles."""
    words = text.encode(errors="replace").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    own = np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))
    size = min(width, len(words))
    total = np.full(len(own) - size + 1, size, np.uint64)
    for i in range(size):
        total = (total + own[i : len(own) - size + 1 + i]) * FACTORS[i % len(FACTORS)]
        total ^= total >> np.uint64(29)
    total = np.sort(total)
    return total[np.concatenate(([True], total[1:] != total[:-1]))]


def counted(own: np.ndarray) -> np.ndarray:
    """Those of the sorted shingles whose lists are counted."""
    return own[: np.searchsorted(own, np.uint64(int(UNIVERSE * (1 << 64))))]


def prefix_size(n: int, percent: int) -> int:
    """Shingles of which two similar sets share at least one."""
    return n - (percent * n + 99) // 100 + 1


def digests(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles and a digest of the set for each row."""

    def make(texts: list) -> tuple[list, list]:
        sets = [shingles(t, width) for t in texts]
        return [len(s) for s in sets], [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_texts(rows, make, {"n_shingles": ("bigint", pa.int64()), "digest": ("binary", pa.binary())}, done=forget)


def long_lists(texts: DataFrame, width: int, bound: int = LONG_LISTS, least: int = LEAST_LONG) -> np.ndarray:
    """The shingles (first 40 bits) with the longest inverted lists, longest last. Counted over all documents."""
    buckets = 4 * shuffle_partitions(texts.sparkSession)

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            for text in batch["text"]:
                held.append(counted(shingles(text, width)) >> np.uint64(24))
                size += len(held[-1])
                if size > 2_000_000:
                    yield cut(held)
                    held, size = [], 0
        if size:
            yield cut(held)

    def cut(held):
        """Distinct values with their counts, by ranges; each range as the bytes of its steps, which compress well."""
        values, times = np.unique(np.concatenate(held), return_counts=True)
        bounds = np.searchsorted(values, (np.arange(1, buckets) * (UNIVERSE * (1 << 40) / buckets)).astype(np.uint64))
        out = []
        for bucket, (part, n) in enumerate(zip(np.split(values, bounds), np.split(times.astype("<u4"), bounds))):
            if len(part):
                steps = np.diff(part, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)
                planes = np.ascontiguousarray(steps.T[:5]).tobytes()
                out.append((bucket, zlib.compress(planes, 1), zlib.compress(n.tobytes(), 1)))
        return pd.DataFrame(out, columns=["bucket", "values", "times"])

    def count(group: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for data in group["values"]:
            planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(5, -1)
            steps = np.zeros((planes.shape[1], 8), np.uint8)
            steps[:, :5] = planes.T
            parts.append(np.cumsum(steps.view("<u8").ravel()))
        times = np.concatenate([np.frombuffer(zlib.decompress(data), "<u4") for data in group["times"]])
        values, at = np.unique(np.concatenate(parts), return_inverse=True)
        n = np.bincount(at, times).astype(np.int64)
        many = n >= least
        return pd.DataFrame({"value": values[many].astype(np.int64), "n": n[many]})

    sent = texts.select("text").mapInPandas(tidied(send, forget), "bucket int, values binary, times binary")
    lists = stored(sent.groupBy("bucket").applyInPandas(count, "value bigint, n bigint"), "lengths")
    # How many lists have each length tells where to cut; one task then sees little more than ``bound`` rows, and the driver ``bound`` as numbers.
    each = lists.groupBy("n").agg(F.count("*").alias("times")).toArrow().sort_by([("n", "descending")])
    so_far = np.cumsum(each["times"].to_numpy())
    cut = each["n"].to_numpy()[min(int(np.searchsorted(so_far, bound)), len(each) - 1)] if len(each) else least
    rows = lists.where(F.col("n") >= int(cut)).orderBy(F.desc("n"), "value").limit(bound).toArrow()
    values, n = rows["value"].to_numpy(), rows["n"].to_numpy()
    found = values[np.lexsort((values, -n))][::-1].astype(np.uint64)
    del rows, values, n
    release()
    return found


def merged_lists(texts: DataFrame, long: np.ndarray, width: int, percent: int) -> DataFrame:
    """(shingle, doc) of the lists that are merged: of each set the first shingles in the order, without those of one document."""
    at = np.argsort(long)
    shared = texts.sparkSession.sparkContext.broadcast((long[at], at))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        values, places = shared.value
        for batch in batches:
            parts, spares = [], []
            for text in batch["text"]:
                own = shingles(text, width)
                first = counted(own)
                rank = np.zeros(len(first), np.int64)
                if len(values) and len(first):
                    short = first >> np.uint64(24)
                    spot = np.minimum(np.searchsorted(values, short), len(values) - 1)
                    rank = np.where(values[spot] == short, places[spot] + 1, 0)
                usual = first[rank == 0]
                spare = len(usual) - prefix_size(len(own), percent) if len(own) else 0
                # What the counted shingles can't fill comes from the others: by hash, the long ones last.
                late = np.concatenate((own[len(first) :], first[np.argsort(rank, kind="stable")][len(usual) :]))[: max(0, -spare)]
                parts += [usual, late]
                spares += [spare, -len(own) - 1]
            sizes = [len(p) for p in parts]
            yield pd.DataFrame(
                {
                    "shingle": np.concatenate(parts).view(np.int64) if parts else [],
                    "doc": np.repeat(np.repeat(batch["doc"].to_numpy(), 2), sizes), "spare": np.repeat(spares, sizes),
                    "late": np.repeat(np.tile([False, True], len(parts) // 2), sizes),
                }
            )

    rows = texts.select("doc", "text").mapInPandas(tidied(run, forget), "shingle bigint, doc bigint, spare int, late boolean")
    # Late rows need no length. Their lists may be long, so each goes to a task of its own choice.
    spread = F.when(F.col("late"), F.xxhash64("shingle", "doc")).otherwise(F.col("shingle"))
    n = F.count("*").over(Window.partitionBy(spread, "late"))
    kept = rows.withColumn("n", n).where("late OR n > 1")
    # Late rows are few, and sorted in with a length beyond all others.
    of_doc = kept.groupBy("doc").agg(
        F.array_sort(F.collect_list(F.struct(F.when(F.col("late"), F.lit(1 << 60)).otherwise(F.col("n")).alias("n"), "shingle"))).alias("own"),
        F.max("spare").alias("spare"),
    )
    # ``spare`` of the counted ones can stay unused, if that many are its own.
    size = F.size("own") - F.greatest(F.col("spare"), F.lit(0))
    return of_doc.where(size > 0).select(F.explode(F.slice("own", F.lit(1), size)).alias("s"), "doc").select("s.shingle", "doc")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Each node of ``edges`` with the smallest node reachable from it: (node, root).

    Large-star and small-star steps; both keep the edges of a node in one sum-like aggregate, and the number of edges never grows.
    """
    edges = edges.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).where("lo < hi").distinct()
    edges = stored(edges, "edges")
    while True:
        before = edges
        # Large star: every larger neighbour is linked to the smallest neighbour.
        both = edges.select("lo", "hi").union(edges.select(F.col("hi").alias("lo"), F.col("lo").alias("hi")))
        least = both.groupBy("lo").agg(F.min("hi").alias("m")).select("lo", F.least("lo", "m").alias("m"))
        large = both.where("hi > lo").join(least, "lo").select(F.col("m").alias("lo"), "hi").where("lo < hi").distinct()
        # Small star: every smaller neighbour, and the node itself, is linked to the smallest one.
        mins = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(mins, "hi").select(F.explode(F.array(F.col("hi"), F.col("lo"))).alias("hi"), F.col("m").alias("lo"))
        edges = stored(small.where("lo < hi").select("lo", "hi").distinct(), "edges")
        same = edges.join(before, ["lo", "hi"], "left_anti").isEmpty() and edges.count() == before.count()
        if same:
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
                edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
            )


class Forest:
    """Union-find."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def links_between(index: list[np.ndarray], queries: list[np.ndarray], same: bool, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links from ``queries`` to ``index`` (positions), by T-occurrence search.

    With ``same`` both are one list, and only earlier positions are searched.
    """
    sizes = np.array([len(s) for s in index], np.int64)
    terms, inverse = np.unique(np.concatenate(index), return_inverse=True)
    owner = np.repeat(np.arange(len(index)), sizes)
    posts = owner[np.argsort(inverse, kind="stable")]
    lengths = np.bincount(inverse, minlength=len(terms))
    starts = np.concatenate(([0], np.cumsum(lengths)))
    shift = 0 if same else len(index)
    forest, found = Forest(len(index) + (0 if same else len(queries))), []
    for q, own in enumerate(queries):
        n = len(own)
        spot = np.minimum(np.searchsorted(terms, own), len(terms) - 1)
        lists = spot[terms[spot] == own]
        lists = lists[np.argsort(lengths[lists], kind="stable")]
        # Sizes between n * t and n / t. Needed of all lists, for the smallest of them.
        smallest = -(-percent * n // 100)
        need = -(-percent * (n + smallest) // (100 + percent))
        merged = len(lists) - need + 1
        if merged <= 0:
            continue
        # Long lists are set aside, as many as the threshold allows; the short ones are merged.
        short = np.concatenate([posts[starts[t] : starts[t + 1]] for t in lists[:merged]])
        counts = np.bincount(short, minlength=len(index))
        cands = np.flatnonzero(counts)
        if same:
            cands = cands[cands < q]
        a = sizes[cands]
        least = -(-percent * (n + a) // (100 + percent))
        cands = cands[(100 * np.minimum(a, n) >= percent * np.maximum(a, n)) & (counts[cands] + len(lists) - merged >= least)]
        # Most promising first: a link to one document of a class spares all others of it.
        for c in cands[np.argsort(-counts[cands], kind="stable")].tolist():
            if forest.find(c) == forest.find(q + shift):
                continue
            other = index[c]
            at = np.minimum(np.searchsorted(other, own), len(other) - 1)
            common = int((other[at] == own).sum())
            if 100 * common >= percent * (n + len(other) - common):
                forest.join(c, q + shift)
                found.append((c, q))
    return found


def family_links(members: DataFrame, texts: DataFrame, width: int, percent: int, block: int = BLOCK) -> DataFrame:
    """Links (a, b) inside families, given as (root, doc)."""
    # A family is dealt into blocks by a hash of the document; each pair of blocks is a group of its own.
    sized = members.groupBy("root").agg(F.count("*").alias("_n")).where("_n > 1")
    blocks = members.join(sized, "root").withColumn("_blocks", F.ceil(F.col("_n") / block).cast("int"))
    blocks = blocks.withColumn("_own", F.pmod(F.xxhash64("doc"), F.col("_blocks")).cast("int"))
    dealt = blocks.select("root", "doc", "_own", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other")).select(
        "root", "doc", "_own", F.least("_own", "_other").alias("_x"), F.greatest("_own", "_other").alias("_y")
    )
    # Only texts that may belong to a family are shuffled.
    texts = KeyFilter(members.select("doc")).rows(texts, ["doc"])
    dealt = dealt.join(texts, "doc").dropDuplicates(["root", "doc", "_x", "_y"])

    def search(group: pd.DataFrame) -> pd.DataFrame:
        x, y = group["_x"].iloc[0], group["_y"].iloc[0]
        first = group[group["_own"] == x].sort_values("doc")
        second = first if x == y else group[group["_own"] == y].sort_values("doc")
        if not len(first) or not len(second):
            return pd.DataFrame({"a": [], "b": []})
        index = [shingles(t, width) for t in first["text"]]
        queries = index if x == y else [shingles(t, width) for t in second["text"]]
        pairs = links_between(index, queries, x == y, percent)
        ids, others = first["doc"].to_numpy(), second["doc"].to_numpy()
        return pd.DataFrame({"a": [ids[a] for a, _ in pairs], "b": [others[b] for _, b in pairs]})

    return dealt.groupBy("root", "_x", "_y").applyInPandas(search, "a bigint, b bigint")


def jaccard_classes(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id for each row of ``docs``."""
    sets = stored(digests(docs, width), "sets")
    # Smallest document of each set.
    reps = sets.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("rep"))
    reps = stored(reps, "reps")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc"), "text").where("doc_id IS NOT NULL")
    lists = stored(merged_lists(texts, long_lists(texts, width), width, percent), "lists")
    # Each document of a list is tied to the smallest one. A long list is aggregated by tasks first, and split by the join.
    heads = lists.groupBy("shingle").agg(F.min("doc").alias("tie"))
    families = components(lists.join(heads, "shingle").where("doc > tie").select("tie", "doc"), "tie", "doc")
    # Of equal sets only one document is compared; the others share its class by their digest.
    members = stored(families.join(reps, families["node"] == reps["rep"], "left_semi"), "members")
    linked = components(family_links(members.select("root", F.col("node").alias("doc")), texts, width, percent))
    named = reps.join(linked, reps["rep"] == linked["node"], "left").select("digest", F.coalesce("root", "rep").alias("component_id"))
    return sets.join(named, "digest", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one_each(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``docs`` without the documents whose class has a smaller id. Documents without an id are kept."""
    classes = jaccard_classes(docs, width, percent)
    name = free_name(docs, "_gone")
    gone = classes.where("component_id < doc_id").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, docs["doc_id"] == gone[name], "left_anti")
