"""Alignment of two tokenizations of each text: token groups over the same bytes, links between overlapping tokens, and their counts.

Tokenizer A is a byte-level BPE and reads a blank and the text; tokenizer B is a piece model, which adds this blank itself. Each token
stands for some bytes, so a text becomes two ascending arrays of end offsets. Where both have an end, a group is closed.

The arrays are compared at the current shift of their indices, with steps that double while whole blocks agree and halve
after: a stretch of one-to-one tokens is jumped over in a few comparisons. At its end, the tokens up to the next common end are
walked one by one, and the shift is set anew.

Where neither tokenizer can have a token across the place before a blank that follows a word (known from their files), texts are cut there, and
what is encoded and aligned is each new word: these follow each other in one text. A worker remembers words up to a bound, and a text's ids and path are those
of its words. With other files whole texts are encoded and aligned.

The result is a path: for each byte range between neighbouring ends one code, 1 where a token of A ends, 2 where one of B ends,
3 where both do. Each code is a link of one token of A with one of B, and each 3 closes a group, so links and groups follow from running sums.

Counts of linked id pairs over the corpus are added up in each task before they are shuffled. Up to ``PAIRS`` different pairs they are broadcast
for the sums of each document; beyond it, documents send their distinct pairs to a join.

Defined results: NULL and empty texts, and texts that the tokens of A or B do not spell exactly, have no tokens, groups or links;
repeated rows each count and get a row each; a NULL id stays NULL; an empty table gives no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from hashlib import sha256
from itertools import chain, count, groupby, islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postpulse.llm.common import stored, tidied

#: Pairs of ids whose counts are broadcast, 17 bytes each.
PAIRS = 1_000_000
#: Bytes of text aligned at once.
SLICE = 1 << 20
#: Words that a worker remembers, and their letters; beyond either it begins anew.
WORDS, LETTERS = 200_000, 4_000_000
#: Words that the piece model reads at once: its time grows faster than the text.
GROUP = 100
#: Links counted at once.
LINKS = 1_000_000
#: Rows of an alignment that are worked on at once.
ROWS = 250
ONE_A, ONE_B, BOTH = 1, 2, 3
SHIFT = 32
#: The blank before a word, and one that follows other whitespace.
BREAK, RAGGED = re.compile(r" (?<=\S )"), re.compile(r" (?<=\s )")


def byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones as they are, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Spelling:
    """The bytes of each id."""

    def __init__(self, tokens: list[bytes]):
        self.tokens, self.sizes = pa.array(tokens, pa.large_binary()), np.array([len(t) for t in tokens], np.int64)

    def ends(self, ids: np.ndarray, data: bytes) -> list[int] | None:
        """End offsets of tokens; nothing where they don't spell ``data``."""
        ends = np.cumsum(self.sizes[ids])
        if len(ids) == 0 or ends[-1] != len(data):
            return None
        spelled = self.tokens.take(pa.array(ids)).buffers()[2]
        return ends.tolist() if spelled.slice(0, len(data)).equals(pa.py_buffer(data)) else None


class ByteTokenizer:
    """Ids by a byte-level BPE file, and the bytes of each id.

    The file's own library is slow. Where each merge makes the next id, ids are ranks, and the faster library for ranks gives the same ids.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        vocab, letters = given["model"]["vocab"], byte_alphabet()
        special = {t["content"] for t in given.get("added_tokens", []) if t.get("special")}
        tokens = [b""] * (max(vocab.values(), default=-1) + 1)
        ranks = {}
        for token, n in vocab.items():
            tokens[n] = token.encode() if token in special else bytes(letters[c] for c in token)
            if token not in special:
                ranks[tokens[n]] = n
        self.spelling = Spelling(tokens)
        merges = [m.split(" ") if isinstance(m, str) else m for m in given["model"]["merges"]]
        made = [vocab["".join(m)] for m in merges]
        step = given.get("pre_tokenizer") or {}
        plain = step.get("type") == "ByteLevel" and not step.get("add_prefix_space") and step.get("use_regex", True)
        self.by_words = plain and not given.get("normalizer") and made == list(range(256, 256 + len(made))) and len(ranks) == 256 + len(made)
        if self.by_words:
            # The pattern begins a token before each blank that follows no whitespace.
            import tiktoken

            own = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.encode = own.encode_ordinary
        else:
            from tokenizers import Tokenizer

            own = Tokenizer.from_file(path)
            own.encode_special_tokens = True
            self.encode = lambda text: own.encode(text, add_special_tokens=False).ids


class PieceTokenizer:
    """Ids by a piece model, and the bytes of each id."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.encode = model.encode_as_numpy
        pieces = [(n, model.id_to_piece(n)) for n in range(model.get_piece_size())]
        self.spelling = Spelling(
            [bytes([int(piece[3:-1], 16)]) if model.is_byte(n) else piece.replace("▁", " ").encode() for n, piece in pieces]
        )
        # Merges stay within words where they go by rank, none makes a piece with a blank after a letter, and texts are taken as they are.
        own = [n for n, _ in pieces if not (model.is_byte(n) or model.is_control(n) or model.is_unknown(n) or model.is_unused(n))]
        probe = " a  b \t" + "".join(map(chr, [*range(1, 0xD800), *range(0xE000, 0x110000)])) + "  "
        self.by_words = (
            all(model.get_score(n).is_integer() for n in own)
            and not any("▁" in piece.lstrip("▁") for _, piece in pieces)
            and model.normalize(probe) == "▁" + probe.replace(" ", "▁")
        )


@cache
def tokenizers(path_a: str, path_b: str) -> tuple[ByteTokenizer, PieceTokenizer]:
    """Loaded once in each worker."""
    return ByteTokenizer(path_a), PieceTokenizer(path_b)


def align_ends(a: list[int], b: list[int]) -> bytes:
    """Path through two ascending lists of ends, the last of which are equal."""
    out, i, shift, size = bytearray(), 0, 0, len(a)
    while i < size:
        # Whole blocks at this shift: steps double, then halve.
        start, step = i, 1
        while i < size and a[i : i + step] == b[i + shift : i + shift + step]:
            i += step
            step *= 2
        while step > 1 and i < size:
            step //= 2
            if a[i : i + step] == b[i + shift : i + shift + step]:
                i += step
        i = min(i, size)
        out += b"\3" * (i - start)
        if i == size:
            break
        # Up to the next common end.
        j = i + shift
        while a[i] != b[j]:
            if a[i] < b[j]:
                out.append(ONE_A)
                i += 1
            else:
                out.append(ONE_B)
                j += 1
        out.append(BOTH)
        i, j = i + 1, j + 1
        shift = j - i
    return bytes(out)


NO_IDS = np.empty(0, np.int32)


def align_ids(data: bytes, ids_a: np.ndarray, ids_b: np.ndarray, a: ByteTokenizer, b: PieceTokenizer) -> bytes:
    """The path between ids that spell ``data``; nothing where they don't."""
    ends_a, ends_b = a.spelling.ends(ids_a, data), b.spelling.ends(ids_b, data)
    return b"" if ends_a is None or ends_b is None else align_ends(ends_a, ends_b)


def align_text(text: str | None, a: ByteTokenizer, b: PieceTokenizer) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Ids of both tokenizers and the path between them."""
    if not text:
        return NO_IDS, NO_IDS, b""
    ids_a, ids_b = np.array(a.encode(" " + text), np.int32), np.array(b.encode(text), np.int32)
    path = align_ids(b" " + text.encode(errors="replace"), ids_a, ids_b, a, b)
    return (ids_a, ids_b, path) if path else (NO_IDS, NO_IDS, b"")


def words_of(text: str) -> list[str]:
    """The text cut at each blank that follows no whitespace; these blanks are left out. No word but the last ends in whitespace, and none is empty."""
    words = BREAK.split(text) if text[0] == " " or RAGGED.search(text) else text.split(" ")
    if not words[-1]:
        words[-2:] = [words[-2] + " "]
    return words


class Words:
    """Ids and paths of words with the blank before them, one after the other, and where each word's end. A word that isn't spelled has none."""

    def __init__(self, a: ByteTokenizer, b: PieceTokenizer, words: int = WORDS, letters: int = LETTERS):
        self.a, self.b, self.words, self.letters = a, b, words, letters
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = defaultdict(count().__next__)
        self.held, self.flat, self.ends = 0, [NO_IDS, NO_IDS, np.empty(0, np.uint8)], [np.zeros(1, np.int64)] * 3

    def _found(self, words: list[str]) -> list[tuple[list[np.ndarray], list[np.ndarray]]]:
        """Ids, path and ends of words that follow each other in one text."""
        text = " ".join(words)
        ids_a = np.array(self.a.encode(" " + text), np.int32)
        ids_b = np.concatenate([self.b.encode(" ".join(words[i : i + GROUP])) for i in range(0, len(words), GROUP)])
        path = align_ids(b" " + text.encode(), ids_a, ids_b, self.a, self.b)
        if not path and len(words) > 1:
            # Some word isn't spelled.
            half = len(words) // 2
            return self._found(words[:half]) + self._found(words[half:])
        if not path:
            return [([NO_IDS, NO_IDS, np.empty(0, np.uint8)], [np.zeros(1, np.int64)] * 3)]
        codes = np.frombuffer(path, np.uint8)
        ends = np.cumsum(pc.binary_length(pa.array(words, pa.large_string())).to_numpy() + 1)
        upto = [np.searchsorted(np.cumsum(t.spelling.sizes[i]), ends) + 1 for t, i in ((self.a, ids_a), (self.b, ids_b))]
        return [([ids_a, ids_b, codes], [*upto, np.searchsorted(np.cumsum(codes & 1, dtype=np.int64), upto[0]) + 1])]

    def _learn(self, words: list[str]) -> None:
        # Whitespace at the end of a word would join the next one's blank, and U+2581 is spelled as a blank.
        text = " ".join(words) + " "
        groups = [words]
        if "▁" in text or RAGGED.search(text):
            parts = [(alone, list(own)) for alone, own in groupby(words, lambda w: w[-1].isspace() or "▁" in w)]
            groups = [g for alone, own in parts for g in ([[w] for w in own] if alone else [own])]
        found = [f for group in groups for f in self._found(group)]
        self.held += len(text)
        for k in range(3):
            sizes = [np.diff(ends[k], prepend=0) for _, ends in found]
            self.ends[k] = np.concatenate((self.ends[k], self.ends[k][-1] + np.cumsum(np.concatenate(sizes))))
            self.flat[k] = np.concatenate([self.flat[k], *[flat[k] for flat, _ in found]])

    def align(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of A, of B and paths of all texts, one after the other, each with the offsets of the texts."""
        if len(self.number) > self.words or self.held > self.letters:
            self.forget()
        split = [words_of(text) if text else [] for text in texts]
        n, known = np.array([len(s) for s in split], np.int64), len(self.number)
        # New words get the next numbers.
        at = np.fromiter(map(self.number.__getitem__, chain.from_iterable(split)), np.int64, n.sum())
        if len(self.number) > known:
            self._learn(list(islice(reversed(self.number), len(self.number) - known))[::-1])
        # A text with a word that isn't spelled has no tokens.
        lost = np.concatenate(([0], np.cumsum(np.diff(self.ends[2])[at] == 0)))[np.concatenate(([0], np.cumsum(n)))]
        whole = np.diff(lost) == 0
        at, n = at[np.repeat(whole, n)], np.where(whole, n, 0)
        bounds = np.concatenate(([0], np.cumsum(n)))
        out = []
        for flat, ends in zip(self.flat, self.ends):
            sizes = ends[at + 1] - ends[at]
            upto = np.concatenate(([0], np.cumsum(sizes)))
            out.append((flat[np.repeat(ends[at] - upto[:-1], sizes) + np.arange(upto[-1])], upto[bounds]))
        return out


@cache
def known_words(path_a: str, path_b: str) -> Words:
    """What a worker remembers."""
    return Words(*tokenizers(path_a, path_b))


def align_texts(texts: list[str | None], path_a: str, path_b: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """As ``Words.align``, by words where both tokenizers allow it."""
    a, b = tokenizers(path_a, path_b)
    if a.by_words and b.by_words:
        return known_words(path_a, path_b).align(texts)
    found = [(ids_a, ids_b, np.frombuffer(path, np.uint8)) for ids_a, ids_b, path in (align_text(text, a, b) for text in texts)]
    return [(np.concatenate(parts), np.cumsum([0, *map(len, parts)])) for parts in zip(*found)]


ALIGNED = "doc_id bigint, row bigint, ids_a array<int>, ids_b array<int>, path binary"


def align_documents(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """doc_id, a number of the row, ids by A and by B, and the path of each text."""
    files = (path_a or public_tokenizers.path("byte_bpe_50k.json"), path_b or public_tokenizers.path("piece_bpe_32k.model"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy())
            at = 0
            while at < batch.num_rows:
                # What is held follows the longest text and not the batch.
                to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + SLICE, side="right")))
                *ids, (codes, ends) = align_texts(batch.column(1)[at:to].to_pylist(), *files)
                columns = [pa.ListArray.from_arrays(pa.array(e.astype(np.int32)), pa.array(i)) for i, e in ids]
                buffers = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(codes)]
                columns.append(pa.Array.from_buffers(pa.binary(), to - at, buffers))
                rows = pa.array(range(row, row + to - at), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0)[at:to], rows, *columns], ["doc_id", "row", "ids_a", "ids_b", "path"])
                row += to - at
                at = to

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(tidied(run), ALIGNED)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few rows at a time, so that what is held follows the longest texts and not the batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _flat(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy()


def _links(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Linked pairs (id of A in the upper half) and codes of all rows, and the number of links of each row.

    A path uses up the ids of its row, so the paths of a batch can be followed as one.
    """
    codes = np.frombuffer(b"".join(batch.column("path").to_pylist()), np.uint8)
    at_a, at_b = np.cumsum(codes & 1, dtype=np.int64) - (codes & 1), np.cumsum(codes >> 1, dtype=np.int64) - (codes >> 1)
    a, b = _flat(batch.column("ids_a")).astype(np.int64), _flat(batch.column("ids_b")).astype(np.int64)
    pairs = (a[at_a] << SHIFT) | b[at_b] if len(codes) else np.empty(0, np.int64)
    return pairs, codes, pc.binary_length(batch.column("path")).to_numpy().astype(np.int64)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """a, b, n and whether n is the highest of its b, for all linked pairs of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sums, waiting, size = np.empty(0, np.int64), np.empty(0, np.int64), [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            own, n = np.unique(np.concatenate(waiting), return_counts=True) if waiting else (keys[:0], sums[:0])
            every, at = np.unique(np.concatenate((keys, own)), return_inverse=True)
            return every, np.bincount(at, np.concatenate((sums, n)), len(every)).astype(np.int64)

        for batch in _slices(batches):
            waiting.append(_links(batch)[0])
            size += len(waiting[-1])
            if size > LINKS:
                keys, sums = merged()
                waiting, size = [], 0
                if len(keys) > LINKS:
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums)], ["pair", "n"])
                    keys, sums = keys[:0], sums[:0]
        keys, sums = merged()
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums)], ["pair", "n"])

    parts = aligned.select("ids_a", "ids_b", "path").mapInArrow(run, "pair bigint, n bigint")
    sums = parts.groupBy("pair").agg(F.sum("n").alias("n")).select(
        "pair", "n", F.col("pair").bitwiseAND(F.lit((1 << SHIFT) - 1)).alias("b")
    )
    sums = stored(sums, "pairs")
    # One row for each id of B.
    top = sums.groupBy("b").agg(F.max("n").alias("top"))
    return sums.join(F.broadcast(top), "b").select(
        F.shiftright("pair", SHIFT).alias("a"), "b", "n", (F.col("n") == F.col("top")).alias("best"), "pair"
    )


@cache
def decimals(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Digits of all numbers of that many bits, one more place after them, and how many there are."""
    numbers = np.arange(1 << bits)
    width = len(str(numbers[-1]))
    table = np.zeros((len(numbers), width + 1), np.uint8)
    table[:, :width] = numbers.astype(f"S{width}").view(np.uint8).reshape(-1, width)
    return table, (table > 0).sum(axis=1).astype(np.int32)


def group_texts(a: np.ndarray, b: np.ndarray, codes: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """Groups of ids of each row, as ``a1,a2|b1;a3|b2``; ``sizes`` are the ids of each row, of A and B together."""
    closed = np.flatnonzero(codes == BOTH)
    if not len(closed):
        return [b""] * len(sizes)
    ends_a, ends_b = np.cumsum(codes & 1, dtype=np.int64)[closed], np.cumsum(codes >> 1, dtype=np.int64)[closed]
    starts_b = np.concatenate(([0], ends_b[:-1]))
    # Places in the order of the text: ids of B follow those of A in each group.
    ids = np.empty(len(a) + len(b), np.int64)
    ids[np.arange(len(a)) + np.repeat(starts_b, np.diff(ends_a, prepend=0))] = a
    ids[np.arange(len(b)) + np.repeat(ends_a, np.diff(ends_b, prepend=0))] = b
    marks = np.full(len(ids), ord(","), np.uint8)
    marks[ends_a - 1 + starts_b], marks[ends_a + ends_b - 1] = ord("|"), ord(";")
    table, count = decimals(int(ids.max()).bit_length())
    letters, digits = table[ids], count[ids]
    letters[np.arange(len(ids)), digits] = marks
    data = letters[letters > 0].tobytes()
    ends = np.concatenate(([0], np.cumsum(digits + 1)))[np.concatenate(([0], np.cumsum(sizes)))].tolist()
    # Without the last mark.
    return [data[lo : max(lo, hi - 1)] for lo, hi in zip(ends, ends[1:])]


HEADS = {
    "doc_id": pa.int64(), "row": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(),
    "n_links": pa.int64(), "groups_sha256": pa.string(),
}
HEAD = ", ".join(f"{name} {'string' if name == 'groups_sha256' else 'bigint'}" for name in HEADS)


def _heads(batch: pa.RecordBatch, codes: np.ndarray, links: np.ndarray) -> list[pa.Array]:
    upto = np.concatenate(([0], np.cumsum(codes == BOTH)))
    ends = np.cumsum(links)
    sizes = [pc.list_value_length(batch.column(c)).to_numpy().astype(np.int64) for c in ("ids_a", "ids_b")]
    texts = group_texts(_flat(batch.column("ids_a")), _flat(batch.column("ids_b")), codes, sizes[0] + sizes[1])
    digests = [sha256(t).hexdigest() if t else "" for t in texts]
    made = [batch.column("doc_id"), batch.column("row"), *map(pa.array, sizes)]
    return [*made, pa.array(upto[ends] - upto[ends - links]), pa.array(links), pa.array(digests, pa.string())]


def summarise(aligned: DataFrame, counts: DataFrame, pairs: int = PAIRS) -> DataFrame:
    """Numbers of tokens, groups and links of each row of a stored alignment; how many links are the best of their id of B, the sum of
    their counts, and a digest of the groups. ``counts`` should be stored."""
    return _by_broadcast(aligned, counts) if counts.count() <= pairs else _by_join(aligned, counts)


def _by_broadcast(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    known = counts.select("pair", "n", "best").toArrow().sort_by("pair")
    table = tuple(known.column(c).to_numpy() for c in ("pair", "n", "best"))
    shared = aligned.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, best = shared.value
        for batch in _slices(batches):
            own, codes, links = _links(batch)
            at, ends = np.searchsorted(keys, own), np.cumsum(links)
            columns = _heads(batch, codes, links)
            for values in (best[at].astype(np.int64), n[at]):
                upto = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
                columns.append(pa.array(upto[ends] - upto[ends - links]))
            yield pa.RecordBatch.from_arrays(columns, [*HEADS, "n_best", "count_sum"])

    return aligned.mapInArrow(run, f"{HEAD}, n_best bigint, count_sum bigint").drop("row")


def _by_join(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """The distinct pairs of each row meet their counts in a shuffle."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            own, _, links = _links(batch)
            for row, keys in zip(batch.column("row").to_pylist(), np.split(own, np.cumsum(links)[:-1])):
                each, times = np.unique(keys, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([row] * len(each), pa.int64()), pa.array(each), pa.array(times)], ["row", "pair", "times"])

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            yield pa.RecordBatch.from_arrays(_heads(batch, *_links(batch)[1:]), list(HEADS))

    own = aligned.mapInArrow(spread, "row bigint, pair bigint, times bigint")
    sums = own.join(counts.select("pair", "n", "best"), "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")
    )
    joined = aligned.mapInArrow(heads, HEAD).join(sums, "row", "left").drop("row")
    return joined.withColumns({c: F.coalesce(c, F.lit(0).cast("bigint")) for c in ("n_best", "count_sum")})


def token_groups(aligned: DataFrame) -> DataFrame:
    """doc_id, number of the group, and its ids by A and B, one row for each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            _, codes, links = _links(batch)
            closed = np.flatnonzero(codes == BOTH)
            upto = [np.concatenate(([0], np.cumsum(bit)[closed])) for bit in (codes & 1, codes >> 1)]
            lists = [
                pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), batch.column(c).flatten())
                for c, cut in zip(("ids_a", "ids_b"), upto)
            ]
            owner = np.repeat(np.arange(len(links)), links)[closed]
            first = np.searchsorted(owner, owner)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(owner)), pa.array(np.arange(len(owner)) - first), *lists],
                ["doc_id", "number", "a", "b"],
            )

    return aligned.mapInArrow(run, "doc_id bigint, number bigint, a array<int>, b array<int>")


def alignment_counts(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, pairs: int = PAIRS) -> DataFrame:
    """``summarise`` of ``docs``; each text is tokenised once."""
    aligned = stored(align_documents(docs, path_a, path_b), "aligned")
    return summarise(aligned, stored(pair_counts(aligned), "counts"), pairs)
