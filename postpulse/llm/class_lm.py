"""Class-based bigram model of words (Brown et al.), and the log probability of each text under it.

Words are runs without ASCII white space, A-Z in lower case; each text ends with an end mark. Every word of the training texts is a unit of its own;
a word that they lack belongs to a unit by its shape (length, first and last character). With ``local``, only so many of the most frequent words are
units, and all others go by shape.
Exchange clustering assigns units to classes so that the class bigrams of the training texts become most likely:

1. The ``top`` most frequent words and the shapes are moved one at a time, until no move helps.
2. With these classes fixed, the classes left and right of every other unit are summed over all training texts, and all of them are moved at once, each
   to the class that raises the likelihood most.
3. The class bigrams are counted anew.

    P(text) = product of P(class | class before) * P(unit | class) * P(word | unit)

Transitions are interpolated with class frequencies, emissions within a shape are add-one smoothed with one place
for unseen words, so probabilities add up to one. Word counts come from a shuffle over all training texts. ``held`` bounds what is
broadcast, not what is learned: the words above a count, which is found by a histogram of counts, are known to every task, and texts are stored as
their numbers. Each occurrence of another word is a row with the units beside it: shuffled by word it gets its class, by text the class that follows.

Defined results: NULL text is empty and consists of the end mark; rows equal in id and text are one document and one
row, but teach each time; a NULL id is never held out and teaches nothing; no training rows give uniform smoothing. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postpulse.llm.common import HASH, ID, KEY, stored, tidied

TOP = 480
#: Words that every task holds.
LOCAL = 150_000
CLASSES = 32
#: Share of the class bigram against the class frequency.
MIX = 0.95
SHAPES = 64
END = SHAPES
END_BYTES = np.int32(END).tobytes()
#: Units: the shapes, the end mark, then words, the most frequent ones first.
FIRST_WORD = SHAPES + 1
#: Steps of a doubling in the histogram of counts.
STEPS = 8


def words_of(text: str | None) -> list[bytes]:
    """``bytes.lower`` and ``bytes.split`` know ASCII only, as the definition asks."""
    return text.encode(errors="replace").lower().split() if text else []


def shape_of(word: bytes) -> int:
    """One of ``SHAPES``: four lengths, four kinds of last character, four kinds of first character."""
    n, last, first = len(word), word[-1], word[0]
    length = (n > 4) + (n > 8) + (n > 12)
    end = 0 if 97 <= last <= 122 else 1 if last == 44 else 2 if last in b".!?;:" else 3
    start = 0 if 97 <= first <= 109 else 1 if 109 < first <= 122 else 2 if first > 127 else 3
    return (length * 4 + end) * 4 + start


def word_counts(texts: DataFrame) -> DataFrame:
    """word, shape, n over all rows of ``texts``; each task counts before it sends."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        docs = 0

        def flush():
            words, counts = list(total), list(total.values())
            total.clear()
            return batch_of([w.decode() for w in words], [shape_of(w) for w in words], counts)

        def batch_of(words, shapes, counts):
            columns = [pa.array(words, pa.string()), pa.array(shapes, pa.int32()), pa.array(counts, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["word", "shape", "n"])

        for batch in batches:
            docs += batch.num_rows
            for text in batch.column(0).to_pylist():
                total.update(words_of(text))
                if len(total) > 500_000:
                    yield flush()
        yield flush()
        yield batch_of([None], [END], [docs])

    rows = texts.select("_text").mapInArrow(count, "word string, shape int, n bigint")
    return rows.groupBy("word", "shape").agg(F.sum("n").alias("n"))


class Units(dict):
    """Units of words: known ones from the table, others by shape; recent ones are remembered."""

    def __init__(self, table: dict[bytes, int], memory: int = 150_000):
        super().__init__(table)
        self.table, self.most = table, len(table) + memory

    def __missing__(self, word: bytes) -> int:
        if len(self) > self.most:
            self.clear()
            self.update(self.table)
        self[word] = unit = shape_of(word)
        return unit


def coded(texts: DataFrame, table: dict[bytes, int]) -> DataFrame:
    """The texts as units, stored: a number for each row, its units with the end mark behind them as 32-bit integers, and the words that
    ``table`` lacks, whose units are shapes here, in their order with blanks between them."""
    shared = texts.sparkSession.sparkContext.broadcast(table)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units(shared.value)
        for batch in batches:
            numbers, rest = [], []
            for text in batch.column(4).to_pylist():
                words = words_of(text)
                own = np.fromiter(map(units.__getitem__, words), np.int32, len(words))
                numbers.append(own.tobytes() + END_BYTES)
                rest.append(b" ".join([words[i] for i in np.flatnonzero(own < SHAPES).tolist()]))
            columns = [*batch.columns[:4], pa.array(numbers, pa.binary()), pa.array(rest, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["row", *KEY, "teaches", "units", "rest"])

    rows = texts.select(F.monotonically_increasing_id().alias("row"), F.col(ID).cast("bigint").alias(ID), HASH, "teaches", "_text")
    return stored(rows.mapInArrow(tidied(code), f"row bigint, {ID} bigint, {HASH} bigint, teaches boolean, units binary, rest string"), "units", compression="zstd")


def sequence(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The units of all rows one after the other behind an end mark, and how many each row has."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join([END_BYTES, *rows]), np.int32), np.array([len(r) // 4 for r in rows], np.int64)


def pair_sums(pairs: DataFrame, size: int) -> np.ndarray:
    """Counts by two groups, from rows of ``pair`` and ``n``."""
    out = np.zeros(size * size)
    for r in pairs.groupBy("pair").agg(F.sum("n").alias("n")).collect():  # at most one row for each pair of groups
        out[r.pair] = r.n
    return out.reshape(size, size)


def pairs_in(total: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["pair", "n"])


def neighbours(texts: DataFrame, group: np.ndarray) -> np.ndarray:
    """How often the groups of neighbouring units of the coded ``texts`` follow each other; a text starts after the end mark of another."""
    size = int(group.max()) + 1
    shared = texts.sparkSession.sparkContext.broadcast(group)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        for batch in batches:
            own = shared.value[sequence(batch.column(0))[0]]
            total += np.bincount(own[:-1] * size + own[1:], minlength=size * size)
        yield pairs_in(total)

    return pair_sums(texts.select("units").mapInArrow(tidied(count), "pair int, n bigint"), size)


def join_classes(texts: DataFrame, group: np.ndarray, base: np.ndarray, class_pairs: np.ndarray) -> np.ndarray:
    """Class of each unit: that of ``base`` for those that are a group of their own, and the best class for each of the others."""
    late = group != np.arange(len(group))
    if not late.any():
        return base
    classes = len(class_pairs)
    shared = texts.sparkSession.sparkContext.broadcast((base, late, class_pairs))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group_class, moved, _ = shared.value
        total = np.zeros(len(moved) * 2 * classes, np.int32)
        for batch in batches:
            seq = sequence(batch.column(0))[0]
            c, at = group_class[seq], np.flatnonzero(moved[seq])
            slot = seq[at].astype(np.int64) * 2 * classes
            np.add.at(total, slot + c[at - 1], 1)
            np.add.at(total, slot + classes + c[at + 1], 1)
        # One row for each unit: its slots and their counts.
        unit, slot = np.divmod(np.flatnonzero(total), 2 * classes)
        at = np.append(np.flatnonzero(np.diff(unit, prepend=-1)), len(unit))
        n = total[total > 0]
        for i in range(0, len(at) - 1, 20_000):
            part = at[i : i + 20_001]
            own, offsets = slice(part[0], part[-1]), pa.array((part - part[0]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (slot[own].astype(np.int16), n[own])]
            yield pa.RecordBatch.from_arrays([pa.array(unit[part[:-1]].astype(np.int32)), *lists], ["unit", "slots", "counts"])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group_class, _, tables = shared.value
        for batch in batches:
            sides = np.zeros((batch.num_rows, 2 * classes))
            at = np.repeat(np.arange(batch.num_rows), np.diff(batch.column(1).offsets.to_numpy()))
            sides[at, batch.column(1).flatten().to_numpy()] = batch.column(2).flatten().to_numpy()
            best = moved_to(sides, group_class[batch.column(0).to_numpy()], tables)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best.astype(np.int32))], ["unit", "class"])

    sums = texts.select("units").mapInArrow(tidied(look), "unit int, slots array<smallint>, counts array<int>").repartition("unit")
    sums = sums.select("unit", F.explode(F.arrays_zip("slots", "counts")).alias("e")).select("unit", F.col("e.slots").alias("slot"), F.col("e.counts").alias("n"))
    # Rows of a unit are in one partition already.
    each = sums.groupBy("unit", "slot").agg(F.sum("n").alias("n")).groupBy("unit").agg(F.collect_list(F.struct("slot", "n")).alias("s"))
    chosen = each.select("unit", F.col("s.slot").alias("slot"), F.col("s.n").alias("n")).mapInArrow(choose, "unit int, class int")
    out = base.copy()
    for r in chosen.collect():  # one row for each unit at most
        out[r.unit] = r["class"]
    return out


def occurrences(texts: DataFrame, group: np.ndarray | None = None) -> DataFrame:
    """A row for each word that is not in the table: its text; its place there, shape, and whether the text teaches, as one number ``spot``; and
    the units left and right of it, or their ``group``, as one number ``sides``."""
    shared = texts.sparkSession.sparkContext.broadcast(group)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seq, sizes = sequence(batch.column(2))
            spots = np.flatnonzero(seq < SHAPES)
            words = [w for rest in batch.column(3).to_pylist() if rest for w in rest.split(" ")]
            text = np.repeat(np.arange(batch.num_rows), sizes)[spots - 1]
            teaches = batch.column(1).to_numpy(zero_copy_only=False)[text].astype(np.int64)
            left, right = seq[spots - 1], seq[spots + 1]
            if shared.value is not None:
                left, right = shared.value[left], shared.value[right]
            spot = (spots * SHAPES + seq[spots]) * 2 + teaches
            columns = [batch.column(0).take(pa.array(text)), pa.array(words, pa.string()), pa.array(spot), pa.array(left.astype(np.int64) << 32 | right)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "word", "spot", "sides"])

    return texts.select("row", "teaches", "units", "rest").mapInArrow(tidied(find), "row bigint, word string, spot bigint, sides bigint")


def left_right(sides: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return sides >> 32, sides & 0xFFFFFFFF


def learned_words(texts: DataFrame, base: np.ndarray, class_pairs: np.ndarray, is_unit: Column) -> DataFrame:
    """The words of the training texts that are not in the table, stored: count, class, and whether ``is_unit`` (of the count ``n``) makes them units.

    They are moved like the units of the table, from the class of their shape, by sums that stay in the tasks.
    """
    classes = len(class_pairs)
    shared = texts.sparkSession.sparkContext.broadcast((base, class_pairs))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group_class, tables = shared.value
        for batch in batches:
            (left, right), n = left_right(batch.column(3).flatten().to_numpy()), batch.column(4).flatten().to_numpy()
            at = np.repeat(np.arange(batch.num_rows), np.diff(batch.column(3).offsets.to_numpy())) * 2 * classes
            size = batch.num_rows * 2 * classes
            sides = np.bincount(at + left, n, size) + np.bincount(at + classes + right, n, size)
            shape = np.array([shape_of(w.encode()) for w in batch.column(0).to_pylist()], np.int64)
            best = moved_to(sides.reshape(-1, 2 * classes), group_class[shape], tables)
            columns = [batch.column(0), batch.column(1), pa.array(best.astype(np.int32)), batch.column(2)]
            yield pa.RecordBatch.from_arrays(columns, ["word", "n", "class", "unit"])

    found = occurrences(texts, base).select("word", "sides").repartition("word")
    # Rows of a word are in one partition already; a word has at most one row for each pair of classes.
    sums = found.groupBy("word", "sides").agg(F.count("*").alias("n"))
    each = sums.groupBy("word").agg(F.sum("n").alias("n"), F.collect_list(F.struct("sides", "n")).alias("s"))
    sides = each.select("word", "n", is_unit.alias("unit"), F.col("s.sides").alias("s_sides"), F.col("s.n").alias("s_n"))
    return stored(sides.mapInArrow(tidied(choose), "word string, n bigint, class int, unit boolean"), "learned", compression="zstd")


def marked(texts: DataFrame, learned: DataFrame) -> DataFrame:
    """The occurrences of words that are not in the table, stored with their counts, their codes and those that follow in the text. A code is the
    shape of a word, or ``SHAPES`` and the class of a unit."""
    shape = F.shiftright("spot", 1).bitwiseAND(SHAPES - 1)
    code = F.when(F.col("unit"), F.col("class") + SHAPES).otherwise(shape).cast("int").alias("code")
    found = occurrences(texts).join(learned, "word", "left").select("row", "spot", "sides", code, F.coalesce("n", F.lit(0)).alias("n"))
    following = F.lead("code", 1, 0).over(Window.partitionBy("row").orderBy("spot")).alias("following")
    teaches = (F.col("spot").bitwiseAND(1) == 1).alias("teaches")
    return stored(found.select("row", teaches, "sides", "code", "n", following), "marked", compression="zstd")


def sides_of(batch: pa.RecordBatch, own: np.ndarray, classes: int) -> tuple[np.ndarray, ...]:
    """Classes left of, of, and right of marked occurrences, and which of them follow a unit of the table: other pairs count with their left word."""
    sides, code, following = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("sides", "code", "following"))
    left, right = left_right(sides)
    coded_class = np.concatenate((own[:SHAPES], np.arange(classes)))
    return own[left], coded_class[code], np.where(right < SHAPES, coded_class[following], own[right]), left >= SHAPES


def marked_pairs(spots: DataFrame, own: np.ndarray, classes: int) -> np.ndarray:
    """How often classes follow each other where one or both are of marked occurrences."""
    shared = spots.sparkSession.sparkContext.broadcast(own)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(classes * classes, np.int64)
        for batch in batches:
            before, here, after, first = sides_of(batch, shared.value, classes)
            both = np.concatenate((before[first] * classes + here[first], here * classes + after))
            total += np.bincount(both, minlength=classes * classes)
        yield pairs_in(total)

    return pair_sums(spots.select("sides", "code", "following").mapInArrow(tidied(count), "pair int, n bigint"), classes)


def moved_to(sides: np.ndarray, now: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """``best_class`` for any number of units."""
    parts = [best_class(sides[i : i + 500], now[i : i + 500], pairs) for i in range(0, len(now), 500)]
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def best_class(sides: np.ndarray, now: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The class to which each unit should move, given how often each class stands left and right of it (``sides``), its class, and the class bigrams."""
    classes, rows = len(pairs), np.arange(len(sides))
    left, right = sides[:, :classes], sides[:, classes:]
    size = sides.sum(1, keepdims=True) / 2
    # Row and column sums of the tables without the unit, which never hold less than nothing.
    below = np.maximum(left[rows, now] + right[rows, now] - pairs[now, now], 0)
    into, out = pairs.sum(0) - right, pairs.sum(1) - left
    into[rows, now] += below - left.sum(1)
    out[rows, now] += below - right.sum(1)
    gain = _xlogx(into) - _xlogx(into + size) + _xlogx(out) - _xlogx(out + size)
    # Only the classes that stand beside a unit change its gain.
    for own, other, table in ((right, left, pairs.T), (left, right, pairs)):
        unit, beside = np.nonzero(own)
        if not len(unit):
            continue
        n, g = own[unit, beside], now[unit]
        cells = table[beside]
        cells[np.arange(len(unit)), g] -= n
        same = beside == g
        cells[same] -= other[unit[same]]
        cells = np.maximum(cells, 0)
        first = np.flatnonzero(np.diff(unit, prepend=-1))
        gain[unit[first]] += np.add.reduceat(_xlogx(cells + n[:, None]) - _xlogx(cells), first)
    best = gain.argmax(1)
    return np.where(gain[rows, best] > gain[rows, now] + 1e-9, best, now)


def _xlogx(a):
    return a * np.log(np.maximum(a, 1e-300))


def exchange(pairs: np.ndarray, classes: int = CLASSES, rounds: int = 8) -> np.ndarray:
    """Class of each unit, by moving units one at a time to the class that raises the likelihood of ``pairs`` most."""
    units = len(pairs)
    weight = pairs.sum(1) + pairs.sum(0)
    own = np.empty(units, np.int64)
    own[np.argsort(-weight, kind="stable")] = np.arange(units) % classes
    right, left = np.zeros((units, classes)), np.zeros((units, classes))
    for c in range(classes):
        right[:, c], left[:, c] = pairs[:, own == c].sum(1), pairs[own == c].sum(0)
    table = np.zeros((classes, classes))
    np.add.at(table, own, right)
    out, into = pairs.sum(1), pairs.sum(0)
    n_out, n_in = table.sum(1), table.sum(0)
    for _ in range(rounds):
        moved = 0
        for u in np.argsort(-weight, kind="stable"):
            if not weight[u]:
                continue
            g, s = own[u], pairs[u, u]
            r, l = right[u].copy(), left[u].copy()
            r[g] -= s
            l[g] -= s
            table[g] -= r
            table[:, g] -= l
            table[g, g] -= s
            n_out[g] -= out[u]
            n_in[g] -= into[u]
            base = _xlogx(table)
            gain = (_xlogx(table + r) - base).sum(1) + (_xlogx(table + l[:, None]) - base).sum(0)
            d = np.diag(table)
            gain += _xlogx(d + r + l + s) - _xlogx(d + r) - _xlogx(d + l) + _xlogx(d)
            gain -= _xlogx(n_out + out[u]) - _xlogx(n_out) + _xlogx(n_in + into[u]) - _xlogx(n_in)
            k = int(np.argmax(gain))
            if gain[k] <= gain[g] + 1e-9:
                k = g
            table[k] += r
            table[:, k] += l
            table[k, k] += s
            n_out[k] += out[u]
            n_in[k] += into[u]
            if k != g:
                moved += 1
                own[u] = k
                right[:, g] -= pairs[:, u]
                right[:, k] += pairs[:, u]
                left[:, g] -= pairs[u]
                left[:, k] += pairs[u]
        if not moved:
            break
    return own


@dataclass
class Model:
    """``own``: class of each unit of the table; ``move``: log10 probability of a class after a class, ``emit``: of a unit in its class; ``places``:
    log10 of the smoothed size of a shape, 0 for other units; ``times``: occurrences of words that are units, 0 for shapes; ``sizes``: smoothed
    occurrences of each class."""

    table: dict[bytes, int]
    own: np.ndarray
    move: np.ndarray
    emit: np.ndarray
    places: np.ndarray
    times: np.ndarray
    sizes: np.ndarray
    tokens: int
    distinct: int


def step_of(n: str = "n") -> Column:
    return F.floor(F.log2(n) * STEPS).cast("int")


def least_step(words: DataFrame, most: int) -> int | None:
    """The step of the histogram of counts from which on there are at most ``most`` words."""
    # Some hundred rows.
    sizes = sorted(words.groupBy(step_of().alias("step")).agg(F.count("*").alias("n")).collect(), reverse=True)
    taken, least = 0, None
    for r in sizes:
        taken += r.n
        if taken > most:
            break
        least = r.step
    return least


def frequent_words(words: DataFrame, most: int) -> list[tuple[str, int]]:
    """The words above a count, at most ``most`` of them, the most frequent first. No word is ranked: counts are put in a histogram first."""
    least = least_step(words, most)
    if least is None:
        return []
    found = words.where(step_of() >= least).select("word", "n").toArrow()
    return sorted(zip(found.column(0).to_pylist(), found.column(1).to_pylist()), key=lambda r: (-r[1], r[0]))


def fit_tables(counts: DataFrame, texts: DataFrame, top: int = TOP, local: int | None = None, classes: int = CLASSES, held: int = LOCAL) -> Model:
    """Cluster the units of the training ``texts``, given their stored word ``counts``."""
    return fit_coded(counts, texts.withColumn("teaches", F.lit(True)), top, local, classes, held)[0]


def fit_coded(
    counts: DataFrame, rows: DataFrame, top: int, local: int | None, classes: int, held: int
) -> tuple[Model, DataFrame, DataFrame]:
    """The model of those of ``rows`` that teach, all rows coded, and their marked words."""
    tokens, distinct = counts.agg(F.sum("n"), F.count("*")).first()
    words = counts.where("word IS NOT NULL")
    frequent = frequent_words(words, held if local is None else min(held, local))
    table = {w.encode(): FIRST_WORD + i for i, (w, _) in enumerate(frequent)}
    least = 0 if local is None else least_step(words, local)
    is_unit = F.lit(False) if least is None else step_of() >= least
    texts = coded(rows, table)
    teaching = texts.where("teaches")
    shapes = np.array([shape_of(w) for w in table], np.int64)
    times = np.concatenate((np.zeros(FIRST_WORD, np.int64), np.array([n for _, n in frequent], np.int64)))
    # Groups of the first step: the top words for themselves, all others by shape.
    early = np.arange(FIRST_WORD + min(top, len(table)))
    group = np.concatenate((early, shapes[top:]))
    pairs = neighbours(teaching, group)
    first = exchange(pairs, classes)
    base = first[group]
    class_pairs = np.zeros((classes, classes))
    np.add.at(class_pairs, (first[:, None], first[None, :]), pairs)
    own = join_classes(teaching, group, base, class_pairs)
    learned = learned_words(teaching, base, class_pairs, is_unit)
    spots = marked(texts, learned)
    # Pairs of units of the table; shapes are a group that is left out.
    into = neighbours(teaching, np.concatenate((np.full(SHAPES, classes), own[SHAPES:])))[:classes, :classes]
    into = into + marked_pairs(spots.where("teaches"), own, classes)
    n, v = np.zeros(SHAPES), np.zeros(SHAPES)
    for r in words.where(~is_unit).groupBy("shape").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        n[r["shape"]], v[r["shape"]] = r.n, r.v
    ends = counts.where("word IS NULL").agg(F.sum("n")).first()[0] or 0
    # One more of each unit keeps every unit possible.
    unit_n = np.concatenate((n, [ends], times[FIRST_WORD:])) + 1.0
    class_n = np.bincount(own, unit_n, classes)
    for r in learned.where("unit").groupBy("class").agg(F.sum(F.col("n") + 1).alias("n")).collect():
        class_n[r["class"]] += r.n
    frequency = class_n / class_n.sum()
    after = into.sum(1, keepdims=True)
    share = np.where(after > 0, MIX, 0.0)
    moves = share * into / np.maximum(after, 1) + (1 - share) * frequency
    places = np.concatenate((np.log10(n + v + 1), np.zeros(1 + len(table))))
    times[END] = ends
    # A class may be empty: nothing moves there.
    move = np.log10(np.maximum(moves, 1e-300))
    emit = np.log10(unit_n / class_n[own])
    # The row of the end mark stands in the table even where no text was counted.
    model = Model(table, own, move, emit, places, times, class_n, int(tokens or 0), max(0, int(distinct) - (ends == 0)))
    return model, texts, spots


def score(
    docs: DataFrame, teaches: Column, top: int = TOP, local: int | None = None, classes: int = CLASSES, held: int = LOCAL
) -> DataFrame:
    """One row per document: tokens, known tokens and both log10 probabilities. ``teaches`` picks the training rows by ``doc_id``."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").alias(ID), F.xxhash64("text").alias(HASH), F.coalesce(teaches, F.lit(False)).alias("teaches"), F.col("text").alias("_text")
    )
    counts = stored(word_counts(rows.where("teaches")), "words")
    model, texts, spots = fit_coded(counts, rows, top, local, classes, held)
    model.table = {}
    shared = spark.sparkContext.broadcast(model)
    total = np.log10(model.tokens + model.distinct + 1)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        logs, known_units = np.log10(m.times + 1), m.times > 0
        # Words that are not in the table are added later, with the moves to and from them: they are a class without cost here.
        own, emit = m.own.copy(), m.emit.copy()
        own[:SHAPES], emit[:SHAPES] = classes, 0
        move = np.pad(m.move, (0, 1))
        for batch in batches:
            seq, sizes = sequence(batch.column(3))
            after, at, c = seq[1:], np.cumsum(sizes) - sizes, own[seq]
            value = np.add.reduceat(move[c[:-1], c[1:]] + emit[after], at) if len(at) else np.empty(0)
            base = np.add.reduceat(logs[after], at) if len(at) else np.empty(0)
            known = np.add.reduceat(known_units[after], at, dtype=np.int64) if len(at) else np.empty(0, np.int64)
            columns = [*batch.columns[:3], pa.array(sizes), pa.array(known), pa.array(base), pa.array(value)]
            yield pa.RecordBatch.from_arrays(columns, ["row", *KEY, "tokens", "known", "base", "own"])

    def look_marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        emit = np.concatenate((m.emit[:SHAPES] - m.places[:SHAPES], -np.log10(np.maximum(m.sizes, 1))))
        for batch in batches:
            if not batch.num_rows:
                continue
            before, here, after, first = sides_of(batch, m.own, classes)
            row, n, code = (batch.column(i).to_numpy() for i in (0, 1, 2))
            logs = np.log10(n + 1)
            value = emit[code] + logs + m.move[here, after] + np.where(first, m.move[before, here], 0)
            at = np.flatnonzero(np.diff(row, prepend=row[0] - 1))
            sums = [np.add.reduceat(n > 0, at, dtype=np.int64), np.add.reduceat(logs, at), np.add.reduceat(value, at)]
            yield pa.RecordBatch.from_arrays([pa.array(row[at]), *map(pa.array, sums)], ["row", "known", "base", "own"])

    sums = "known bigint, base double, own double"
    near = texts.select("row", *KEY, "units").mapInArrow(tidied(look), f"row bigint, {ID} bigint, {HASH} bigint, tokens bigint, {sums}")
    far = spots.select("row", "n", "code", "sides", "following").mapInArrow(tidied(look_marked), f"row bigint, {sums}")
    each = near.unionByName(far, allowMissingColumns=True).groupBy("row").agg(
        *[F.max(c).alias(c) for c in (*KEY, "tokens")], *[F.sum(c).alias(c) for c in ("known", "base", "own")]
    )
    # Repeated rows of a document have equal sums.
    return each.groupBy(*KEY).agg(*[F.max(c).alias(c) for c in ("tokens", "known", "base", "own")]).select(
        F.col(ID).alias("doc_id"), F.col("tokens").alias("n_tokens"), F.col("known").alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") - F.col("tokens") * F.lit(float(total))).alias("base_score"),
        F.col("own").alias("score"),
    )
