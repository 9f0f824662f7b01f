"""Helpers shared by the text operators.

A document is a row with ``doc_id`` and ``text``; other columns are never read, so they may have any
name. Keyed operators tell documents apart by id and text: rows equal in both are one document. Order
between documents is by id, rows without an id last, then by a hash of the text.
"""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postpulse.session import scratch_path

#: Rows and bytes of a batch that goes to Python.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20
#: Returns free memory to the system, where the C library can.
TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)

#: Bits of a key filter for each key and in a chunk, and the most chunks: 8 MB.
KEY_BITS, CHUNK_BITS, MOST_CHUNKS = 16, 1 << 16, 1 << 10

ID, HASH = "_id", "_tx"
KEY = [ID, HASH]


def keyed(docs: DataFrame) -> DataFrame:
    """Id, text hash and text under internal names."""
    return docs.select(F.col("doc_id").alias(ID), F.xxhash64("text").alias(HASH), F.col("text").alias("_text"))


def same_key(left: DataFrame, right: DataFrame) -> Column:
    """Null-safe equality of the keys."""
    return left[ID].eqNullSafe(right[ID]) & (left[HASH] == right[HASH])


def free_name(df: DataFrame, base: str) -> str:
    """``base``, lengthened until no column has this name."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def map_texts(df: DataFrame, make: Callable, fields: dict[str, tuple[str, pa.DataType]], passed: int = 1, done: Callable | None = None) -> DataFrame:
    """The first ``passed`` columns as they are, and the columns that ``make`` returns for lists of all but the first.

    ``done`` as for ``tidied``. Ids stay in Arrow, so that NULLs among them don't turn whole numbers into floating-point ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = make(*[batch.column(i).to_pylist() for i in range(1, batch.num_columns)])
            columns = [pa.array(c, kind) for c, (_, kind) in zip(made, fields.values())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:passed], *columns], [*names, *fields])

    names = df.columns[:passed]
    kinds = dict(df.dtypes)
    schema = [f"`{c}` {kinds[c]}" for c in names] + [f"{c} {kind}" for c, (kind, _) in fields.items()]
    return df.mapInArrow(tidied(run, done), ", ".join(schema))


def keep_where(docs: DataFrame, keep: Callable[[str | None], bool]) -> DataFrame:
    """The rows of ``docs`` whose text passes ``keep``, with all their columns and without a shuffle."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask = [keep(text) for text in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(tidied(run), docs.schema)


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """``df`` written once below the shared folder, with ``options`` of Parquet, and read back."""
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class KeyFilter:
    """A Bloom filter of distinct keys, dealt into chunks of 8 kB, to tell rows apart without a shuffle.

    The driver holds two bytes for each key, and 8 MB at most, where a broadcast of the keys takes a hundred for each. Beyond that, more
    rows pass that have none of the keys. The filter says only that a row may have one of them, or has none.
    """

    def __init__(self, keys: DataFrame):
        self.chunks = max(1, min(MOST_CHUNKS, -(-keys.count() * KEY_BITS // CHUNK_BITS)))
        words = CHUNK_BITS // 64
        chunk, bits = self._places(keys.columns)
        found = keys.select(chunk.alias("chunk"), F.explode(F.array(*bits)).alias("bit"))
        found = found.select("chunk", F.shiftright("bit", 6).alias("word"), _one("bit").alias("bits"))
        empty = keys.sparkSession.range(self.chunks * words).select(
            F.floor(F.col("id") / words).alias("chunk"), (F.col("id") % words).alias("word"), F.lit(0).cast("bigint").alias("bits")
        )
        filled = found.union(empty).groupBy("chunk", "word").agg(F.bit_or("bits").alias("bits"))
        array = F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda s: s["bits"])
        self.table = stored(filled.groupBy("chunk").agg(array.alias("words")), "filter")

    def _places(self, columns: list[str]) -> tuple[Column, list[Column]]:
        """Chunk of a key, and its three bits there."""
        more = F.xxhash64(F.lit("bits"), *columns)
        return F.pmod(F.xxhash64(*columns), F.lit(self.chunks)), [F.shiftright(more, 16 * i).bitwiseAND(F.lit(CHUNK_BITS - 1)) for i in range(3)]

    def rows(self, df: DataFrame, columns: list[str], held: bool = True) -> DataFrame:
        """The rows of ``df`` whose ``columns``, of the types that the keys have, may be a key; without ``held`` all others."""
        chunk, words = free_name(df, "_chunk"), free_name(df, "_words")
        table = self.table.select(F.col("chunk").alias(chunk), F.col("words").alias(words))
        own, bits = self._places(columns)
        on = own == F.col(chunk)
        for bit in bits:
            on &= F.get(words, F.shiftright(bit, 6).cast("int")).bitwiseAND(_one(bit)) != 0
        return df.join(F.broadcast(table), on, "left_semi" if held else "left_anti")


def _one(bit: Column | str) -> Column:
    """The number with this bit of 64 set."""
    bit = F.col(bit) if isinstance(bit, str) else bit
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), bit.bitwiseAND(F.lit(63)).cast("int"))


def small_batches(spark: SparkSession) -> None:
    """Let texts travel to Python in batches of a few megabytes: what a task holds at once follows the batch. Smaller settings are left alone."""
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{key}"
        now = int(re.sub(r"\D", "", spark.conf.get(name)) or 0)
        if not 0 < now <= most:
            spark.conf.set(name, str(most))


def release() -> None:
    """Give free memory of this process back to the system."""
    pa.default_memory_pool().release_unused()
    if TRIM:
        TRIM(0)


def tidied(run: Callable, done: Callable | None = None) -> Callable:
    """``run`` over batches, after which the worker calls ``done``, to forget what it remembered, and gives free memory back: workers
    outlive their tasks. ``done`` is a function of a module, as anything else reaches the worker as a copy."""

    def call(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            if done:
                done()
            release()

    return call


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_mod(column: Column, modulus: int) -> Column:
    """CRC-32 of the value as text, modulo; NULL for NULL."""
    return F.crc32(column.cast("string").cast("binary")) % modulus
