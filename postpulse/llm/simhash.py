"""SimHash fingerprints of documents, and all fingerprints within a Hamming radius; DataFrame functions only.

Terms are pairs of neighbouring words (the last word also counts alone), without case. Each term votes on each of 128 bits with its hash,
for one or against zero, by its weight: the longer its words, the more it says (1 to 4). A bit of the fingerprint is
set where the votes for it outweigh the others.

Votes are sums of 64-bit numbers that hold two 32-bit counters each, so a text is summed in one aggregate without any shuffle of terms; counters
cannot overflow below a thousand million terms. Search uses block tables: fingerprints that differ in no more bits than the radius
differ in few bits of one block at least, as its share of the radius is rounded down. The blocks of the asked fingerprints are listed with
all ways to change that many bits, and joined with the blocks of all; then the whole distance is checked.

Defined results: NULL and empty texts and those without words have the fingerprint of zeros; rows equal in id and text are one
document; ties in votes give 0; a single document is its own next one; an empty table gives no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postpulse.llm.common import HASH, ID, KEY, keyed, same_key, stored
from postpulse.operators.frames import with_ordinal

#: Of 128 bits. Texts of 450 words with 10 changed (Jaccard 0.8 of five-word shingles) differ in some 12 bits, with a deviation of 3.
RADIUS = 20
BITS = 128
BLOCKS = 7
PAIR = (1 << 32) + 1


def fingerprints(texts: DataFrame, keys: list[str], text: str = "_text") -> DataFrame:
    """The two halves ``f1`` and ``f2`` of the fingerprint of each row; ``keys`` tell rows apart."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[ \t\n\x0B\f\r]+"), lambda w: w != "")
    rows = texts.select(*keys, words.alias("_w"))
    pairs = F.arrays_zip(F.col("_w").alias("a"), F.slice("_w", F.lit(2), F.greatest(F.size("_w"), F.lit(1))).alias("b"))
    terms = rows.select(*keys, F.inline_outer(pairs).alias("a", "b"))
    letters = F.length("a") + F.coalesce(F.length("b"), F.lit(0))
    weight = F.when(F.col("a").isNull(), 0).otherwise(F.least(F.lit(4), 1 + F.floor(letters / 6))).cast("bigint")
    terms = terms.select(*keys, F.xxhash64("a", "b").alias("h1"), F.xxhash64(F.lit("second"), "a", "b").alias("h2"), weight.alias("w"))
    votes = [
        F.sum(F.shiftrightunsigned(h, j).bitwiseAND(F.lit(PAIR)) * F.col("w")).alias(f"{h}_{j}") for h in ("h1", "h2") for j in range(32)
    ]
    sums = terms.groupBy(*keys).agg(F.sum("w").alias("w"), *votes)

    def half(h: str) -> Column:
        out = F.lit(0).cast("bigint")
        for j in range(32):
            low, high = F.col(f"{h}_{j}").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(f"{h}_{j}", 32)
            for bit, count in ((j, low), (j + 32, high)):
                value = (1 << bit) - (1 << 64) * (bit == 63)
                out = out.bitwiseOR(F.when(count * 2 > F.col("w"), F.lit(value).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
        return out

    return sums.select(*keys, half("h1").alias("f1"), half("h2").alias("f2"))


def as_text(f1: str, f2: str) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(f1), 16, "0"), F.lpad(F.hex(f2), 16, "0")))


def distance(a1, a2, b1, b2) -> Column:
    return F.bit_count(F.col(a1).bitwiseXOR(F.col(b1))) + F.bit_count(F.col(a2).bitwiseXOR(F.col(b2)))


def likeness(*halves) -> Column:
    return 1 - distance(*halves) / F.lit(float(BITS))


def block_shares(radius: int, blocks: int = BLOCKS) -> list[int]:
    """Bits in which each block may differ (-1: none is searched), so that two fingerprints within ``radius`` meet in one block at least."""
    return [(radius + 1) // blocks - 1 + (i < (radius + 1) % blocks) for i in range(blocks)]


def block_tables(prints: DataFrame, radius: int = RADIUS, changed: bool = False) -> DataFrame:
    """Each fingerprint once for each searched block: block number and the block's bits; with ``changed``, once for each way to change the block's share of bits."""
    edges = [BITS * i // BLOCKS for i in range(BLOCKS + 1)]

    def bits(lo: int, hi: int) -> Column:
        """Bits lo to hi of the fingerprint, counted from the low end of f1."""
        parts, at = [], 0
        for name, first in (("f1", 0), ("f2", 64)):
            a, b = max(lo, first) - first, min(hi, first + 64) - first
            if a < b:
                parts.append(F.shiftleft(F.shiftrightunsigned(name, a).bitwiseAND(F.lit((1 << (b - a)) - 1)), at))
                at += b - a
        return parts[0] if len(parts) == 1 else parts[0].bitwiseOR(parts[1])

    searched = [(i, s, edges[i], edges[i + 1]) for i, s in enumerate(block_shares(radius)) if s >= 0]
    blocks = [F.struct(F.lit(i).alias("block"), bits(a, b).cast("bigint").alias("bits")) for i, _, a, b in searched]
    rows = prints.select("*", F.inline(F.array(*blocks)))
    if not changed:
        return rows
    masks = [(i, sum(1 << j for j in c)) for i, s, a, b in searched for n in range(s + 1) for c in combinations(range(b - a), n)]
    ways = F.broadcast(prints.sparkSession.createDataFrame(masks, "block int, mask bigint"))
    return rows.join(ways, "block").withColumn("bits", F.col("bits").bitwiseXOR(F.col("mask"))).drop("mask")


def find_near(prints: DataFrame, queries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """For each distinct fingerprint of ``queries``, the distinct fingerprints of ``prints`` within ``radius``, and how many rows have them.

    Rows are pre-aggregated by fingerprint, so that a group of copies is one row of the tables.
    """
    counted = prints.groupBy("f1", "f2").agg(F.count("*").alias("n"))
    asked = block_tables(queries.select("f1", "f2").distinct(), radius, changed=True).withColumnsRenamed({"f1": "q1", "f2": "q2"})
    near = asked.join(block_tables(counted, radius), ["block", "bits"]).where(distance("q1", "q2", "f1", "f2") <= radius)
    return near.select("q1", "q2", "f1", "f2", "n").distinct()


def with_next(docs: DataFrame) -> DataFrame:
    """Key, text, its length, its successor's key and the edited text: the last third replaced by the start of the next
    document in descending order of ids; the first follows the last."""
    # Repeated rows go along; the aggregate over terms brings them together without changing a majority.
    texts = keyed(docs)
    keys = with_ordinal(
        texts.select(*KEY, F.coalesce(F.length("_text"), F.lit(0)).alias("n_chars")).distinct(), [F.col(ID).desc_nulls_last(), F.col(HASH)], "_place", "_all"
    )
    after = keys.select(F.pmod(F.col("_place") - 1, F.col("_all")).alias("_place"), F.col(ID).alias("_nid"), F.col(HASH).alias("_ntx"))
    pairs = keys.join(after, "_place").select(*KEY, "n_chars", "_nid", "_ntx")
    given = texts.select(F.col(ID).alias("_gid"), F.col(HASH).alias("_gtx"), F.col("_text").alias("_given"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    starts = pairs.join(given, pairs["_nid"].eqNullSafe(given["_gid"]) & (pairs["_ntx"] == given["_gtx"])).select(
        *KEY, "n_chars", "_nid", "_ntx", F.substring(F.coalesce("_given", F.lit("")), F.lit(1), third).alias("_start")
    )
    joined = texts.join(starts, same_key(texts, starts)).select(texts[ID], texts[HASH], "_text", "n_chars", "_nid", "_ntx", "_start")
    kept = F.substring(F.coalesce("_text", F.lit("")), F.lit(1), (F.col("n_chars") - third).cast("int"))
    return joined.withColumn("_edited", F.concat(kept, F.col("_start"))).drop("_start")


def fingerprint_pairs(docs: DataFrame) -> DataFrame:
    """One row per document: both fingerprints, digest of the edited text, and the next document's key."""
    rows = with_next(docs).withColumn("edited_sha256", F.sha2(F.col("_edited").cast("binary"), 256))
    keys = [*KEY, "n_chars", "_nid", "_ntx", "edited_sha256"]
    both = F.array(F.struct(F.lit(0).alias("v"), F.col("_text").alias("t")), F.struct(F.lit(1).alias("v"), F.col("_edited").alias("t")))
    prints = fingerprints(rows.select(*keys, F.inline(both).alias("_v", "_t")), [*keys, "_v"], "_t")
    pick = lambda c, v: F.max(F.when(F.col("_v") == v, F.col(c)))
    return prints.groupBy(*keys).agg(
        pick("f1", 0).alias("f1"), pick("f2", 0).alias("f2"), pick("f1", 1).alias("e1"), pick("f2", 1).alias("e2")
    )


def fingerprint_documents(docs: DataFrame, radius: int = RADIUS, every: int = 100) -> DataFrame:
    """Fingerprints, likeness to the edited text and to the next document, and for documents whose id is divisible by
    ``every`` the number of other documents within ``radius``."""
    prints = stored(fingerprint_pairs(docs), "prints")
    ours = prints.select(F.col(ID).alias("_oid"), F.col(HASH).alias("_otx"), F.col("f1").alias("n1"), F.col("f2").alias("n2"))
    paired = prints.join(ours, prints["_nid"].eqNullSafe(ours["_oid"]) & (prints["_ntx"] == ours["_otx"]), "left")
    asked = prints.where(F.col(ID) % every == 0)
    near = find_near(prints, asked, radius).groupBy("q1", "q2").agg(F.sum("n").alias("_near"))
    counts = asked.join(near, (asked["f1"] == near["q1"]) & (asked["f2"] == near["q2"])).select(
        F.col(ID).alias("_aid"), F.col(HASH).alias("_atx"), (F.col("_near") - 1).alias("n_near")
    )
    out = paired.join(counts, paired[ID].eqNullSafe(counts["_aid"]) & (paired[HASH] == counts["_atx"]), "left")
    return out.select(
        F.col(ID).alias("doc_id"), F.col("n_chars").cast("bigint").alias("n_chars"), "edited_sha256", as_text("f1", "f2").alias("fingerprint"),
        as_text("e1", "e2").alias("edited_fingerprint"), likeness("f1", "f2", "e1", "e2").alias("near_edited"),
        likeness("f1", "f2", "n1", "n2").alias("near_next"), "n_near",
    )
