"""Repeated runs of lines, found by winnowing over line hashes; DataFrame functions only.

A unit is the smallest run of consecutive non-blank lines that must be found. With ``least``, it is a run from a line on, or up to a line, that
has just ``least`` words: often a single line; every eight characters of a line count as a word at least, for scripts without blanks.
A text of fewer words is one unit. Without ``least``, all runs of ``grams + window - 1`` lines are units. Each line (or ``grams`` neighbouring ones)
is hashed, and of the hashes of a unit the smallest, the rightmost among equals, is a fingerprint. Two equal units choose the same
fingerprint at the same place, so a unit that occurs twice has a fingerprint that occurs twice: only these go on. Places with
a common fingerprint are joined and extended both ways, to all units that contain it; of equal units the first
stays (smallest document, then first line), and the lines of all later ones are deleted. Overlapping units
make up longer runs, so that every repeated passage of at least a unit goes, and nothing shorter.

Lines are compared as they are. A blank line goes with the line before it.

Defined results: NULL text stays NULL and has no lines; texts without lines, and without ``least`` those with fewer lines than a run,
stay as they are; rows equal in id and text are one document and keep or lose the same lines; documents without an id come last. An
empty table gives no rows. All columns of the input are kept, only ``text`` changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postpulse.llm.common import HASH, ID, KEY, KeyFilter, free_name, keyed, stored

GRAMS = 2
WINDOW = 3
#: Words of the shortest passage that ``op1_line_dedup`` removes.
LEAST = 8
#: As many characters of a line count as a word at least.
LETTERS = 8


def filled(line: Column) -> Column:
    return F.length(F.btrim(line, F.lit(" \t\r"))) > 0


def runs(docs: DataFrame, grams: int = GRAMS, window: int = WINDOW) -> DataFrame:
    """All runs of the keyed ``docs``: place, fingerprint and where it lies, line numbers, and a 128-bit digest."""
    size = grams + window - 1
    lines = F.transform(F.split("_text", "\n"), lambda x, i: F.struct(i.alias("i"), x.alias("x")))
    rows = docs.select(*KEY, F.filter(lines, lambda s: filled(s["x"])).alias("_lines"))
    rows = rows.where(F.size("_lines") >= size)
    rows = rows.select(
        *KEY, F.transform("_lines", lambda s: s["i"]).alias("_at"),
        F.transform("_lines", lambda s: F.xxhash64(s["x"])).alias("_h"),
        F.transform("_lines", lambda s: F.xxhash64(F.lit("second"), s["x"])).alias("_g"),
    )
    rows = rows.withColumn(
        "_grams",
        F.transform(F.sequence(F.lit(0), F.size("_h") - grams), lambda i: F.xxhash64(*[F.get("_h", i + j) for j in range(grams)])),
    )

    def run(i: Column) -> Column:
        # The smallest hash; of equal ones that with the largest number.
        best = F.array_min(F.array(*[F.struct(F.get("_grams", i + j).alias("f"), (-(i + j)).alias("p")) for j in range(window)]))
        return F.struct(
            i.alias("start"), best.alias("best"), F.slice("_at", i + 1, size).alias("at"),
            F.xxhash64(F.slice("_h", i + 1, size)).alias("w1"), F.xxhash64(F.slice("_g", i + 1, size)).alias("w2"),
        )

    every = F.transform(F.sequence(F.lit(0), F.size("_h") - size), run)
    return rows.select(*KEY, F.explode(every).alias("r")).select(
        *KEY, F.col("r.start").alias("start"), F.col("r.best.f").alias("print"),
        F.xxhash64(ID, HASH, "r.best.p").alias("spot"), F.col("r.at").alias("at"), F.col("r.w1").alias("w1"), F.col("r.w2").alias("w2"),
    )


def passages(docs: DataFrame, least: int) -> DataFrame:
    """All units of ``least`` words of the keyed ``docs``, as ``runs`` gives them.

    A run of ``least`` words or more is the union of its units: a line has the unit up to it, or that from it on, inside the run, or
    lies in the unit that starts the run. No line is without words, so a unit has ``least`` lines at most.
    """
    lines = F.transform(F.split("_text", "\n"), lambda x, i: F.struct(i.alias("i"), x.alias("x")))
    rows = docs.select(*KEY, F.filter(lines, lambda s: filled(s["x"])).alias("_lines")).where(F.size("_lines") > 0)

    def words(x: Column) -> Column:
        blanks = F.size(F.split(F.btrim(x, F.lit(" \t\r")), r"[ \t\r]+"))
        return F.greatest(blanks, F.floor(F.length(x) / LETTERS).cast("int"))

    rows = rows.select(
        *KEY, F.transform("_lines", lambda s: s["i"]).alias("_at"),
        F.transform("_lines", lambda s, i: F.struct(F.xxhash64(s["x"]).alias("f"), (-i).alias("p"))).alias("_h"),
        F.transform("_lines", lambda s: F.xxhash64(F.lit("second"), s["x"])).alias("_g"),
        F.transform("_lines", lambda s: words(s["x"])).alias("_n"), F.size("_lines").alias("_size"),
    )

    def length(part: Column) -> Column:
        """Lines of ``part`` that have ``least`` words; 0 if all have fewer."""
        add = lambda a, n: F.when(a["n"] >= least, a).otherwise(F.struct((a["n"] + n).alias("n"), (a["k"] + 1).alias("k")))
        empty = F.struct(F.lit(0).alias("n"), F.lit(0).alias("k"))
        return F.aggregate(part, empty, add, lambda a: F.when(a["n"] >= least, a["k"]).otherwise(0))

    # Units as numbers: first line and length.
    base = least + 1
    places = F.sequence(F.lit(0), F.col("_size") - 1)
    from_line = F.transform(places, lambda i: F.struct(i.alias("i"), length(F.slice("_n", i + 1, least)).alias("k")))

    def before(j: Column) -> Column:
        low = F.greatest(j + 1 - least, F.lit(0))
        k = length(F.reverse(F.slice("_n", low + 1, j - low + 1)))
        return F.struct((j + 1 - k).alias("i"), k.alias("k"))

    codes = lambda units: F.transform(F.filter(units, lambda u: u["k"] > 0), lambda u: u["i"].cast("bigint") * base + u["k"])
    found = F.array_union(codes(from_line), codes(F.transform(places, before)))
    rows = rows.withColumn("_units", found).withColumn("_units", F.when(F.size("_units") > 0, F.col("_units")).otherwise(F.array(F.col("_size").cast("bigint"))))

    def unit(code: Column) -> Column:
        first, k = F.floor(code / base).cast("int"), (code % base).cast("int")
        part = F.slice("_h", first + 1, k)
        return F.struct(
            first.alias("start"), F.array_min(part).alias("best"), F.slice("_at", first + 1, k).alias("at"),
            F.xxhash64(F.transform(part, lambda h: h["f"])).alias("w1"), F.xxhash64(F.slice("_g", first + 1, k)).alias("w2"),
        )

    return rows.select(*KEY, F.explode(F.transform("_units", unit)).alias("r")).select(
        *KEY, F.col("r.start").alias("start"), F.col("r.best.f").alias("print"),
        F.xxhash64(ID, HASH, "r.best.p").alias("spot"), F.col("r.at").alias("at"), F.col("r.w1").alias("w1"), F.col("r.w2").alias("w2"),
    )


def repeated_lines(docs: DataFrame, grams: int = GRAMS, window: int = WINDOW, least: int | None = None) -> DataFrame:
    """Key and number of each line that belongs to a later occurrence of a unit."""
    every = stored(passages(keyed(docs), least) if least else runs(keyed(docs), grams, window), "runs")
    shared = every.groupBy("print").agg(F.min("spot").alias("lo"), F.max("spot").alias("hi")).where("lo != hi").select("print")
    matched = every.join(shared, "print", "left_semi")
    place = F.struct(F.col(ID).isNull().alias("none"), F.col(ID).alias("id"), F.col(HASH).alias("tx"), F.col("start").alias("start"))
    first = matched.groupBy("w1", "w2").agg(F.min(place).alias("first"))
    later = matched.join(first, ["w1", "w2"]).where(place > F.col("first"))
    return later.select(*KEY, F.explode("at").alias("i")).distinct()


def drop_repeated_runs(
    docs: DataFrame, grams: int = GRAMS, window: int = WINDOW, keep_empty: bool = False, least: int | None = None
) -> DataFrame:
    """``docs`` without the repeated lines. Texts of which nothing is left go, or with ``keep_empty`` become empty."""
    return _without(docs, repeated_lines(docs, grams, window, least), keep_empty)


def _without(docs: DataFrame, gone: DataFrame, keep_empty: bool) -> DataFrame:
    gone = stored(gone, "gone")
    # Lines of the touched documents, and of the few others that pass the filter of their keys.
    touched = KeyFilter(stored(gone.select(*KEY).distinct(), "touched"))
    lines = touched.rows(keyed(docs), KEY).select(*KEY, F.posexplode(F.split("_text", "\n")).alias("i", "x"))
    # Repeated rows give their lines once.
    lines = lines.dropDuplicates([*KEY, "i"])
    marks = gone.select(F.col(ID).alias("_gid"), F.col(HASH).alias("_gtx"), F.col("i").alias("_gi"))
    on = lines[ID].eqNullSafe(marks["_gid"]) & (lines[HASH] == marks["_gtx"]) & (lines["i"] == marks["_gi"])
    marked = lines.join(marks, on, "left").select(
        *KEY, "i", "x", F.when(filled(F.col("x")), F.col("_gi").isNotNull()).alias("own")
    )
    upto = Window.partitionBy(*KEY).orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    kept = marked.withColumn("cut", F.coalesce(F.last("own", ignorenulls=True).over(upto), F.lit(False)))
    left = F.array_sort(F.collect_list(F.when(~F.col("cut"), F.struct("i", "x"))))
    rest = kept.groupBy(*KEY).agg(
        F.array_join(F.transform(left, lambda s: s["x"]), "\n").alias("_rest"), F.max("own").alias("_cut")
    ).where("_cut").select(F.col(ID).alias("_rid"), F.col(HASH).alias("_rtx"), "_rest")
    name = free_name(docs, "_row_hash")
    rows = docs.withColumn(name, F.xxhash64("text"))
    # Rows that the filter leaves out stay where they are.
    whole, others = touched.rows(rows, ["doc_id", name], held=False), touched.rows(rows, ["doc_id", name])
    joined = others.join(rest, others["doc_id"].eqNullSafe(rest["_rid"]) & (others[name] == rest["_rtx"]), "left")
    untouched = rest["_rtx"].isNull()
    if not keep_empty:
        joined = joined.where(untouched | filled(rest["_rest"]))
    text = F.when(untouched, others["text"]).otherwise(rest["_rest"]).alias("text")
    new = joined.select(*[text if c == "text" else others[c] for c in docs.columns])
    return whole.drop(name).union(new)
