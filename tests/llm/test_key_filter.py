"""What the driver holds of keys and list lengths: filters of bits, and the longest lists as numbers."""

from __future__ import annotations

import brute
import numpy as np
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postpulse.llm import common, jaccard, line_dedup


def test_no_key_is_missed(spark):
    rows = spark.range(0, 6000).select(F.when(F.col("id") % 1000 > 0, F.col("id")).alias("_id"), F.xxhash64(F.col("id").cast("string")).alias("_tx"), F.lit(1).alias("_chunk"))
    keys = common.stored(rows.where("_id % 3 = 0 OR _id IS NULL").select("_id", "_tx"), "keys")
    found = common.KeyFilter(keys)
    assert found.chunks == 1 and common.KeyFilter(keys.limit(0)).rows(rows, ["_id", "_tx"]).isEmpty()
    held, others = found.rows(rows, ["_id", "_tx"]), found.rows(rows, ["_id", "_tx"], held=False)
    assert held.columns == others.columns == rows.columns and held.count() + others.count() == 6000
    assert others.where("_id % 3 = 0 OR _id IS NULL").isEmpty() and held.count() < 2400


def test_a_full_filter_lets_more_rows_pass(spark, monkeypatch):
    monkeypatch.setattr(common, "CHUNK_BITS", 64)
    monkeypatch.setattr(common, "MOST_CHUNKS", 2)
    lines = ["a b c d e f g h i", "k l m n o p q r s", "", "t u v"]
    rows = [(i, "\n".join([f"{i} w w w w w w w w", *lines[i % 5 :]])) for i in range(60)]
    docs = spark.createDataFrame([*rows, (90, " \n"), (90, " \n"), (91, None)], "doc_id long, text string")
    gone = line_dedup.repeated_lines(docs, least=8)
    assert common.KeyFilter(gone.select(*common.KEY).distinct()).chunks == 2
    out = [tuple(r) for r in line_dedup.drop_repeated_runs(docs, least=8).collect()]
    assert sorted(r for r in out if r[0] < 60) == sorted((d, "\n".join(x)) for d, x in brute.line_passages(rows).items())
    # Blank and missing texts have no lines: they stay, whatever the filter says.
    assert sorted((r for r in out if r[0] >= 60), key=str) == [(90, " \n"), (90, " \n"), (91, None)]


def test_no_broadcast_holds_the_keys(spark, monkeypatch):
    sent = []
    monkeypatch.setattr(F, "broadcast", lambda df, real=F.broadcast: (sent.append(df), real(df))[1])
    docs = spark.createDataFrame([(i, f"a b c d e f g h i\n{i} k l m n o p q r s t u v w x") for i in range(300)], "doc_id long, text string")
    assert line_dedup.drop_repeated_runs(docs, least=8).count() == 300
    members = spark.range(300).select(F.lit(0).cast("long").alias("root"), F.col("id").alias("doc"))
    jaccard.family_links(members, docs.select(F.col("doc_id").alias("doc"), "text"), 4, 85).count()
    assert sent and all(df.count() < 100 for df in sent)


@pytest.mark.parametrize("bound", [0, 1, 4, 7, 100])
def test_longest_lists_reach_the_driver_as_numbers(spark, monkeypatch, bound):
    texts = [f"w{i} w{i} w{i}" for i in range(30) for _ in range(3 + i // 10)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc long, text string").repartition(5)
    counted = [(i, jaccard.counted(jaccard.shingles(f"w{i} w{i} w{i}", 3))) for i in range(30)]
    order = sorted((-(3 + i // 10), int(own[0] >> np.uint64(24))) for i, own in counted if len(own))
    assert sum(n <= -4 for n, _ in order) > 4
    monkeypatch.setattr(DataFrame, "collect", lambda self: pytest.fail("rows become Python objects of the driver"))
    monkeypatch.setattr(type(docs), "collect", lambda self: pytest.fail("rows become Python objects of the driver"))
    found = jaccard.long_lists(docs, 3, bound=bound, least=4)
    assert found.dtype == np.uint64 and found.tolist() == [v for n, v in order if n <= -4][:bound][::-1]
