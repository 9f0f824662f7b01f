"""Quality scores: plain logistic scores, held-out accuracy, odd inputs."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import pytest
import xxhash

from postpulse.llm import quality, queries

SCHEMA = "doc_id bigint, text string, label int, at int, score string"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 1, 2, "x") for d, t in rows], SCHEMA).repartition(3)


def plain_score(text, model):
    """The score from single features, one by one."""
    mask, words = (1 << 64) - 1, re.findall(r"\w+|[^\w\s]+", text or "")
    own = [xxhash.xxh3_64_intdigest(w.encode()) for w in words]
    own = [h if i == 0 or h != own[i - 1] else int(quality.REPEAT) for i, h in enumerate(own)]
    f, g = map(int, quality.FACTORS)
    grams = [h * f & mask for h in own] + [((x * g & mask) ^ y) * f & mask for x, y in zip(own, own[1:])]
    n = Counter(h >> (64 - quality.BITS) for h in grams)
    norm = math.sqrt(sum(math.log1p(k) ** 2 for k in n.values())) or 1
    z = sum(math.log1p(k) / norm * model.weights[i] for i, k in n.items()) + model.bias
    return 1 / (1 + math.exp(-z))


def test_held_out_accuracy_and_scores(spark, data):
    folder = data.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    out = queries.QUERIES["op13_quality"](spark, folder)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) for d, r in got.items())
    held = [(got[r.doc_id], r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    right = sum(r.predicted == q for r, q in held)
    assert right >= 0.9 * len(held)
    assert sum(r.predicted for r, q in held if q == 1) >= 0.98 * sum(q for _, q in held)
    model = quality.fit(docs, labels.where("crc32(cast(cast(doc_id AS string) AS binary)) % 5 != 0"))
    for r in docs.limit(150).collect():
        assert got[r.doc_id].score == pytest.approx(plain_score(r.text, model))


def test_labels_of_held_out_rows_teach_nothing(spark, data):
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    own = "crc32(cast(cast(doc_id AS string) AS binary)) % 5 != 0"
    turned = labels.selectExpr("doc_id", f"CASE WHEN {own} THEN quality ELSE 1 - quality END AS quality")
    models = [quality.fit(docs, t.where(own)) for t in (labels, turned)]
    assert (models[0].weights == models[1].weights).all() and models[0].bias == models[1].bias


def test_odd_rows(spark):
    docs = frame(spark, [(None, "no id"), (1, None), (2, ""), (3, "fine words here"), (3, "fine words here"), (4, "bad ### bad"), (5, "x " * 50_000), (6, " \n")])
    labels = spark.createDataFrame(
        [(None, 1), (1, 1), (2, 0), (3, 1), (3, 1), (4, 0), (4, None), (4, 7), (9, 1)], "doc_id bigint, quality int"
    )
    model = quality.fit(docs, labels)
    got = quality.score(docs, model).collect()
    assert len(got) == 8 and all(0 <= r.score <= 1 for r in got)
    bias = {r.score for r in got if r.doc_id in (1, 2, 6)}
    assert len(bias) == 1
    scores = {r.doc_id: r.score for r in got}
    assert scores[3] > scores[4]
    untaught = quality.score(docs, quality.fit(docs, labels.limit(0))).collect()
    assert {r.score for r in untaught} == {0.5}
    assert quality.score(docs.limit(0), model).count() == 0
    # Repeated rows and labels change nothing.
    again = quality.fit(docs.union(docs), labels.union(labels))
    assert (again.weights == model.weights).all()


def test_sample_is_bounded(spark):
    docs = frame(spark, [(i, f"t{i}") for i in range(4000)])
    labels = spark.range(4000).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS quality")
    n = quality.labelled_sample(docs, labels, 400).count()
    assert 300 < n < 500
