"""The pipeline: every stage on its own input."""

from __future__ import annotations

import brute
import corpus_pipeline as pipeline


def test_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    assert [name for name, _ in pipeline.STAGES] == ["language_id", "line_dedup", "jaccard_join", "decontamination", "packing"]
    states = [docs]
    for name, stage in pipeline.STAGES:
        states.append(pipeline.stored(stage(spark, states[-1], data), name))
    texts = [sorted((r.doc_id, r.text) for r in s.collect()) for s in states[:-1]]
    assert all(s.columns == docs.columns for s in states[:-1])
    assert len(texts[1]) >= 0.98 * len(texts[0])
    lines = {d: "\n".join(x) for d, x in brute.line_passages(texts[1]).items()}
    assert dict(texts[2]) == {d: t for d, t in lines.items() if t.strip() or not dict(texts[1])[d].strip()}
    assert [d for d, _ in texts[3]] == [d for d, _, c in brute.jaccard(texts[2], 5, 80) if d == c]
    items = [tuple(r) for r in spark.read.parquet(f"{data}/benchmark.parquet").select("item_id", "text").collect()]
    assert [d for d, _ in texts[4]] == [r[0] for r in brute.contamination(texts[3], items) if not r[5]]
    assert {r.doc_id for r in states[5].collect()} == {d for d, _ in texts[4]}
    assert spark.read.parquet(f"{data}/documents.parquet").count() >= pipeline.run(spark, data).select("doc_id").distinct().count() > 0


def test_stages_on_odd_rows(spark, data):
    """Missing ids and texts, repeated rows, clashing columns and empty tables pass through every stage."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, _id bigint, _tx string, _rest string"
    plain = spark.read.parquet(f"{data}/documents.parquet").where("lang IS NOT NULL").limit(30).collect()
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars, 1, "x", "y") for r in plain]
    text = rows[0][1]
    rows += [(None, text, "en", "s", 1, 2, "x", "y"), (None, None, None, None, None, None, None, None), (7001, None, "en", "s", 0, 3, "x", "y"),
             (7002, "", "en", "s", 0, 3, "x", "y"), (7003, text + " more", "en", "s", 9, 3, "x", "y"), (7003, text + " more", "en", "s", 9, 3, "x", "y")]
    docs = spark.createDataFrame(rows, schema).repartition(3)
    for given, empty in ((docs, False), (docs.limit(0), True)):
        for name, stage in pipeline.STAGES:
            out = pipeline.stored(stage(spark, given, data), name)
            if name != "packing":
                assert out.columns == docs.columns, name
            assert (out.count() == 0) if empty else (0 < out.count() <= len(rows) + 60), name
