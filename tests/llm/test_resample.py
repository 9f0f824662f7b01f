"""Importance resampling against a plain version, and on odd inputs."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from postpulse.llm import queries, resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain(docs, target, percent=25, least=20, buckets=10_000, seed=7):
    """doc_id, n_features, weight, score, rank by the definition."""
    def features(text):
        words = WORD.findall((text or "").translate(FOLD))
        return words + [f"{x} {y}" for x, y in zip(words, words[1:])], len(words)

    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    own = [(d, *features(t)) for d, t in docs]
    raw = Counter(bucket(f) for _, fs, _ in own for f in fs)
    aim = Counter(bucket(f) for t in target for f in features(t)[0])
    s_all, t_all = sum(raw.values()), sum(aim.values())
    gain = [math.floor(1000 * math.log((aim[i] + 1) * (s_all + buckets) / ((raw[i] + 1) * (t_all + buckets)))) for i in range(buckets)]
    rows = []
    for d, fs, n in own:
        weight = sum(gain[bucket(f)] for f in fs) // len(fs) if fs else 0
        h = int(sha256(f"{seed}:{d}".encode()).hexdigest()[:8], 16)
        rows.append((d, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    fit = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0]))
    rank = {r[0]: i + 1 for i, r in enumerate(fit[: percent * len(fit) // 100])}
    return sorted((*r[:4], rank.get(r[0])) for r in rows)


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 1, "x", 2) for d, t in rows], "doc_id bigint, text string, score int, n_words string, rank int").repartition(3)


def test_query_equals_definition(spark, data):
    docs = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    out = queries.QUERIES["op12_importance_resampling"](spark, data)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {k for _, k in out.dtypes} == {"bigint"}
    assert sorted(map(tuple, out.collect())) == plain(docs, target)


@pytest.mark.parametrize("memory", [3, 200_000])
def test_odd_texts(spark, monkeypatch, memory):
    monkeypatch.setattr(resample, "MEMORY", memory)
    rng = random.Random(3)
    words = ["Ab", "a", "12", "é中", "x" * 47, "x" * 48, "y" * 90, "İ"]
    odd = ["", "  \n\n ", "one", "One\ntwo", "\n\na b\n\n.\nc d\n", "a\r\nb\x1cc\x85d e", "Tail\n", "w" * 10_000, "a_b-c@d[e`f{g\x7fh"]
    odd += [(" " if rng.random() < 0.7 else "\n").join(rng.choice(words) for _ in range(rng.randrange(60))) for _ in range(40)]
    odd += ["the same text of a few words\n" * 6] * 3 + ["long " * 30_000, None]
    target = ["a 12 Ab\nthe same text", None, ""]
    rows = list(enumerate(odd))
    for share, least in ((25, 20), (100, 1), (0, 0)):
        got = resample.importance_resample(frame(spark, rows), spark.createDataFrame([(t,) for t in target], "text string"), share, least)
        assert sorted(tuple(r)[:1] + tuple(r)[2:] for r in got.collect()) == plain(rows, target, share, least)


def test_ties_missing_ids_and_empty_tables(spark):
    text = " ".join(f"w{i}" for i in range(25))
    docs = frame(spark, [(None, text), (None, text), (5, text), (5, text), (6, "short")])
    target = spark.createDataFrame([("w1 w2",)], "text string")
    got = resample.importance_resample(docs, target, percent=100).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2, 3, 4] and len(got) == 5
    assert {r.doc_id for r in got if r["rank"] is None} == {6}
    none = docs.limit(0)
    assert resample.importance_resample(none, target).count() == 0
    assert resample.importance_resample(docs, target.limit(0), percent=100).where("rank IS NOT NULL").count() == 4
    kept = resample.keep_drawn(docs, target, percent=50)
    assert kept.columns == docs.columns and 2 <= kept.count() <= 4


def test_pair_hashes_without_pairs():
    hasher = resample.WordHasher()
    words = [b"a", b"word", b"z" * 47, b"z" * 48, b"z" * 200, "é中".encode()]
    left, right = zip(*[(x, y) for x in words for y in words])
    codes = hasher.codes([*left, *right])
    got = hasher.pairs(codes[: len(left)], codes[len(left) :])
    assert got.tolist() == [zlib.crc32(x + b" " + y) for x, y in zip(left, right)]
    assert np.array_equal(hasher.single(codes[: len(left)]), [zlib.crc32(x) for x in left])


def test_equal_lines_are_counted_once(spark):
    """A line that occurs many times reaches the hashing as one row."""
    docs = frame(spark, [(i, "head of all\n" * 50 + f"own {i}") for i in range(30)])
    lines = docs.selectExpr("explode(split(text, '\n')) AS line").groupBy("line").count()
    assert lines.count() == 31
    counts = resample.feature_counts(docs)
    assert counts[zlib.crc32(b"head of") % 10_000] >= 1500 and counts[zlib.crc32(b"all head") % 10_000] >= 49 * 30
