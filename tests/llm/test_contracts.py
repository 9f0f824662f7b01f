"""The queries, digests and columns included, against plain versions over the given documents."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import brute
import pytest
from tokenizers import Tokenizer

from postpulse.llm import packing, queries


@pytest.fixture(scope="module")
def given(spark, data):
    return sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect())


def answer(spark, data, name, columns):
    out = queries.QUERIES[name](spark, data)
    assert out.columns[: len(columns)] == columns
    return [tuple(r)[: len(columns)] for r in out.sort("doc_id").collect()]


def test_op1(spark, data, given):
    got = answer(spark, data, "op1_line_dedup", ["doc_id", "n_kept", "kept_sha256"])
    kept = brute.line_passages(given)
    assert got == [(d, sum(bool(x.strip(" \t\r")) for x in kept[d]), brute.sha("\n".join(kept[d]))) for d, _ in given]


def test_op2(spark, data, given):
    items = [tuple(r) for r in spark.read.parquet(f"{data}/benchmark.parquet").select("item_id", "text").collect()]
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert answer(spark, data, "op2_decontamination", columns) == brute.contamination(given, items)


def test_op3(spark, data, given):
    tokenizer = Tokenizer.from_file(packing.public_tokenizers.path("word_bpe_49k.json"))
    ids = {d: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for d, t in given}
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    got, want, places = answer(spark, data, "op3_best_fit_packing", columns), [], defaultdict(list)
    for d, own in ids.items():
        for n, first in enumerate(range(0, len(own), 4096)):
            part = own[first : first + 4096]
            want.append((d, n, first, len(part), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))))
    assert sorted(r[:5] for r in got) == sorted(want)
    for r in got:
        places[r[5]].append((r[6], r[3]))
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(places) <= -(-sum(map(len, ids.values())) // 4096) * 1.02 + 1


def test_op4(spark, data, given):
    assert answer(spark, data, "op4_ngram_jaccard_join", ["doc_id", "n_shingles", "component_id"]) == brute.jaccard(given)


def test_op5_base(spark, data, given):
    columns = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"]
    want = brute.base_scores(given)
    for r in answer(spark, data, "op5_lm_scoring", columns):
        assert r[1] == (zlib.crc32(str(r[0]).encode()) % 7 == 2) and r[2:5] == want[r[0]][:3] and r[5] == pytest.approx(want[r[0]][3])


def test_op7_base(spark, data, given):
    kinds = (
        ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
        ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20), ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
    )
    columns = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    for (doc, *counts, digest, spans), (_, text) in zip(answer(spark, data, "op7_secret_scan", columns), given):
        found = [(m.start(), i, m.end()) for i, (_, p, g, n) in enumerate(kinds) for m in p.finditer(text or "") if len(m[g]) >= n]
        listed = [f"{kinds[i][0]}:{a}:{b}" for a, i, b in sorted(found)]
        assert counts == [sum(i == k for _, i, _ in found) for k in range(3)] and digest == brute.sha(",".join(listed)), doc
        every = spans.split(",") if spans else []
        assert [s for s in every if not s.startswith("format:")] == listed


def test_op8(spark, data, given):
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    got, order = {r[0]: r for r in answer(spark, data, "op8_simhash", columns)}, given[::-1]
    bits = lambda a, b: 1 - (int(a, 16) ^ int(b, 16)).bit_count() / 128
    prints = defaultdict(set)
    for i, (doc, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)]
        k = len(text) // 3
        edited = text[: len(text) - k] + (after[1] or "")[:k]
        r = got[doc]
        assert r[1:3] == (len(text), brute.sha(edited))
        assert r[5] == pytest.approx(bits(r[3], r[4])) and r[6] == pytest.approx(bits(r[3], got[after[0]][3]))
        prints[text].add(r[3])
        if i < 25:
            assert r[3] == plain_simhash(spark, text)
    assert all(len(p) == 1 for p in prints.values())


def plain_simhash(spark, text):
    """Votes of word pairs, one by one; only the hashes come from Spark."""
    words = [w for w in re.split(r"[ \t\n\x0b\f\r]+", text.lower()) if w]
    pairs = list(zip(words, [*words[1:], None]))
    if not pairs:
        return "0" * 32
    n = Counter(pairs)
    rows = spark.createDataFrame([(a, b, k) for (a, b), k in n.items()], "a string, b string, k int")
    votes, total = [0] * 128, 0
    for r in rows.selectExpr("a", "b", "k", "xxhash64(a, b) AS h1", "xxhash64('second', a, b) AS h2").collect():
        weight = min(4, 1 + (len(r.a) + len(r.b or "")) // 6) * r.k
        total += weight
        for half, h in enumerate((r.h1, r.h2)):
            for j in range(64):
                votes[half * 64 + j] += weight * (h >> j & 1)
    value = [sum((2 * votes[half * 64 + j] > total) << j for j in range(64)) for half in range(2)]
    return f"{value[0]:016x}{value[1]:016x}"


def test_op9(spark, data, given):
    columns = ["doc_id", "held_out", "lang_pred", "score"]
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    got = answer(spark, data, "op9_language_id", columns)
    assert all(r[1] == (zlib.crc32(str(r[0]).encode()) % 5 == 0) and 0 <= r[3] <= 1 for r in got)
    assert sum(r[2] == langs[r[0]] for r in got if r[1]) >= 0.95 * sum(r[1] for r in got)


def test_op10(spark, data, given):
    assert answer(spark, data, "op10_substring_dedup", ["doc_id", "n_words", "n_removed", "kept_sha256"]) == brute.repeats(given)
