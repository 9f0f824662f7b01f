"""The text operators against plain versions of their definitions, and on odd inputs."""

from __future__ import annotations

import random
import textwrap
import zlib
from collections import Counter

import brute
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from postpulse.llm import (
    class_lm, decontaminate, fm_index, jaccard, langid, licenses, line_dedup, packing, queries, secrets, simhash, substring_dedup,
)

SCHEMA = "doc_id bigint, text string, _tx string, n_words int, spans string, lang string, source string"
WORDS = [a + b for a in ("ba", "Re", "ti", "mo", "é") for b in ("n", "ka", "st", "x1", ".", "ly")]


def passage(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """Random texts with shared passages, near and exact copies, shared lines, and odd ones."""
    rng = random.Random(5)
    shared = [passage(rng, 70) for _ in range(3)]
    lines = [passage(rng, 6) for _ in range(12)]
    texts = []
    for i in range(90):
        text = passage(rng, rng.choice([3, 40, 120, 200]))
        if i % 5 == 0:
            text += " " + rng.choice(shared) + " " + passage(rng, 30)
        if i % 7 == 0:
            at = rng.randrange(6)
            text = "\n".join([text, *lines[at : at + rng.choice([3, 4, 6])], "", passage(rng, 9)])
        if i % 9 == 0 and texts:
            words = rng.choice(texts).split(" ")
            words[rng.randrange(len(words))] = "changed"
            text = " ".join(words)
        if i % 13 == 0 and texts:
            text = rng.choice(texts)
        texts.append(text)
    texts += ["", " \n\t ", "word", "\x1c control\x1dchars", passage(rng, 5000), "a b c\n" * 30, "中文 текст ñ"]
    return list(enumerate(texts))


def frame(spark, docs, lang="en"):
    rows = [(d, t, "x", 1, "y", lang, "s") for d, t in docs]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return frame(spark, corpus).cache()


@pytest.fixture(scope="module")
def odd(spark):
    """Missing ids and texts, repeated rows, one id with two texts."""
    return frame(spark, [(None, "no id here at all"), (None, None), (1, None), (2, "twice the same text"), (2, "twice the same text"), (2, "other text"), (3, "")])


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_contamination_equals_definition(spark, docs, corpus):
    items = [(7, " ".join(corpus[0][1].split()[:15])), (8, corpus[20][1]), (9, "word"), (10, None), (11, "...")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for block in (50_000, 20):
        found = decontaminate.find_contamination(docs, bench, block_patterns=block)
        got = {r.doc_id: (r.n_words, r.n_hit, set(r["items"])) for r in found.collect()}
        want = {r[0]: r[1:] for r in brute.contamination(corpus, items)}
        assert {d: (g[0], g[1], len(g[2]), brute.sha(",".join(sorted(g[2]))), g[1] > 0) for d, g in got.items()} == want
    texts = dict(corpus)
    for r in found.where("n_hit > 0").collect():
        words = sum(len(brute.ALNUM.findall(texts[r.doc_id][s.start : s.end])) for s in r.spans)
        assert words == r.n_hit
    kept = {r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect()}
    assert kept == {d for d, w in want.items() if not w[4]}
    assert decontaminate.find_contamination(docs, bench.limit(0)).where("n_hit > 0").count() == 0


@pytest.mark.parametrize("universe", [0.35, 0.0])
def test_jaccard_classes_equal_definition(spark, docs, corpus, monkeypatch, universe):
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    monkeypatch.setattr(jaccard, "UNIVERSE", universe)
    for width, percent in ((4, 85), (5, 80)):
        got = sorted(tuple(r) for r in jaccard.jaccard_classes(docs, width, percent).collect())
        assert got == brute.jaccard(corpus, width, percent)


def test_divide_skip_finds_every_component():
    rng = np.random.default_rng(3)
    base = [np.unique(rng.integers(0, 400, 60).astype(np.uint64)) for _ in range(6)]
    sets = []
    for _ in range(60):
        own = set(base[rng.integers(6)].tolist())
        for _ in range(rng.integers(0, 9)):
            own.discard(rng.choice(sorted(own)))
            own.add(int(rng.integers(0, 400)))
        sets.append(np.array(sorted(own), np.uint64))
    for percent in (50, 80, 90):
        links = jaccard.links_between(sets, sets, True, percent)
        forest, want = jaccard.Forest(60), jaccard.Forest(60)
        for a, b in links:
            forest.join(a, b)
        for a in range(60):
            for b in range(a):
                n = len(np.intersect1d(sets[a], sets[b]))
                if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                    want.join(a, b)
        assert [forest.find(i) for i in range(60)] == [want.find(i) for i in range(60)]


def test_substring_removal_equals_definition(docs, corpus, monkeypatch):
    want = brute.repeats(corpus)
    for shard in (substring_dedup.SHARD, 300):
        monkeypatch.setattr(substring_dedup, "SHARD", shard)
        got = sorted((r.doc_id, r.n_words, r.n_removed, brute.sha(r.kept)) for r in substring_dedup.remove_repeats(docs).collect())
        assert got == want
    assert sum(r[2] > 0 for r in want) > 10


def test_hot_anchors_are_compared_by_hash(docs):
    usual = rows(substring_dedup.remove_repeats(docs).drop("spans"))
    spans = substring_dedup.repeated_spans(docs, hot=0).groupBy("doc").count()
    assert {r[0] for r in usual if r[2]} == {r.doc for r in spans.collect()}


def test_wide_windows_are_sorted_deep_enough():
    """Regions of a window of 150 words have up to 292; copies that differ in few words agree further than the usual depth."""
    rng = random.Random(4)
    base = [str(rng.randrange(50)) for _ in range(290)]
    texts = []
    for i in range(40):
        words = list(base)
        for _ in range(2):
            words[rng.randrange(290)] = f"own{rng.randrange(4)}"
        texts.append((i, " ".join(words)))
    group = pd.DataFrame({"anchor": 1, "digest": range(40), "doc": range(40), "words": [t for _, t in texts]})
    gone = {d: set() for d, _ in texts}
    for r in substring_dedup.search_shard(group, 150).itertuples():
        gone[r.digest].update(range(r.lo, r.hi))
    assert [(d, len(g)) for d, g in gone.items()] == [(r[0], r[2]) for r in brute.repeats(texts, 150)]


def test_matching_windows_equal_definition():
    rng = np.random.default_rng(1)
    for _ in range(40):
        sizes = rng.integers(5, 40, 12)
        parts = [rng.integers(1, 4, n) for n in sizes]
        parts[5][:5] = parts[0][:5]
        text = np.concatenate([np.append(p, 0) for p in parts])
        starts = np.cumsum(sizes + 1) - sizes - 1
        owners = rng.integers(0, 5, 12).astype(np.int32)
        index = fm_index.FMIndex(text, np.repeat(owners, sizes + 1))
        window = int(rng.integers(3, 12))
        marks = [set() for _ in parts]
        for i, lo, hi in fm_index.matching_windows(index, text, starts, sizes, owners, window, probe=2):
            marks[i].update(range(lo, hi))
        grams = {}
        for p, o in zip(parts, owners):
            for i in range(len(p) - window + 1):
                grams.setdefault(tuple(p[i : i + window]), set()).add(o)
        for p, o, found in zip(parts, owners, marks):
            want = set()
            for i in range(len(p) - window + 1):
                if min(grams[tuple(p[i : i + window])]) < o:
                    want.update(range(i, i + window))
            assert found == want


def test_line_runs_equal_definition(docs, corpus):
    want = brute.line_runs(corpus)
    got = {r.doc_id: r.text for r in line_dedup.drop_repeated_runs(docs, keep_empty=True).collect()}
    assert got == {d: "\n".join(x) for d, x in want.items()}
    assert sum(got[d] != t for d, t in corpus) > 3
    kept = line_dedup.drop_repeated_runs(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {d for d, t in corpus if got[d].strip() or not t.strip()}


def test_short_repeated_passages_go(spark, docs, corpus):
    """Every run of 8 words or more that occurs earlier goes, however few its lines; so do copies of short texts."""
    more = [(500, "one two three\n\nfour five six\nseven eight\nown line"), (501, "other\none two three\nfour five six\nseven eight"),
            (502, "short text"), (503, "short text"), (504, "中" * 70), (505, "x\n" + "中" * 70), (506, "short\ntext"), (507, "own line\nshort text")]
    lines = {d: t.split("\n") for d, t in corpus + more}
    size = lambda x: max(len(x.strip(" \t\r").replace("\t", " ").replace("\r", " ").split(" ")) - x.strip(" ").count("  "), len(x) // 8)
    seen, gone = set(), {}
    for d in sorted(lines):
        full = [i for i, x in enumerate(lines[d]) if x.strip(" \t\r")]
        cut = set()
        for a in range(len(full)):
            for b in range(a + 1, min(len(full), a + 40) + 1):
                run = tuple(lines[d][i] for i in full[a:b])
                if sum(map(size, run)) >= 8 or (b - a == len(full)):
                    if run in seen:
                        cut.update(full[a:b])
                    seen.add(run)
        for i, x in enumerate(lines[d]):
            if not x.strip(" \t\r") and i - 1 in cut:
                cut.add(i)
        gone[d] = cut
    given = docs.union(frame(spark, more))
    got = {r.doc_id: r.text for r in line_dedup.drop_repeated_runs(given, keep_empty=True, least=8).collect()}
    want = {d: "\n".join(x for i, x in enumerate(lines[d]) if i not in gone[d]) for d in lines}
    assert {d for d in want if got[d] != want[d]} == set()
    assert (got[501], got[503], got[505], got[506], got[507]) == ("other", "", "x", "short\ntext", "own line\nshort text")


def test_line_runs_need_no_python(docs):
    plan = line_dedup.drop_repeated_runs(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_packing_round_trip(spark, docs, corpus):
    from tokenizers import Tokenizer

    path = packing.public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    packed = packing.pack_documents(docs, path, 256, with_ids=True).cache()
    ids = {d: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for d, t in corpus}
    pieces, used = {}, Counter()
    sequences = {r.sequence_id: r["ids"] for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        own = ids[r.doc_id][r.start : r.start + r.length]
        assert list(r["ids"]) == own == sequences[r.sequence_id][r.offset : r.offset + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes()) and r.start == r.piece * 256
        pieces.setdefault(r.doc_id, []).append(r.length)
        used[r.sequence_id] += r.length
    assert {d: sum(p) for d, p in pieces.items()} == {d: len(i) for d, i in ids.items()}
    assert max(used.values()) <= 256 and all(len(sequences[s]) == n for s, n in used.items())
    assert len(used) <= sum(used.values()) / 256 * 1.05 + 1


def test_dominance_keeps_the_optimum():
    """Against exhaustive packing of few pieces."""

    def best(items, capacity):
        found = [len(items)]

        def go(i, rooms):
            if len(rooms) >= found[0]:
                return
            if i == len(items):
                found[0] = len(rooms)
                return
            for k in range(len(rooms)):
                if rooms[k] >= items[i]:
                    go(i + 1, rooms[:k] + [rooms[k] - items[i]] + rooms[k + 1 :])
            go(i + 1, [*rooms, capacity - items[i]])

        go(0, [])
        return found[0]

    rng = random.Random(2)
    for _ in range(60):
        items = sorted((rng.randint(1, 20) for _ in range(8)), reverse=True)
        left = dict(Counter(items))
        fixed = sum(g.count for g in packing.reduce_by_dominance(left, 20))
        rest = sorted((k for k, n in left.items() for _ in range(n)), reverse=True)
        assert fixed + best(rest, 20) == best(items, 20)


def test_chunked_encoding_equals_whole_texts():
    from tokenizers import Tokenizer

    path = packing.public_tokenizers.path("word_bpe_49k.json")
    texts = ["a\x1cb c", "don't. won't've x'. İ. ΣΑΣ, é ́x\xa0y <|endoftext|> <|ENDOFTEXT|>, 12.5% ½? 三.", "", "  ", "x" * 3000]
    whole = Tokenizer.from_file(path)
    assert [x.tolist() for x in packing.ChunkEncoder(path).encode(pa.array(texts))] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_base_scores_and_gain(docs, corpus):
    want = brute.base_scores(corpus)
    for local in (class_lm.LOCAL, 5):
        got = class_lm.score(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2, top=3, local=local, classes=3).collect()
        assert len(got) == len(corpus)
        for r in got:
            assert (r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:3]
            assert r.base_score == pytest.approx(want[r.doc_id][3])
    assert all(r.score < 0 for r in got)


def test_repeated_rows_score_as_one(docs):
    """Words beyond the broadcast ones count once, however often the row of a held-out document stands there."""
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    twice = docs.unionByName(docs.where(held)).unionByName(docs.where(held & (F.col("doc_id") < 40)))
    got = [{r.doc_id: r for r in class_lm.score(d, ~held, top=3, local=5, classes=3).collect()} for d in (docs, twice)]
    assert got[0].keys() == got[1].keys()
    for d, r in got[0].items():
        assert tuple(got[1][d])[:4] == tuple(r)[:4]
        assert tuple(got[1][d])[4:] == pytest.approx(tuple(r)[4:])


def test_class_model_is_a_distribution():
    rng = np.random.default_rng(0)
    pairs = rng.integers(0, 9, (30, 30)).astype(float)
    own = class_lm.exchange(pairs, 4)

    def likelihood(own):
        table = np.zeros((4, 4))
        np.add.at(table, (own[:, None], own[None, :]), pairs)
        return class_lm._xlogx(table).sum() - class_lm._xlogx(table.sum(0)).sum() - class_lm._xlogx(table.sum(1)).sum()

    start = np.empty(30, np.int64)
    start[np.argsort(-(pairs.sum(0) + pairs.sum(1)), kind="stable")] = np.arange(30) % 4
    assert likelihood(own) > likelihood(start)


def test_language_model_on_held_out_rows(spark, data):
    given = spark.read.parquet(f"{data}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = langid.fit(given.where(~held))
    got = langid.predict(given.where(held), model).join(given.select("doc_id", "lang"), "doc_id")
    assert got.where("lang = lang_pred").count() >= 0.95 * got.count() > 0
    assert model.predict(None) == model.predict("12 !?") == ("und", 0.0)
    assert langid.fit(given.limit(0)).predict("text") == ("und", 0.0)
    assert langid.keep_recognised(given, model).columns == given.columns


def test_simhash_edits_and_search(docs, corpus):
    got = {r.doc_id: r for r in simhash.fingerprint_documents(docs, every=1).collect()}
    order = sorted(corpus, reverse=True)
    for i, (d, t) in enumerate(order):
        n, after = len(t) // 3, order[(i + 1) % len(order)][1]
        assert (got[d].n_chars, got[d].edited_sha256) == (len(t), brute.sha(t[: len(t) - n] + after[:n]))
    value = {d: int(r.fingerprint, 16) for d, r in got.items()}
    for d, r in got.items():
        assert r.n_near == sum((value[d] ^ v).bit_count() <= simhash.RADIUS for v in value.values()) - 1
    texts = dict(corpus)
    assert all(value[a] == value[b] for a in texts for b in texts if texts[a] == texts[b])
    long = [r for d, r in got.items() if len(texts[d]) > 300]
    assert np.mean([r.near_edited for r in long]) > 0.65


def test_simhash_finds_near_duplicates(spark):
    """Pairs at Jaccard 0.8 of five-word shingles: 450 words, 10 of them changed."""
    rng = random.Random(7)
    texts = []
    for i in range(100):
        words = [f"{rng.choice(WORDS)}{rng.randrange(500)}" for _ in range(450)]
        texts.append((2 * i, " ".join(words)))
        for at in range(20, 450, 45):
            words[at] = f"new{rng.randrange(500)}"
        texts.append((2 * i + 1, " ".join(words)))
    got = {r.doc_id: r for r in simhash.fingerprint_documents(frame(spark, texts), every=1).collect()}
    assert sum(r.n_near >= 1 for r in got.values()) >= 0.95 * len(got)
    value = {d: int(r.fingerprint, 16) for d, r in got.items()}
    far = np.array([(value[2 * i] ^ value[2 * i + 1]).bit_count() for i in range(100)])
    print("bits", far.mean(), far.std(), "recall at 3, 16, 20:", (far <= 3).mean(), (far <= 16).mean(), (far <= 20).mean())
    for radius in (0, 3, 20):
        prints = simhash.fingerprint_pairs(frame(spark, texts))
        near = simhash.find_near(prints, prints.where("_id < 40"), radius).count()
        assert near == len({(value[d], v) for d in range(40) for v in value.values() if (value[d] ^ v).bit_count() <= radius})


def test_license_digests(spark):
    mit = licenses.KNOWN["MIT"][0]
    texts = [(1, "Copyright (c) 2020 Someone\n\n" + mit.upper()), (2, "x\nReleased under the  MIT Licence\ny"), (3, mit[:-20]), (4, None), (5, "Licensed under CC BY-NC 4.0!")]
    got = {r.doc_id: (r.licenses, r.whole_text) for r in licenses.scan_licenses(frame(spark, texts)).collect()}
    assert got == {1: (["MIT"], "MIT"), 2: (["MIT notice"], None), 3: ([], None), 4: ([], None), 5: (["CC-BY-NC-4.0 notice"], "CC-BY-NC-4.0 notice")}
    for texts in licenses.KNOWN.values():
        assert all(any(m in t.lower() for m in licenses.MARKERS) for t in texts)


def test_whole_licenses_in_their_usual_form(spark):
    """Headings, copyright lines, other line breaks, and whole licences inside longer texts."""
    whole = dict(licenses.whole_texts()[::-1])
    assert {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2", "GPL-3", "LGPL-2.1", "LGPL-3", "MPL-2.0", "CC0-1.0", "MIT", "ISC", "Zlib"} <= whole.keys()
    names = sorted(whole)
    wrap = lambda t: "\n\n".join("\n".join(textwrap.wrap(p, 60)) for p in t.split("\n\n"))
    line = "Copyright (c) 2024 Some One\nAll rights reserved.\n\n"
    short = ("MIT", "ISC", "Zlib", "BSD-2-Clause", "BSD-3-Clause")
    texts = [(i, (licenses.HEADINGS[n][0] + "\n\n" + line + wrap(whole[n])) if n in short else whole[n]) for i, n in enumerate(names)]
    texts += [(100 + i, "# Notes\n\nBefore it.\n\n" + line + (wrap(whole[n]) if n in short else whole[n]) + "\n\nAfter it.") for i, n in enumerate(names)]
    got = {r.doc_id: (r.licenses, r.whole_text) for r in licenses.scan_licenses(frame(spark, texts)).collect()}
    for i, n in enumerate(names):
        assert n in got[i][0] and got[i][1] == n
        assert n in got[100 + i][0] and got[100 + i][1] is None


def test_licences_by_digests_only(spark):
    """Neighbouring spellings, several licences in one text, almost whole ones; no scan of texts for each known one."""
    whole = dict(licenses.whole_texts())
    isc, mit = whole["ISC"], whole["MIT"]
    texts = [(1, f"first {isc} then {mit} and {isc} end"), (2, f"a {mit[:-30]} b"), (3, f"a {isc.replace(' ', '  ').upper()} b"),
             (4, "licence licence licenced organisation organisation")]
    docs = frame(spark, texts)
    found = licenses.scan_licenses(docs)
    got = {r.doc_id: r.licenses for r in found.collect()}
    assert got == {1: ["ISC", "MIT"], 2: [], 3: ["ISC"], 4: []}
    form = docs.where("doc_id = 4").select(licenses.canonical(F.col("text"))).first()[0]
    assert form == "license license licensed organization organization"
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_secret_formats_are_learned(spark):
    rng = random.Random(1)
    keys = ["".join(rng.choice("0123456789abcdef") for _ in range(32)) for _ in range(80)]
    access = ["AKIA" + "".join(rng.choice("ABCDEFGHIJ234567") for _ in range(16)) for _ in range(80)]
    texts = [(i, f'é token = "{k}" then {a}.') for i, (k, a) in enumerate(zip(keys, access))]
    loose = "AKIB" + access[0][4:]
    texts += [(100, f"plain words {loose} Password:'abc'  PASSWORD: abcdef1 thththelongword"), (101, None), (102, "AKIA123 0123456789abcdef")]
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in secrets.find_secrets(frame(spark, texts)).collect()}
    text = dict(texts)[0]
    at = text.index("AKIA")
    assert got[0] == [("assign", 2, 2 + len(f'token = "{keys[0]}')), ("hex", text.index(keys[0]), text.index(keys[0]) + 32), ("access", at, at + 20)]
    # A key like the labelled ones is found without the fixed prefix.
    assert [s[0] for s in got[100]] == ["format", "assign"] and got[101] == got[102] == []


def test_secrets_inside_tokens_are_found():
    """Candidates begin and end at marks, and are as short as the labelled ones."""
    rng = random.Random(2)
    short = ["zq" + "".join(rng.choice("0123456789") for _ in range(8)) for _ in range(80)]
    long = ["AKIA" + "".join(rng.choice("ABCDEFGHIJ234567") for _ in range(16)) for _ in range(80)]
    automata = {"assign": secrets.infer([secrets.symbols(w) for w in short]), "access": secrets.infer([secrets.symbols(w) for w in long])}
    loose = "AKIB" + long[0][4:]
    for text in (f"at the end {loose}.", f"key={loose} x", f"https://a.example/v/{loose}/raw", f"see {short[0]}, or {loose}...", f"({short[1]})"):
        found = secrets.learned_spans(text, [], automata)
        assert {text[a:b] for a, b, _, _ in found} == {w for w in (loose, short[0], short[1]) if w in text}
        assert all(text[a:b] == value for a, b, _, value in found)
    at = f"key={loose}".index(loose)
    assert secrets.learned_spans(f"key={loose}", [(at, at + 20, "access", loose)], automata) == []


def test_odd_rows(spark, odd):
    none = odd.limit(0)
    bench = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    keyed = 6  # rows that differ in id or text
    for name, run, n in (
        ("lines", lambda d: line_dedup.drop_repeated_runs(d, keep_empty=True), 7),
        ("hits", lambda d: decontaminate.find_contamination(d, bench), 7),
        ("pack", packing.pack_documents, 7),
        ("classes", jaccard.jaccard_classes, 7),
        ("scores", lambda d: class_lm.score(d, F.col("doc_id") != 3), keyed),
        ("licenses", licenses.scan_licenses, keyed),
        ("secrets", secrets.find_secrets, 7),
        ("prints", simhash.fingerprint_documents, keyed),
        ("repeats", substring_dedup.remove_repeats, 7),
    ):
        assert run(odd).count() == n, name
        assert run(none).count() == 0, name
    classes = {(r.doc_id, r.component_id) for r in jaccard.jaccard_classes(odd).collect()}
    assert (2, 2) in classes and (3, 3) in classes and (1, 1) in classes


def test_sql_of_queries(spark, data):
    from postpulse.checks.compare import canonical, connect

    con = connect(data)
    for name, sql in queries.ORACLES.items():
        assert canonical(queries.QUERIES[name](spark, data).toPandas()) == canonical(con.execute(sql).df()), name
