"""Token alignment against a plain version, and on odd inputs."""

from __future__ import annotations

import random
from bisect import bisect_right
from collections import Counter, defaultdict
from hashlib import sha256

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from postpulse.llm import queries, token_align
from postpulse.llm.common import stored

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def plain(docs):
    """The definition: overlaps of byte ranges, common ends, counts over all documents."""
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = token_align.byte_alphabet()

    def spans(ids, spell):
        out, at = [], 0
        for n in ids:
            out.append((at, at + len(spell(n)), n))
            at = out[-1][1]
        return out, b"".join(spell(n) for n in ids)

    def piece(n):
        own = b.id_to_piece(n)
        return bytes.fromhex(own[3:5]) if b.is_byte(n) else own.replace("▁", " ").encode()

    rows, counts = [], Counter()
    for doc, text in docs:
        own_a = own_b = links = groups = []
        if text:
            own_a, bytes_a = spans(a.encode(" " + text, add_special_tokens=False).ids, lambda n: bytes(letters[c] for c in a.id_to_token(n)))
            own_b, bytes_b = spans(b.encode(text), piece)
            if not bytes_a == bytes_b == b" " + text.encode():
                own_a = own_b = []
            starts = [x[0] for x in own_b]
            links = [
                (x[2], y[2]) for x in own_a for y in own_b[max(0, bisect_right(starts, x[0]) - 1) : bisect_right(starts, x[1] - 1)]
                if x[0] < y[1] and y[0] < x[1]
            ]
            counts.update(links)
            ends = sorted({x[1] for x in own_a} & {x[1] for x in own_b})
            groups = [
                ",".join(str(x[2]) for x in own_a if lo < x[1] <= hi) + "|" + ",".join(str(x[2]) for x in own_b if lo < x[1] <= hi)
                for lo, hi in zip([0, *ends], ends)
            ] if len(text) < 5000 else None
        rows.append((doc, len(own_a), len(own_b), ends if text and own_a else [], links, groups))
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return [
        (doc, n_a, n_b, len(ends), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
         None if groups is None else sha256(";".join(groups).encode()).hexdigest() if groups else "")
        for doc, n_a, n_b, ends, links, groups in rows
    ]


def compare(got, want):
    got = {r[0]: r for r in got}
    assert len(got) == len(want)
    for w in want:
        assert got[w[0]][:7] == w[:7] and (w[7] is None or got[w[0]][7] == w[7]), w[0]


def texts(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, row string, path string, ids_a int").repartition(3)


def test_query_equals_definition(spark, data):
    docs = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    out = queries.QUERIES["op11_token_alignment"](spark, data)
    assert out.columns == COLUMNS
    compare([tuple(r) for r in out.collect()], plain(docs))


@pytest.mark.parametrize("pairs", [0, 1_000_000])
def test_odd_texts(spark, pairs):
    rng = random.Random(4)
    odd = [None, "", " ", "  two  blanks ", "line\n\nbreaks\r\n\ttabs", "<|endoftext|> <s> </s> <unk> <0x0A>", "▁ low line", "ﬁ ２ Ⅳ é é 　 中文🙂",
           "a" * 3000, "don't they'll 1234567890 x=y;\r\n{}\r", "\x00 \x1c null", "same text", "same text", "word " * 20_000,
           "".join(chr(rng.choice([32, 10, 65, 97, 0xE9, 0x4E2D, 0x1F600])) for _ in range(500))]
    rows = list(enumerate(odd))
    got = token_align.alignment_counts(texts(spark, [(i, t, "r", "p", 1) for i, t in rows]), pairs=pairs)
    compare([tuple(r[c] for c in COLUMNS) for r in got.collect()], plain(rows))
    twice = token_align.alignment_counts(texts(spark, [(7, "same text", "r", "p", 1)] * 2 + [(None, "other", "", "", None)] * 2), pairs=pairs)
    assert sorted((r.doc_id or 0, r.n_links > 0, r.count_sum) for r in twice.collect())[2:] == [(7, True, r) for r in [4, 4]]
    assert token_align.alignment_counts(texts(spark, [(1, "x", "", "", 1)]).limit(0), pairs=pairs).count() == 0


def test_groups_spell_the_text(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").limit(20)
    aligned = stored(token_align.align_documents(docs), "aligned")
    ids = {r.doc_id: (r.ids_a, r.ids_b) for r in aligned.collect()}
    groups = token_align.token_groups(aligned).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("number", "a", "b"))).alias("g"))
    found = {r.doc_id: ([x for g in r.g for x in g.a], [x for g in r.g for x in g.b]) for r in groups.collect()}
    assert found == {d: i for d, i in ids.items() if i[0]}


def test_paths_of_random_ends():
    """All paths walk both lists, and close a group at each common end."""
    rng = random.Random(6)
    for _ in range(500):
        size = rng.choice([1, 2, 5, 40, 300])
        cut = lambda p: sorted({i for i in range(1, size) if rng.random() < p} | {size})
        a = cut(rng.random())
        b = a if rng.random() < 0.3 else cut(rng.random()) if rng.random() < 0.5 else sorted({*a, rng.randrange(1, size + 1)})
        both = sorted({*a, *b})
        want = bytes((e in set(a)) + 2 * (e in set(b)) for e in both)
        assert token_align.align_ends(a, b) == want


def test_byte_tokenizer_equals_the_other_library(spark, data):
    path = public_tokenizers.path("byte_bpe_50k.json")
    own, other = token_align.ByteTokenizer(path), Tokenizer.from_file(path)
    other.encode_special_tokens = True
    for r in spark.read.parquet(f"{data}/documents.parquet").where("text IS NOT NULL").limit(60).collect():
        assert own.encode(" " + r.text) == other.encode(" " + r.text, add_special_tokens=False).ids


FILES = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def aligned_rows(found, rows):
    return [tuple(flat[ends[k] : ends[k + 1]].tolist() for flat, ends in found) for k in range(rows)]


@pytest.mark.parametrize("bounds", [(token_align.WORDS, token_align.LETTERS), (5, 10_000), (10_000, 30)])
def test_words_equal_whole_texts(spark, data, bounds):
    """Texts put together from words have the ids and paths of whole texts, also where words are forgotten."""
    rng = random.Random(8)
    marks = [" ", "  ", "\n", " \n", "\n ", "\t", "\xa0", "\x85", "\x1c", "　", "a", "Be", "'s", "12", "...", "▁", "é", "é", "中文", "🙂", "<s>", "\x00"]
    texts = [None, "", " ", "  ", "\n", " lead", "trail ", "trail  ", "trail\n", "trail \n", "▁", "a ▁ b", "same words here", "same words here"]
    texts += ["".join(rng.choices(marks, weights=[9] + [1] * 9 + [4] * 12, k=rng.randrange(1, 40))) for _ in range(600)]
    texts += [r.text for r in spark.read.parquet(f"{data}/documents.parquet").limit(40).collect()]
    a, b = token_align.tokenizers(*FILES)
    assert a.by_words and b.by_words
    words = token_align.Words(a, b, *bounds)
    got = [row for at in range(0, len(texts), 50) for row in aligned_rows(words.align(texts[at : at + 50]), len(texts[at : at + 50]))]
    want = [(ids_a.tolist(), ids_b.tolist(), list(path)) for ids_a, ids_b, path in (token_align.align_text(t, a, b) for t in texts)]
    assert got == want


def test_a_repeated_word_is_encoded_once(monkeypatch):
    a, b = token_align.tokenizers(*FILES)
    read, encode = [], b.encode
    monkeypatch.setattr(b, "encode", lambda text: read.append(len(text)) or encode(text))
    token_align.known_words.cache_clear()
    texts = [" ".join(random.Random(n).choices(["one", "other", "third", "word"], k=300)) for n in range(20)]
    found = token_align.align_texts(texts, *FILES)
    assert sum(read) < 50 and [len(row[0]) for row in aligned_rows(found, 20)] == [300] * 20


def test_files_that_do_not_split_at_blanks_read_whole_texts(monkeypatch):
    a, b = token_align.tokenizers(*FILES)
    texts = [None, "some words  here", "▁", "some words"]
    want = aligned_rows(token_align.align_texts(texts, *FILES), 4)
    monkeypatch.setattr(b, "by_words", False)
    monkeypatch.setattr(token_align, "known_words", None)
    assert aligned_rows(token_align.align_texts(texts, *FILES), 4) == want
