"""Cleaning steps and features on hand-written text."""

from __future__ import annotations

import hashlib
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postpulse.config import Settings, TextConfig
from postpulse.functions import encoding, features
from postpulse.operators.cleaning import add_clean_text, add_features, clean_dataframe, coerce_types, fill_missing


def cleaned(spark, texts, cfg=TextConfig()):
    df = spark.createDataFrame(list(enumerate(texts)), "n int, content string")
    return [r.content_clean for r in add_clean_text(df, cfg).orderBy("n").collect()]


@pytest.mark.parametrize("encoding_repair", [True, False])
def test_clean_text_pairs(spark, encoding_repair):
    cfg = TextConfig(fix_encoding=encoding_repair)
    pairs = [
        ("Good Morning, Traders?", "good morning, traders?"),
        ("chart at http://charts.in/x1 now", "chart at now"),
        ("@Desk see #Nifty50", "@desk see #nifty50"),
        ("UP 🚀 only", "up only"),
        ("\t two  blanks ", "two blanks"),
        ("Nifty आज ऊपर", "nifty आज ऊपर"),
        ("äöü ß £ ¶", ""),
        (None, ""),
        ("", ""),
        ("a\nb", "ab"),
        ("HTTPS://X.y www.site.in/x end", "https://x.y end"),
        ("😀", ""),
        ("...", "..."),
        ("see\xa0https://a.b/c　now", "seenow" if not encoding_repair else "see now"),
    ]
    assert cleaned(spark, [p[0] for p in pairs], cfg) == [p[1] for p in pairs]


def test_toggles(spark):
    text = "@user Hi #tag 😀 café\nnext"
    assert cleaned(spark, [text], TextConfig(remove_mentions=True, remove_hashtags=True)) == ["hi cafnext"]
    assert cleaned(spark, [text], TextConfig(newline_to_space=True)) == ["@user hi #tag caf next"]
    plain = TextConfig(remove_non_printable=False, convert_to_lowercase=False)
    assert cleaned(spark, [text], plain) == ["@user Hi #tag 😀 café next"]
    assert cleaned(spark, [text], TextConfig(remove_non_printable=False, remove_emojis=True)) == ["@user hi #tag café next"]
    # With Indic text off, only what is not ASCII is dropped, and the line break is whitespace.
    assert cleaned(spark, ["a\nb आ"], TextConfig(keep_indian_chars=False)) == ["a b"]


def test_indic_hashtag_is_removed_up_to_the_first_mark(spark):
    # Combining marks are no word characters.
    assert cleaned(spark, ["#निफ्टी up"], TextConfig(remove_hashtags=True)) == ["िफ्टी up"]


def test_repair_encoding(spark):
    texts = [
        "cafÃ©", "café", "नमस्ते", "itâ€™s", "Tom &amp; Co &lt;3", "a < b &amp; c", "“x” ‘y’", "ＡＢＣ１", "ﬁn ﬂow",
        "a\r\nb\rc d", "x\x00y﻿z", "Ã naïve 漢字",
    ]
    wanted = [
        "café", "café", "नमस्ते", "it's", "Tom & Co <3", "a < b &amp; c", "\"x\" 'y'", "ABC1", "fin flow",
        "a\nb\nc\nd", "xyz", "Ã naïve 漢字",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    assert [r.t for r in encoding.repair_encoding(df, "t").orderBy("n").collect()] == wanted


def test_nfc_decides_what_survives(spark):
    decomposed = "café"
    assert cleaned(spark, [decomposed]) == ["caf"]
    assert cleaned(spark, [decomposed], TextConfig(normalize_nfc=False)) == ["cafe"]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="aB \t\n é1_!?.@#नि😀w.:/htps", max_size=30), min_size=1, max_size=40))
def test_steps_match_plain_python(spark, texts):
    """URL removal, whitespace and features against direct Python."""
    import re

    cfg = TextConfig(fix_encoding=False)
    df = spark.createDataFrame(list(enumerate(texts)), "n int, content string")
    rows = add_features(add_clean_text(df, cfg), cfg).orderBy("n").collect()
    kept = re.compile("[^\x20-\x7eऀ-ॿ஀-௿ఀ-౿ಀ-೿ഀ-ൿ]+")
    for text, row in zip(texts, rows):
        want = " ".join(kept.sub("", re.sub(r"https?://\S+|www\.\S+", "", text).lower()).split())
        words = want.split()
        assert row.content_clean == want
        assert (row.char_count, row.word_count) == (len(want), len(words))
        assert row.sentence_count == len(re.split(r"[.!?]+", want))
        assert row.avg_word_length == pytest.approx(sum(map(len, words)) / len(words) if words else 0)
        assert (row.exclamation_count, row.question_count) == (want.count("!"), want.count("?"))
        assert row.content_hash == hashlib.md5(want.encode()).hexdigest()
        assert row.has_mention == bool(re.search(r"@\w+", want))
        assert row.has_url == bool(re.search(r"https?://\S+|www\.\S+", want))
        assert row.has_hindi == bool(re.search("[ऀ-ॿ]", want))


def test_feature_values(spark):
    text = "this is a test sentence with 11 words and #hashtag @mention."
    df = spark.createDataFrame([(text,)], "content_clean string")
    row = add_features(df).first()
    assert (row.word_count, row.sentence_count, row.has_hashtag, row.has_mention) == (11, 2, True, True)
    assert not row.has_url and not row.has_emoji and not row.has_any_indian_language


def test_words_count_as_substrings_once(spark):
    df = spark.createDataFrame([("enterprise group up up",)], "content_clean string")
    assert add_features(df).first().positive_word_count == 2


def test_raw_text_flags(spark):
    cfg = TextConfig(raw_text_flags=True)
    df = spark.createDataFrame([("BUY NOW https://x.y 😀",)], "content string")
    row = add_features(add_clean_text(df, cfg), cfg).first()
    assert row.has_url and row.has_emoji and row.uppercase_ratio > 0.25
    default = add_features(add_clean_text(df)).first()
    assert not default.has_url and not default.has_emoji and default.uppercase_ratio == 0


def test_fill_missing(spark):
    df = spark.createDataFrame(
        [("a", 1.0, "x", ["t"], True), (None, None, None, None, None)],
        "text string, count double, category string, tags array<string>, flag boolean",
    )
    assert [tuple(r) for r in fill_missing(df).collect()] == [("a", 1.0, "x", ["t"], True), ("", 0.0, "", [], False)]


def test_coerce_types(spark):
    df = spark.createDataFrame(
        [("2024-01-01 00:00:00", "12.7"), ("soon", "many"), (None, None), ("", "1e300"), ("", "NaN")],
        "timestamp string, like_count string",
    )
    rows = coerce_types(df).collect()
    assert [r.like_count for r in rows] == [12, 0, 0, 0, 0]
    assert [r.timestamp is None for r in rows] == [False, True, True, True, True]


def test_clean_dataframe(spark):
    df = spark.createDataFrame(
        [
            ("1", "Same text", 5, "2024-01-01 02:00:00"), ("2", "same   TEXT", None, "2024-01-01 01:00:00"),
            ("3", None, 1, None), ("4", "", 1, "2024-01-02 00:00:00"),
        ],
        "tweet_id string, content string, like_count long, timestamp string",
    )
    rows = {r.tweet_id: r for r in clean_dataframe(df).collect()}
    # The earlier copy stays; of the two blank posts the one that has a time.
    assert sorted(rows) == ["2", "4"]
    assert rows["2"].like_count == 0 and rows["2"].content_clean == "same text"
    assert clean_dataframe(df, Settings(deduplicate=False)).count() == 4


def test_text_work_needs_no_shuffle_and_python_only_for_nfc(spark, data):
    from postpulse.checks.queries import posts

    def plan(cfg):
        df = add_features(add_clean_text(posts(spark, data), cfg), cfg)
        return df._jdf.queryExecution().executedPlan().toString()

    assert "ArrowEvalPython" in plan(TextConfig())
    assert "EvalPython" not in plan(TextConfig(normalize_nfc=False))


def test_cheap_tests_agree_with_the_full_ones(spark):
    """Texts that cheap tests leave out would not have changed: capitals, mis-decoded text, unusual characters."""
    rng = random.Random(5)
    chars = "aZ é\n\x00\x1f\x7f\x80\x9f\xa0ÃÂâôõ" + encoding.CP1252_CHARS + "ʻʼ中🙂𝐀İKſｆ"
    texts = ["", None, *chars, *("".join(rng.choices(chars, k=rng.randrange(1, 6))) for _ in range(3000))]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    capitals = F.length(t) - F.length(F.regexp_replace(t, r"\p{Lu}+", ""))
    got = df.select(
        "t", features.uppercase_ratio(t).alias("ratio"), F.when(F.length(t) == 0, 0.0).otherwise(capitals / F.length(t)).alias("want_ratio"),
        F.regexp_like(t, F.lit(encoding.LEAD_THEN_CHAR)).alias("lead"),
        F.regexp_like(F.translate(t, encoding.CP1252_CHARS, encoding.LATIN1_CONTROLS), F.lit(encoding.LEAD_THEN_TAIL)).alias("want_lead"),
        F.regexp_like(t, F.lit(encoding.UNUSUAL)).alias("unusual"),
    ).collect()
    assert [r.ratio for r in got] == [r.want_ratio for r in got] and [r.lead for r in got] == [r.want_lead for r in got]
    odd = lambda c: (c < " " and c != "\n") or "\x7f" <= c <= "\x9f" or c >= "ʼ"
    assert [r.unusual for r in got] == [None if r.t is None else any(map(odd, r.t)) for r in got]
