"""Raw lines, flattening and the selection of posts."""

from __future__ import annotations

import json
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from postpulse.config import SelectionConfig
from postpulse.sources import jsonl, selection, tables
from postpulse.sources.sample_posts import raw_lines

FULL = {
    "id": 123, "content": "Nifty up", "user": {"username": "raj", "id": 7}, "date": "2024-01-01T10:00:00+05:30", "lang": "en",
    "hashtags": ["nifty50"], "mentionedUsers": [{"username": "desk"}, {"username": "bob"}], "urls": ["https://x.y"],
    "replyCount": 1, "retweetCount": 2, "likeCount": 3, "quoteCount": 4, "viewCount": 5, "sourceLabel": "Web",
    "media": [{"type": "photo"}, {"type": "video"}], "possiblySensitive": True, "inReplyToTweetId": 99, "unknown": [1, {"a": 2}],
}


@pytest.fixture()
def flat(spark, tmp_path):
    lines = [
        json.dumps(FULL), "", "   ", "{broken", '{"id": 5', "[1, 2]", "17", "null",
        json.dumps({"id": "a", "media": None, "user": None, "mentionedUsers": ["plain", {"username": "u"}], "likeCount": "12.7"}),
        json.dumps({"id": "b", "likeCount": "many", "date": "soon", "hashtags": None, "inReplyToTweetId": None}),
        json.dumps({"id": "c", "user": "only a name", "viewCount": 1e3}),
    ]
    (tmp_path / "feed.jsonl").write_text("\n".join(lines))
    return {r.tweet_id: r for r in jsonl.flatten_tweets(jsonl.ingest_jsonl(spark, str(tmp_path))).collect()}


def test_flatten(flat):
    assert set(flat) == {"123", "a", "b", "c"}
    r = flat["123"]
    assert (r.username, r.user_id, r.content, r.language, r.source) == ("raj", "7", "Nifty up", "en", "Web")
    assert str(r.timestamp) == "2024-01-01 04:30:00"
    assert (r.hashtags, r.mentions, r.urls) == (["nifty50"], ["desk", "bob"], ["https://x.y"])
    assert (r.reply_count, r.retweet_count, r.like_count, r.quote_count, r.view_count, r.media_count) == (1, 2, 3, 4, 5, 2)
    assert r.is_sensitive and r.is_reply and json.loads(r.raw_data) == FULL


def test_defaults(flat):
    a, b, c = flat["a"], flat["b"], flat["c"]
    assert (a.username, a.media_count, a.mentions, a.like_count) == ("", 0, ["plain", "u"], 12)
    assert (b.like_count, b.timestamp, b.hashtags, b.is_reply, b.is_sensitive) == (0, None, [], False, False)
    assert (c.username, c.view_count) == ("", 1000)


def test_raw_lines_round_trip(spark, data, tmp_path):
    from postpulse.checks.queries import posts

    df = posts(spark, data)
    raw_lines(df).write.text(str(tmp_path / "feed"))
    back = jsonl.flatten_tweets(jsonl.ingest_jsonl(spark, str(tmp_path / "feed")))
    keys = ["tweet_id", "username", "language", "like_count"]
    assert sorted(map(tuple, back.select(keys).collect())) == sorted(map(tuple, df.select(keys).collect()))


def brute_force(rows, cfg, since):
    sources = [("hashtag:" + h.lower().lstrip("#"), "tag") for h in cfg.hashtags] + [("term:" + t.lower(), "term") for t in cfg.search_terms]
    out = []
    for name, kind in sources:
        if len(out) >= cfg.min_tweets_target:
            break
        word = name.split(":", 1)[1]
        hits = [
            r for r in rows if str(r.timestamp) >= since and (
                any(word == (t or "").lower().lstrip("#") for t in r.hashtags or []) if kind == "tag"
                else r.language == "en" and word in (r.content or "").lower()
            )
        ]
        cap = cfg.max_tweets_per_hashtag // (1 if kind == "tag" else 2)
        # Newest first, equal times by id.
        hits = sorted(sorted(hits, key=lambda r: r.tweet_id), key=lambda r: r.timestamp, reverse=True)[:cap]
        out += [(r.tweet_id, name) for r in hits]
    return sorted(out)


@pytest.mark.parametrize("target, cap", [(2000, 1000), (100, 30), (10, 30), (10_000, 77), (10_000, 1001)])
def test_collection_matches_brute_force(spark, data, target, cap):
    from postpulse.checks.queries import posts

    cfg = SelectionConfig(min_tweets_target=target, max_tweets_per_hashtag=cap)
    df = posts(spark, data)
    got = selection.collect_posts(df, "2024-01-30 10:00:00", 24 * 20, cfg).select("tweet_id", "matched_source").collect()
    assert sorted(map(tuple, got)) == brute_force(df.collect(), cfg, "2024-01-10")


def test_caps_have_one_plan_and_rank_keys(spark, data):
    from postpulse.checks.queries import posts

    matched = selection.union_sources(posts(spark, data), SelectionConfig(), "2024-01-30 10:00:00", 240)
    plans = []
    for cap in (30, 1000, 50_000):
        out = selection.cap_per_source(matched, SelectionConfig(max_tweets_per_hashtag=cap))
        plans.append(re.sub(r"[0-9]+", "", out._jdf.queryExecution().executedPlan().toString()))
    assert plans[0] == plans[1] == plans[2]
    # Sources are ranked over stored keys; only rows of one id at one time are put in order with their texts.
    ranked = [line for line in plans[0].splitlines() if "row_number" in line and "windowspecdefinition" in line]
    assert len(ranked) == 2 and sum("windowspecdefinition(matched_source#, tweet_id#, _at#" in line for line in ranked) == 1


def test_caps_with_equal_times_and_repeated_rows(spark):
    rows = [("term:a", None if i % 50 == 0 else pd.Timestamp("2024-01-01") + pd.Timedelta(seconds=i // 40), f"p{i % 37:02d}", f"text {i}") for i in range(400)]
    rows += [("hashtag:b", pd.Timestamp("2024-01-01"), "same", "x")] * 9
    rows = [(s, None if t is None else t.to_pydatetime(), i, c) for s, t, i, c in rows]
    df = spark.createDataFrame(rows, "matched_source string, timestamp timestamp, tweet_id string, content string").repartition(4)
    for cap in (0, 1, 7, 90, 396, 399, 798, 5000):
        got = selection.cap_per_source(df, SelectionConfig(max_tweets_per_hashtag=cap)).collect()
        order = lambda r: (r[1] is None, -(r[1].timestamp() if r[1] else 0), r[2])
        want = sorted((r for r in rows if r[0] == "term:a"), key=order)[: cap // 2] + [r for r in rows if r[0] == "hashtag:b"][:cap]
        assert sorted((r[0], str(r[1]), r[2]) for r in got) == sorted((r[0], str(r[1]), r[2]) for r in want), cap
        assert len({r[3] for r in got if r[0] == "term:a"}) == min(cap // 2, 400)
    assert selection.cap_per_source(df.limit(0), SelectionConfig()).count() == 0


def test_hashtag_queries(spark):
    df = spark.createDataFrame(
        [("1", ["#Nifty50"]), ("2", ["SENSEX", None]), ("3", None), ("4", ["#nifty500"])], "id string, hashtags array<string>"
    )
    found = tables.query_data(df, hashtags=["nifty50", "#Sensex"])
    assert sorted(r.id for r in found.collect()) == ["1", "2"]
    assert tables.query_data(df).count() == 4


def test_time_range_is_inclusive(spark):
    df = spark.sql("select timestamp'2024-01-01 00:00:00' as timestamp union all select timestamp'2024-01-02 00:00:00'")
    assert tables.in_time_range(df, "2024-01-01 00:00:00", "2024-01-02 00:00:00").count() == 2
    assert tables.in_time_range(df, start="2024-01-01 00:00:01").count() == 1
    assert tables.in_time_range(df.withColumn("date", F.to_date("timestamp")), end="2024-01-01 12:00:00").count() == 1
