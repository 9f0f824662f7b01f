"""The registered queries once more, as SQL for DuckDB."""

from __future__ import annotations

import re

from postpulse.functions import encoding as enc
from postpulse.functions import lexicon as lx
from postpulse.functions.scores import normal_quantile
from postpulse.sources.sample_posts import OPENINGS, TAGS

NOT_KEPT = rf"[^\x20-\x7E{''.join(lx.INDIC_BLOCKS.values())}]+"
AS_OF = "2024-01-31 00:00:00"
DAY = 86_400_000_000
MINUTE = 60_000_000


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def r6(expression: str) -> str:
    return f"round(CAST({expression} AS DOUBLE), 6) + 0.0"


def cut(column: str, pattern: str, replacement: str = "") -> str:
    return f"regexp_replace({column}, {lit(pattern)}, {lit(replacement)}, 'g')"


def matches(column: str, pattern: str) -> str:
    return f"regexp_matches({column}, {lit(pattern)})"


def present(column: str, words: tuple[str, ...]) -> str:
    return "(" + " + ".join(f"CAST(contains(lower({column}), {lit(w)}) AS BIGINT)" for w in words) + ")"


def replaced(column: str, pairs: tuple[tuple[str, str], ...]) -> str:
    for old, new in pairs:
        column = f"replace({column}, {lit(old)}, {lit(new)})"
    return column


def case(modulus: int, values: tuple) -> str:
    arms = " ".join(f"WHEN {i} THEN {lit(v)}" for i, v in enumerate(values) if v is not None)
    return f"CASE event_id % {modulus} {arms} END"


CTE: dict[str, str] = {}

CTE["tweets"] = f"""
SELECT CAST(event_id AS VARCHAR) AS tweet_id, 'user_' || CAST(user_id AS VARCHAR) AS username,
  CASE WHEN event_id % 50 <> 0 OR text IS NOT NULL THEN {case(8, OPENINGS)}
    || CASE WHEN event_id % 4 = 0 THEN ' https://ex.co/p' || event_id ELSE '' END
    || CASE WHEN event_id % 8 = 1 THEN ' @desk #Nifty50' ELSE '' END
    || CASE WHEN event_id % 20 = 7 THEN ' नमस्ते दुनिया' ELSE '' END
    || CASE WHEN event_id % 25 = 3 THEN ' 😀' ELSE '' END
    || CASE WHEN event_id % 40 = 11 THEN ' cafÃ© &amp; “bar”' ELSE '' END
    || CASE WHEN event_id % 50 = 21 THEN ' cafe' || chr(769) || ' ﬁrst' ELSE '' END
    || CASE WHEN event_id % 2 = 0 THEN ' t' || event_id ELSE '' END
    || ' ' || coalesce(text, '') END AS content,
  ts AS "timestamp", coalesce(lang, 'en') AS language, string_split({case(6, TAGS)}, ',') AS hashtags,
  event_id % 20 AS reply_count, event_id * 3 % 50 AS retweet_count, event_id * 7 % 100 AS like_count,
  event_id % 5 AS quote_count, event_id * 13 % 9900 + 100 AS view_count
FROM events LEFT JOIN documents ON doc_id = event_id"""

CTE["entities"] = f"""
SELECT *, CASE WHEN contains(t, '&') AND NOT contains(t, '<') THEN {replaced('t', enc.ENTITIES)} ELSE t END AS t1
FROM (SELECT *, coalesce(content, '') AS t FROM tweets)"""
CTE["narrowed"] = f"""
SELECT *, translate(t1, {lit(enc.CP1252_CHARS)}, {lit(enc.LATIN1_CONTROLS)}) AS narrow FROM entities"""
CTE["decoded"] = f"""
SELECT *, CASE WHEN {matches('narrow', enc.LEAD_THEN_TAIL)} AND {matches('narrow', enc.ALL_LATIN1)}
  THEN try(decode(unhex(array_to_string(list_transform(string_split(narrow, ''), lambda c: printf('%02X', unicode(c))), ''))))
  END AS decoded FROM narrowed"""
_simple = f"translate({replaced('coalesce(decoded, t1)', enc.LIGATURES)}, {lit(enc.WIDE_FROM + enc.QUOTES_FROM)}, {lit(enc.WIDE_TO + enc.QUOTES_TO)})"
CTE["repaired"] = f"""
SELECT * EXCLUDE (t, t1, narrow, decoded), {cut(cut(_simple, enc.LINE_BREAK, chr(10)), enc.CONTROL)} AS repaired FROM decoded"""


def clean(column: str) -> str:
    """The default steps after encoding repair."""
    return f"trim({cut(cut('lower(' + cut(column, lx.URL) + ')', NOT_KEPT), f'[{lx.SPACE}]+', ' ')}, ' ')"


CTE["texts"] = f"""
SELECT * EXCLUDE (repaired), {clean('nfc_normalize(repaired)')} AS content_clean FROM repaired"""

_words = "CASE WHEN content_clean = '' THEN 0 ELSE len(string_split(content_clean, ' ')) END"
FEATURES = {
    "char_count": "CAST(length(content_clean) AS BIGINT)",
    "word_count": f"CAST({_words} AS BIGINT)",
    "sentence_count": "CAST(len(regexp_split_to_array(content_clean, '[.!?]+')) AS BIGINT)",
    "has_emoji": matches("content_clean", lx.EMOJI_CHAR),
    "has_mention": matches("content_clean", lx.MENTION),
    "has_hashtag": matches("content_clean", lx.HASHTAG),
    "has_url": matches("content_clean", lx.URL),
    "avg_word_length": r6(
        "CASE WHEN content_clean = '' THEN 0 ELSE "
        "list_avg(list_transform(string_split(content_clean, ' '), lambda w: length(w))) END"
    ),
    "exclamation_count": "CAST(length(content_clean) - length(replace(content_clean, '!', '')) AS BIGINT)",
    "question_count": "CAST(length(content_clean) - length(replace(content_clean, '?', '')) AS BIGINT)",
    "uppercase_ratio": r6(
        "CASE WHEN content_clean = '' THEN 0 ELSE length(" + cut("content_clean", r"[^\p{Lu}]")
        + ") / CAST(length(content_clean) AS DOUBLE) END"
    ),
    **{f"has_{name}": matches("content_clean", f"[{block}]") for name, block in lx.INDIC_BLOCKS.items()},
    "has_any_indian_language": matches("content_clean", "[" + "".join(lx.INDIC_BLOCKS.values()) + "]"),
    "positive_word_count": present("content_clean", lx.POSITIVE_WORDS),
    "negative_word_count": present("content_clean", lx.NEGATIVE_WORDS),
    "sentiment_score": present("content_clean", lx.POSITIVE_WORDS) + " - " + present("content_clean", lx.NEGATIVE_WORDS),
    "market_term_count": present("content_clean", lx.MARKET_TERMS),
    "content_hash": "md5(content_clean)",
}
CTE["featured"] = "SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in FEATURES.items()) + " FROM texts"
CTE["filled"] = """
SELECT * EXCLUDE (content, hashtags), coalesce(content, '') AS content, coalesce(hashtags, []) AS hashtags FROM featured"""
CTE["cleaned"] = """
SELECT * FROM filled QUALIFY row_number() OVER (PARTITION BY content_hash
  ORDER BY "timestamp" NULLS LAST, tweet_id) = 1"""

_norm = ", ".join(
    f"CASE WHEN max({c}) OVER () > 0 THEN ({c} - min({c}) OVER ()) / nullif(CAST(max({c}) OVER () - min({c}) OVER () AS DOUBLE), 0) END AS {c}_normalized"
    for c in ("reply_count", "retweet_count", "like_count", "quote_count", "view_count")
)
CTE["normalized"] = f"SELECT *, {_norm} FROM cleaned"
CTE["weighted"] = """
SELECT *, 0.2 * reply_count_normalized + 0.3 * retweet_count_normalized + 0.3 * like_count_normalized
  + 0.1 * quote_count_normalized + 0.1 * view_count_normalized AS engagement_score FROM normalized"""


def signals(source: str) -> str:
    return f"""
SELECT *, CAST(sign(sentiment_score) AS BIGINT) AS sentiment_signal,
  (like_count + retweet_count * 2 + reply_count * 3) / 100.0 AS engagement_proxy,
  sign(sentiment_score) * (like_count + retweet_count * 2 + reply_count * 3) / 100.0 AS weighted_sentiment,
  exclamation_count * CAST(0.5 AS DOUBLE) + question_count * CAST(0.3 AS DOUBLE)
    + CASE WHEN uppercase_ratio > 0.3 THEN CAST(0.2 AS DOUBLE) ELSE 0 END AS urgency_signal,
  tanh(market_term_count / CAST(10 AS DOUBLE)) AS market_focus_signal,
  CASE WHEN {present('content_clean', lx.TECHNICAL_PHRASES)} > 0 THEN 1::BIGINT ELSE 0::BIGINT END AS technical_mention_signal,
  CAST(len(list_filter(hashtags, lambda h: contains(lower(h), 'nifty'))) > 0 AS BIGINT) AS has_nifty_hashtag,
  CAST(len(list_filter(hashtags, lambda h: contains(lower(h), 'sensex'))) > 0 AS BIGINT) AS has_sensex_hashtag,
  greatest(0.0, least(1.0, 1 - (epoch_us(max("timestamp") OVER ()) - epoch_us("timestamp")) / CAST({DAY} AS DOUBLE))) AS time_decay
FROM {source}"""


CTE["scored"] = signals("cleaned")
SUMS = ("weighted_sentiment", "technical_mention_signal", "has_nifty_hashtag", "has_sensex_hashtag",
        "like_count", "retweet_count", "reply_count")
MEANS = ("sentiment_signal", "urgency_signal", "market_focus_signal")


def kind(c: str) -> str:
    return "DOUBLE" if c == "weighted_sentiment" else "BIGINT"


def totals(source: str, minutes: int) -> str:
    aggregates = [f"avg({c}) AS {c}" for c in MEANS]
    aggregates += [f"CAST(sum({c}) AS {kind(c)}) AS {c}" for c in SUMS]
    return f"""
SELECT time_bucket(INTERVAL {minutes} MINUTE, "timestamp", (SELECT date_trunc('day', min("timestamp")) FROM {source})) AS "timestamp",
  {', '.join(aggregates)}, count(*) AS tweet_count
FROM {source} WHERE "timestamp" IS NOT NULL GROUP BY ALL"""


def filled(source: str, minutes: int) -> str:
    columns = [f"t.{c}" for c in MEANS] + [f"coalesce(t.{c}, 0) AS {c}" for c in (*SUMS, "tweet_count")]
    return f"""
SELECT s."timestamp", {', '.join(columns)}
FROM (SELECT unnest(generate_series((SELECT min("timestamp") FROM {source}), (SELECT max("timestamp") FROM {source}),
  INTERVAL {minutes} MINUTE)) AS "timestamp") s LEFT JOIN {source} t ON s."timestamp" = t."timestamp" """


DERIVED = """
SELECT *, abs(sentiment_signal) AS sentiment_strength, like_count + retweet_count + reply_count AS engagement_total,
  sentiment_signal AS avg_sentiment, abs(sentiment_signal) * tweet_count AS sentiment_volume FROM {source}"""

_z = repr(normal_quantile(0.95))
_p = "greatest(0.0, least(1.0, (sentiment_signal + 1) / 2))"
_n = "nullif(CAST(tweet_count AS DOUBLE), 0)"
_mid = f"(({_p} + {_z} * {_z} / (2 * {_n})) / (1 + {_z} * {_z} / {_n}))"
_half = f"({_z} * sqrt({_p} * (1 - {_p}) / {_n} + {_z} * {_z} / (4 * {_n} * {_n})) / (1 + {_z} * {_z} / {_n}))"
INTERVALS = f"""
SELECT *, sentiment_ci_upper - sentiment_ci_lower AS sentiment_ci_width FROM (SELECT *,
  CASE WHEN tweet_count = 0 THEN 0 ELSE 2 * ({_mid} - {_half}) - 1 END AS sentiment_ci_lower,
  CASE WHEN tweet_count = 0 THEN 0 ELSE 2 * ({_mid} + {_half}) - 1 END AS sentiment_ci_upper FROM {{source}})"""
WEIGHTS = (("avg_sentiment", 0.4), ("sentiment_volume", 0.2), ("urgency_signal", 0.1),
           ("technical_mention_signal", 0.1), ("engagement_total", 0.1), ("market_focus_signal", 0.1))


def zscore(c: str) -> str:
    return f"({c} - avg({c}) OVER ()) / (stddev_samp({c}) OVER () + 1e-10)"


COMPOSITE = "SELECT *, tanh(" + " + ".join(f"CAST({w} AS DOUBLE) * ({zscore(c)})" for c, w in WEIGHTS) + ") AS composite_signal FROM {source}"

CTE["totals60"] = totals("scored", 60)
CTE["filled60"] = filled("totals60", 60)
CTE["derived60"] = DERIVED.format(source="filled60")
CTE["intervals60"] = INTERVALS.format(source="derived60")
CTE["windows"] = COMPOSITE.format(source="intervals60")
CTE["totals7"] = totals("scored", 7)
CTE["filled7"] = filled("totals7", 7)
CTE["derived7"] = DERIVED.format(source="filled7")

CTE["last_day"] = """
SELECT * FROM filled WHERE "timestamp" >= TIMESTAMP '2024-01-30'
QUALIFY row_number() OVER (PARTITION BY content_hash ORDER BY "timestamp", tweet_id) = 1"""
CTE["last_scored"] = signals("last_day")
CTE["last_totals"] = totals("last_scored", 60)
CTE["both_totals"] = """
SELECT * FROM totals60 WHERE "timestamp" < TIMESTAMP '2024-01-30' UNION ALL SELECT * FROM last_totals"""
CTE["both_filled"] = filled("both_totals", 60)
CTE["both_windows"] = COMPOSITE.format(
    source="(" + INTERVALS.format(source="(" + DERIVED.format(source="both_filled") + ")") + ")"
)

# Scores of every post, duplicates kept, for the stream.
CTE["all_scored"] = signals("filled")
CTE["all_totals"] = totals("all_scored", 60)
CTE["closed"] = """
SELECT * FROM all_totals WHERE "timestamp" + INTERVAL 1 HOUR <=
  (SELECT date_trunc('milliseconds', max("timestamp")) - INTERVAL 2 HOUR FROM all_scored)"""
CTE["closed_filled"] = filled("closed", 60)
CTE["closed_windows"] = COMPOSITE.format(
    source="(" + INTERVALS.format(source="(" + DERIVED.format(source="closed_filled") + ")") + ")"
)

_stop = "[" + ", ".join(lit(w) for w in lx.ENGLISH_STOP_WORDS) + "]"
CTE["tokens"] = f"SELECT tweet_id, regexp_extract_all(lower(content_clean), {lit(lx.TOKEN)}) AS tokens FROM cleaned"
CTE["content_words"] = f"SELECT tweet_id, list_filter(tokens, lambda w: NOT list_contains({_stop}, w)) AS tokens FROM tokens"
CTE["grams"] = """
SELECT tweet_id, list_concat(tokens, CASE WHEN len(tokens) > 1 THEN list_transform(range(1, len(tokens)),
  lambda i: tokens[i] || ' ' || tokens[i + 1]) ELSE [] END) AS grams FROM content_words"""
CTE["pairs"] = "SELECT tweet_id, term, count(*) AS n FROM (SELECT tweet_id, unnest(grams) AS term FROM grams) GROUP BY ALL"
CTE["terms"] = "SELECT term, count(*) AS doc_freq, CAST(sum(n) AS BIGINT) AS term_freq FROM pairs GROUP BY term"
CTE["vocabulary"] = """
SELECT term, doc_freq, term_freq, n_docs, ln((n_docs + 1) / CAST(doc_freq + 1 AS DOUBLE)) + 1 AS idf
FROM terms CROSS JOIN (SELECT count(*) AS n_docs FROM cleaned)
WHERE doc_freq >= 2 AND doc_freq <= 0.95 * n_docs ORDER BY term_freq DESC, term LIMIT 1000"""
CTE["vectors"] = """
SELECT tweet_id, term, n * idf / sqrt(sum(n * idf * n * idf) OVER (PARTITION BY tweet_id)) AS tfidf
FROM pairs JOIN vocabulary USING (term)"""

CTE["width"] = """
SELECT CASE WHEN n > 10000 THEN 60 WHEN n > 5000 THEN 30 WHEN n > 2000 THEN 15 WHEN n > 1000 THEN 10 ELSE 5 END AS m
FROM (SELECT count(*) AS n FROM tweets)"""

CTE["log"] = """
SELECT event_id AS request_id, user_id AS client, ts, epoch_us(ts) AS ats, event_type <> 'error' AS ok, value AS response_time FROM events"""


def audit(per_minute: int, per_hour: int, client: str) -> str:
    def trailing(what: str, span: int) -> str:
        return f"{what} OVER (PARTITION BY client ORDER BY ats RANGE BETWEEN {span} PRECEDING AND {1 if what.startswith('count') else 0} PRECEDING)"

    return f"""
SELECT request_id, client, calls_minute, calls_hour, calls_minute >= {per_minute} OR calls_hour >= {per_hour} AS limited,
  greatest(CASE WHEN calls_minute >= {per_minute} THEN {MINUTE} - (ats - oldest_minute) ELSE 0 END,
    CASE WHEN calls_hour >= {per_hour} THEN {60 * MINUTE} - (ats - oldest_hour) ELSE 0 END) / 1e6 AS wait_seconds
FROM (SELECT request_id, client, ats, {trailing('count(*)', MINUTE)} AS calls_minute, {trailing('count(*)', 60 * MINUTE)} AS calls_hour,
  {trailing('min(ats)', MINUTE)} AS oldest_minute, {trailing('min(ats)', 60 * MINUTE)} AS oldest_hour
  FROM (SELECT request_id, {client} AS client, ats FROM log JOIN events ON event_id = request_id))"""


CTE["audit_users"] = audit(1, 2, "user_id")
CTE["audit_types"] = audit(2, 5, "event_type")
CTE["health"] = """
SELECT endpoint, count(*) FILTER (ok) AS success_count, count(*) FILTER (NOT ok) AS failure_count,
  coalesce(sum(response_time) FILTER (ok), 0) AS total_response_time, max(ts) AS last_used,
  max(ts) FILTER (ok) AS last_success, max(ts) FILTER (NOT ok) AS last_failure,
  count(*) FILTER (NOT ok AND (last_at IS NULL OR (ts, request_id) > (last_at, last_id))) AS consecutive_failures
FROM (SELECT client AS endpoint, *, max(ts) FILTER (ok) OVER (PARTITION BY client) AS last_at,
  arg_max(request_id, (ts, request_id)) FILTER (ok) OVER (PARTITION BY client) AS last_id FROM log) GROUP BY endpoint"""
CTE["active"] = """
SELECT *, success_count / CAST(success_count + failure_count AS DOUBLE) AS success_rate,
  total_response_time / nullif(success_count, 0) AS mean_response_time,
  (success_count = 0 OR success_count / nullif(CAST(success_count + failure_count - consecutive_failures AS DOUBLE), 0) >= 0.7)
    AND consecutive_failures < 3 AS is_active FROM health"""

_sources = [("hashtag", t) for t in ("nifty50", "sensex", "intraday", "banknifty")] + [
    ("term", t) for t in ("nifty 50", "sensex", "bse", "nse")]


def source_arm(i: int, kind_: str, name: str) -> str:
    found = (
        f"len(list_filter(hashtags, lambda h: ltrim(lower(h), '#') = {lit(name)})) > 0" if kind_ == "hashtag"
        else f"contains(lower(content), {lit(name)}) AND language = 'en'"
    )
    return f"SELECT *, {i} AS source_no, {lit(kind_ + ':' + name)} AS matched_source FROM tweets WHERE \"timestamp\" >= TIMESTAMP '2024-01-01' AND {found}"


CTE["matched"] = " UNION ALL ".join(source_arm(i, k, n) for i, (k, n) in enumerate(_sources))
CTE["capped"] = """
SELECT * FROM matched QUALIFY row_number() OVER (PARTITION BY matched_source ORDER BY "timestamp" DESC, tweet_id)
  <= CASE WHEN matched_source LIKE 'hashtag:%' THEN 1000 ELSE 500 END"""
CTE["taken"] = """
SELECT * FROM capped WHERE source_no IN (SELECT source_no FROM (SELECT source_no,
  coalesce(sum(n) OVER (ORDER BY source_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM (SELECT source_no, count(*) AS n FROM capped GROUP BY source_no)) WHERE before < 2000)"""


def query(select: str) -> str:
    """``select`` preceded by the definitions it needs, in order of dependence."""


    needed: list[str] = []

    def visit(text: str) -> None:
        for name in CTE:
            if name not in needed and re.search(rf"\b(FROM|JOIN|IN)\s*\(*\s*{name}\b", text):
                visit(CTE[name])
                if name not in needed:
                    needed.append(name)

    visit(select)
    if not needed:
        return select
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n]})" for n in needed) + "\n" + select
