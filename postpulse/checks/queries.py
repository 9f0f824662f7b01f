"""Every operator as a query over the given tables, with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postpulse.checks.oracles import AS_OF, COMPOSITE, FEATURES, NOT_KEPT, WEIGHTS, clean, cut, present, query, r6, zscore
from postpulse.config import RequestConfig, SelectionConfig, TextConfig, Tier
from postpulse.functions import cleaning, encoding, features, scores
from postpulse.functions import lexicon as lx
from postpulse.operators import (
    cleaning as clean_ops, dedupe, engagement, reports, request_log, sampling, signals, tfidf,
)
from postpulse.plans import full_run
from postpulse.session import cut_lineage, scratch_path
from postpulse.sinks import retention, signal_store, storage
from postpulse.sources import jsonl, sample_posts, selection, tables
from postpulse.streaming import live_signals

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

Query = Callable[[SparkSession, str], DataFrame]


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = query(oracle)
        return run

    return add


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six places, without negative zero."""
    return df.withColumns(
        {c: F.round(F.col(c), 6) + F.lit(0.0) for c, kind in df.dtypes if kind == "double"}
    )


def tags(df: DataFrame) -> DataFrame:
    return df.withColumn("hashtags", F.array_join("hashtags", ","))


def posts(spark: SparkSession, folder: str) -> DataFrame:
    return sample_posts.read_tweets(spark, folder)


def texts(spark: SparkSession, folder: str) -> DataFrame:
    return clean_ops.add_clean_text(posts(spark, folder)).select("tweet_id", "content_clean")


def cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return clean_ops.clean_dataframe(posts(spark, folder))


def stored(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned posts, materialised for queries that read them more than once."""
    return cut_lineage(cleaned(spark, folder))


def stored_texts(spark: SparkSession, folder: str) -> DataFrame:
    """The texts of cleaned posts alone, materialised as above."""
    return cut_lineage(cleaned(spark, folder).select("tweet_id", "content_clean"))


def scored(spark: SparkSession, folder: str) -> DataFrame:
    return full_run.scored_posts(posts(spark, folder))


def windows(spark: SparkSession, folder: str, minutes: int = 60) -> DataFrame:
    return signals.aggregate_signals(scored(spark, folder), minutes)


def finished(spark: SparkSession, folder: str) -> DataFrame:
    return full_run.posts_to_signals(posts(spark, folder))


def log(spark: SparkSession, folder: str) -> DataFrame:
    return sample_posts.request_log(spark.read.parquet(f"{folder}/events.parquet"))


def landed(spark: SparkSession, folder: str) -> str:
    """The posts as a folder of raw lines, with a blank and two broken lines for each tenth post."""
    lines = sample_posts.raw_lines(posts(spark, folder), F.col("tweet_id").cast("bigint").alias("number"))
    extra = F.when(
        F.col("number") % 10 == 0,
        F.array("value", F.lit("  "), F.concat(F.lit('{"id": '), F.col("value")), F.lit("not json")),
    ).otherwise(F.array("value"))
    path = scratch_path(spark, "landed")
    lines.select(F.explode(extra).alias("value")).write.text(path)
    return path


DOUBLE_MEASURES = {"sentiment_signal", "urgency_signal", "market_focus_signal", "weighted_sentiment",
                   "sentiment_strength", "avg_sentiment", "sentiment_volume", "sentiment_ci_lower",
                   "sentiment_ci_upper", "sentiment_ci_width", "composite_signal"}
TOTALS = (*signals.MEANS, *signals.SUMS, "tweet_count")
DERIVED = (*TOTALS, "sentiment_strength", "engagement_total", "avg_sentiment", "sentiment_volume")
INTERVALS = (*DERIVED, "sentiment_ci_lower", "sentiment_ci_upper", "sentiment_ci_width")
FINISHED = (*INTERVALS, "composite_signal")


def measures(columns: tuple[str, ...], source: str) -> str:
    listed = ", ".join(f"{r6(c)} AS {c}" if c in DOUBLE_MEASURES else f"CAST({c} AS BIGINT) AS {c}" for c in columns)
    return f'SELECT "timestamp", {listed} FROM {source}'


WRITTEN = measures(FINISHED, "windows")


# --- sources --------------------------------------------------------------------------

POST_COLUMNS = (
    "tweet_id", "username", "content", "timestamp", "language", "hashtags",
    "reply_count", "retweet_count", "like_count", "quote_count", "view_count",
)
POSTS_SQL = (
    'SELECT tweet_id, username, content, "timestamp", language, array_to_string(hashtags, \',\') AS hashtags, '
    "reply_count, retweet_count, like_count, quote_count, view_count FROM tweets"
)


@register("make_tweets", POSTS_SQL)
def make_tweets(spark, folder):
    return tags(posts(spark, folder))


@register(
    "ingest_jsonl",
    """SELECT tweet_id AS id, username, content, language AS lang, CAST(like_count AS VARCHAR) AS "likeCount",
    array_to_string(hashtags, ',') AS hashtags FROM tweets""",
)
def ingest_jsonl(spark, folder):
    raw = jsonl.ingest_jsonl(spark, landed(spark, folder))
    return tags(raw.select("id", "user.username", "content", "lang", "likeCount", "hashtags"))


@register(
    "flatten_tweets",
    """SELECT tweet_id, username, replace(username, 'user_', '') AS user_id, coalesce(content, '') AS content,
    "timestamp", language, coalesce(array_to_string(hashtags, ','), '') AS hashtags, 'desk' AS mentions,
    reply_count, retweet_count, like_count, quote_count, view_count, '' AS source, CAST(0 AS BIGINT) AS media_count,
    false AS is_sensitive, false AS is_reply FROM tweets""",
)
def flatten_tweets(spark, folder):
    flat = jsonl.flatten_tweets(jsonl.ingest_jsonl(spark, landed(spark, folder)))
    return tags(flat).withColumns(
        {"mentions": F.array_join("mentions", ","), "timestamp": F.col("timestamp").cast("timestamp_ntz")}
    ).drop("urls", "collected_at", "raw_data")


@register("scan_parquet", "SELECT event_id, ts, event_type FROM events WHERE event_type = 'error' AND value > 10")
def scan_parquet(spark, folder):
    condition = (F.col("event_type") == "error") & (F.col("value") > 10)
    return tables.scan_parquet(spark, f"{folder}/events.parquet", condition, ["event_id", "ts", "event_type"])


@register(
    "dataset_stats",
    """SELECT CAST(count(*) AS BIGINT) AS total_rows, CAST(1 AS BIGINT) AS num_files, CAST(11 AS BIGINT) AS num_columns,
    'l_orderkey,l_partkey,l_suppkey,l_linenumber,l_quantity,l_extendedprice,l_discount,l_tax,l_returnflag,l_linestatus,l_shipdate'
    AS columns, '' AS partition_columns FROM lineitem""",
)
def dataset_stats(spark, folder):
    return tables.dataset_stats(spark.read.parquet(f"{folder}/lineitem.parquet")).drop("total_size_mb")


# --- selection ------------------------------------------------------------------------

# A look-back over the whole month that the tables cover.
SELECTION = SelectionConfig()
HOURS = 720


@register(
    "select_hashtag",
    """SELECT tweet_id, "timestamp" FROM tweets WHERE "timestamp" >= TIMESTAMP '2024-01-01'
    AND len(list_filter(hashtags, lambda h: ltrim(lower(h), '#') = 'nifty50')) > 0""",
)
def select_hashtag(spark, folder):
    return selection.select_hashtag(posts(spark, folder), "#nifty50", AS_OF, HOURS).select("tweet_id", "timestamp")


@register(
    "select_term",
    """SELECT tweet_id, "timestamp" FROM tweets WHERE "timestamp" >= TIMESTAMP '2024-01-01' AND language = 'en'
    AND contains(lower(content), 'sensex')""",
)
def select_term(spark, folder):
    return selection.select_term(posts(spark, folder), "Sensex", AS_OF, HOURS).select("tweet_id", "timestamp")


@register("union_sources", "SELECT tweet_id, source_no, matched_source FROM matched")
def union_sources(spark, folder):
    return selection.union_sources(posts(spark, folder), SELECTION, AS_OF, HOURS).select(
        "tweet_id", "source_no", "matched_source"
    )


@register("cap_per_source", 'SELECT tweet_id, matched_source, "timestamp" FROM capped')
def cap_per_source(spark, folder):
    matched = selection.union_sources(posts(spark, folder), SELECTION, AS_OF, HOURS)
    return selection.cap_per_source(matched, SELECTION).select("tweet_id", "matched_source", "timestamp")


@register("stop_at_target", 'SELECT tweet_id, matched_source, "timestamp" FROM taken')
def stop_at_target(spark, folder):
    return selection.collect_posts(posts(spark, folder), AS_OF, HOURS, SELECTION).select(
        "tweet_id", "matched_source", "timestamp"
    )


@register("language_filter", "SELECT tweet_id, language FROM tweets WHERE language IN ('en', 'hi')")
def language_filter(spark, folder):
    return selection.language_filter(posts(spark, folder)).select("tweet_id", "language")


# --- sinks: what was written, read back ---------------------------------------------------

NARROW = "SELECT tweet_id, \"timestamp\", like_count"


def narrow(df: DataFrame) -> DataFrame:
    return df.select("tweet_id", "timestamp", "like_count")


@register(
    "save_tweets",
    f'{NARROW}, CAST(CAST("timestamp" AS DATE) AS VARCHAR) AS date, CAST(date_part(\'hour\', "timestamp") AS INTEGER) AS hour FROM tweets',
)
def save_tweets(spark, folder):
    path = scratch_path(spark, "posts")
    storage.save_tweets(posts(spark, folder), path)
    return spark.read.parquet(path).select("tweet_id", "timestamp", "like_count", F.col("date").cast("string").alias("date"), "hour")


@register("save_table", f"{NARROW} FROM tweets UNION ALL {NARROW} FROM tweets WHERE like_count > 50")
def save_table(spark, folder):
    base = scratch_path(spark, "tables")
    df = narrow(posts(spark, folder))
    storage.save_table(df, base, "posts", "error")
    path = storage.save_table(df.where("like_count > 50"), base, "posts", "append")
    return narrow(spark.read.parquet(path))


@register(
    "partition_overwrite",
    f"""{NARROW}, quote_count FROM tweets WHERE quote_count <> 2
    UNION ALL SELECT tweet_id, "timestamp", like_count + 1000, quote_count FROM tweets WHERE quote_count = 2 AND like_count > 50""",
)
def partition_overwrite(spark, folder):
    path = scratch_path(spark, "partitions")
    df = posts(spark, folder).select("tweet_id", "timestamp", "like_count", "quote_count")
    storage.partition_overwrite(df, path, ["quote_count"])
    changed = df.where("quote_count = 2 and like_count > 50").withColumn("like_count", F.col("like_count") + 1000)
    storage.partition_overwrite(changed, path, ["quote_count"])
    return spark.read.schema(df.schema).parquet(path)


@register("append_single", f"{NARROW} FROM tweets UNION ALL {NARROW} FROM tweets")
def append_single(spark, folder):
    path = scratch_path(spark, "appended")
    for _ in range(2):
        storage.append_single(narrow(posts(spark, folder)), path)
    return spark.read.parquet(path)


_candidates = ("language", "like_count", "quote_count", "tweet_id", "username")


@register(
    "pick_partition_cols",
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS \"column\", count(DISTINCT {c}) AS distinct_count, "
        f"count(DISTINCT {c}) BETWEEN 2 AND 99 AS eligible FROM tweets"
        for i, c in enumerate(_candidates)
    ),
)
def pick_partition_cols(spark, folder):
    return storage.partition_col_report(posts(spark, folder), _candidates)


@register("compact_dataset", f"{NARROW} FROM tweets")
def compact_dataset(spark, folder):
    source, target = scratch_path(spark, "parts"), scratch_path(spark, "compact")
    narrow(posts(spark, folder)).write.parquet(source)
    storage.compact_dataset(spark, source, target)
    return spark.read.parquet(target)


def dated(spark: SparkSession, folder: str) -> DataFrame:
    return storage.with_date_hour(posts(spark, folder))


@register(
    "retention_filter",
    'SELECT tweet_id, CAST(CAST("timestamp" AS DATE) AS VARCHAR) AS date FROM tweets WHERE CAST("timestamp" AS DATE) >= DATE \'2024-01-16\'',
)
def retention_filter(spark, folder):
    return storage.retention_filter(dated(spark, folder), AS_OF, 15).select("tweet_id", F.col("date").cast("string").alias("date"))


@register(
    "retention_expired",
    """SELECT CAST(CAST("timestamp" AS DATE) AS VARCHAR) AS date, count(*) AS row_count FROM tweets
    WHERE CAST("timestamp" AS DATE) < DATE '2024-01-16' GROUP BY ALL""",
)
def retention_expired(spark, folder):
    return storage.expired_dates(dated(spark, folder), AS_OF, 15).withColumn("date", F.col("date").cast("string"))


@register(
    "retention_apply",
    """SELECT tweet_id, CAST(CAST("timestamp" AS DATE) AS VARCHAR) AS date FROM tweets WHERE CAST("timestamp" AS DATE) >= DATE '2024-01-16'""",
)
def retention_apply(spark, folder):
    """What is left of a table of daily partitions after the expired ones were deleted."""
    base = scratch_path(spark, "tiers")
    dated(spark, folder).select("tweet_id", "date").write.partitionBy("date").parquet(f"{base}/raw")
    retention.apply_retention(spark, base, AS_OF, [Tier("raw", 15)], delete=True)
    return spark.read.parquet(f"{base}/raw").select("tweet_id", F.col("date").cast("string").alias("date"))


@register("write_clean", "SELECT tweet_id, content_clean, content_hash FROM cleaned")
def write_clean(spark, folder):
    path = scratch_path(spark, "processed")
    storage.write_run(cleaned(spark, folder).select("tweet_id", "content_clean", "content_hash"), path, "r1")
    return spark.read.parquet(path).where("run_id = 'r1'").drop("run_id")


@register("write_signals", WRITTEN)
def write_signals(spark, folder):
    path = scratch_path(spark, "signals")
    storage.write_run(finished(spark, folder), path, "r1")
    return rounded(storage.read_run(spark, path, "r1").select("timestamp", *FINISHED))


_summary_sql = ", ".join(
    f"{e} AS {n}"
    for n, e in (
        ("signal_windows", "count(*)"),
        ("avg_signal_strength", r6("avg(abs(composite_signal))")),
        ("signal_volatility", r6("stddev_samp(composite_signal)")),
        ("positive_signal_percentage", r6("count(*) FILTER (composite_signal > 0) * 100.0 / count(*)")),
        ("mean", r6("avg(composite_signal)")),
        ("std", r6("stddev_samp(composite_signal)")),
        ("min", r6("min(composite_signal)")),
        ("max", r6("max(composite_signal)")),
        ("q25", r6("quantile_cont(composite_signal, 0.25)")),
        ("median", r6("quantile_cont(composite_signal, 0.5)")),
        ("q75", r6("quantile_cont(composite_signal, 0.75)")),
    )
)


@register("write_summary_json", f"SELECT {_summary_sql} FROM windows")
def write_summary_json(spark, folder):
    path = scratch_path(spark, "summary")
    summary = reports.signal_summary(finished(spark, folder))
    storage.write_summary_json(summary, path)
    return rounded(spark.read.schema(summary.schema).json(path))


# --- filters and projections --------------------------------------------------------------


@register(
    "query_time_range",
    """SELECT tweet_id, "timestamp" FROM tweets
    WHERE "timestamp" BETWEEN TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-20 18:30:00'""",
)
def query_time_range(spark, folder):
    found = tables.query_data(dated(spark, folder), "2024-01-05 06:00:00", "2024-01-20 18:30:00")
    return found.select("tweet_id", "timestamp")


@register(
    "query_hashtags",
    """SELECT tweet_id, array_to_string(hashtags, ',') AS hashtags FROM tweets
    WHERE list_has_any(list_transform(hashtags, lambda h: lower(h)), ['#nifty50', '#banknifty'])""",
)
def query_hashtags(spark, folder):
    found = tables.query_data(posts(spark, folder), hashtags=["#Nifty50", "BANKNIFTY"])
    return tags(found.select("tweet_id", "hashtags"))


@register(
    "query_min_engagement",
    f"SELECT tweet_id, {r6('engagement_score')} AS engagement_score FROM weighted WHERE engagement_score >= 0.4005",
)
def query_min_engagement(spark, folder):
    found = tables.query_data(engagement.normalize_data(stored(spark, folder)), min_engagement=0.4005)
    return rounded(found.select("tweet_id", "engagement_score"))


@register("project_columns", "SELECT l_orderkey, l_quantity FROM lineitem")
def project_columns(spark, folder):
    return tables.project_columns(spark.read.parquet(f"{folder}/lineitem.parquet"), ["l_orderkey", "l_quantity"])


@register(
    "recent_window",
    f"""SELECT "timestamp", tweet_count, {r6('composite_signal')} AS composite_signal, {r6('avg_sentiment')} AS avg_sentiment,
    {r6('weighted_sentiment')} AS weighted_sentiment FROM windows
    WHERE "timestamp" >= (SELECT max("timestamp") - INTERVAL 24 HOUR FROM windows)""",
)
def recent_window(spark, folder):
    return rounded(reports.recent_window(finished(spark, folder), 24))


@register(
    "fill_missing",
    """SELECT tweet_id, coalesce(content, '') AS content, "timestamp", coalesce(array_to_string(hashtags, ','), '') AS hashtags,
    like_count, coalesce(CASE WHEN like_count > 90 THEN NULL ELSE like_count END, 0) AS shown FROM tweets""",
)
def fill_missing(spark, folder):
    df = posts(spark, folder).select("tweet_id", "content", "timestamp", "hashtags", "like_count")
    return tags(clean_ops.fill_missing(df.withColumn("shown", F.when(F.col("like_count") <= 90, F.col("like_count")))))


@register(
    "coerce_types",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE ts END AS "timestamp",
    CASE WHEN event_id % 4 = 0 THEN 0 ELSE CAST(trunc(value) AS BIGINT) END AS like_count,
    user_id AS view_count FROM events""",
)
def coerce_types(spark, folder):
    loose = spark.read.parquet(f"{folder}/events.parquet").select(
        "event_id",
        F.when(F.col("event_id") % 3 == 0, "not a time").otherwise(F.col("ts").cast("string")).alias("timestamp"),
        F.when(F.col("event_id") % 4 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("like_count"),
        F.col("user_id").cast("double").alias("view_count"),
    )
    typed = clean_ops.coerce_types(loose)
    return typed.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


# --- text cleaning ----------------------------------------------------------------------------


def text_query(name: str, step: Callable[[Column], Column], sql: str) -> None:
    def run(spark, folder):
        source = F.coalesce("content", F.lit(""))
        return posts(spark, folder).select("tweet_id", step(source).alias("text"))

    register(name, f"SELECT tweet_id, {sql} AS text FROM tweets")(run)


_content = "coalesce(content, '')"
text_query("clean_remove_urls", cleaning.remove_urls, cut(_content, lx.URL))
text_query("clean_remove_mentions", cleaning.remove_mentions, cut(_content, lx.MENTION))
text_query("clean_remove_hashtags", cleaning.remove_hashtags, cut(_content, lx.HASHTAG))
text_query("clean_remove_emoji", cleaning.remove_emoji, cut(_content, lx.EMOJI_CHAR))
text_query("clean_lowercase", F.lower, f"lower({_content})")
text_query("clean_strip_nonprintable", cleaning.strip_nonprintable, cut(_content, NOT_KEPT))
text_query("clean_strip_nonascii", lambda c: cleaning.strip_nonprintable(c, False), cut(_content, lx.NOT_ASCII))
text_query("clean_collapse_ws", cleaning.collapse_whitespace, f"trim({cut(_content, f'[{lx.SPACE}]+', ' ')}, ' ')")


@register("repair_encoding", "SELECT tweet_id, repaired FROM repaired")
def repair_encoding(spark, folder):
    df = posts(spark, folder).select("tweet_id", F.coalesce("content", F.lit("")).alias("repaired"))
    return encoding.repair_encoding(df, "repaired")


@register("normalize_nfc", f"SELECT tweet_id, nfc_normalize({_content}) AS text FROM tweets")
def normalize_nfc(spark, folder):
    return posts(spark, folder).select("tweet_id", encoding.normalize_nfc(F.coalesce("content", F.lit(""))).alias("text"))


@register("clean_text", "SELECT tweet_id, content_clean FROM texts")
def clean_text(spark, folder):
    return texts(spark, folder)


@register("clean_documents", f"SELECT doc_id, {clean('text')} AS content_clean FROM documents")
def clean_documents(spark, folder):
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    return cleaning.clean_text(documents, "text", cfg=TextConfig(fix_encoding=False)).select("doc_id", "content_clean")


# --- features -----------------------------------------------------------------------------------


def feature_query(name: str, *columns: str) -> None:
    def run(spark, folder):
        return rounded(clean_ops.add_features(texts(spark, folder)).select("tweet_id", *columns))

    register(name, f"SELECT tweet_id, {', '.join(f'{FEATURES[c]} AS {c}' for c in columns)} FROM texts")(run)


feature_query("feat_lengths", "char_count", "word_count")
feature_query("feat_sentence_count", "sentence_count")
feature_query("feat_presence_flags", "has_emoji", "has_mention", "has_hashtag", "has_url")
feature_query("feat_avg_word_length", "avg_word_length")
feature_query("feat_punct_counts", "exclamation_count", "question_count")
feature_query("feat_uppercase_ratio", "uppercase_ratio")
feature_query(
    "feat_script_flags",
    "has_hindi", "has_tamil", "has_telugu", "has_kannada", "has_malayalam", "has_any_indian_language",
)
feature_query("feat_sentiment", "positive_word_count", "negative_word_count", "sentiment_score")
feature_query("feat_market_terms", "market_term_count")
feature_query("content_hash", "content_hash")
feature_query("expand_features", *FEATURES)


@register(
    "feat_raw_surface",
    f"""SELECT tweet_id, regexp_matches({_content}, '{lx.URL}') AS has_url, regexp_matches({_content}, '{lx.EMOJI_CHAR}') AS has_emoji,
    {r6(f"CASE WHEN {_content} = '' THEN 0 ELSE length({cut(_content, '[^' + chr(92) + 'p{Lu}]')}) / CAST(length({_content}) AS DOUBLE) END")}
    AS uppercase_ratio FROM tweets""",
)
def feat_raw_surface(spark, folder):
    added = features.feature_columns(F.lit(""), F.col("content"), TextConfig(raw_text_flags=True))
    return rounded(
        posts(spark, folder).select("tweet_id", *[added[c].alias(c) for c in ("has_url", "has_emoji", "uppercase_ratio")])
    )


@register(
    "clean_dataframe",
    'SELECT tweet_id, username, "timestamp", language, array_to_string(hashtags, \',\') AS hashtags, reply_count, retweet_count, '
    f"like_count, quote_count, view_count, content, content_clean, {', '.join(FEATURES)} FROM cleaned",
)
def clean_dataframe(spark, folder):
    return rounded(tags(cleaned(spark, folder)))


# --- duplicates, engagement ------------------------------------------------------------------------


@register("dedupe_by_hash", "SELECT tweet_id, \"timestamp\", content_hash FROM cleaned")
def dedupe_by_hash(spark, folder):
    df = cleaning.clean_text(posts(spark, folder)).withColumn("content_hash", features.content_hash(F.col("content_clean")))
    return dedupe.dedupe_by_hash(df.select("tweet_id", "timestamp", "content_hash"))


@register(
    "dedupe_report",
    """SELECT count(*) AS rows_before, count(DISTINCT content_hash) AS rows_after,
    count(*) - count(DISTINCT content_hash) AS rows_removed FROM featured""",
)
def dedupe_report(spark, folder):
    return dedupe.dedupe_report(texts(spark, folder).select(features.content_hash(F.col("content_clean")).alias("content_hash")))


_normalised = [f"{c}_normalized" for c in engagement.WEIGHTS]


@register(
    "minmax_normalize",
    "SELECT tweet_id, " + ", ".join(f"{r6(c)} AS {c}" for c in _normalised) + " FROM normalized",
)
def minmax_normalize(spark, folder):
    return rounded(engagement.minmax_normalize(stored(spark, folder)).select("tweet_id", *_normalised))


@register("engagement_score", f"SELECT tweet_id, {r6('engagement_score')} AS engagement_score FROM weighted")
def engagement_score(spark, folder):
    return rounded(engagement.normalize_data(stored(spark, folder)).select("tweet_id", "engagement_score"))


@register(
    "engagement_proxy",
    f"SELECT tweet_id, {r6('(like_count + 2 * retweet_count + 3 * reply_count) / 100.0')} AS engagement_proxy FROM tweets",
)
def engagement_proxy(spark, folder):
    proxy = scores.engagement_proxy(F.col("like_count"), F.col("retweet_count"), F.col("reply_count"))
    return rounded(posts(spark, folder).select("tweet_id", proxy.alias("engagement_proxy")))


# --- signals per post --------------------------------------------------------------------------------


def signal_query(name: str, *columns: str) -> None:
    def run(spark, folder):
        timed = "time_decay" in columns
        source = stored(spark, folder) if timed else cleaned(spark, folder)
        df = signals.individual_signals(source, time_decay=timed)
        return rounded(df.select("tweet_id", *columns))

    doubles = ("weighted_sentiment", "urgency_signal", "market_focus_signal", "time_decay", "engagement_proxy")
    listed = ", ".join(f"{r6(c) if c in doubles else c} AS {c}" for c in columns)
    register(name, f"SELECT tweet_id, {listed} FROM scored")(run)


signal_query("sig_sentiment", "sentiment_signal")
signal_query("sig_weighted_sentiment", "weighted_sentiment")
signal_query("sig_urgency", "urgency_signal")
signal_query("sig_market_focus", "market_focus_signal")
signal_query("sig_technical", "technical_mention_signal")
signal_query("sig_hashtags", "has_nifty_hashtag", "has_sensex_hashtag")
signal_query("sig_time_decay", "time_decay")
signal_query(
    "individual_signals",
    "sentiment_signal", "engagement_proxy", "weighted_sentiment", "urgency_signal", "market_focus_signal",
    "technical_mention_signal", "has_nifty_hashtag", "has_sensex_hashtag", "time_decay",
)


@register(
    "sig_weighted_by_score",
    f"SELECT tweet_id, {r6('sign(sentiment_score) * engagement_score')} AS weighted_sentiment FROM weighted",
)
def sig_weighted_by_score(spark, folder):
    df = signals.individual_signals(engagement.normalize_data(stored(spark, folder)), time_decay=False)
    return rounded(df.select("tweet_id", "weighted_sentiment"))


# --- windows -------------------------------------------------------------------------------------------

@register("aggregate_signals", measures(TOTALS, "totals60"))
def aggregate_signals(spark, folder):
    totals = signals.window_totals(scored(spark, folder))
    stamp = F.timestamp_micros("bucket").cast("timestamp_ntz").alias("timestamp")
    return rounded(totals.select(stamp, *TOTALS))


@register("gap_fill_windows", measures(TOTALS, "filled7"))
def gap_fill_windows(spark, folder):
    return rounded(windows(spark, folder, 7).select("timestamp", *TOTALS))


@register("derived_window_metrics", measures(DERIVED, "derived7"))
def derived_window_metrics(spark, folder):
    return rounded(windows(spark, folder, 7).select("timestamp", *DERIVED))


@register("wilson_ci", measures(INTERVALS, "intervals60"))
def wilson_ci(spark, folder):
    return rounded(signals.confidence_intervals(windows(spark, folder)).select("timestamp", *INTERVALS))


@register(
    "zscore_components",
    'SELECT "timestamp", ' + ", ".join(f"{r6(zscore(c))} AS {c}_z" for c, _ in WEIGHTS) + " FROM derived7",
)
def zscore_components(spark, folder):
    df = signals.zscore_components(windows(spark, folder, 7))
    return rounded(df.select("timestamp", *[f"{c}_z" for c, _ in WEIGHTS]))


@register(
    "composite_signal",
    f'SELECT "timestamp", {r6("composite_signal")} AS composite_signal FROM ({COMPOSITE.format(source="derived7")})',
)
def composite_signal(spark, folder):
    return rounded(signals.composite_signal(windows(spark, folder, 7)).select("timestamp", "composite_signal"))


@register("generate_from_clean", measures(FINISHED, "windows"))
def generate_from_clean(spark, folder):
    """From a stored table of cleaned posts, as the staged run does."""
    return rounded(signals.generate_signals(stored(spark, folder)).select("timestamp", *FINISHED))


@register("generate_signals", measures(FINISHED, "windows"))
def generate_signals(spark, folder):
    return rounded(finished(spark, folder).select("timestamp", *FINISHED))


# --- reports -----------------------------------------------------------------------------------------------


@register(
    "signals_by_hour_day",
    "SELECT day_number, day, "
    + ", ".join(f"{r6(f'avg(composite_signal) FILTER (hour = {h})')} AS h{h:02d}" for h in range(24))
    + """ FROM (SELECT unnest(range(7)) AS day_number,
    unnest(['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday']) AS day)
    LEFT JOIN (SELECT isodow("timestamp") - 1 AS d, date_part('hour', "timestamp") AS hour, composite_signal FROM windows)
    ON d = day_number GROUP BY ALL""",
)
def signals_by_hour_day(spark, folder):
    return rounded(reports.signals_by_hour_day(finished(spark, folder)))


@register("signal_summary", f"SELECT {_summary_sql} FROM windows")
def signal_summary(spark, folder):
    return rounded(reports.signal_summary(finished(spark, folder)))


def histogram_sql(source: str) -> str:
    bounds = f"(SELECT min(value) AS low, max(value) AS high FROM {source})"
    return f"""SELECT bin, {r6('low + bin * (high - low) / 50')} AS bin_start, {r6('low + (bin + 1) * (high - low) / 50')} AS bin_end,
    count(value) AS n FROM (SELECT unnest(range(50)) AS bin) CROSS JOIN {bounds}
    LEFT JOIN (SELECT value, least(CAST(floor((value - low) / ((high - low) / 50)) AS BIGINT), 49) AS b
      FROM {source} CROSS JOIN {bounds}) ON b = bin
    GROUP BY bin, low, high"""


@register("signal_histogram", histogram_sql("events"))
def signal_histogram(spark, folder):
    return rounded(reports.signal_histogram(spark.read.parquet(f"{folder}/events.parquet"), "value"))


@register("composite_histogram", histogram_sql(f"(SELECT {r6('composite_signal')} AS value FROM windows)"))
def composite_histogram(spark, folder):
    """Rounded first, so that both engines cut the same values at the edges."""
    signal = rounded(finished(spark, folder).select("composite_signal"))
    return rounded(reports.signal_histogram(cut_lineage(signal)))


@register(
    "hashtag_distribution",
    """SELECT ltrim(lower(tag), '#') AS hashtag, count(*) AS posts FROM (SELECT unnest(hashtags) AS tag FROM tweets)
    GROUP BY ALL ORDER BY posts DESC, hashtag LIMIT 20""",
)
def hashtag_distribution(spark, folder):
    return reports.hashtag_distribution(posts(spark, folder))


@register(
    "stage_counts",
    """SELECT 0 AS position, 'collected' AS stage, count(*) AS row_count FROM tweets
    UNION ALL SELECT 1, 'cleaned', count(*) FROM cleaned UNION ALL SELECT 2, 'windows', count(*) FROM windows""",
)
def stage_counts(spark, folder):
    base = scratch_path(spark, "stages")
    raw = posts(spark, folder)
    clean_posts = clean_ops.clean_dataframe(raw)
    storage.write_run(clean_posts, base, "r1")
    stored = spark.read.parquet(base)
    return reports.stage_counts(collected=raw, cleaned=stored, windows=signals.generate_signals(stored))


@register(
    "panel_series",
    " UNION ALL ".join(
        f"SELECT \"timestamp\", '{panel}' AS panel, '{c}' AS series, {r6(c)} AS value FROM windows"
        for panel, columns in reports.SERIES.items()
        for c in columns
    ),
)
def panel_series(spark, folder):
    return rounded(reports.panel_series(finished(spark, folder)))


# --- terms -----------------------------------------------------------------------------------------------------


def split_words(spark: SparkSession, folder: str) -> DataFrame:
    df = cleaned(spark, folder)
    return df.select("tweet_id", tfidf.tokenize(F.col("content_clean")).alias("tokens"))


def exploded(df: DataFrame, column: Column) -> DataFrame:
    return df.select("tweet_id", F.posexplode(column).alias("position", "term")).withColumn(
        "position", F.col("position").cast("bigint")
    )


def positions(column: str, source: str) -> str:
    return f"SELECT tweet_id, unnest({column}) AS term, unnest(range(len({column}))) AS position FROM {source}"


@register("tokenize", positions("tokens", "tokens"))
def tokenize(spark, folder):
    return exploded(split_words(spark, folder), F.col("tokens"))


@register("remove_stop_words", positions("tokens", "content_words"))
def remove_stop_words(spark, folder):
    return exploded(split_words(spark, folder), tfidf.remove_stop_words(F.col("tokens")))


@register("ngrams", positions("grams", "grams"))
def ngrams(spark, folder):
    words = split_words(spark, folder).withColumn("tokens", tfidf.remove_stop_words(F.col("tokens")))
    return exploded(words, tfidf.ngrams(F.col("tokens")))


@register("term_counts", "SELECT tweet_id, term, n FROM pairs")
def term_counts(spark, folder):
    return tfidf.term_counts(cleaned(spark, folder)).where(F.col("term").isNotNull())


@register("term_stats", "SELECT term, doc_freq, term_freq FROM terms")
def term_stats(spark, folder):
    return tfidf.term_stats(tfidf.term_counts(cleaned(spark, folder)))


@register("fit_vocabulary", "SELECT term, doc_freq, term_freq, n_docs FROM vocabulary")
def fit_vocabulary(spark, folder):
    return tfidf.fit_vocabulary(stored_texts(spark, folder)).select("term", "doc_freq", "term_freq", "n_docs")


@register("idf", f"SELECT term, {r6('idf')} AS idf FROM vocabulary")
def idf(spark, folder):
    return rounded(tfidf.fit_vocabulary(stored_texts(spark, folder)).select("term", "idf"))


def fitted(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Posts, stored because they are read twice and more, and the model fitted on them."""
    df = stored_texts(spark, folder)
    return df, cut_lineage(tfidf.fit_vocabulary(df))


@register("tfidf_vectors", f"SELECT tweet_id, term, {r6('tfidf')} AS tfidf FROM vectors")
def tfidf_vectors(spark, folder):
    return rounded(tfidf.tfidf_vectors(*fitted(spark, folder)))


@register(
    "tfidf_row_stats",
    f"""SELECT tweet_id, {r6('coalesce(sum(tfidf), 0)')} AS tfidf_sum, {r6('coalesce(sum(tfidf), 0) / width')} AS tfidf_mean,
    {r6('sqrt(greatest(coalesce(sum(tfidf * tfidf), 0) / width - (coalesce(sum(tfidf), 0) / width) ** 2, 0))')} AS tfidf_std
    FROM cleaned LEFT JOIN vectors USING (tweet_id) CROSS JOIN (SELECT count(*) AS width FROM vocabulary)
    GROUP BY tweet_id, width""",
)
def tfidf_row_stats(spark, folder):
    return rounded(tfidf.tfidf_row_stats(*fitted(spark, folder)))


@register("save_model", f"SELECT term, doc_freq, term_freq, {r6('idf')} AS idf, n_docs FROM vocabulary")
def save_model(spark, folder):
    path = scratch_path(spark, "model")
    storage.save_model(tfidf.fit_vocabulary(stored_texts(spark, folder)), path)
    return rounded(storage.load_model(spark, path))


# --- sampling ------------------------------------------------------------------------------------------------------

POINTS = 1000


def random_sql(seed: int) -> str:
    return f"SELECT tweet_id, \"timestamp\", like_count FROM tweets ORDER BY md5('{seed}:' || tweet_id), tweet_id LIMIT {POINTS}"


@register("sample_random", random_sql(42))
def sample_random(spark, folder):
    return sampling.sample_random(narrow(posts(spark, folder)), POINTS)


@register("sample_reservoir", random_sql(7))
def sample_reservoir(spark, folder):
    return sampling.sample_reservoir(narrow(posts(spark, folder)), POINTS)


@register(
    "sample_systematic",
    f"""SELECT tweet_id, "timestamp", like_count FROM (SELECT *, row_number() OVER (ORDER BY "timestamp", tweet_id) - 1 AS o,
    greatest(1, count(*) OVER () // {POINTS}) AS step FROM tweets)
    WHERE o % step = 0 AND o // step < {POINTS}""",
)
def sample_systematic(spark, folder):
    return sampling.sample_systematic(narrow(posts(spark, folder)), POINTS)


@register(
    "downsample_time",
    f"""SELECT s."timestamp", {r6('l')} AS like_count, {r6('v')} AS view_count
    FROM (SELECT unnest(generate_series((SELECT min(time_bucket(m * INTERVAL 1 MINUTE, "timestamp")) FROM tweets, width),
      (SELECT max(time_bucket(m * INTERVAL 1 MINUTE, "timestamp")) FROM tweets, width), m * INTERVAL 1 MINUTE)) AS "timestamp" FROM width) s
    LEFT JOIN (SELECT time_bucket(m * INTERVAL 1 MINUTE, "timestamp") AS "timestamp", avg(like_count) AS l, avg(view_count) AS v
      FROM tweets, width GROUP BY ALL) t ON s."timestamp" = t."timestamp" """,
)
def downsample_time(spark, folder):
    return rounded(sampling.downsample_time(posts(spark, folder).select("timestamp", "like_count", "view_count")))


@register("order_by_time", NARROW + ' FROM tweets ORDER BY "timestamp", tweet_id')
def order_by_time(spark, folder):
    return sampling.order_by_time(narrow(posts(spark, folder)), "tweet_id")


@register(
    "latest_windows",
    f"""SELECT "timestamp", {r6('composite_signal')} AS composite_signal, {r6('avg_sentiment')} AS avg_sentiment, tweet_count
    FROM windows ORDER BY "timestamp" DESC LIMIT 5""",
)
def latest_windows(spark, folder):
    return rounded(sampling.latest_windows(finished(spark, folder)))


# --- incremental and streaming ------------------------------------------------------------------------------------------


@register("incremental_run", measures(FINISHED, "both_windows"))
def incremental_run(spark, folder):
    """The last day scored again over a store that already holds the whole month; the composite is that of one run over both."""
    path = scratch_path(spark, "incremental")
    df = posts(spark, folder)
    full_run.run_incremental(df, path, AS_OF, HOURS)
    return rounded(full_run.run_incremental(df, path, AS_OF, 24).select("timestamp", *FINISHED))


@register("stream_signals", measures(TOTALS, "closed"))
def stream_signals(spark, folder):
    output = scratch_path(spark, "stream")
    raw = jsonl.stream_jsonl(spark, landed(spark, folder))
    live_signals.start_stream_signals(raw, output, scratch_path(spark, "offsets")).awaitTermination()
    stored = spark.read.parquet(output)
    return rounded(stored.select(F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), *TOTALS))


@register("stream_composite", measures(FINISHED, "closed_windows"))
def stream_composite(spark, folder):
    store = scratch_path(spark, "store")
    raw = jsonl.stream_jsonl(spark, landed(spark, folder))
    live_signals.start_stream_composite(raw, store, scratch_path(spark, "offsets")).awaitTermination()
    stored = signal_store.read_signals(spark, store)
    return rounded(stored.select(F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), *FINISHED))


# --- request log ---------------------------------------------------------------------------------------------------------

AUDIT = f"SELECT request_id, client, calls_minute, calls_hour, limited, {r6('wait_seconds')} AS wait_seconds FROM "
PER_USER = RequestConfig(per_minute=1, per_hour=2)
PER_TYPE = RequestConfig(per_minute=2, per_hour=5)


@register("rate_audit", AUDIT + "audit_users")
def rate_audit(spark, folder):
    return rounded(request_log.rate_audit(log(spark, folder), PER_USER))


@register("rate_audit_busy_clients", AUDIT + "audit_types")
def rate_audit_busy_clients(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet")
    busy = sample_posts.request_log(events.withColumn("user_id", F.col("event_type")))
    return rounded(request_log.rate_audit(busy, PER_TYPE))


@register(
    "rate_summary",
    f"""SELECT count(*) AS total_calls, count(*) FILTER (limited) AS limited_calls, {r6('sum(wait_seconds)')} AS total_wait_seconds,
    {r6('avg(wait_seconds)')} AS avg_wait_per_call FROM audit_users""",
)
def rate_summary(spark, folder):
    return rounded(request_log.rate_summary(request_log.rate_audit(log(spark, folder), PER_USER)))


@register(
    "rate_limit_errors",
    f"SELECT doc_id, {present('text', lx.RATE_LIMIT_PHRASES)} > 0 AS is_limit FROM documents",
)
def rate_limit_errors(spark, folder):
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    return documents.select("doc_id", request_log.is_rate_limit_error(F.col("text")).alias("is_limit"))


HEALTH = (
    "endpoint, success_count, failure_count, last_used, last_success, last_failure, consecutive_failures, "
    + f"{r6('total_response_time')} AS total_response_time, {r6('mean_response_time')} AS mean_response_time, "
    + f"{r6('success_rate')} AS success_rate"
)


def active(spark: SparkSession, folder: str) -> DataFrame:
    return request_log.endpoint_active(request_log.endpoint_health(log(spark, folder)))


@register("endpoint_health", f"SELECT {HEALTH} FROM active")
def endpoint_health(spark, folder):
    return rounded(request_log.endpoint_health(log(spark, folder)))


@register("endpoint_active", "SELECT endpoint, consecutive_failures, is_active FROM active")
def endpoint_active(spark, folder):
    return active(spark, folder).select("endpoint", "consecutive_failures", "is_active")


@register(
    "endpoint_rank",
    f"""SELECT endpoint, {r6('success_rate - 0.1 * consecutive_failures')} AS score FROM active""",
)
def endpoint_rank(spark, folder):
    return rounded(request_log.endpoint_rank(request_log.endpoint_health(log(spark, folder))).select("endpoint", "score"))


@register("endpoint_least_recent", "SELECT endpoint, last_used FROM health ORDER BY last_used NULLS FIRST, endpoint LIMIT 1")
def endpoint_least_recent(spark, folder):
    return request_log.endpoint_least_recent(request_log.endpoint_health(log(spark, folder)))


@register(
    "endpoint_summary",
    f"""SELECT count(*) AS total_endpoints, count(*) FILTER (is_active) AS active_endpoints,
    {r6('count(*) FILTER (is_active) * 100.0 / count(*)')} AS active_percentage,
    {r6('sum(success_count) / sum(success_count + failure_count)')} AS avg_success_rate,
    {r6('sum(total_response_time) / sum(success_count)')} AS avg_response_time,
    CAST(sum(success_count) AS BIGINT) AS total_successful_requests, CAST(sum(failure_count) AS BIGINT) AS total_failed_requests FROM active""",
)
def endpoint_summary(spark, folder):
    return rounded(request_log.endpoint_summary(active(spark, folder)))
