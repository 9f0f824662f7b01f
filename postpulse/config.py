"""Typed settings with the defaults of the sample configuration."""

from __future__ import annotations

from dataclasses import dataclass, field


# The defaults below are those of the sample configuration, and results depend on them.


@dataclass(frozen=True)
class SelectionConfig:
    hashtags: tuple[str, ...] = ("#nifty50", "#sensex", "#intraday", "#banknifty")
    search_terms: tuple[str, ...] = ("Nifty 50", "Sensex", "BSE", "NSE")
    time_window_hours: int = 24
    min_tweets_target: int = 2000
    max_tweets_per_hashtag: int = 1000
    language_filter: tuple[str, ...] = ("en", "hi")


@dataclass(frozen=True)
class TextConfig:
    remove_urls: bool = True
    remove_mentions: bool = False
    remove_hashtags: bool = False
    remove_emojis: bool = False
    convert_to_lowercase: bool = True
    keep_indian_chars: bool = True
    remove_non_printable: bool = True
    fix_encoding: bool = True
    detect_language: bool = True
    # Unicode composition is part of encoding repair. It is the one step that needs Python.
    normalize_nfc: bool = True
    # Off: line breaks are deleted with the other control characters ("a\nb" becomes "ab").
    newline_to_space: bool = False
    # On: has_url, has_emoji and uppercase_ratio look at the raw text. Off: at the cleaned
    # text, where URLs and capitals are already gone.
    raw_text_flags: bool = False


@dataclass(frozen=True)
class TfidfConfig:
    max_features: int = 1000
    ngram_range: tuple[int, int] = (1, 2)
    min_df: int = 2
    max_df: float = 0.95


@dataclass(frozen=True)
class SignalConfig:
    window_minutes: int = 60
    confidence: float = 0.95
    # Adds engagement_score before scoring; the standard run uses the raw-count proxy.
    normalize_engagement: bool = False


@dataclass(frozen=True)
class StorageConfig:
    compression: str = "snappy"
    partitioning_enabled: bool = True
    partition_columns: tuple[str, ...] = ("date", "hour")


@dataclass(frozen=True)
class Tier:
    """How long a folder keeps its partitions by day, or how many of its entries."""

    folder: str
    days: int | None = None
    latest: int | None = None
    column: str = "date"


# Days by tier, and models.
RETENTION = (Tier("raw", 30), Tier("processed", 90), Tier("signals", 180), Tier("models", latest=10))


@dataclass(frozen=True)
class SamplingConfig:
    max_points: int = 1000
    method: str = "systematic"
    seed: int = 42


@dataclass(frozen=True)
class RequestConfig:
    per_minute: int = 30
    per_hour: int = 300
    min_success_rate: float = 0.7
    max_failures: int = 3


@dataclass(frozen=True)
class Settings:
    selection: SelectionConfig = field(default_factory=SelectionConfig)
    text: TextConfig = field(default_factory=TextConfig)
    tfidf: TfidfConfig = field(default_factory=TfidfConfig)
    signals: SignalConfig = field(default_factory=SignalConfig)
    storage: StorageConfig = field(default_factory=StorageConfig)
    sampling: SamplingConfig = field(default_factory=SamplingConfig)
    requests: RequestConfig = field(default_factory=RequestConfig)
    deduplicate: bool = True
