"""Cleaning steps as column expressions, in their fixed order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postpulse.config import TextConfig
from postpulse.functions import lexicon as lx
from postpulse.functions.encoding import is_ascii, normalize_nfc, repair_encoding


def may_have_url(text: Column) -> Column:
    return F.contains(text, F.lit("://")) | F.contains(text, F.lit("www."))


def only_where(condition: Column, changed: Column, text: Column) -> Column:
    """Apply a costly step only to texts that a cheap test lets through."""
    return F.when(condition, changed).otherwise(text)


def remove_urls(text: Column) -> Column:
    return only_where(may_have_url(text), F.regexp_replace(text, lx.URL, ""), text)


def remove_mentions(text: Column) -> Column:
    return only_where(F.contains(text, F.lit("@")), F.regexp_replace(text, lx.MENTION, ""), text)


def remove_hashtags(text: Column) -> Column:
    return only_where(F.contains(text, F.lit("#")), F.regexp_replace(text, lx.HASHTAG, ""), text)


def remove_emoji(text: Column) -> Column:
    return only_where(~is_ascii(text), F.regexp_replace(text, lx.EMOJI_CHAR, ""), text)


def strip_nonprintable(text: Column, keep_indian_chars: bool = True) -> Column:
    return F.regexp_replace(text, lx.NOT_KEPT if keep_indian_chars else lx.NOT_ASCII, "")


def collapse_whitespace(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, rf"[{lx.SPACE}]+", " "))


def collapse_blanks(text: Column) -> Column:
    """The same for text in which the blank is the only whitespace left."""
    return F.trim(only_where(F.contains(text, F.lit("  ")), F.regexp_replace(text, " {2,}", " "), text))


def clean_steps(df: DataFrame, name: str, cfg: TextConfig = TextConfig()) -> DataFrame:
    """The steps after encoding repair, as far as ``cfg`` turns them on, each a projection of
    its own (see ``repair_encoding``)."""
    blanks_only = cfg.remove_non_printable and cfg.keep_indian_chars
    steps = [
        (cfg.remove_urls, remove_urls),
        (cfg.remove_mentions, remove_mentions),
        (cfg.remove_hashtags, remove_hashtags),
        (cfg.remove_emojis, remove_emoji),
        (cfg.convert_to_lowercase, F.lower),
        (cfg.newline_to_space, collapse_whitespace),
        (cfg.remove_non_printable, lambda text: strip_nonprintable(text, cfg.keep_indian_chars)),
        (True, collapse_blanks if blanks_only else collapse_whitespace),
    ]
    for wanted, step in steps:
        if wanted:
            df = df.withColumn(name, step(F.col(name)))
    return df


def clean_text(df: DataFrame, source: str = "content", name: str = "content_clean", cfg: TextConfig = TextConfig()) -> DataFrame:
    """Add the cleaned text of ``source``; NULL becomes the empty string."""
    df = df.withColumn(name, F.coalesce(F.col(source), F.lit("")))
    if cfg.fix_encoding:
        df = repair_encoding(df, name)
        if cfg.normalize_nfc:
            df = df.withColumn(name, normalize_nfc(F.col(name)))
    return clean_steps(df, name, cfg)
