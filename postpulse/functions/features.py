"""Text features as column expressions. Counts of words and word lengths expect text whose
whitespace is collapsed, which is what cleaning leaves."""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from postpulse.config import TextConfig
from postpulse.functions import lexicon as lx
from postpulse.functions.cleaning import may_have_url
from postpulse.functions.encoding import is_ascii


def char_count(text: Column) -> Column:
    return F.length(text).cast("bigint")


def word_count(text: Column) -> Column:
    spaces = F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))
    return F.when(text == "", 0).otherwise(spaces + 1).cast("bigint")


def sentence_count(text: Column) -> Column:
    """Pieces between runs of ``.!?``; a trailing run leaves one empty piece."""
    return F.size(F.split(text, r"[.!?]+")).cast("bigint")


def avg_word_length(text: Column) -> Column:
    words = word_count(text)
    letters = F.length(text) - (words - 1)
    return F.when(words == 0, 0.0).otherwise(F.try_divide(letters.cast("double"), words))


def count_char(text: Column, char: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))).cast("bigint")


def uppercase_ratio(text: Column) -> Column:
    capitals = (F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}+", ""))).cast("double")
    # Cheaper than a search: what is ASCII and equal to its lower case has no capitals. The empty text is, too.
    without = is_ascii(text) & (F.lower(text) == text)
    return F.when(without, 0.0).otherwise(F.try_divide(capitals, F.length(text)))


def has_emoji(text: Column) -> Column:
    return ~is_ascii(text) & F.regexp_like(text, F.lit(lx.EMOJI_CHAR))


def has_mention(text: Column) -> Column:
    return F.contains(text, F.lit("@")) & F.regexp_like(text, F.lit(lx.MENTION))


def has_hashtag(text: Column) -> Column:
    return F.contains(text, F.lit("#")) & F.regexp_like(text, F.lit(lx.HASHTAG))


def has_url(text: Column) -> Column:
    return may_have_url(text) & F.regexp_like(text, F.lit(lx.URL))


def script_flags(text: Column) -> dict[str, Column]:
    flags = {
        f"has_{name}": ~is_ascii(text) & F.regexp_like(text, F.lit(f"[{block}]"))
        for name, block in lx.INDIC_BLOCKS.items()
    }
    flags["has_any_indian_language"] = reduce(or_, flags.values())
    return flags


def words_present(text: Column, words: tuple[str, ...]) -> Column:
    """How many of ``words`` occur anywhere in the text, also inside longer words."""
    lowered = F.lower(text)
    return reduce(add, [F.contains(lowered, F.lit(w)).cast("bigint") for w in words])


def any_word_present(text: Column, words: tuple[str, ...]) -> Column:
    lowered = F.lower(text)
    return reduce(or_, [F.contains(lowered, F.lit(w)) for w in words])


def content_hash(text: Column) -> Column:
    return F.md5(text)


def feature_columns(clean: Column, raw: Column | None = None, cfg: TextConfig = TextConfig()) -> dict[str, Column]:
    """Every feature by name. ``raw`` is read only for ``cfg.raw_text_flags``."""
    surface = F.coalesce(raw, F.lit("")) if cfg.raw_text_flags and raw is not None else clean
    features = {
        "char_count": char_count(clean),
        "word_count": word_count(clean),
        "sentence_count": sentence_count(clean),
        "has_emoji": has_emoji(surface),
        "has_mention": has_mention(clean),
        "has_hashtag": has_hashtag(clean),
        "has_url": has_url(surface),
        "avg_word_length": avg_word_length(clean),
        "exclamation_count": count_char(clean, "!"),
        "question_count": count_char(clean, "?"),
        "uppercase_ratio": uppercase_ratio(surface),
    }
    if cfg.detect_language:
        features |= script_flags(clean)
    positive = words_present(clean, lx.POSITIVE_WORDS)
    negative = words_present(clean, lx.NEGATIVE_WORDS)
    features |= {
        "positive_word_count": positive,
        "negative_word_count": negative,
        "sentiment_score": positive - negative,
        "market_term_count": words_present(clean, lx.MARKET_TERMS),
    }
    return features
