"""Cleaning of a posts table: text, features, missing values, types, duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postpulse.config import Settings, TextConfig
from postpulse.functions.cleaning import clean_text
from postpulse.functions.features import content_hash, feature_columns
from postpulse.operators.dedupe import dedupe_by_hash
from postpulse.schemas import COUNTS


def add_clean_text(posts: DataFrame, cfg: TextConfig = TextConfig()) -> DataFrame:
    return clean_text(posts, cfg=cfg)


def add_features(posts: DataFrame, cfg: TextConfig = TextConfig()) -> DataFrame:
    """Feature columns of ``content_clean`` and its hash, in one projection."""
    raw = F.col("content") if "content" in posts.columns else None
    return posts.withColumns(
        feature_columns(F.col("content_clean"), raw, cfg) | {"content_hash": content_hash(F.col("content_clean"))}
    )


def fill_missing(df: DataFrame) -> DataFrame:
    """Numbers become 0, text becomes empty, flags false, arrays empty. Times stay NULL."""
    filled = {}
    for field in df.schema.fields:
        kind, column = field.dataType, F.col(field.name)
        if isinstance(kind, T.NumericType):
            filled[field.name] = F.coalesce(column, F.lit(0).cast(kind))
        elif isinstance(kind, T.StringType):
            filled[field.name] = F.coalesce(column, F.lit(""))
        elif isinstance(kind, T.BooleanType):
            filled[field.name] = F.coalesce(column, F.lit(False))
        elif isinstance(kind, T.ArrayType):
            filled[field.name] = F.coalesce(column, F.array().cast(kind))
    return df.withColumns(filled) if filled else df


def coerce_types(df: DataFrame) -> DataFrame:
    """Times that do not parse become NULL; counts that do not parse become 0, and
    fractions are cut off."""
    kinds = dict(df.dtypes)
    typed = {}
    for name in ("timestamp", "collected_at"):
        if kinds.get(name) == "string":
            typed[name] = F.try_to_timestamp(F.col(name))
    for name in COUNTS:
        if name in kinds and kinds[name] != "bigint":
            number = F.col(name).try_cast("double")
            typed[name] = F.coalesce(number.try_cast("bigint"), F.lit(0).cast("bigint"))
    return df.withColumns(typed) if typed else df


def featurise(posts: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Clean text, features, filled values and types. Works row by row, without a shuffle."""
    return coerce_types(fill_missing(add_features(add_clean_text(posts, settings.text), settings.text)))


def clean_dataframe(posts: DataFrame, settings: Settings = Settings()) -> DataFrame:
    cleaned = featurise(posts, settings)
    return dedupe_by_hash(cleaned) if settings.deduplicate else cleaned
