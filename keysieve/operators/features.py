"""Cleaning filters and the feature/label projection.

All projections are added in one ``withColumns`` per stage so Catalyst
collapses them into a single Project inside one codegen stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keysieve.functions import charclass as cc


def drop_blank(df: DataFrame, col: str = "password") -> DataFrame:
    """Drop NULL and whitespace-only strings (``^\\s*$``)."""
    return df.where(~cc.is_blank(col))


def drop_long(df: DataFrame, col: str = "password",
              max_length: int = cc.MAX_LENGTH_EXCLUSIVE) -> DataFrame:
    """Keep strings strictly shorter than ``max_length`` characters."""
    return df.where(F.length(col) < max_length)


def clean(df: DataFrame, col: str = "password",
          max_length: int = cc.MAX_LENGTH_EXCLUSIVE) -> DataFrame:
    return drop_long(drop_blank(df, col), col, max_length)


def with_features(df: DataFrame, col: str = "password") -> DataFrame:
    """Ten INT flags plus ``length``."""
    return df.withColumns(cc.flag_columns(col))


def with_score(df: DataFrame) -> DataFrame:
    return df.withColumn("score", cc.score())


def with_label(df: DataFrame, label_col: str = "password_strength") -> DataFrame:
    return df.withColumn(label_col, cc.strength_label("score"))


def label(df: DataFrame, col: str = "password",
          label_col: str = "password_strength") -> DataFrame:
    """Flags, length, score and label in one pass."""
    return with_label(with_score(with_features(df, col)), label_col)


def with_frequency_band(df: DataFrame, count_col: str = "breach_count",
                        threshold: int = cc.COMMON_THRESHOLD) -> DataFrame:
    return df.withColumn("common_or_rare", cc.frequency_band(count_col, threshold))
