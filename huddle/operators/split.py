"""Repeatable train/test splits and cross-validation folds.

Splits are a pure function of a row key (md5 bucket), so they need no
shuffle, survive recomputation after executor loss, and are the same in
any engine that has md5.  Season splits are plain filters that reach the
scan as partition filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from huddle.functions.columns import hash_bucket


def split_label(key: str | Column, test_percent: int = 20) -> Column:
    """'test' for ``test_percent`` of the keys, 'train' for the rest."""
    return F.when(hash_bucket(key, 100) < test_percent, "test").otherwise("train")


def random_split(df: DataFrame, key: str, test_percent: int = 20) -> tuple[DataFrame, DataFrame]:
    b = hash_bucket(key, 100)
    return df.filter(b >= test_percent), df.filter(b < test_percent)


def with_folds(df: DataFrame, key: str, folds: int = 5, fold_col: str = "fold") -> DataFrame:
    return df.withColumn(fold_col, hash_bucket(key, folds))


def season_split(
    df: DataFrame, test_season: int | Column, season_col: str = "season"
) -> tuple[DataFrame, DataFrame]:
    """Train on seasons before ``test_season``, test on it."""
    s = F.col(season_col)
    t = test_season if isinstance(test_season, Column) else F.lit(test_season)
    return df.filter(s < t), df.filter(s == t)


def season_split_label(test_season: int | Column, season_col: str = "season") -> Column:
    s = F.col(season_col)
    t = test_season if isinstance(test_season, Column) else F.lit(test_season)
    return F.when(s < t, "train").when(s == t, "test").otherwise("later")
