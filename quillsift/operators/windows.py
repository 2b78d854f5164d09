"""Group values repeated on every row, and filters on whole groups.

A window would sort each group inside one task. These operators aggregate per group, which
combines map-side, and join the one row per group back; Spark broadcasts that side when it is
measured to be small and splits a skewed group when it is not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsift.operators.joins import splittable
from quillsift.operators.ranks import window_rank_avg

__all__ = [
    "group_filter",
    "group_filter_mean",
    "group_filter_size",
    "window_group",
    "window_group_max",
    "window_group_mean",
    "window_rank_avg",
]


def window_group(df: DataFrame, keys: Sequence[str], name: str, aggregate: Column) -> DataFrame:
    """The group's aggregate on every row; NULL on a row without a group."""
    keys = list(keys)
    per_group = df.na.drop(subset=keys).groupBy(*keys).agg(aggregate.alias(name))
    return df.join(splittable(per_group), keys, "left").select(*df.columns, name)


def window_group_mean(
    df: DataFrame, keys: Sequence[str], column: str, name: str = "group_mean"
) -> DataFrame:
    return window_group(df, keys, name, F.avg(column))


def window_group_max(
    df: DataFrame, keys: Sequence[str], column: str, name: str = "group_max"
) -> DataFrame:
    return window_group(df, keys, name, F.max(column))


def group_filter(
    df: DataFrame, keys: Sequence[str], aggregate: Column, limit: float
) -> DataFrame:
    """All rows of the groups whose aggregate exceeds the limit."""
    keys = list(keys)
    passing = (
        df.na.drop(subset=keys)
        .groupBy(*keys)
        .agg(aggregate.alias("_measure"))
        .where(F.col("_measure") > limit)
        .select(*keys)
    )
    return df.join(splittable(passing), keys, "left_semi")


def group_filter_mean(
    df: DataFrame, keys: Sequence[str], column: str, above: float
) -> DataFrame:
    return group_filter(df, keys, F.avg(column), above)


def group_filter_size(df: DataFrame, keys: Sequence[str], more_than: int) -> DataFrame:
    return group_filter(df, keys, F.count("*"), more_than)
