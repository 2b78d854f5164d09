"""Row filters. A row whose condition is unknown counts as not matching, on both sides."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_COMPARE = {
    ">": Column.__gt__,
    ">=": Column.__ge__,
    "<": Column.__lt__,
    "<=": Column.__le__,
    "==": Column.__eq__,
    "!=": Column.__ne__,
}


def holds(rule: Column) -> Column:
    """The rule as true or false, an unknown result being false."""
    return F.coalesce(rule, F.lit(False))


def filter_cmp(df: DataFrame, column: str, operator: str, value: Any) -> DataFrame:
    return df.where(_COMPARE[operator](F.col(column), value))


def filter_equal(df: DataFrame, column: str, value: Any) -> DataFrame:
    return df.where(F.col(column) == value)


def filter_and(df: DataFrame, *rules: Column) -> DataFrame:
    for rule in rules:
        df = df.where(rule)
    return df


def filter_or(df: DataFrame, first: Column, *rest: Column) -> DataFrame:
    for rule in rest:
        first = first | rule
    return df.where(first)


def filter_in(df: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    return df.where(F.col(column).isin(*values))


def filter_not_in(df: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    """Rows outside the list, rows without a value included."""
    return df.where(~holds(F.col(column).isin(*values)))


def filter_notnull(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull())


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(subset) if subset else None)
