"""Sorting, top rows and stacking.

Sorts put missing values last in both directions. ``ties`` ends the order in unique columns; it
makes results repeatable and lets the range shuffle split a value that many rows share.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def order_by(column: str, descending: bool = False) -> Column:
    return F.desc_nulls_last(column) if descending else F.asc_nulls_last(column)


def sort_mixed(
    df: DataFrame,
    columns: Sequence[str],
    descending: Sequence[bool],
    ties: Sequence[str] = (),
) -> DataFrame:
    order = [order_by(c, d) for c, d in zip(columns, descending, strict=True)]
    return df.orderBy(*order, *[order_by(t) for t in ties])


def sort_desc(df: DataFrame, column: str, ties: Sequence[str] = ()) -> DataFrame:
    return sort_mixed(df, [column], [True], ties)


def top_k(df: DataFrame, column: str, k: int, ties: Sequence[str]) -> DataFrame:
    """The k rows with the highest values; each task keeps k rows and only those meet."""
    return sort_desc(df, column, ties).limit(k)


def top_one(df: DataFrame, column: str, ties: Sequence[str]) -> DataFrame:
    return top_k(df, column, 1, ties)


def top_k_spend(sales: DataFrame, k: int = 5) -> DataFrame:
    """Customers by total spend."""
    per_customer = sales.groupBy("customer").agg(
        F.count("*").alias("orders"), F.sum("total_price").alias("total_spend")
    )
    return top_k(per_customer, "total_spend", k, ["customer"])


def slice_rows(df: DataFrame, order: Sequence[str | Column], start: int, count: int) -> DataFrame:
    """Rows by position in a stated order."""
    return df.orderBy(*order).offset(start).limit(count)


def union_all(first: DataFrame, *rest: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, rest, first)


def union_ragged(first: DataFrame, *rest: DataFrame) -> DataFrame:
    """Stack frames with different columns; a column a frame lacks is NULL in its rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rest, first)
