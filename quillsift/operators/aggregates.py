"""Grouped aggregates and reports.

Functions with DataFrame-style grouping leave out rows whose group key is missing and total a
group without values as 0; the ``report_*`` functions follow SQL and keep a NULL group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsift.operators.ranks import exact_percentiles


def _grouped(df: DataFrame, keys: Sequence[str]):
    return df.na.drop(subset=list(keys)).groupBy(*keys)


def group_named(df: DataFrame, keys: Sequence[str], aggregates: Mapping[str, Column]) -> DataFrame:
    """Named aggregates per group: ``{"avg_salary": F.avg("salary"), ...}``."""
    return _grouped(df, keys).agg(*[c.alias(name) for name, c in aggregates.items()])


def group_mean(df: DataFrame, keys: Sequence[str], column: str, name: str = "mean") -> DataFrame:
    return group_named(df, keys, {name: F.avg(column)})


def group_multi(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    return group_named(
        df,
        keys,
        {
            "mean": F.avg(column),
            "min": F.min(column),
            "max": F.max(column),
            "count": F.count(column),
        },
    )


def group_two_keys(df: DataFrame, first: str, second: str, column: str) -> DataFrame:
    return group_mean(df, [first, second], column)


def agg_sum(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    return group_named(df, keys, {"sum": F.coalesce(F.sum(column), F.lit(0))})


def agg_min(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    return group_named(df, keys, {"min": F.min(column)})


def agg_max(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    return group_named(df, keys, {"max": F.max(column)})


def agg_count(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    return group_named(df, keys, {"count": F.count(column)})


def agg_nunique(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    return group_named(df, keys, {"nunique": F.count_distinct(column)})


def agg_std(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    return group_named(df, keys, {"std": F.stddev_samp(column)})


def _present(column: str, order: Sequence[str]) -> Column:
    return F.when(F.col(column).isNotNull(), F.struct(*order))


def agg_first(df: DataFrame, keys: Sequence[str], column: str, order: Sequence[str]) -> DataFrame:
    """First value per group in ``order``, missing values passed over."""
    return group_named(df, keys, {"first": F.min_by(column, _present(column, order))})


def agg_last(df: DataFrame, keys: Sequence[str], column: str, order: Sequence[str]) -> DataFrame:
    return group_named(df, keys, {"last": F.max_by(column, _present(column, order))})


def agg_median(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Exact, interpolated median per group; see ``ranks`` for how large groups are spread."""
    return exact_percentiles(df, column, {"median": 0.5}, keys)


def pivot_mean(df: DataFrame, index: Sequence[str], value: str) -> DataFrame:
    return group_named(df, index, {value: F.avg(value)})


# Reducer names accepted by pivot_multi.
_REDUCERS = {
    "mean": F.avg,
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "count": F.count,
    "nunique": F.count_distinct,
    "std": F.stddev_samp,
}


def pivot_multi(df: DataFrame, index: Sequence[str], reducers: Mapping[str, str]) -> DataFrame:
    """One reducer per value column: ``{"salary": "mean", "experience": "max"}``."""
    return group_named(df, index, {c: _REDUCERS[r](c) for c, r in reducers.items()})


def revenue_report(
    df: DataFrame, key: str, amount: str, total: str = "total_revenue", orders: str = "orders"
) -> DataFrame:
    """Orders and revenue per key, highest revenue first; the key settles equal revenue."""
    return (
        df.groupBy(key)
        .agg(F.count("*").alias(orders), F.sum(amount).alias(total))
        .orderBy(F.desc_nulls_last(total), F.asc_nulls_last(key))
    )


def report_by_product(sales: DataFrame) -> DataFrame:
    return revenue_report(sales, "product", "total_price")


def report_by_category(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("product_category")
        .agg(
            F.count("*").alias("orders"),
            F.sum("total_price").alias("total_revenue"),
            F.round(F.avg("total_price"), 2).alias("avg_order_value"),
        )
        .orderBy(F.desc_nulls_last("total_revenue"), F.asc_nulls_last("product_category"))
    )


def report_by_region(sales: DataFrame) -> DataFrame:
    return revenue_report(sales, "region", "total_price")


def report_category_clean(orders: DataFrame) -> DataFrame:
    return revenue_report(orders, "product_category", "amount_clean")


def latest_load(df: DataFrame) -> DataFrame:
    return df.agg(F.max("loaded_at").alias("latest_load"))
