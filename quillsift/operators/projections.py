"""Column selection, renaming and derived columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsift.functions import derive_band


def select_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols)


def drop_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def rename_cols(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def derive_arith(df: DataFrame, name: str, expression: Column) -> DataFrame:
    return df.withColumn(name, expression)


def add_band(df: DataFrame, source: str, name: str = "band", **limits: Any) -> DataFrame:
    return df.withColumn(name, derive_band(F.col(source), **limits))


def derive_flag(df: DataFrame, name: str, marker: Column) -> DataFrame:
    """Boolean column telling whether ``marker`` is present."""
    return df.withColumn(name, marker.isNotNull())


def derive_const(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def project_ordered(df: DataFrame, target_cols: Sequence[str]) -> DataFrame:
    """The target's columns in the target's order; a missing one is an error, not a NULL."""
    return df.select(*target_cols)


def map_column(
    df: DataFrame, source: str, name: str, function: Callable[[Column], Column]
) -> DataFrame:
    """Apply a Column function, or a ``pandas_udf`` where built-in functions cannot say it."""
    return df.withColumn(name, function(F.col(source)))
