"""Catalog tables and SQL text with bound parameters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def ensure_table(
    spark: SparkSession, name: str, schema: T.StructType, path: str | None = None
) -> DataFrame:
    """Create the table unless it exists, and return it."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    place = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{place}")
    return spark.table(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def sql_query(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """Run SQL text; DataFrames passed by name stand for ``{name}`` in it."""
    return spark.sql(query, **tables)


def sql_params_named(
    spark: SparkSession, query: str, params: Mapping[str, Any], **tables: DataFrame
) -> DataFrame:
    """SQL with ``:name`` markers, bound as values and never spliced into the text."""
    return spark.sql(query, args=dict(params), **tables)


def sql_params_positional(
    spark: SparkSession, query: str, params: Sequence[Any], **tables: DataFrame
) -> DataFrame:
    """SQL with ``?`` markers."""
    return spark.sql(query, args=list(params), **tables)


def catalog_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    scope = f" IN {database}" if database else ""
    return spark.sql(f"SHOW TABLES{scope}")


def catalog_columns(spark: SparkSession, name: str) -> DataFrame:
    rows = [(c.name, c.dataType, c.nullable) for c in spark.catalog.listColumns(name)]
    return spark.createDataFrame(rows, "column_name STRING, column_type STRING, nullable BOOLEAN")
