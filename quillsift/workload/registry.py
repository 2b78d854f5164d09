"""Registration of queries with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillsift.workload.inputs import INPUT_SQL

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Types both engines return alike: whole numbers as BIGINT, decimals as DOUBLE, dates and
    times as text."""

    def shown(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, T.IntegralType):
            c = c.cast("bigint")
        elif isinstance(field.dataType, (T.DateType, T.TimestampNTZType)):
            c = c.cast("string")
        return c.alias(field.name)

    return df.select(*[shown(f) for f in df.schema])


def with_inputs(sql: str, uses: Sequence[str]) -> str:
    """Put the derived inputs a statement reads in front of it as common table expressions."""
    if not uses:
        return sql.strip()
    inputs = ", ".join(f"{name} AS ({INPUT_SQL[name].strip()})" for name in uses)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {inputs}, {body[5:]}"
    return f"WITH {inputs} {body}"


def query(name: str, sql: str | None = None, uses: Sequence[str] = ()):
    def register(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(function(spark, sf_dir))

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = with_inputs(sql, uses)
        return function

    return register
