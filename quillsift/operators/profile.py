"""Profiles of a table: one pass over the data each, results as small tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillsift.operators.percentiles import measured, percentiles_at_once, supported
from quillsift.operators.ranks import exact_percentiles
from quillsift.schemas import BIGINT, DOUBLE, TEXT, schema

# The quartiles shown by profile_describe.
QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def profile_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count")).withColumn(
        "column_count", F.lit(len(df.columns))
    )


def count_table(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))


def _long_form(wide: DataFrame, rows: Sequence[Sequence[Column]], names: Sequence[str]) -> DataFrame:
    """Turn the one-row result of an aggregate into one row per profiled column."""
    items = [F.struct(*[c.alias(n) for c, n in zip(r, names, strict=True)]) for r in rows]
    return wide.select(F.inline(F.array(*items)))


def profile_nulls(df: DataFrame) -> DataFrame:
    """Missing values per column."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    rows = [[F.lit(c), F.col(c)] for c in df.columns]
    return _long_form(wide, rows, ["column_name", "null_count"])


def profile_schema(df: DataFrame) -> DataFrame:
    """Column names, types and non-missing values per column."""
    wide = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    rows = [[F.lit(c), F.lit(t), F.col(c)] for c, t in df.dtypes]
    return _long_form(wide, rows, ["column_name", "column_type", "non_null_count"])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


DESCRIBED = schema(
    column_name=TEXT,
    count=BIGINT,
    mean=DOUBLE,
    std=DOUBLE,
    min=DOUBLE,
    max=DOUBLE,
    p25=DOUBLE,
    p50=DOUBLE,
    p75=DOUBLE,
)


def profile_describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles per numeric column.

    Ids and money are summed, compared and selected in their own types; only what is shown is a
    double. One pass takes the sums of all columns, and two passes as a rule select the quartiles of
    all columns together (see ``percentiles_at_once``). NaN has no rank. The result is computed here
    and holds one row per column.
    """
    chosen = list(columns or numeric_columns(df))
    kinds = {c: df.schema[c].dataType for c in chosen}
    at_once = [c for c in chosen if supported(kinds[c])]
    sums = []
    for i, c in enumerate(chosen):
        exact = isinstance(kinds[c], T.DecimalType)
        total = F.sum(c).cast("double") / F.count(c) if exact else F.avg(c)
        sums += [
            F.count(c).alias(f"count_{i}"),
            total.alias(f"mean_{i}"),
            F.stddev_samp(c).alias(f"std_{i}"),
            F.min(c).alias(f"min_{i}"),
            F.max(c).alias(f"max_{i}"),
        ]
        if c in at_once:
            value = measured(df, c)
            ends = {"low": F.min(value), "high": F.max(value), "rows": F.count(value)}
            sums += [v.alias(f"{k}_{i}") for k, v in ends.items()]
    row = df.agg(*sums).first() if chosen else None
    place = {c: i for i, c in enumerate(chosen)}
    ends = {c: tuple(row[f"{k}_{place[c]}"] for k in ("low", "high", "rows")) for c in at_once}
    quartiles = percentiles_at_once(df, ends, QUARTILES)

    def double(value) -> float | None:
        return None if value is None else float(value)

    rows = []
    for i, c in enumerate(chosen):
        shown = [row[f"{k}_{i}"] for k in ("count", "mean", "std", "min", "max")]
        if c in quartiles:
            found = quartiles[c].values()
            picked = [float(a) + (float(b) - float(a)) * float(w) for a, b, w in found]
        elif c in at_once:
            picked = [None] * len(QUARTILES)
        else:  # wide decimals
            picked = list(exact_percentiles(df, c, QUARTILES).first())
        rows.append((c, shown[0], *map(double, shown[1:]), *map(double, picked)))
    return df.sparkSession.createDataFrame(rows, DESCRIBED)


def profile_head(
    df: DataFrame, order: Sequence[str], rows: int = 5, last: bool = False
) -> DataFrame:
    """First or last rows in a stated order."""
    sort = [F.desc_nulls_last(c) if last else F.asc_nulls_last(c) for c in order]
    return df.orderBy(*sort).limit(rows)
