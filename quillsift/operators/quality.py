"""Validation into valid and rejected rows, quarantine and reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsift.operators.filters import filter_and, holds
from quillsift.operators.ordering import union_ragged

REASON, FAILED, OK = "reject_reason", "failed_rules", "is_valid"

Rules = Mapping[str, Column]


def required(*columns: str) -> dict[str, Column]:
    return {f"{c} is missing": F.col(c).isNotNull() for c in columns}


def positive(*columns: str) -> dict[str, Column]:
    return {f"{c} is not positive": F.col(c) > 0 for c in columns}


def whole(*columns: str) -> dict[str, Column]:
    """A missing value breaks another rule than this one."""
    return {
        f"{c} is not whole": F.col(c).isNull() | (F.col(c) == F.floor(c)) for c in columns
    }


def sales_rules() -> dict[str, Column]:
    """A sale needs an id, which keys the stored tables, a customer, and a whole quantity."""
    return {
        **required("order_id", "customer"),
        **positive("quantity", "unit_price"),
        **whole("quantity"),
    }


def quantity_price_rules() -> dict[str, Column]:
    return positive("quantity", "unit_price")


def ecommerce_rules() -> dict[str, Column]:
    return {
        **required("order_id", "customer_email", "shipping_country"),
        **positive("unit_price", "amount_clean", "quantity_clean"),
    }


# Reject reasons of the supported feeds.
SALES_REASON = "null or invalid sales data (customer/quantity/unit_price)"
CHUNK_REASON = "null or invalid quantity/unit_price"
ORDER_REASON = "null or invalid order data"
COLUMN_REASON = "null or invalid value in required columns"


def all_hold(rules: Rules) -> Column:
    """Whether every rule holds. An unknown rule, as any comparison with a missing value is, has
    failed; otherwise the row would be in neither half of the split."""
    return reduce(Column.__and__, [holds(rule) for rule in rules.values()])


def failures(rules: Rules) -> Column:
    """Names of the failed rules."""
    names = [F.when(~holds(rule), F.lit(name)) for name, rule in rules.items()]
    return F.array_compact(F.array(*names))


def flag_valid(df: DataFrame, rules: Rules) -> DataFrame:
    """Add the list of failed rules, put together once, and ``is_valid``, true where it is empty."""
    return df.withColumn(FAILED, failures(rules)).withColumn(OK, F.size(FAILED) == 0)


def reject_reason(df: DataFrame, reason: str) -> DataFrame:
    return df.withColumn(REASON, F.lit(reason))


def validate(df: DataFrame, rules: Rules, reason: str) -> tuple[DataFrame, DataFrame]:
    """Valid rows as they came, and rejected rows with the reason and the failed rules.

    Both halves are plain filters over the same input, without a shuffle; those of the valid half
    can reach the scan. To write both from one pass, stage ``flag_valid`` instead (see
    ``plans.staging``).
    """
    valid = filter_and(df, *rules.values())
    rejected = df.withColumn(FAILED, failures(rules)).where(F.size(FAILED) > 0)
    return valid, reject_reason(rejected, reason).select(*df.columns, REASON, FAILED)


def routed(df: DataFrame, rules: Rules, status: str = "row_status") -> DataFrame:
    """Every row once, with the rules it failed and its status: valid or rejected.

    Where both parts go on, this reads the input once; ``validate`` reads it for each of them.
    """
    judged = df.withColumn(FAILED, failures(rules))
    return judged.withColumn(status, F.when(F.size(FAILED) == 0, "valid").otherwise("rejected"))


def reconcile_routed(
    rows: DataFrame, parts: Sequence[str], status: str = "row_status"
) -> DataFrame:
    """``reconcile`` for parts that are told apart by a status: one pass over the rows. A row whose
    status is none of the parts, or missing, leaves the result unbalanced."""
    counts = {p: F.count_if(F.col(status) == p) for p in parts}
    source = F.count(F.lit(1))
    return rows.agg(
        source.alias("source_rows"),
        *[c.alias(f"{p}_rows") for p, c in counts.items()],
        (source == reduce(Column.__add__, counts.values())).alias("balanced"),
    )


def status_counts(flagged: DataFrame) -> DataFrame:
    """Source, valid and rejected rows of a flagged table, counted in one pass."""
    source = F.count(F.lit(1))
    valid, rejected = F.count_if(F.col(OK)), F.count_if(F.size(FAILED) > 0)
    return flagged.agg(
        source.alias("source_rows"),
        valid.alias("valid_rows"),
        rejected.alias("rejected_rows"),
        (source == valid + rejected).alias("balanced"),
    )


def validate_columns(
    df: DataFrame, required_cols: Sequence[str], numeric_cols: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Required columns present, numeric columns above zero."""
    return validate(df, {**required(*required_cols), **positive(*numeric_cols)}, COLUMN_REASON)


def validate_sales(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return validate(df, sales_rules(), SALES_REASON)


def validate_ecommerce(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return validate(df, ecommerce_rules(), ORDER_REASON)


def quarantine(*rejects: DataFrame) -> DataFrame:
    """All rejects in one table, whatever columns their sources have."""
    return union_ragged(*rejects)


def reconcile(source: DataFrame, **parts: DataFrame) -> DataFrame:
    """Whether the parts together hold exactly as many rows as the source."""

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count("*").alias("n")).withColumn("part", F.lit(name))

    counts = counted(source, "source")
    for name, df in parts.items():
        counts = counts.unionByName(counted(df, name))

    def rows(name: str) -> Column:
        return F.sum(F.when(F.col("part") == name, F.col("n")).otherwise(0))

    total = F.sum(F.when(F.col("part") != "source", F.col("n")).otherwise(0))
    return counts.agg(
        rows("source").alias("source_rows"),
        *[rows(name).alias(f"{name}_rows") for name in parts],
        (rows("source") == total).alias("balanced"),
    )
