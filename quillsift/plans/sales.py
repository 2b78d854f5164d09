"""Sales flows."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsift.functions import clean_text, parse_date, to_int, to_number
from quillsift.functions.numbers import to_money
from quillsift.functions.text import strip_text
from quillsift.operators.aggregates import (
    report_by_category,
    report_by_product,
    report_by_region,
)
from quillsift.operators.audit import Run
from quillsift.operators.ordering import top_k_spend
from quillsift.operators.projections import project_ordered
from quillsift.operators.quality import (
    FAILED,
    OK,
    SALES_REASON,
    flag_valid,
    reject_reason,
    sales_rules,
)
from quillsift.plans.staging import STATUS, run_summary, stage, validity_status, with_status
from quillsift.schemas import SALES_REPORT_CLEAN
from quillsift.sources.snapshots import append_distinct, append_new, read_distinct, read_stored

# The text columns of the sales feeds.
TEXTS = ("customer", "region", "product", "product_category", "product_name")
RAW = "raw"


def _to_price(c: Column) -> Column:
    return to_money(strip_text(c.cast("string")))




# What the dirty columns of a feed are read as; text of the wrong shape is missing.
TYPED = {"order_id": to_int, "quantity": to_number, "unit_price": _to_price}


def flagged_sales(raw: DataFrame) -> DataFrame:
    """Sales rows, typed, with their failed rules, their status, and rejected rows as they came in
    ``raw``."""
    typed = [TYPED[c](F.col(c)).alias(c) if c in TYPED else F.col(c) for c in raw.columns]
    rows = raw.select(*typed, F.struct(*raw.columns).alias(RAW))
    judged = flag_valid(rows, sales_rules()).withColumn(STATUS, validity_status())
    return judged.withColumn(RAW, F.when(~F.col(OK), F.col(RAW))).drop(OK)


def rejected_sales(staged: DataFrame) -> DataFrame:
    """Rejected rows as they came, with the reason and the failed rules."""
    rows = with_status(staged, "rejected").select(f"{RAW}.*", FAILED)
    return reject_reason(rows, SALES_REASON)


def transform_sales(valid: DataFrame) -> DataFrame:
    """Clean text and date, and compute the total of the row in exact decimals."""
    texts = [c for c in TEXTS if c in valid.columns]
    exact_quantity = F.col("quantity").try_cast("decimal(15,3)")
    return valid.withColumns(
        {
            **{c: clean_text(F.col(c)) for c in texts},
            "order_date": parse_date(F.col("order_date")),
            # Only whole quantities are valid, so nothing is rounded here.
            "quantity": F.col("quantity").try_cast("int"),
            "total_price": (exact_quantity * F.col("unit_price")).cast("decimal(24,2)"),
        }
    )


class ProductReport(NamedTuple):
    clean: DataFrame
    rejected: DataFrame
    report: DataFrame


def sales_by_product(raw: DataFrame, folder: str) -> ProductReport:
    """Validate, transform, and report revenue per product."""
    staged = stage(flagged_sales(raw), folder)
    clean = transform_sales(with_status(staged, "valid").drop(FAILED, RAW))
    return ProductReport(clean, rejected_sales(staged), report_by_product(clean))


class SalesReport(NamedTuple):
    clean: DataFrame
    rejected: DataFrame
    by_category: DataFrame
    by_region: DataFrame
    top_customers: DataFrame
    summary: DataFrame


def sales_report(
    spark: SparkSession, raw: DataFrame, store: str, stage_folder: str, run: Run
) -> SalesReport:
    """Validate, transform, add new orders to the stored tables, and report on all stored orders.

    Orders whose id is stored already are left alone. Rejects have no reliable id and are kept by
    their whole content, each different one once with its number of copies in all loads. A rerun
    adds nothing to either table.
    """
    staged = stage(flagged_sales(raw), stage_folder)
    clean = transform_sales(with_status(staged, "valid")).withColumn("loaded_at", run.stamp())
    clean = project_ordered(clean, SALES_REPORT_CLEAN.fieldNames())
    rejected = rejected_sales(staged)
    loaded = append_new(spark, f"{store}/sales_clean", clean, ["order_id"], clean.columns[1:])
    append_distinct(spark, f"{store}/sales_rejected", rejected)
    stored = read_stored(spark, f"{store}/sales_clean", clean.schema)
    return SalesReport(
        stored,
        read_distinct(spark, f"{store}/sales_rejected", rejected.schema),
        report_by_category(stored),
        report_by_region(stored),
        top_k_spend(stored),
        run_summary(staged, loaded),
    )
