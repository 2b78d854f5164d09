"""E-commerce flow: an incremental batch with copies, mixed dates and dirty numbers."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from quillsift.functions import clean_amount, clean_quantity, clean_text, parse_mixed_dates
from quillsift.operators.aggregates import report_category_clean
from quillsift.operators.dedup import dedup_keep_first
from quillsift.operators.joins import splittable
from quillsift.operators.loads import COPIES, KNOWN, keys_of_load
from quillsift.operators.projections import project_ordered
from quillsift.operators.quality import (
    FAILED,
    OK,
    ORDER_REASON,
    ecommerce_rules,
    flag_valid,
    reject_reason,
)
from quillsift.plans.staging import STATUS, run_summary, stage, validity_status, with_status
from quillsift.schemas import ECOMMERCE_CLEAN
from quillsift.sources.snapshots import (
    append_distinct,
    append_rows,
    read_candidates,
    read_distinct,
    read_stored,
)

# The text columns that are normalised after validation.
NORMALISED = (
    "customer_name",
    "customer_email",
    "product_category",
    "product_name",
    "payment_method",
    "shipping_country",
    "order_status",
)


def clean_numbers(df: DataFrame) -> DataFrame:
    """Typed dates, amounts and quantities; the raw amount and quantity stay beside them."""
    return df.withColumns(
        {
            "order_date": parse_mixed_dates(F.col("order_date")),
            "amount_clean": clean_amount(F.col("amount")),
            "quantity_clean": clean_quantity(F.col("quantity")),
        }
    )


def transform_ecommerce(valid: DataFrame) -> DataFrame:
    normal = valid.withColumns({c: clean_text(F.col(c)) for c in NORMALISED})
    return project_ordered(normal, ECOMMERCE_CLEAN.fieldNames())


def batch_order(df: DataFrame) -> list[Column]:
    """An order that settles which copy of an order id counts as the first."""
    return [F.asc_nulls_last(c) for c in df.columns if c != "order_id"]


def routed_orders(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """One row per order id of the batch, with its status: known (stored already), valid or
    rejected; and its copies in the batch.

    The first copy of an order counts. A known order keeps its id only. Rows without an id are no
    copies of each other: each of them is judged, and rejected.
    """
    has_id = F.col("order_id").isNotNull()
    with_id = batch.where(has_id)
    # Copies go first: a resent order with very many copies then joins as one row.
    unique = dedup_keep_first(with_id, ["order_id"], batch_order(batch))
    keys = keys_of_load(stored, with_id.select("order_id"), ["order_id"])
    marked = unique.join(splittable(keys), "order_id")
    alone = {COPIES: F.lit(1).cast("bigint"), KNOWN: F.lit(False)}
    rows = marked.unionByName(batch.where(~has_id).withColumns(alone))
    judged = flag_valid(clean_numbers(rows), ecommerce_rules())
    status = F.when(F.col(KNOWN), "known").otherwise(validity_status())
    kept = {
        c: F.when(~F.col(KNOWN), F.col(c)) for c in [*batch.columns, FAILED] if c != "order_id"
    }
    return judged.withColumns(kept).withColumn(STATUS, status).drop(OK, KNOWN)


def batch_counts(staged: DataFrame) -> Row:
    """Rows of the batch, of orders that were stored already, and copies dropped from it."""
    copies, known = F.col(COPIES), F.col(STATUS) == "known"
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return staged.agg(
        total(copies).alias("extracted"),
        total(F.when(known, copies)).alias("skipped"),
        total(F.when(~known, copies - 1)).alias("duplicates"),
    ).head()


class Ecommerce(NamedTuple):
    clean: DataFrame
    rejected: DataFrame
    report: DataFrame
    summary: DataFrame
    skipped: int
    duplicates: int


def ecommerce(spark: SparkSession, batch: DataFrame, store: str, stage_folder: str) -> Ecommerce:
    """Load one batch: skip known ids, drop copies, clean, validate, append, report.

    The batch is routed once, and everything else is read from what that wrote. Rejected rows are
    kept by their content, so that a rerun does not store them again.
    """
    clean_path, rejected_path = f"{store}/ecommerce_clean", f"{store}/ecommerce_rejected"
    known = read_candidates(spark, clean_path, batch.select("order_id"), ["order_id"])
    staged = stage(routed_orders(batch, known), stage_folder)
    clean = transform_ecommerce(with_status(staged, "valid").drop(FAILED, COPIES))
    rejected = reject_reason(with_status(staged, "rejected").drop(COPIES), ORDER_REASON)

    counts = batch_counts(staged)
    # The stage holds new ids only, each once.
    loaded = append_rows(spark, clean_path, clean, ["order_id"])
    append_distinct(spark, rejected_path, rejected)
    stored = read_stored(spark, clean_path, ECOMMERCE_CLEAN)
    summary = run_summary(staged, loaded).withColumn("rows_extracted", F.lit(counts.extracted))
    return Ecommerce(
        stored,
        read_distinct(spark, rejected_path, rejected.schema),
        report_category_clean(stored),
        summary,
        counts.skipped,
        counts.duplicates,
    )
