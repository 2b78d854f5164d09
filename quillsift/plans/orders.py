"""Order flows: lookup, keyed append, upsert with audit columns, file batches."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillsift.functions import to_number
from quillsift.operators.audit import Run, audit_columns
from quillsift.operators.joins import join_left_flag
from quillsift.operators.loads import Load, load_new_only
from quillsift.operators.ordering import union_ragged
from quillsift.operators.quality import ORDER_REASON, required, validate
from quillsift.plans.staging import STATUS, stage, with_status
from quillsift.sources.ranged import ROWS_PER_RANGE, read_ranged, upsert_ranged
from quillsift.sources.snapshots import append_new
from quillsift.streaming.ledger import file_ledger


class Lookup(NamedTuple):
    matched: DataFrame
    unmatched: DataFrame
    rejected: DataFrame


def orders_lookup(orders: DataFrame, customers: DataFrame, folder: str) -> Lookup:
    """Orders with their customer; unknown customers and missing ids are kept apart.

    Ids are validated before the join, so that rows without one, which can match nothing, are not
    shuffled. One left join and one write serve all three outputs.
    """
    # Ids of a column with gaps arrive as "101.0".
    typed = orders.withColumn("customer_id", to_number(F.col("customer_id")).try_cast("bigint"))
    valid, rejected = validate(typed, required("customer_id"), ORDER_REASON)
    flagged = join_left_flag(valid, customers, ["customer_id"])
    found = F.when(F.col("customer_found"), "matched").otherwise("unmatched")
    parts = union_ragged(
        flagged.withColumn(STATUS, found), rejected.withColumn(STATUS, F.lit("rejected"))
    )
    staged = stage(parts, folder)
    return Lookup(
        with_status(staged, "matched").select(*flagged.columns),
        with_status(staged, "unmatched").select(*valid.columns, "customer_found"),
        with_status(staged, "rejected").select(*rejected.columns),
    )


def incremental(target: DataFrame, batches: Iterable[DataFrame]) -> Load:
    """Apply batches in turn as keyed loads; added and skipped are those of the last batch."""
    load = Load(target, target.limit(0), target.limit(0))
    for batch in batches:
        order = [c for c in batch.columns if c != "order_id"]
        load = load_new_only(load.table, batch, ["order_id"], order)
    return load


def store_incremental(spark: SparkSession, path: str, batch: DataFrame) -> int:
    """Append a batch's new orders to the stored table; returns how many were new."""
    order = [c for c in batch.columns if c != "order_id"]
    return append_new(spark, path, batch, ["order_id"], order)


def upsert_audit(
    spark: SparkSession,
    root: str,
    batch: DataFrame,
    source_file: str,
    run: Run,
    keep: int | None = 2,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Stamp a batch with audit columns, upsert it by order id into the stored table, and return
    that table. Only the ranges of ids that the batch touches are rewritten; the ``keep`` newest
    states stay readable."""
    stamped = audit_columns(batch, run, source_file)
    order = [c for c in batch.columns if c != "order_id"]
    upsert_ranged(spark, root, stamped, ["order_id"], order, keep, rows_per_range)
    return read_ranged(spark, root, stamped.schema)


def files(
    spark: SparkSession,
    pattern: str | list[str],
    schema: T.StructType,
    store: str,
    run: Run,
) -> DataFrame:
    """Load the batch files not loaded before; returns their ledger rows."""
    return file_ledger(spark, pattern, schema, f"{store}/orders_batched", f"{store}/ledger", run)
