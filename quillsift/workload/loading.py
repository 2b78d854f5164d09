"""Validation, quarantine, keyed loads and row changes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsift.operators import aggregates, audit, loads, quality
from quillsift.plans.ecommerce import clean_numbers
from quillsift.workload import inputs
from quillsift.workload.cleaning import AMOUNT_SQL, QUANTITY_SQL
from quillsift.workload.registry import query
from quillsift.workload.relational import (
    INCOMING_SQL,
    STORED_SQL,
    incoming_orders,
    stored_orders,
)

# --- validation --------------------------------------------------------------------------------


def _both_parts(valid: DataFrame, rejected: DataFrame, columns: list[str]) -> DataFrame:
    """Valid and rejected rows in one result, with the text of the failed rules."""
    failed = F.concat_ws("; ", quality.FAILED).alias("failed")
    return valid.select(*columns, F.lit("valid").alias("part"), F.lit("").alias("failed")).unionByName(
        rejected.select(*columns, F.lit("rejected").alias("part"), failed)
    )


def _failed_sql(*rules: tuple[str, str]) -> str:
    cases = ", ".join(
        f"CASE WHEN NOT COALESCE({rule}, FALSE) THEN '{name}' END" for rule, name in rules
    )
    return f"concat_ws('; ', {cases})"


_SALES_FAILED = _failed_sql(
    ("customer IS NOT NULL", "customer is missing"),
    ("quantity > 0", "quantity is not positive"),
    ("unit_price > 0", "unit_price is not positive"),
)


@query(
    "validate",
    f"""SELECT employee_id, CASE WHEN failed = '' THEN 'valid' ELSE 'rejected' END AS part, failed
        FROM (SELECT employee_id, {_failed_sql(
            ("department IS NOT NULL", "department is missing"),
            ("salary IS NOT NULL", "salary is missing"),
            ("salary > 0", "salary is not positive"),
        )} AS failed
        FROM (SELECT employee_id, department, TRY_CAST(salary AS DECIMAL(12,2)) AS salary
              FROM employees_raw) AS typed) AS judged""",
    ["employees_raw"],
)
def _validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inputs.employees_raw(spark, sf_dir)
    typed = raw.withColumn("salary", F.col("salary").try_cast("decimal(12,2)"))
    valid, rejected = quality.validate_columns(typed, ["department", "salary"], ["salary"])
    return _both_parts(valid, rejected, ["employee_id"])


@query(
    "validate_sales",
    f"""SELECT order_id, CASE WHEN failed = '' THEN 'valid' ELSE 'rejected' END AS part, failed
        FROM (SELECT order_id, {_SALES_FAILED} AS failed FROM sales_raw) AS judged""",
    ["sales_raw"],
)
def _validate_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both_parts(*quality.validate_sales(inputs.sales_raw(spark, sf_dir)), ["order_id"])


CLEAN_ECOMMERCE_SQL = f"""(SELECT *, {AMOUNT_SQL} AS amount_clean,
                                  {QUANTITY_SQL} AS quantity_clean FROM ecommerce_raw)"""

ECOMMERCE_RULES_SQL = (
    ("customer_email IS NOT NULL", "customer_email is missing"),
    ("shipping_country IS NOT NULL", "shipping_country is missing"),
    ("unit_price > 0", "unit_price is not positive"),
    ("amount_clean > 0", "amount_clean is not positive"),
    ("quantity_clean > 0", "quantity_clean is not positive"),
)


@query(
    "validate_ecommerce",
    f"""SELECT order_id, order_status,
               CASE WHEN failed = '' THEN 'valid' ELSE 'rejected' END AS part, failed
        FROM (SELECT order_id, order_status, {_failed_sql(*ECOMMERCE_RULES_SQL)} AS failed
              FROM {CLEAN_ECOMMERCE_SQL} AS cleaned) AS judged""",
    ["ecommerce_raw"],
)
def _validate_ecommerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both parts from one pass; ``_valid_orders`` reads the same rules as filters."""
    cleaned = clean_numbers(inputs.ecommerce_raw(spark, sf_dir))
    rows = quality.routed(cleaned, quality.ecommerce_rules(), "part")
    failed = F.concat_ws("; ", quality.FAILED).alias("failed")
    return rows.select("order_id", "order_status", "part", failed)


@query(
    "validate_ecommerce_parts",
    f"""SELECT CASE WHEN failed = '' THEN 'valid' ELSE 'rejected' END AS part, order_status,
               count(*) AS row_count
        FROM (SELECT order_status, {_failed_sql(*ECOMMERCE_RULES_SQL)} AS failed
              FROM {CLEAN_ECOMMERCE_SQL} AS cleaned) AS judged
        GROUP BY part, order_status""",
    ["ecommerce_raw"],
)
def _validate_ecommerce_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid and rejected rows as two tables."""
    valid, rejected = quality.validate_ecommerce(clean_numbers(inputs.ecommerce_raw(spark, sf_dir)))
    parts = {"valid": valid, "rejected": rejected}
    both = [df.select(F.lit(n).alias("part"), "order_status") for n, df in parts.items()]
    return both[0].unionByName(both[1]).groupBy("part", "order_status").agg(
        F.count("*").alias("row_count")
    )


@query(
    "reject_reason",
    f"""SELECT order_id, '{quality.SALES_REASON}' AS reject_reason FROM sales_raw
        WHERE NOT COALESCE(customer IS NOT NULL AND quantity > 0 AND unit_price > 0, FALSE)""",
    ["sales_raw"],
)
def _reject_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = quality.validate_sales(inputs.sales_raw(spark, sf_dir))
    return rejected.select("order_id", "reject_reason")


@query(
    "quarantine",
    f"""SELECT order_id, NULL AS employee_id, '{quality.SALES_REASON}' AS reject_reason
        FROM sales_raw
        WHERE NOT COALESCE(customer IS NOT NULL AND quantity > 0 AND unit_price > 0, FALSE)
        UNION ALL
        SELECT NULL, employee_id, '{quality.COLUMN_REASON}' FROM employees_raw
        WHERE department IS NULL""",
    ["sales_raw", "employees_raw"],
)
def _quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad_sales = quality.validate_sales(inputs.sales_raw(spark, sf_dir))
    _, bad_staff = quality.validate_columns(inputs.employees_raw(spark, sf_dir), ["department"])
    return quality.quarantine(bad_sales, bad_staff).select(
        "order_id", "employee_id", "reject_reason"
    )


@query(
    "reconcile",
    """SELECT count(*) AS source_rows,
              count(*) FILTER (WHERE COALESCE(ok, FALSE)) AS valid_rows,
              count(*) FILTER (WHERE NOT COALESCE(ok, FALSE)) AS rejected_rows,
              TRUE AS balanced
       FROM (SELECT customer IS NOT NULL AND quantity > 0 AND unit_price > 0 AS ok
             FROM sales_raw) AS judged""",
    ["sales_raw"],
)
def _reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.routed(inputs.sales_raw(spark, sf_dir), quality.sales_rules())
    return quality.reconcile_routed(rows, ["valid", "rejected"])


# --- audit -------------------------------------------------------------------------------------

_FIRST_RUN = audit.Run("run-1", dt.datetime(2026, 1, 1, 8, 0))
_SECOND_RUN = audit.Run("run-2", dt.datetime(2026, 1, 2, 8, 0))


def _audited(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = audit.audit_columns(stored_orders(spark, sf_dir), _FIRST_RUN, "v1")
    second = audit.audit_columns(incoming_orders(spark, sf_dir), _SECOND_RUN, "v2")
    return first.unionByName(second)


_AUDITED_SQL = f"""(SELECT *, 'v1' AS source_file, 'run-1' AS run_id,
                           TIMESTAMP '2026-01-01 08:00:00' AS loaded_at FROM {STORED_SQL} AS s
                    UNION ALL
                    SELECT *, 'v2', 'run-2', TIMESTAMP '2026-01-02 08:00:00'
                    FROM {INCOMING_SQL} AS i)"""


@query(
    "audit_columns",
    f"""SELECT order_id, CAST(loaded_at AS VARCHAR) AS loaded_at, source_file, run_id
        FROM {_AUDITED_SQL} AS audited""",
    ["orders_in"],
)
def _audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _audited(spark, sf_dir).select("order_id", "loaded_at", "source_file", "run_id")


@query(
    "audit_query",
    f"""SELECT order_id, source_file FROM {_AUDITED_SQL} AS audited
        WHERE source_file = 'v2' AND run_id = 'run-2'""",
    ["orders_in"],
)
def _audit_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = audit.audit_query(_audited(spark, sf_dir), source_file="v2", run_id="run-2")
    return rows.select("order_id", "source_file")


@query(
    "latest_load",
    f"SELECT CAST(max(loaded_at) AS VARCHAR) AS latest_load FROM {_AUDITED_SQL} AS audited",
    ["orders_in"],
)
def _latest_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.latest_load(_audited(spark, sf_dir))


# --- keyed loads -------------------------------------------------------------------------------

_ORDER = ["amount", "status", "priority", "order_date", "customer_id"]

_NEW_ONLY_SQL = f"""
    SELECT order_id, CAST(amount AS DOUBLE) AS amount FROM {STORED_SQL} AS s
    UNION ALL
    SELECT order_id, CAST(amount AS DOUBLE) FROM {INCOMING_SQL} AS i
    WHERE NOT EXISTS (SELECT 1 FROM {STORED_SQL} AS s WHERE s.order_id = i.order_id)"""


def _repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The overlapping batch with every tenth order sent again with a higher amount."""
    again = F.explode(F.sequence(F.lit(0), F.when(F.col("order_id") % 10 == 0, 1).otherwise(0)))
    amount = (F.col("amount") + 5 * F.col("copy")).cast("decimal(12,2)")
    rows = incoming_orders(spark, sf_dir).withColumn("copy", again)
    return rows.withColumn("amount", amount).drop("copy")


# Of the repeated orders the first by amount is new; the last by amount wins an upsert.
@query("load_new_only", _NEW_ONLY_SQL, ["orders_in"])
def _load_new_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    load = loads.load_new_only(
        stored_orders(spark, sf_dir), _repeated(spark, sf_dir), ["order_id"], _ORDER
    )
    return load.table.select("order_id", "amount")


@query(
    "load_do_nothing",
    """SELECT order_id, line, CASE WHEN line = 1 THEN 0 ELSE CAST(price AS DOUBLE) END AS price
       FROM (
           SELECT *, row_number() OVER (PARTITION BY order_id, line ORDER BY price, part_id) AS n
           FROM lines_in) AS numbered
       WHERE n = 1""",
    ["lines_in"],
)
def _load_do_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From a batch that repeats its key, into a table that holds all first lines, unpriced."""
    batch = inputs.lines(spark, sf_dir).select("order_id", "line", "price", "part_id")
    free = F.lit(0).cast(batch.schema["price"].dataType)
    key, order = ["order_id", "line"], ["price", "part_id"]
    first = loads.load_do_nothing(
        batch.limit(0), batch.where("line = 1").withColumn("price", free), key, order
    )
    load = loads.load_do_nothing(first.table, batch, key, order)
    return load.table.select("order_id", "line", "price")


@query(
    "load_counts",
    f"""SELECT sum(copies) AS incoming_rows,
               count(*) FILTER (WHERE NOT known) AS added_rows,
               COALESCE(sum(copies) FILTER (WHERE known), 0) AS skipped_rows,
               COALESCE(sum(copies - 1) FILTER (WHERE NOT known), 0) AS duplicate_rows
        FROM (SELECT order_id IN (SELECT order_id FROM {STORED_SQL} AS s) AS known,
                     CASE WHEN order_id % 10 = 0 THEN 2 ELSE 1 END AS copies
              FROM {INCOMING_SQL} AS i) AS judged""",
    ["orders_in"],
)
def _load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    incoming = _repeated(spark, sf_dir)
    keys = loads.keys_of_load(stored_orders(spark, sf_dir), incoming, ["order_id"])
    return loads.counts_of_keys(keys)


def _changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repeated batch with amounts raised, so that replaced rows can be told."""
    incoming = _repeated(spark, sf_dir)
    raised = (F.col("amount") + 1).cast("decimal(12,2)")
    return incoming.withColumns({"amount": raised, "status": F.lit("N")})


_CHANGED_SQL = f"""(SELECT * REPLACE (
                        CAST(amount + CASE WHEN order_id % 10 = 0 THEN 6 ELSE 1 END
                             AS DECIMAL(12,2)) AS amount, 'N' AS status)
                    FROM {INCOMING_SQL} AS i)"""


@query(
    "upsert_replace",
    f"""SELECT order_id, CAST(amount AS DOUBLE) AS amount, status FROM {_CHANGED_SQL} AS c
        UNION ALL
        SELECT order_id, CAST(amount AS DOUBLE), status FROM {STORED_SQL} AS s
        WHERE order_id NOT IN (SELECT order_id FROM {_CHANGED_SQL} AS c)""",
    ["orders_in"],
)
def _upsert_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    upserted = loads.upsert_replace(
        stored_orders(spark, sf_dir), _changed(spark, sf_dir), ["order_id"], ["amount"]
    )
    return upserted.select("order_id", "amount", "status")


@query(
    "upsert_update",
    f"""SELECT COALESCE(s.order_id, c.order_id) AS order_id,
               CAST(COALESCE(c.amount, s.amount) AS DOUBLE) AS amount,
               COALESCE(s.status, c.status) AS status
        FROM {STORED_SQL} AS s FULL OUTER JOIN {_CHANGED_SQL} AS c ON s.order_id = c.order_id""",
    ["orders_in"],
)
def _upsert_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    upserted = loads.upsert_update(
        stored_orders(spark, sf_dir),
        _changed(spark, sf_dir),
        ["order_id"],
        ["amount"],
        ["amount"],
    )
    return upserted.select("order_id", "amount", "status")


@query(
    "update_where",
    """SELECT order_id, priority, CAST(CASE WHEN priority = '1-URGENT' THEN 0 ELSE amount END
                                       AS DOUBLE) AS amount
       FROM orders_in""",
    ["orders_in"],
)
def _update_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.orders(spark, sf_dir)
    updated = loads.update_where(orders, F.col("priority") == "1-URGENT", {"amount": 0})
    return updated.select("order_id", "priority", "amount")


@query(
    "update_expr_returning",
    """SELECT order_id, CAST(round(amount * CAST(1.10 AS DECIMAL(3,2)), 2) AS DOUBLE) AS amount
       FROM orders_in WHERE status = 'F'""",
    ["orders_in"],
)
def _update_expr_returning(spark: SparkSession, sf_dir: str) -> DataFrame:
    raised = F.col("amount") * F.lit("1.10").cast("decimal(3,2)")
    _, changed = loads.update_expr_returning(
        inputs.orders(spark, sf_dir),
        F.col("status") == "F",
        {"amount": raised},
        ["order_id", "amount"],
    )
    return changed


@query(
    "delete_where",
    """SELECT order_id, customer FROM sales_raw
       WHERE NOT COALESCE(upper(trim(customer)) LIKE '%0', FALSE)""",
    ["sales_raw"],
)
def _delete_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = inputs.sales_raw(spark, sf_dir).select("order_id", "customer")
    return loads.delete_where(sales, F.upper(F.trim("customer")).like("%0"))
