"""Scalar cleaning functions over whole columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsift.functions import (
    amount_is_dirty,
    blank_to_null,
    clean_amount,
    clean_quantity,
    clean_text,
    date_parts,
    file_basename,
    file_dirname,
    file_stem,
    fill_const,
    format_month,
    parse_date,
    parse_mixed_dates,
    round_dec,
    to_int,
    to_money,
    to_number,
    upper_text,
    years_since,
)
from quillsift.operators.projections import add_band, map_column
from quillsift.operators.ranks import fill_median
from quillsift.workload import inputs
from quillsift.workload.registry import query


def strip_sql(column: str) -> str:
    return f"trim({column}, ' ' || chr(9) || chr(10) || chr(13))"


AMOUNT_SQL = "TRY_CAST(replace(replace(amount, '$', ''), ',', '') AS DECIMAL(12,2))"

_BARE_QUANTITY = f"TRY_CAST(regexp_replace({strip_sql('quantity')}, '\\s*units?$', '') AS DOUBLE)"
QUANTITY_SQL = (
    f"CASE WHEN {_BARE_QUANTITY} = floor({_BARE_QUANTITY}) "
    f"THEN CAST({_BARE_QUANTITY} AS INTEGER) END"
)

MIXED_DATE_SQL = """CAST(COALESCE(try_strptime(order_date, '%Y-%m-%d'),
    try_strptime(order_date, '%m/%d/%Y'), try_strptime(order_date, '%d-%m-%Y')) AS DATE)"""

# The median in whole cents, halves rounded up.
MEDIAN_SALARY_SQL = (
    "CAST(floor(median(CAST(salary * 100 AS DOUBLE)) + 0.5) / 100 AS DECIMAL(12,2))"
)

ISO_DATE_SQL = "CAST(try_strptime(join_date, '%Y-%m-%d') AS DATE)"


@query(
    "clean_text",
    f"""SELECT order_id, lower({strip_sql('customer')}) AS customer,
               lower({strip_sql('region')}) AS region,
               lower({strip_sql('product_name')}) AS product_name
        FROM sales_raw""",
    ["sales_raw"],
)
def _clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = inputs.sales_raw(spark, sf_dir)
    texts = ["customer", "region", "product_name"]
    return sales.select("order_id", *[clean_text(F.col(c)).alias(c) for c in texts])


@query("upper_text", "SELECT c_custkey, upper(c_name) AS name_upper FROM customer")
def _upper_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = inputs.table(spark, sf_dir, "customer")
    return customer.select("c_custkey", upper_text(F.col("c_name")).alias("name_upper"))


@query(
    "blank_to_null",
    """SELECT employee_id, nullif(salary, 'N/A') AS salary,
              nullif(join_date, 'unknown') AS join_date
       FROM employees_raw""",
    ["employees_raw"],
)
def _blank_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.employees_raw(spark, sf_dir).select(
        "employee_id",
        *[blank_to_null(F.col(c), ["N/A", "unknown"]).alias(c) for c in ("salary", "join_date")],
    )


@query(
    "to_number",
    "SELECT employee_id, TRY_CAST(salary AS DOUBLE) AS salary FROM employees_raw",
    ["employees_raw"],
)
def _to_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inputs.employees_raw(spark, sf_dir)
    return raw.select("employee_id", to_number(F.col("salary")).alias("salary"))


@query(
    "to_int",
    f"""SELECT order_id, order_status,
               CASE WHEN regexp_full_match({strip_sql('quantity')}, '[+-]?[0-9]+')
                    THEN CAST({strip_sql('quantity')} AS BIGINT) END AS quantity
        FROM ecommerce_raw""",
    ["ecommerce_raw"],
)
def _to_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inputs.ecommerce_raw(spark, sf_dir)
    return raw.select("order_id", "order_status", to_int(F.col("quantity")).alias("quantity"))


@query(
    "clean_amount",
    f"""SELECT order_id, order_status, CAST({AMOUNT_SQL} AS DOUBLE) AS amount_clean,
               regexp_matches(amount, '[$,]') AS amount_was_dirty
        FROM ecommerce_raw""",
    ["ecommerce_raw"],
)
def _clean_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.ecommerce_raw(spark, sf_dir).select(
        "order_id",
        "order_status",
        clean_amount(F.col("amount")).alias("amount_clean"),
        amount_is_dirty(F.col("amount")).alias("amount_was_dirty"),
    )


@query(
    "count_dirty_amounts",
    """SELECT count(*) AS row_count,
              count(*) FILTER (WHERE regexp_matches(amount, '[$,]')) AS dirty_count
       FROM ecommerce_raw""",
    ["ecommerce_raw"],
)
def _count_dirty_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.ecommerce_raw(spark, sf_dir).agg(
        F.count("*").alias("row_count"),
        F.count_if(amount_is_dirty(F.col("amount"))).alias("dirty_count"),
    )


@query(
    "clean_quantity",
    f"SELECT order_id, order_status, {QUANTITY_SQL} AS quantity_clean FROM ecommerce_raw",
    ["ecommerce_raw"],
)
def _clean_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.ecommerce_raw(spark, sf_dir).select(
        "order_id", "order_status", clean_quantity(F.col("quantity")).alias("quantity_clean")
    )


@query(
    "parse_date",
    f"SELECT employee_id, CAST({ISO_DATE_SQL} AS VARCHAR) AS join_date FROM employees_raw",
    ["employees_raw"],
)
def _parse_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inputs.employees_raw(spark, sf_dir)
    return raw.select("employee_id", parse_date(F.col("join_date")).alias("join_date"))


@query(
    "parse_mixed_dates",
    f"""SELECT order_id, order_status, CAST({MIXED_DATE_SQL} AS VARCHAR) AS order_date
        FROM ecommerce_raw""",
    ["ecommerce_raw"],
)
def _parse_mixed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.ecommerce_raw(spark, sf_dir).select(
        "order_id", "order_status", parse_mixed_dates(F.col("order_date")).alias("order_date")
    )


@query(
    "date_parts",
    """SELECT order_id, year(order_date) AS order_year, month(order_date) AS order_month,
              quarter(order_date) AS order_quarter
       FROM orders_in""",
    ["orders_in"],
)
def _date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.orders(spark, sf_dir)
    return orders.select("order_id", *date_parts(F.col("order_date"), "order_"))


@query(
    "format_month",
    """SELECT order_id, strftime(order_date, '%Y-%m') AS year_month,
              strftime(order_date, '%Y-%m-%d') AS day, strftime(order_date, '%Y') AS year,
              strftime(order_date, '%B %Y') AS month_name
       FROM orders_in""",
    ["orders_in"],
)
def _format_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    styles = ["year_month", "day", "year", "month_name"]
    return inputs.orders(spark, sf_dir).select(
        "order_id", *[format_month(F.col("order_date"), s).alias(s) for s in styles]
    )


@query(
    "years_since",
    f"SELECT employee_id, 2026 - year({ISO_DATE_SQL}) AS years_at_company FROM employees_raw",
    ["employees_raw"],
)
def _years_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = parse_date(F.col("join_date"))
    return inputs.employees_raw(spark, sf_dir).select(
        "employee_id", years_since(joined, 2026).alias("years_at_company")
    )


@query(
    "fill_const",
    "SELECT employee_id, COALESCE(TRY_CAST(salary AS DOUBLE), 0) AS salary FROM employees_raw",
    ["employees_raw"],
)
def _fill_const(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.employees_raw(spark, sf_dir).select(
        "employee_id", fill_const(to_number(F.col("salary")), 0.0).alias("salary")
    )


@query(
    "fill_median",
    f"""WITH typed AS (SELECT employee_id, TRY_CAST(salary AS DECIMAL(12,2)) AS salary
                      FROM employees_raw)
       SELECT employee_id,
              CAST(COALESCE(salary, (SELECT {MEDIAN_SALARY_SQL} FROM typed)) AS DOUBLE) AS salary
       FROM typed""",
    ["employees_raw"],
)
def _fill_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inputs.employees_raw(spark, sf_dir)
    return fill_median(raw.select("employee_id", to_money(F.col("salary")).alias("salary")), "salary")


@query(
    "round_dec",
    """SELECT order_id, line, part_id, supplier_id,
              CAST(round(price * discount, 2) AS DOUBLE) AS saving
       FROM lines_in""",
    ["lines_in"],
)
def _round_dec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.lines(spark, sf_dir).select(
        "order_id",
        "line",
        "part_id",
        "supplier_id",
        round_dec(F.col("price") * F.col("discount")).alias("saving"),
    )


@query(
    "file_basename",
    r"""SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS base_name,
               regexp_extract(url, '^(.*)/[^/]*$', 1) AS folder,
               regexp_replace(regexp_extract(url, '([^/]*)$', 1), '([^.])\.[^.]*$', '\1') AS stem
        FROM pages""",
)
def _file_basename(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return inputs.table(spark, sf_dir, "pages").select(
        "page_id",
        file_basename(url).alias("base_name"),
        file_dirname(url).alias("folder"),
        file_stem(url).alias("stem"),
    )


BAND_SQL = """CASE WHEN salary >= 90000 THEN 'high' WHEN salary >= 60000 THEN 'mid'
              ELSE 'low' END"""


@query(
    "derive_band",
    f"SELECT employee_id, CAST(salary AS DOUBLE) AS salary, {BAND_SQL} AS band FROM employees_in",
    ["employees_in"],
)
def _derive_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_band(inputs.employees(spark, sf_dir).select("employee_id", "salary"), "salary")


@query(
    "sql_case_band",
    f"SELECT {BAND_SQL} AS band, count(*) AS headcount FROM employees_in GROUP BY 1",
    ["employees_in"],
)
def _sql_case_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        """SELECT CASE WHEN salary >= 90000 THEN 'high'
                       WHEN salary >= 60000 THEN 'mid'
                       ELSE 'low' END AS band,
                  count(*) AS headcount
           FROM {employees} GROUP BY band""",
        employees=inputs.employees(spark, sf_dir),
    )


@query(
    "map_column",
    "SELECT employee_id, CAST(salary * 2 AS DOUBLE) AS doubled FROM employees_in",
    ["employees_in"],
)
def _map_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = map_column(inputs.employees(spark, sf_dir), "salary", "doubled", lambda c: c * 2)
    return mapped.select("employee_id", "doubled")
