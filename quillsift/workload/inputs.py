"""Inputs derived from the test tables.

The tables are clean, so dirt is added by expressions on the row's own id, stated once for Spark
and once as SQL for the oracle. Every row of the base table takes part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(key: Column, n: int, rest: int = 0) -> Column:
    return key % n == rest


def money(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(12,2)")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with exact money and a calendar date."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("status"),
        money("o_totalprice").alias("amount"),
        F.to_date("o_orderdate").alias("order_date"),
        F.col("o_orderpriority").alias("priority"),
    )


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in the shape of employees."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("employee_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("department"),
        money(F.col("c_acctbal") * 10).alias("salary"),
        (key % 12).alias("experience"),
        F.date_add(F.lit("2015-01-01").cast("date"), (key % 3000).cast("int")).alias("join_date"),
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with exact numbers; neither the order nor the line number is unique."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_suppkey").alias("supplier_id"),
        money("l_quantity").alias("quantity"),
        money("l_extendedprice").alias("price"),
        money("l_discount").alias("discount"),
        money("l_tax").alias("tax"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("status"),
        F.to_date("l_shipdate").alias("ship_date"),
    )


LINE_ORDER = ["line", "part_id", "supplier_id", "quantity", "price", "discount", "tax", "flag",
              "status", "ship_date"]


def sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with customer and region as a dirty sales feed."""
    key = F.col("o_orderkey")
    joined = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return joined.select(
        key.alias("order_id"),
        F.when(_every(key, 25), None)
        .when(_every(key, 3), F.concat(F.lit("  "), F.upper("c_name"), F.lit(" ")))
        .otherwise(F.col("c_name"))
        .alias("customer"),
        F.when(_every(key, 2), F.upper("r_name"))
        .otherwise(F.concat(F.lit(" "), F.lower("r_name")))
        .alias("region"),
        F.col("o_orderpriority").alias("product_category"),
        F.concat(F.lit("Item "), F.col("o_orderstatus"), F.lit("\t\n")).alias("product_name"),
        F.when(_every(key, 7), None)
        .when(_every(key, 7, 1), F.lit(-1))
        .otherwise(key % 5 + 1)
        .cast("double")
        .alias("quantity"),
        F.when(_every(key, 50, 3), None)
        .when(_every(key, 100, 4), money(F.lit(-50)))
        .otherwise(money("o_totalprice"))
        .alias("unit_price"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
    )


def product_sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their part as a dirty feed of product sales."""
    line = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    joined = line.join(part, F.col("l_partkey") == F.col("p_partkey"))
    key = F.col("l_orderkey") + F.col("l_suppkey")
    return joined.select(
        F.col("l_orderkey").alias("order_id"),
        F.when(_every(key, 9), None)
        .otherwise(F.concat(F.lit("Supplier "), F.col("l_suppkey").cast("string")))
        .alias("customer"),
        F.when(_every(key, 2), F.upper("p_name"))
        .otherwise(F.concat(F.lit(" "), F.col("p_name"), F.lit("  ")))
        .alias("product"),
        F.when(_every(key, 8), None)
        .when(_every(key, 11), -F.col("l_quantity"))
        .otherwise(F.col("l_quantity"))
        .alias("quantity"),
        F.when(_every(key, 13), None).otherwise(money("l_extendedprice")).alias("unit_price"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("order_date"),
    )


def _copies(df: DataFrame, twice: Column) -> DataFrame:
    """Each row once, or twice where the condition holds, numbered 0 and 1 in ``copy``."""
    return df.withColumn("copy", F.explode(F.sequence(F.lit(0), F.when(twice, 1).otherwise(0))))


def employees_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a dirty employee feed; every tenth person is entered twice."""
    key = F.col("c_custkey")
    pay = money(F.col("c_acctbal") * 10)
    joined = F.date_add(F.lit("2015-01-01").cast("date"), (key % 3000).cast("int"))
    return _copies(table(spark, sf_dir, "customer"), _every(key, 10)).select(
        (key * 2 + F.col("copy")).alias("employee_id"),
        F.when(_every(key, 3), F.concat(F.lit("  "), F.upper("c_name"), F.lit("\t")))
        .otherwise(F.col("c_name"))
        .alias("name"),
        F.when(_every(key, 17), None).otherwise(F.col("c_mktsegment")).alias("department"),
        F.when(_every(key, 11), "N/A")
        .when(_every(key, 13), None)
        .otherwise(pay.cast("string"))
        .alias("salary"),
        F.when(_every(key, 19), "unknown")
        .when(_every(key, 23), None)
        .otherwise(F.date_format(joined, "yyyy-MM-dd"))
        .alias("join_date"),
    )


def ecommerce_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a messy shop feed; every 33rd order is sent twice, with another status."""
    key = F.col("o_orderkey")
    number = (key % 9 + 1).cast("string")
    price = money("o_totalprice")
    day = F.col("o_orderdate")
    return _copies(table(spark, sf_dir, "orders"), _every(key, 33)).select(
        key.alias("order_id"),
        F.concat(F.lit(" Customer "), F.col("o_custkey").cast("string")).alias("customer_name"),
        F.when(_every(key, 14), None)
        .otherwise(F.concat(F.lit("  User"), F.col("o_custkey").cast("string"), F.lit("@Mail.com")))
        .alias("customer_email"),
        F.when(_every(key, 101), "not a date")
        .when(_every(key, 3), F.date_format(day, "yyyy-MM-dd"))
        .when(_every(key, 3, 1), F.date_format(day, "MM/dd/yyyy"))
        .otherwise(F.date_format(day, "dd-MM-yyyy"))
        .alias("order_date"),
        F.when(_every(key, 2), F.concat(F.upper("o_orderpriority"), F.lit(" ")))
        .otherwise(F.lower("o_orderpriority"))
        .alias("product_category"),
        F.concat(F.lit("Item "), F.col("o_orderstatus")).alias("product_name"),
        F.when(_every(key, 20), F.concat(number, F.lit(" units")))
        .when(_every(key, 37), "-3")
        .when(_every(key, 41), "many")
        .when(_every(key, 43), F.concat(number, F.lit(".0")))
        .otherwise(number)
        .alias("quantity"),
        F.when(_every(key, 100, 1), -price)
        .when(_every(key, 200, 2), money(F.lit(0)))
        .otherwise(price)
        .cast("decimal(12,2)")
        .alias("unit_price"),
        F.when(_every(key, 10), F.concat(F.lit("$"), F.format_number(price, 2)))
        .otherwise(price.cast("string"))
        .alias("amount"),
        F.when(_every(key, 5), None).otherwise((key % 30).cast("double")).alias("discount_pct"),
        F.when(_every(key, 4), "SAVE10").alias("coupon_code"),
        F.when(_every(key, 2), "CREDIT CARD ").otherwise(" PayPal").alias("payment_method"),
        F.when(_every(key, 33, 5), None)
        .otherwise(F.concat(F.lit("Country "), (F.col("o_custkey") % 25).cast("string")))
        .alias("shipping_country"),
        F.when(F.col("copy") == 1, "RESENT")
        .otherwise(F.col("o_orderstatus"))
        .alias("order_status"),
    )


# The same inputs as SQL for the oracle.
INPUT_SQL = {
    "orders_in": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
               CAST(o_totalprice AS DECIMAL(12,2)) AS amount, CAST(o_orderdate AS DATE) AS order_date,
               o_orderpriority AS priority
        FROM orders""",
    "employees_in": """
        SELECT c_custkey AS employee_id, c_name AS name, c_mktsegment AS department,
               CAST(c_acctbal * 10 AS DECIMAL(12,2)) AS salary, c_custkey % 12 AS experience,
               DATE '2015-01-01' + CAST(c_custkey % 3000 AS INTEGER) AS join_date
        FROM customer""",
    "lines_in": """
        SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS part_id,
               l_suppkey AS supplier_id, CAST(l_quantity AS DECIMAL(12,2)) AS quantity,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
               CAST(l_discount AS DECIMAL(12,2)) AS discount, CAST(l_tax AS DECIMAL(12,2)) AS tax,
               l_returnflag AS flag, l_linestatus AS status, CAST(l_shipdate AS DATE) AS ship_date
        FROM lineitem""",
    "sales_raw": """
        SELECT o_orderkey AS order_id,
               CASE WHEN o_orderkey % 25 = 0 THEN NULL
                    WHEN o_orderkey % 3 = 0 THEN '  ' || upper(c_name) || ' '
                    ELSE c_name END AS customer,
               CASE WHEN o_orderkey % 2 = 0 THEN upper(r_name)
                    ELSE ' ' || lower(r_name) END AS region,
               o_orderpriority AS product_category,
               'Item ' || o_orderstatus || chr(9) || chr(10) AS product_name,
               CAST(CASE WHEN o_orderkey % 7 = 0 THEN NULL
                         WHEN o_orderkey % 7 = 1 THEN -1
                         ELSE o_orderkey % 5 + 1 END AS DOUBLE) AS quantity,
               CASE WHEN o_orderkey % 50 = 3 THEN NULL
                    WHEN o_orderkey % 100 = 4 THEN CAST(-50 AS DECIMAL(12,2))
                    ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS unit_price,
               strftime(o_orderdate, '%Y-%m-%d') AS order_date
        FROM orders
        JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "product_sales_raw": """
        SELECT l_orderkey AS order_id,
               CASE WHEN (l_orderkey + l_suppkey) % 9 = 0 THEN NULL
                    ELSE 'Supplier ' || l_suppkey END AS customer,
               CASE WHEN (l_orderkey + l_suppkey) % 2 = 0 THEN upper(p_name)
                    ELSE ' ' || p_name || '  ' END AS product,
               CASE WHEN (l_orderkey + l_suppkey) % 8 = 0 THEN NULL
                    WHEN (l_orderkey + l_suppkey) % 11 = 0 THEN -l_quantity
                    ELSE l_quantity END AS quantity,
               CASE WHEN (l_orderkey + l_suppkey) % 13 = 0 THEN NULL
                    ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END AS unit_price,
               strftime(l_shipdate, '%Y-%m-%d') AS order_date
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "employees_raw": """
        SELECT c_custkey * 2 + copy AS employee_id,
               CASE WHEN c_custkey % 3 = 0 THEN '  ' || upper(c_name) || chr(9)
                    ELSE c_name END AS name,
               CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_mktsegment END AS department,
               CASE WHEN c_custkey % 11 = 0 THEN 'N/A'
                    WHEN c_custkey % 13 = 0 THEN NULL
                    ELSE CAST(CAST(c_acctbal * 10 AS DECIMAL(12,2)) AS VARCHAR) END AS salary,
               CASE WHEN c_custkey % 19 = 0 THEN 'unknown'
                    WHEN c_custkey % 23 = 0 THEN NULL
                    ELSE strftime(DATE '2015-01-01' + CAST(c_custkey % 3000 AS INTEGER),
                                  '%Y-%m-%d') END AS join_date
        FROM customer
        JOIN (VALUES (0), (1)) AS v(copy) ON copy = 0 OR c_custkey % 10 = 0""",
    "ecommerce_raw": """
        SELECT o_orderkey AS order_id,
               ' Customer ' || o_custkey AS customer_name,
               CASE WHEN o_orderkey % 14 = 0 THEN NULL
                    ELSE '  User' || o_custkey || '@Mail.com' END AS customer_email,
               CASE WHEN o_orderkey % 101 = 0 THEN 'not a date'
                    WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d')
                    WHEN o_orderkey % 3 = 1 THEN strftime(o_orderdate, '%m/%d/%Y')
                    ELSE strftime(o_orderdate, '%d-%m-%Y') END AS order_date,
               CASE WHEN o_orderkey % 2 = 0 THEN upper(o_orderpriority) || ' '
                    ELSE lower(o_orderpriority) END AS product_category,
               'Item ' || o_orderstatus AS product_name,
               CASE WHEN o_orderkey % 20 = 0 THEN (o_orderkey % 9 + 1) || ' units'
                    WHEN o_orderkey % 37 = 0 THEN '-3'
                    WHEN o_orderkey % 41 = 0 THEN 'many'
                    WHEN o_orderkey % 43 = 0 THEN (o_orderkey % 9 + 1) || '.0'
                    ELSE CAST(o_orderkey % 9 + 1 AS VARCHAR) END AS quantity,
               CAST(CASE WHEN o_orderkey % 100 = 1 THEN -CAST(o_totalprice AS DECIMAL(12,2))
                    WHEN o_orderkey % 200 = 2 THEN 0
                    ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS DECIMAL(12,2)) AS unit_price,
               CASE WHEN o_orderkey % 10 = 0 THEN '$' || format('{:,.2f}', o_totalprice)
                    ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS amount,
               CASE WHEN o_orderkey % 5 = 0 THEN NULL
                    ELSE CAST(o_orderkey % 30 AS DOUBLE) END AS discount_pct,
               CASE WHEN o_orderkey % 4 = 0 THEN 'SAVE10' END AS coupon_code,
               CASE WHEN o_orderkey % 2 = 0 THEN 'CREDIT CARD ' ELSE ' PayPal' END
                   AS payment_method,
               CASE WHEN o_orderkey % 33 = 5 THEN NULL
                    ELSE 'Country ' || (o_custkey % 25) END AS shipping_country,
               CASE WHEN copy = 1 THEN 'RESENT' ELSE o_orderstatus END AS order_status
        FROM orders
        JOIN (VALUES (0), (1)) AS v(copy) ON copy = 0 OR o_orderkey % 33 = 0""",
}
