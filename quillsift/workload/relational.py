"""Profiling, projections, filters, deduplication, joins, aggregates, windows, sorts, set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsift.functions import clean_text, to_money
from quillsift.operators import (
    aggregates,
    dedup,
    filters,
    joins,
    ordering,
    profile,
    projections,
    ranks,
    windows,
)
from quillsift.operators.quality import validate_sales
from quillsift.plans.sales import transform_sales
from quillsift.sources.tables import sql_query
from quillsift.workload import inputs
from quillsift.workload.cleaning import strip_sql
from quillsift.workload.registry import query

# --- profiling ---------------------------------------------------------------------------------


@query(
    "profile_shape",
    "SELECT count(*) AS row_count, 8 AS column_count FROM sales_raw",
    ["sales_raw"],
)
def _profile_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile_shape(inputs.sales_raw(spark, sf_dir))


@query("count_table", "SELECT count(*) AS row_count FROM lineitem")
def _count_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.count_table(inputs.table(spark, sf_dir, "lineitem"))


_SALES_COLUMNS = {
    "order_id": "bigint",
    "customer": "string",
    "region": "string",
    "product_category": "string",
    "product_name": "string",
    "quantity": "double",
    "unit_price": "decimal(12,2)",
    "order_date": "string",
}


@query(
    "profile_nulls",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM sales_raw"
        for c in _SALES_COLUMNS
    ),
    ["sales_raw"],
)
def _profile_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile_nulls(inputs.sales_raw(spark, sf_dir))


@query(
    "profile_schema",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS column_type, count({c}) AS non_null_count "
        "FROM sales_raw"
        for c, t in _SALES_COLUMNS.items()
    ),
    ["sales_raw"],
)
def _profile_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile_schema(inputs.sales_raw(spark, sf_dir))


_DESCRIBED = ["employee_id", "salary", "experience"]


@query(
    "profile_describe",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean,
               round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min,
               CAST(max({c}) AS DOUBLE) AS max,
               round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 4) AS p25,
               round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS p50,
               round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 4) AS p75
            FROM employees_in"""
        for c in _DESCRIBED
    ),
    ["employees_in"],
)
def _profile_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    described = profile.profile_describe(inputs.employees(spark, sf_dir))
    digits = {"mean": 6, "std": 4, "p25": 4, "p50": 4, "p75": 4}
    return described.withColumns({c: F.round(c, n) for c, n in digits.items()})


@query(
    "profile_head",
    """(SELECT 'first' AS part, order_id, CAST(amount AS DOUBLE) AS amount FROM orders_in
        ORDER BY order_id LIMIT 5)
       UNION ALL
       (SELECT 'last' AS part, order_id, CAST(amount AS DOUBLE) AS amount FROM orders_in
        ORDER BY order_id DESC LIMIT 5)""",
    ["orders_in"],
)
def _profile_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.orders(spark, sf_dir).select("order_id", "amount")
    first = profile.profile_head(orders, ["order_id"])
    last = profile.profile_head(orders, ["order_id"], last=True)
    return first.select(F.lit("first").alias("part"), "*").unionByName(
        last.select(F.lit("last").alias("part"), "*")
    )


@query(
    "slice_rows",
    """SELECT order_id, CAST(amount AS DOUBLE) AS amount FROM orders_in
       ORDER BY amount, order_id LIMIT 20 OFFSET 100""",
    ["orders_in"],
)
def _slice_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.orders(spark, sf_dir).select("order_id", "amount")
    return ordering.slice_rows(orders, ["amount", "order_id"], 100, 20)


# --- projections -------------------------------------------------------------------------------


@query("select_cols", "SELECT o_orderkey, o_totalprice FROM orders")
def _select_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.table(spark, sf_dir, "orders")
    return projections.select_cols(orders, ["o_orderkey", "o_totalprice"])


@query("drop_cols", "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def _drop_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.drop_cols(inputs.table(spark, sf_dir, "customer"), ["c_mktsegment"])


@query("rename_cols", "SELECT r_regionkey AS region_id, r_name AS region FROM region")
def _rename_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"r_regionkey": "region_id", "r_name": "region"}
    return projections.rename_cols(inputs.table(spark, sf_dir, "region"), names)


@query(
    "derive_arith",
    """SELECT order_id, line, part_id, supplier_id,
              CAST(quantity * price AS DOUBLE) AS total_price,
              CAST(price * CAST(0.10 AS DECIMAL(3,2)) AS DOUBLE) AS bonus
       FROM lines_in""",
    ["lines_in"],
)
def _derive_arith(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = inputs.lines(spark, sf_dir)
    total = projections.derive_arith(line, "total_price", F.col("quantity") * F.col("price"))
    tenth = F.lit("0.10").cast("decimal(3,2)")
    both = projections.derive_arith(total, "bonus", F.col("price") * tenth)
    return both.select("order_id", "line", "part_id", "supplier_id", "total_price", "bonus")


@query(
    "derive_flag",
    "SELECT order_id, customer IS NOT NULL AS has_customer FROM sales_raw",
    ["sales_raw"],
)
def _derive_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = inputs.sales_raw(spark, sf_dir)
    flagged = projections.derive_flag(sales, "has_customer", F.col("customer"))
    return flagged.select("order_id", "has_customer")


@query(
    "derive_const",
    "SELECT s_suppkey, 'suppliers' AS source_file, 'unchecked' AS reject_reason FROM supplier",
)
def _derive_const(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = inputs.table(spark, sf_dir, "supplier").select("s_suppkey")
    values = {"source_file": "suppliers", "reject_reason": "unchecked"}
    return projections.derive_const(supplier, values)


@query(
    "project_ordered",
    """SELECT priority, order_id, CAST(amount AS DOUBLE) AS amount,
              CAST(order_date AS VARCHAR) AS order_date
       FROM orders_in""",
    ["orders_in"],
)
def _project_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.orders(spark, sf_dir)
    return projections.project_ordered(orders, ["priority", "order_id", "amount", "order_date"])


# --- filters -----------------------------------------------------------------------------------


@query("filter_cmp", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 250000")
def _filter_cmp(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.table(spark, sf_dir, "orders")
    kept = filters.filter_cmp(orders, "o_totalprice", ">", 250000)
    return kept.select("o_orderkey", "o_totalprice")


@query(
    "filter_and",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE o_totalprice > 250000 AND o_orderstatus = 'F'""",
)
def _filter_and(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.table(spark, sf_dir, "orders")
    kept = filters.filter_and(
        orders, F.col("o_totalprice") > 250000, F.col("o_orderstatus") == "F"
    )
    return kept.select("o_orderkey", "o_totalprice")


@query(
    "filter_or",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE o_totalprice < 20000 OR o_orderstatus = 'P'""",
)
def _filter_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.table(spark, sf_dir, "orders")
    kept = filters.filter_or(orders, F.col("o_totalprice") < 20000, F.col("o_orderstatus") == "P")
    return kept.select("o_orderkey", "o_totalprice")


@query(
    "filter_in",
    "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')",
)
def _filter_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = inputs.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return filters.filter_in(customer, "c_mktsegment", ["BUILDING", "MACHINERY"])


@query(
    "filter_not_in",
    """SELECT employee_id, department FROM employees_raw
       WHERE department IS NULL OR department NOT IN ('BUILDING', 'MACHINERY')""",
    ["employees_raw"],
)
def _filter_not_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inputs.employees_raw(spark, sf_dir).select("employee_id", "department")
    return filters.filter_not_in(raw, "department", ["BUILDING", "MACHINERY"])


@query(
    "filter_notnull",
    "SELECT order_id, customer FROM sales_raw WHERE customer IS NOT NULL",
    ["sales_raw"],
)
def _filter_notnull(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = inputs.sales_raw(spark, sf_dir).select("order_id", "customer")
    return filters.filter_notnull(sales, "customer")


@query(
    "drop_nulls",
    """SELECT order_id, customer, quantity FROM sales_raw
       WHERE customer IS NOT NULL AND quantity IS NOT NULL""",
    ["sales_raw"],
)
def _drop_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = inputs.sales_raw(spark, sf_dir).select("order_id", "customer", "quantity")
    return filters.drop_nulls(sales, ["customer", "quantity"])


@query("filter_equal", "SELECT event_id, user_id FROM events WHERE event_type = 'click'")
def _filter_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.table(spark, sf_dir, "events")
    return filters.filter_equal(events, "event_type", "click").select("event_id", "user_id")


# --- deduplication -----------------------------------------------------------------------------


@query("distinct_rows", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def _distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = inputs.table(spark, sf_dir, "lineitem")
    return dedup.distinct_rows(line.select("l_orderkey", "l_linenumber"))


def _line_result(df: DataFrame) -> DataFrame:
    return df.select("order_id", "line", "part_id", "supplier_id", "quantity", "price", "ship_date")


_LINE_SQL = """order_id, line, part_id, supplier_id, CAST(quantity AS DOUBLE) AS quantity,
               CAST(price AS DOUBLE) AS price, CAST(ship_date AS VARCHAR) AS ship_date"""


def _first_line_sql(key: str, order: list[str]) -> str:
    return f"""SELECT {_LINE_SQL} FROM (
                   SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {', '.join(order)}) AS n
                   FROM lines_in) AS numbered
               WHERE n = 1"""


@query("dedup_key", _first_line_sql("order_id", inputs.LINE_ORDER), ["lines_in"])
def _dedup_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = inputs.lines(spark, sf_dir)
    return _line_result(dedup.dedup_key(line, "order_id", inputs.LINE_ORDER))


@query(
    "dedup_keep_first", _first_line_sql("order_id, line", inputs.LINE_ORDER[1:]), ["lines_in"]
)
def _dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = inputs.lines(spark, sf_dir)
    return _line_result(dedup.dedup_keep_first(line, ["order_id", "line"], inputs.LINE_ORDER[1:]))


@query(
    "dedup_business_key",
    f"""SELECT employee_id, name, department, join_date FROM (
            SELECT *, row_number() OVER (PARTITION BY name, department, join_date
                                         ORDER BY employee_id) AS n
            FROM (SELECT employee_id, lower({strip_sql('name')}) AS name, department, join_date
                  FROM employees_raw) AS cleaned) AS numbered
        WHERE n = 1""",
    ["employees_raw"],
)
def _dedup_business_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inputs.employees_raw(spark, sf_dir).drop("salary")
    cleaned = raw.withColumn("name", clean_text(F.col("name")))
    return dedup.dedup_business_key(cleaned, ["name", "department", "join_date"], ["employee_id"])


@query(
    "count_duplicates",
    """SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber
                                                FROM lineitem)) AS duplicates
       FROM lineitem""",
)
def _count_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = inputs.table(spark, sf_dir, "lineitem")
    return dedup.count_duplicates(line, ["l_orderkey", "l_linenumber"])


# --- joins -------------------------------------------------------------------------------------


def _known_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lookup with gaps: customers whose balance is not negative."""
    customer = inputs.table(spark, sf_dir, "customer").where("c_acctbal >= 0")
    return customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"))


_KNOWN_SQL = """(SELECT c_custkey AS customer_id, c_name AS name FROM customer
                 WHERE c_acctbal >= 0)"""


@query(
    "join_inner",
    f"""SELECT o.order_id, o.customer_id, k.name
        FROM orders_in AS o JOIN {_KNOWN_SQL} AS k ON o.customer_id = k.customer_id""",
    ["orders_in"],
)
def _join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.orders(spark, sf_dir).select("order_id", "customer_id")
    return joins.join_inner(orders, _known_customers(spark, sf_dir), ["customer_id"])


@query(
    "join_left_flag",
    f"""SELECT o.order_id, o.customer_id, k.name, k.customer_id IS NOT NULL AS customer_found
        FROM orders_in AS o LEFT JOIN {_KNOWN_SQL} AS k ON o.customer_id = k.customer_id""",
    ["orders_in"],
)
def _join_left_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.orders(spark, sf_dir).select("order_id", "customer_id")
    return joins.join_left_flag(orders, _known_customers(spark, sf_dir), ["customer_id"])


@query(
    "join_split",
    f"""SELECT o.order_id, CASE WHEN k.customer_id IS NULL THEN 'unmatched' ELSE 'matched' END
            AS part
        FROM orders_in AS o LEFT JOIN {_KNOWN_SQL} AS k ON o.customer_id = k.customer_id""",
    ["orders_in"],
)
def _join_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.orders(spark, sf_dir).select("order_id", "customer_id")
    matched, unmatched = joins.join_split(orders, _known_customers(spark, sf_dir), ["customer_id"])
    return matched.select("order_id", F.lit("matched").alias("part")).unionByName(
        unmatched.select("order_id", F.lit("unmatched").alias("part"))
    )


# Two loads of one feed that overlap by a year.
FIRST_LOAD_END, SECOND_LOAD_START = "1999-01-01", "1998-01-01"


def stored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.orders(spark, sf_dir).where(F.col("order_date") < FIRST_LOAD_END)


def incoming_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.orders(spark, sf_dir).where(F.col("order_date") >= SECOND_LOAD_START)


STORED_SQL = f"(SELECT * FROM orders_in WHERE order_date < DATE '{FIRST_LOAD_END}')"
INCOMING_SQL = f"(SELECT * FROM orders_in WHERE order_date >= DATE '{SECOND_LOAD_START}')"


@query(
    "anti_join_new",
    f"""SELECT order_id, CAST(amount AS DOUBLE) AS amount FROM {INCOMING_SQL} AS i
        WHERE NOT EXISTS (SELECT 1 FROM {STORED_SQL} AS s WHERE s.order_id = i.order_id)""",
    ["orders_in"],
)
def _anti_join_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    incoming, stored = incoming_orders(spark, sf_dir), stored_orders(spark, sf_dir)
    return joins.anti_join_new(incoming, stored, ["order_id"]).select("order_id", "amount")


@query(
    "semi_join_skipped",
    f"""SELECT order_id, CAST(amount AS DOUBLE) AS amount FROM {INCOMING_SQL} AS i
        WHERE EXISTS (SELECT 1 FROM {STORED_SQL} AS s WHERE s.order_id = i.order_id)""",
    ["orders_in"],
)
def _semi_join_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    incoming, stored = incoming_orders(spark, sf_dir), stored_orders(spark, sf_dir)
    return joins.semi_join_skipped(incoming, stored, ["order_id"]).select("order_id", "amount")


# --- aggregates --------------------------------------------------------------------------------


def _staff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty employees with a typed salary; departments and salaries have gaps."""
    raw = inputs.employees_raw(spark, sf_dir)
    return raw.withColumn("salary", to_money(F.col("salary")))


_STAFF_SQL = """(SELECT employee_id, name, department, join_date,
                        TRY_CAST(salary AS DECIMAL(12,2)) AS salary FROM employees_raw)"""
_STAFF_GROUPS = f"FROM {_STAFF_SQL} AS staff WHERE department IS NOT NULL GROUP BY department"


@query(
    "group_mean",
    f"SELECT department, round(avg(salary), 6) AS mean {_STAFF_GROUPS}",
    ["employees_raw"],
)
def _group_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.group_mean(_staff(spark, sf_dir), ["department"], "salary")


@query(
    "group_multi",
    f"""SELECT department, round(avg(salary), 6) AS mean, CAST(min(salary) AS DOUBLE) AS min,
               CAST(max(salary) AS DOUBLE) AS max, count(salary) AS count {_STAFF_GROUPS}""",
    ["employees_raw"],
)
def _group_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.group_multi(_staff(spark, sf_dir), ["department"], "salary")


@query(
    "group_named",
    f"""SELECT department, round(avg(salary), 6) AS avg_salary,
               CAST(max(salary) AS DOUBLE) AS max_salary, count(name) AS headcount
        {_STAFF_GROUPS}""",
    ["employees_raw"],
)
def _group_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.group_named(
        _staff(spark, sf_dir),
        ["department"],
        {
            "avg_salary": F.avg("salary"),
            "max_salary": F.max("salary"),
            "headcount": F.count("name"),
        },
    )


@query(
    "group_two_keys",
    """SELECT flag, status, round(avg(price), 6) AS mean FROM lines_in GROUP BY flag, status""",
    ["lines_in"],
)
def _group_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.group_two_keys(inputs.lines(spark, sf_dir), "flag", "status", "price")


@query(
    "agg_sum",
    f"SELECT department, CAST(COALESCE(sum(salary), 0) AS DOUBLE) AS sum {_STAFF_GROUPS}",
    ["employees_raw"],
)
def _agg_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.agg_sum(_staff(spark, sf_dir), ["department"], "salary")


@query(
    "agg_min",
    f"SELECT department, CAST(min(salary) AS DOUBLE) AS min {_STAFF_GROUPS}",
    ["employees_raw"],
)
def _agg_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.agg_min(_staff(spark, sf_dir), ["department"], "salary")


@query(
    "agg_max",
    f"SELECT department, CAST(max(salary) AS DOUBLE) AS max {_STAFF_GROUPS}",
    ["employees_raw"],
)
def _agg_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.agg_max(_staff(spark, sf_dir), ["department"], "salary")


@query(
    "agg_count",
    f"SELECT department, count(salary) AS count {_STAFF_GROUPS}",
    ["employees_raw"],
)
def _agg_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.agg_count(_staff(spark, sf_dir), ["department"], "salary")


@query(
    "agg_nunique",
    "SELECT supplier_id, count(DISTINCT part_id) AS nunique FROM lines_in GROUP BY supplier_id",
    ["lines_in"],
)
def _agg_nunique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.agg_nunique(inputs.lines(spark, sf_dir), ["supplier_id"], "part_id")


def _edge_sql(name: str, direction: str) -> str:
    return f"""SELECT department, CAST(salary AS DOUBLE) AS {name} FROM (
                   SELECT department, salary, row_number() OVER (
                       PARTITION BY department ORDER BY employee_id {direction}) AS n
                   FROM {_STAFF_SQL} AS staff
                   WHERE department IS NOT NULL AND salary IS NOT NULL) AS numbered
               WHERE n = 1"""


@query("agg_first", _edge_sql("first", "ASC"), ["employees_raw"])
def _agg_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    staff = _staff(spark, sf_dir)
    return aggregates.agg_first(staff, ["department"], "salary", ["employee_id"])


@query("agg_last", _edge_sql("last", "DESC"), ["employees_raw"])
def _agg_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    staff = _staff(spark, sf_dir)
    return aggregates.agg_last(staff, ["department"], "salary", ["employee_id"])


@query(
    "agg_std",
    f"SELECT department, round(stddev_samp(salary), 4) AS std {_STAFF_GROUPS}",
    ["employees_raw"],
)
def _agg_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    std = aggregates.agg_std(_staff(spark, sf_dir), ["department"], "salary")
    return std.withColumn("std", F.round("std", 4))


@query(
    "agg_median",
    """SELECT supplier_id, round(median(CAST(price AS DOUBLE)), 3) AS median
       FROM lines_in GROUP BY supplier_id""",
    ["lines_in"],
)
def _agg_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.agg_median(inputs.lines(spark, sf_dir), ["supplier_id"], "price")


# Doubles with all bits of the mantissa in use.
_RATES_SQL = """(SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS part_id,
                        l_suppkey AS supplier_id, l_extendedprice / 7.0::DOUBLE AS rate
                 FROM lineitem)"""


def _rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_suppkey").alias("supplier_id"),
        (F.col("l_extendedprice").cast("double") / 7.0).alias("rate"),
    )


@query(
    "agg_median_double",
    f"""SELECT supplier_id, round(median(rate), 6) AS median
        FROM {_RATES_SQL} AS rates GROUP BY supplier_id""",
)
def _agg_median_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    medians = aggregates.agg_median(_rates(spark, sf_dir), ["supplier_id"], "rate")
    return medians.withColumn("median", F.round("median", 6))


@query(
    "window_rank_avg_double",
    f"""SELECT order_id, line, part_id, supplier_id, rate,
               rank() OVER (PARTITION BY supplier_id ORDER BY rate)
               + (count(*) OVER (PARTITION BY supplier_id, rate) - 1) / 2.0::DOUBLE AS rank
        FROM {_RATES_SQL} AS rates""",
)
def _window_rank_avg_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.window_rank_avg(_rates(spark, sf_dir), ["supplier_id"], "rate")


@query(
    "exact_median",
    "SELECT round(median(CAST(amount AS DOUBLE)), 3) AS median FROM orders_in",
    ["orders_in"],
)
def _exact_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranks.exact_median(inputs.orders(spark, sf_dir), "amount")


@query(
    "pivot_mean",
    f"SELECT department, round(avg(salary), 6) AS salary {_STAFF_GROUPS}",
    ["employees_raw"],
)
def _pivot_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.pivot_mean(_staff(spark, sf_dir), ["department"], "salary")


@query(
    "pivot_multi",
    """SELECT department, round(avg(salary), 6) AS salary, max(experience) AS experience
       FROM employees_in GROUP BY department""",
    ["employees_in"],
)
def _pivot_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    reducers = {"salary": "mean", "experience": "max"}
    return aggregates.pivot_multi(inputs.employees(spark, sf_dir), ["department"], reducers)


@query(
    "sql_group_headcount",
    f"""SELECT department, round(avg(salary), 6) AS avg_salary,
               CAST(max(salary) AS DOUBLE) AS max_salary, count(*) AS headcount
        FROM {_STAFF_SQL} AS staff GROUP BY department""",
    ["employees_raw"],
)
def _sql_group_headcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql_query(
        spark,
        """SELECT department, avg(salary) AS avg_salary, max(salary) AS max_salary,
                  count(*) AS headcount
           FROM {staff} GROUP BY department""",
        staff=_staff(spark, sf_dir),
    )


# --- reports -----------------------------------------------------------------------------------


def _clean_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = validate_sales(inputs.sales_raw(spark, sf_dir))
    return transform_sales(valid)


CLEAN_SALES_SQL = f"""(
    SELECT order_id, lower({strip_sql('customer')}) AS customer,
           lower({strip_sql('region')}) AS region,
           lower({strip_sql('product_category')}) AS product_category,
           CAST(CAST(quantity AS DECIMAL(15,3)) * unit_price AS DECIMAL(24,2)) AS total_price
    FROM sales_raw
    WHERE customer IS NOT NULL AND quantity > 0 AND unit_price > 0)"""


@query(
    "report_by_category",
    f"""SELECT product_category, count(*) AS orders,
               CAST(sum(total_price) AS DOUBLE) AS total_revenue,
               round(avg(total_price), 2) AS avg_order_value
        FROM {CLEAN_SALES_SQL} AS clean GROUP BY product_category ORDER BY total_revenue DESC""",
    ["sales_raw"],
)
def _report_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.report_by_category(_clean_sales(spark, sf_dir))


@query(
    "report_by_region",
    f"""SELECT region, count(*) AS orders, CAST(sum(total_price) AS DOUBLE) AS total_revenue
        FROM {CLEAN_SALES_SQL} AS clean GROUP BY region ORDER BY total_revenue DESC""",
    ["sales_raw"],
)
def _report_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.report_by_region(_clean_sales(spark, sf_dir))


@query(
    "top_k_spend",
    f"""SELECT customer, count(*) AS orders, CAST(sum(total_price) AS DOUBLE) AS total_spend
        FROM {CLEAN_SALES_SQL} AS clean GROUP BY customer
        ORDER BY total_spend DESC, customer LIMIT 5""",
    ["sales_raw"],
)
def _top_k_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.top_k_spend(_clean_sales(spark, sf_dir))


CLEAN_PRODUCTS_SQL = f"""(
    SELECT lower({strip_sql('product')}) AS product,
           CAST(CAST(quantity AS DECIMAL(15,3)) * unit_price AS DECIMAL(24,2)) AS total_price
    FROM product_sales_raw
    WHERE customer IS NOT NULL AND quantity > 0 AND unit_price > 0)"""

PRODUCT_REPORT_SQL = f"""
    SELECT product, count(*) AS orders, CAST(sum(total_price) AS DOUBLE) AS total_revenue
    FROM {CLEAN_PRODUCTS_SQL} AS clean GROUP BY product ORDER BY total_revenue DESC"""


@query("report_by_product", PRODUCT_REPORT_SQL, ["product_sales_raw"])
def _report_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = validate_sales(inputs.product_sales_raw(spark, sf_dir))
    return aggregates.report_by_product(transform_sales(valid))


# --- windows -----------------------------------------------------------------------------------


@query(
    "window_group_mean",
    f"""SELECT employee_id, department, CASE WHEN department IS NOT NULL THEN
                   round(avg(salary) OVER (PARTITION BY department), 6) END AS group_mean
        FROM {_STAFF_SQL} AS staff""",
    ["employees_raw"],
)
def _window_group_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    with_mean = windows.window_group_mean(_staff(spark, sf_dir), ["department"], "salary")
    return with_mean.select("employee_id", "department", "group_mean")


@query(
    "window_group_max",
    f"""SELECT employee_id, department, CASE WHEN department IS NOT NULL THEN
                   CAST(max(salary) OVER (PARTITION BY department) AS DOUBLE) END AS group_max
        FROM {_STAFF_SQL} AS staff""",
    ["employees_raw"],
)
def _window_group_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    with_max = windows.window_group_max(_staff(spark, sf_dir), ["department"], "salary")
    return with_max.select("employee_id", "department", "group_max")


@query(
    "window_rank_avg",
    """SELECT order_id, line, part_id, supplier_id, CAST(quantity AS DOUBLE) AS quantity,
              rank() OVER (PARTITION BY supplier_id ORDER BY quantity)
              + (count(*) OVER (PARTITION BY supplier_id, quantity) - 1) / 2.0::DOUBLE AS rank
       FROM lines_in""",
    ["lines_in"],
)
def _window_rank_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = windows.window_rank_avg(inputs.lines(spark, sf_dir), ["supplier_id"], "quantity")
    return ranked.select("order_id", "line", "part_id", "supplier_id", "quantity", "rank")


@query(
    "group_filter_mean",
    f"""SELECT employee_id, department FROM {_STAFF_SQL} AS staff WHERE department IN (
            SELECT department FROM {_STAFF_SQL} AS s GROUP BY department
            HAVING avg(salary) > 45000)""",
    ["employees_raw"],
)
def _group_filter_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = windows.group_filter_mean(_staff(spark, sf_dir), ["department"], "salary", 45000)
    return kept.select("employee_id", "department")


@query(
    "group_filter_size",
    """SELECT order_id, line, part_id FROM lines_in WHERE order_id IN (
           SELECT order_id FROM lines_in GROUP BY order_id HAVING count(*) > 5)""",
    ["lines_in"],
)
def _group_filter_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = inputs.lines(spark, sf_dir).select("order_id", "line", "part_id")
    return windows.group_filter_size(line, ["order_id"], 5)


# --- sorts and stacking ------------------------------------------------------------------------


@query(
    "sort_desc",
    """SELECT employee_id, CAST(TRY_CAST(salary AS DECIMAL(12,2)) AS DOUBLE) AS salary
       FROM employees_raw ORDER BY salary DESC NULLS LAST, employee_id""",
    ["employees_raw"],
)
def _sort_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    staff = _staff(spark, sf_dir).select("employee_id", "salary")
    return ordering.sort_desc(staff, "salary", ["employee_id"])


@query(
    "sort_mixed",
    """SELECT employee_id, department, experience FROM employees_in
       ORDER BY department, experience DESC, employee_id""",
    ["employees_in"],
)
def _sort_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    staff = inputs.employees(spark, sf_dir).select("employee_id", "department", "experience")
    return ordering.sort_mixed(
        staff, ["department", "experience"], [False, True], ["employee_id"]
    )


@query(
    "top_one",
    """SELECT order_id, CAST(amount AS DOUBLE) AS amount FROM orders_in
       ORDER BY amount DESC, order_id LIMIT 1""",
    ["orders_in"],
)
def _top_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.orders(spark, sf_dir).select("order_id", "amount")
    return ordering.top_one(orders, "amount", ["order_id"])


@query(
    "union_all",
    f"""SELECT order_id, status FROM {STORED_SQL} AS s
        UNION ALL SELECT order_id, status FROM {INCOMING_SQL} AS i""",
    ["orders_in"],
)
def _union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = stored_orders(spark, sf_dir), incoming_orders(spark, sf_dir)
    return ordering.union_all(first, second).select("order_id", "status")


@query(
    "union_ragged",
    """SELECT c_name AS name, c_mktsegment AS segment, NULL AS part_type FROM customer
       UNION ALL SELECT p_name, NULL, p_type FROM part""",
)
def _union_ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = inputs.table(spark, sf_dir, "customer")
    part = inputs.table(spark, sf_dir, "part")
    return ordering.union_ragged(
        customer.select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")),
        part.select(F.col("p_name").alias("name"), F.col("p_type").alias("part_type")),
    )
