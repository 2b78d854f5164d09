"""Composed flows and file-by-file loading over the test tables.

A flow writes its stage and its tables below a fresh run folder and returns what it stored.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsift.operators.audit import Run
from quillsift.operators.quality import quantity_price_rules
from quillsift.plans import ecommerce as shop
from quillsift.plans import employees as staff
from quillsift.plans import orders as order_flows
from quillsift.plans import sales
from quillsift.plans.staging import run_summary, stage
from quillsift.schemas import SALES_RAW
from quillsift.session import run_folder
from quillsift.sources.generate import CLEAN, gen_shop_orders
from quillsift.sources.ranged import (
    delete_ranged,
    read_ranged,
    update_ranged,
    upsert_ranged,
)
from quillsift.sources.snapshots import append_distinct, read_distinct, upsert_partitions
from quillsift.sources.writers import write_csv
from quillsift.streaming.file_stream import chunk_log, chunked_load, file_ledger_stream
from quillsift.streaming.ledger import file_ledger, read_ledger, read_loaded
from quillsift.workload import inputs
from quillsift.workload.cleaning import (
    BAND_SQL,
    ISO_DATE_SQL,
    MEDIAN_SALARY_SQL,
    MIXED_DATE_SQL,
    strip_sql,
)
from quillsift.workload.loading import CLEAN_ECOMMERCE_SQL
from quillsift.workload.registry import query
from quillsift.workload.relational import (
    CLEAN_SALES_SQL,
    INCOMING_SQL,
    PRODUCT_REPORT_SQL,
    STORED_SQL,
    incoming_orders,
    stored_orders,
)

RUN = Run("run-1", dt.datetime(2026, 1, 1, 8, 0))
NEXT_RUN = Run("run-2", dt.datetime(2026, 1, 2, 8, 0))

# --- employees ---------------------------------------------------------------------------------


@query(
    "flow_clean_employees",
    f"""SELECT name, department, CASE WHEN regexp_full_match(salary, '[+-]?[0-9]+')
                    THEN CAST(salary AS BIGINT) END AS salary
        FROM (SELECT lower({strip_sql('name')}) AS name, department,
                     replace(salary, '.00', '') AS salary FROM employees_raw) AS cleaned""",
    ["employees_raw"],
)
def _flow_clean_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inputs.employees_raw(spark, sf_dir).select(
        "name", "department", F.regexp_replace("salary", r"\.00", "").alias("salary")
    )
    return staff.clean_employees(spark, raw, run_folder(spark, "clean_employees"))


@query(
    "flow_employee_features",
    f"""WITH typed AS (
            SELECT employee_id, lower({strip_sql('name')}) AS name, department,
                   TRY_CAST(salary AS DECIMAL(12,2)) AS salary, {ISO_DATE_SQL} AS join_date
            FROM employees_raw),
        filled AS (
            SELECT * REPLACE (COALESCE(salary, (SELECT {MEDIAN_SALARY_SQL} FROM typed))
                                  AS salary) FROM typed),
        numbered AS (
            SELECT *, row_number() OVER (PARTITION BY name, department, join_date
                                         ORDER BY employee_id) AS n FROM filled)
        SELECT employee_id, name, department, CAST(salary AS DOUBLE) AS salary,
               CAST(join_date AS VARCHAR) AS join_date, {BAND_SQL} AS band,
               2026 - year(join_date) AS years_at_company
        FROM numbered WHERE n = 1""",
    ["employees_raw"],
)
def _flow_employee_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staff.employee_features(inputs.employees_raw(spark, sf_dir), 2026)


@query(
    "flow_enrich",
    f"SELECT band, count(*) AS headcount FROM (SELECT {BAND_SQL} AS band FROM employees_in) AS b "
    "GROUP BY band",
    ["employees_in"],
)
def _flow_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = staff.enrich(inputs.employees(spark, sf_dir), run_folder(spark, "enrich"))
    return stored.groupBy("band").agg(F.count("*").alias("headcount"))


def _hr(spark: SparkSession, sf_dir: str) -> staff.HrTables:
    raw = inputs.employees_raw(spark, sf_dir)
    # People without a department have lost their name as well.
    name = F.when(F.col("department").isNotNull(), F.col("name")).alias("name")
    people = raw.select("employee_id", name, "department", "join_date")
    return staff.hr(people, raw.select("employee_id", "salary"))


@query(
    "flow_hr",
    f"""SELECT employee_id, lower({strip_sql('name')}) AS name, CAST(salary AS DOUBLE) AS salary,
               {BAND_SQL} AS salary_band, CAST(join_date AS VARCHAR) AS join_date
        FROM (SELECT employee_id, name, department, TRY_CAST(salary AS DECIMAL(12,2)) AS salary,
                     {ISO_DATE_SQL} AS join_date FROM employees_raw) AS typed
        WHERE department IS NOT NULL AND salary > 0""",
    ["employees_raw"],
)
def _flow_hr(spark: SparkSession, sf_dir: str) -> DataFrame:
    final = _hr(spark, sf_dir).employees
    return final.select("employee_id", "name", "salary", "salary_band", "join_date")


@query(
    "flow_hr_rejected",
    """SELECT employee_id, 'employees' AS source FROM employees_raw WHERE department IS NULL
       UNION ALL
       SELECT employee_id, 'salaries' FROM employees_raw
       WHERE NOT COALESCE(TRY_CAST(salary AS DECIMAL(12,2)) > 0, FALSE)""",
    ["employees_raw"],
)
def _flow_hr_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = _hr(spark, sf_dir).rejected
    no_name = F.array_contains("failed_rules", "name is missing")
    source = F.when(no_name, "employees").otherwise("salaries")
    return rejected.select("employee_id", source.alias("source"))


# --- sales -------------------------------------------------------------------------------------


@query("flow_sales", PRODUCT_REPORT_SQL, ["product_sales_raw"])
def _flow_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inputs.product_sales_raw(spark, sf_dir)
    return sales.sales_by_product(raw, run_folder(spark, "sales")).report


def _sales_report(spark: SparkSession, sf_dir: str) -> sales.SalesReport:
    folder = run_folder(spark, "sales_report")
    raw = inputs.sales_raw(spark, sf_dir)
    return sales.sales_report(spark, raw, f"{folder}/store", f"{folder}/stage", RUN)


@query(
    "flow_sales_report",
    f"""SELECT 'category' AS report, product_category AS key, count(*) AS orders,
               CAST(sum(total_price) AS DOUBLE) AS total
        FROM {CLEAN_SALES_SQL} AS clean GROUP BY product_category
        UNION ALL
        SELECT 'region', region, count(*), CAST(sum(total_price) AS DOUBLE)
        FROM {CLEAN_SALES_SQL} AS clean GROUP BY region
        UNION ALL
        (SELECT 'customer', customer, count(*), CAST(sum(total_price) AS DOUBLE) AS total
         FROM {CLEAN_SALES_SQL} AS clean GROUP BY customer ORDER BY total DESC, customer LIMIT 5)""",
    ["sales_raw"],
)
def _flow_sales_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = _sales_report(spark, sf_dir)

    def shown(df: DataFrame, report: str, key: str, total: str) -> DataFrame:
        return df.select(
            F.lit(report).alias("report"),
            F.col(key).alias("key"),
            "orders",
            F.col(total).alias("total"),
        )

    return (
        shown(result.by_category, "category", "product_category", "total_revenue")
        .unionByName(shown(result.by_region, "region", "region", "total_revenue"))
        .unionByName(shown(result.top_customers, "customer", "customer", "total_spend"))
    )


# A feed whose ids, quantities and prices are text: missing, malformed and repeated ids, fractions,
# prices with a sign, and every 41st row sent twice.
_DIRTY_SALES_SQL = """(
    SELECT CASE WHEN order_id % 97 = 0 THEN NULL WHEN order_id % 89 = 0 THEN 'A' || order_id
                WHEN order_id % 61 = 0 THEN CAST(order_id - 1 AS VARCHAR)
                ELSE CAST(order_id AS VARCHAR) END AS order_id,
           customer, region, product_category, product_name,
           CASE WHEN order_id % 71 = 0 THEN '2.5' ELSE CAST(quantity AS VARCHAR) END AS quantity,
           CASE WHEN order_id % 79 = 0 THEN '$5.00'
                ELSE CAST(unit_price AS VARCHAR) END AS unit_price, order_date
    FROM sales_raw JOIN (VALUES (0), (1)) AS v(copy) ON copy = 0 OR order_id % 41 = 0)"""

_JUDGED_SALES_SQL = f"""(
    SELECT *, concat_ws(', ',
               CASE WHEN TRY_CAST(order_id AS BIGINT) IS NULL THEN 'order_id is missing' END,
               CASE WHEN customer IS NULL THEN 'customer is missing' END,
               CASE WHEN NOT COALESCE(TRY_CAST(quantity AS DOUBLE) > 0, FALSE)
                    THEN 'quantity is not positive' END,
               CASE WHEN NOT COALESCE(TRY_CAST(unit_price AS DECIMAL(12,2)) > 0, FALSE)
                    THEN 'unit_price is not positive' END,
               CASE WHEN quantity = '2.5' THEN 'quantity is not whole' END) AS failed
    FROM {_DIRTY_SALES_SQL} AS dirty)"""


def _dirty_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("order_id")
    text = key.cast("string")
    twice = F.explode(F.sequence(F.lit(0), F.when(key % 41 == 0, 1).otherwise(0)))
    rows = inputs.sales_raw(spark, sf_dir).withColumn("copy", twice).drop("copy")
    return rows.withColumns(
        {
            "order_id": F.when(key % 97 == 0, None)
            .when(key % 89 == 0, F.concat(F.lit("A"), text))
            .when(key % 61 == 0, (key - 1).cast("string"))
            .otherwise(text),
            "quantity": F.when(key % 71 == 0, "2.5").otherwise(F.col("quantity").cast("string")),
            "unit_price": F.when(key % 79 == 0, "$5.00").otherwise(
                F.col("unit_price").cast("string")
            ),
        }
    )


@query(
    "flow_sales_stored",
    f"""SELECT 'clean' AS part, CAST(CAST(order_id AS BIGINT) AS VARCHAR) AS order_id, customer,
               CAST(CAST(CAST(quantity AS DOUBLE) AS INTEGER) AS VARCHAR) AS quantity,
               unit_price, NULL AS failed, 1 AS copies
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY order_id
                  ORDER BY customer, region, product_category, product_name, quantity) AS n
              FROM (SELECT order_id, lower({strip_sql('customer')}) AS customer,
                           lower({strip_sql('region')}) AS region,
                           lower({strip_sql('product_category')}) AS product_category,
                           lower({strip_sql('product_name')}) AS product_name, quantity, unit_price
                    FROM {_JUDGED_SALES_SQL} AS judged WHERE failed = '') AS cleaned) AS numbered
        WHERE n = 1
        UNION ALL
        SELECT 'rejected', order_id, customer, quantity, unit_price, failed, count(*)
        FROM {_JUDGED_SALES_SQL} AS judged WHERE failed <> ''
        GROUP BY order_id, customer, region, product_category, product_name, quantity, unit_price,
                 order_date, failed""",
    ["sales_raw"],
)
def _flow_sales_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything stored after the same dirty feed was loaded twice."""
    folder = run_folder(spark, "sales_stored")
    raw = _dirty_sales(spark, sf_dir)
    for attempt in range(2):
        run = (RUN, NEXT_RUN)[attempt]
        result = sales.sales_report(spark, raw, f"{folder}/store", f"{folder}/s{attempt}", run)
    text = [F.col(c).cast("string").alias(c) for c in ("order_id", "customer", "quantity", "unit_price")]
    clean = result.clean.select(
        F.lit("clean").alias("part"),
        *text,
        F.lit(None).cast("string").alias("failed"),
        F.lit(1).cast("bigint").alias("copies"),
    )
    failed = F.array_join("failed_rules", ", ").alias("failed")
    return clean.unionByName(
        result.rejected.select(F.lit("rejected").alias("part"), *text, failed, "copies")
    )


@query(
    "run_summary",
    """SELECT 'success' AS status, count(*) AS rows_extracted,
              count(*) FILTER (WHERE ok) AS rows_valid,
              count(*) FILTER (WHERE NOT ok) AS rows_rejected,
              count(*) FILTER (WHERE ok) AS rows_loaded, 0 AS error_count
       FROM (SELECT COALESCE(customer IS NOT NULL AND quantity > 0 AND unit_price > 0, FALSE) AS ok
             FROM sales_raw) AS judged""",
    ["sales_raw"],
)
def _run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = stage(
        sales.flagged_sales(inputs.sales_raw(spark, sf_dir)), run_folder(spark, "run_summary")
    )
    summary = run_summary(staged, F.count_if(F.col("row_status") == "valid"))
    return summary.withColumn("error_count", F.size("errors")).drop("errors")


# --- orders ------------------------------------------------------------------------------------


@query(
    "flow_orders_lookup",
    """SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 50 = 0 THEN 'rejected'
                   WHEN c_custkey IS NULL THEN 'unmatched' ELSE 'matched' END AS part
       FROM orders
       LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) AS k
         ON o_custkey = c_custkey""",
)
def _flow_orders_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fiftieth order has lost its customer id; the others carry it as text like 12.0."""
    key, customer_id = F.col("order_id"), F.col("customer_id").cast("double").cast("string")
    orders = inputs.orders(spark, sf_dir).select(
        "order_id", F.when(key % 50 != 0, customer_id).alias("customer_id"), "amount"
    )
    customer = inputs.table(spark, sf_dir, "customer").where("c_acctbal >= 0")
    lookup = customer.select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name")
    )
    result = order_flows.orders_lookup(orders, lookup, run_folder(spark, "orders_lookup"))
    parts = [
        df.select("order_id", F.lit(name).alias("part"))
        for name, df in result._asdict().items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "flow_incremental",
    f"""SELECT count(*) AS row_count, CAST(sum(amount) AS DOUBLE) AS amount,
               (SELECT count(*) FROM {INCOMING_SQL} AS i WHERE order_id NOT IN
                    (SELECT order_id FROM {STORED_SQL} AS s)) AS added_rows
        FROM orders_in""",
    ["orders_in"],
)
def _flow_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping batches, and the second once more."""
    path = run_folder(spark, "incremental")
    first, second = stored_orders(spark, sf_dir), incoming_orders(spark, sf_dir)
    order_flows.store_incremental(spark, path, first)
    added = order_flows.store_incremental(spark, path, second)
    added += order_flows.store_incremental(spark, path, second)
    return spark.read.parquet(path).agg(
        F.count("*").alias("row_count"),
        F.sum("amount").alias("amount"),
        F.lit(added).alias("added_rows"),
    )


@query(
    "flow_upsert_audit",
    """SELECT order_id, CAST(amount AS DOUBLE) AS amount,
              CASE WHEN order_date >= DATE '1998-01-01' THEN 'v2' ELSE 'v1' END AS source_file,
              CASE WHEN order_date >= DATE '1998-01-01' THEN 'run-2' ELSE 'run-1' END AS run_id
       FROM orders_in""",
    ["orders_in"],
)
def _flow_upsert_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_folder(spark, "upsert_audit")
    order_flows.upsert_audit(spark, root, stored_orders(spark, sf_dir), "v1", RUN)
    latest = order_flows.upsert_audit(
        spark, root, incoming_orders(spark, sf_dir), "v2", NEXT_RUN
    )
    return latest.select("order_id", "amount", "source_file", "run_id")


@query(
    "change_ranged",
    """SELECT order_id, CASE WHEN status = 'P' THEN 0.0 ELSE CAST(amount AS DOUBLE) END AS amount,
              order_date >= DATE '1998-01-01' AS replaced
       FROM orders_in WHERE order_id % 1000 >= 10""",
    ["orders_in"],
)
def _change_ranged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, an update and a deletion in a table of small ranges of order ids."""
    root = run_folder(spark, "change_ranged")
    for number, batch in enumerate([stored_orders(spark, sf_dir), incoming_orders(spark, sf_dir)]):
        marked = batch.select("order_id", "status", "amount", F.lit(number == 1).alias("replaced"))
        upsert_ranged(spark, root, marked, ["order_id"], ["amount"], rows_per_range=20_000)
    kinds, key = marked.schema, ["order_id"]
    update_ranged(spark, root, kinds, key, F.col("status") == "P", {"amount": 0})
    delete_ranged(spark, root, kinds, key, F.col("order_id") % 1000 < 10)
    return read_ranged(spark, root, kinds).select("order_id", "amount", "replaced")


@query(
    "quarantine_copies",
    """SELECT status, priority, count(*) FILTER (WHERE order_id % 2 = 0)
              + 2 * count(*) FILTER (WHERE order_id % 3 = 0) AS copies
       FROM orders_in WHERE order_id % 2 = 0 OR order_id % 3 = 0 GROUP BY status, priority""",
    ["orders_in"],
)
def _quarantine_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects that two loads share, the second load of them offered twice: copies add up."""
    path = run_folder(spark, "quarantine_copies")
    rejects = inputs.orders(spark, sf_dir)
    kept = ["status", "priority"]
    append_distinct(spark, path, rejects.where("order_id % 2 = 0").select(*kept))
    thirds = rejects.where("order_id % 3 = 0").select(*kept)
    for _ in range(2):
        append_distinct(spark, path, thirds.unionByName(thirds))
    return read_distinct(spark, path, rejects.select(*kept).schema).drop("content_key")


@query(
    "upsert_partitions",
    """SELECT order_id, CAST(amount AS DOUBLE) AS amount,
              order_date >= DATE '1998-01-01' AS replaced
       FROM orders_in""",
    ["orders_in"],
)
def _upsert_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches into a table kept in ranges of order ids."""
    folder = run_folder(spark, "upsert_partitions")
    ranges = F.expr("order_id div 1000")
    for number, batch in enumerate([stored_orders(spark, sf_dir), incoming_orders(spark, sf_dir)]):
        marked = batch.select("order_id", "amount", F.lit(number == 1).alias("replaced"))
        upsert_partitions(
            spark,
            f"{folder}/table",
            marked,
            ["order_id"],
            ["amount"],
            ranges,
            f"{folder}/stage-{number}",
        )
    return spark.read.parquet(f"{folder}/table").select("order_id", "amount", "replaced")


# --- files -------------------------------------------------------------------------------------


def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.product_sales_raw(spark, sf_dir).select(*SALES_RAW.fieldNames())


#: The feed as files: one file per remainder of the order id, so that what is in a file does not
#: depend on the cluster.
_FILES = 8


def _as_files(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """The feed as CSV files of the sales schema, part-00000 to part-00007; some lines are broken: those of
    order ids that leave 5 by 97 have lost their last field, and those that leave 9 have one more."""
    number = F.pmod("order_id", F.lit(_FILES)).cast("int")
    columns = [F.col(c).cast("string") for c in SALES_RAW.fieldNames()]
    rest = F.col("order_id") % 97
    kept = F.array(*[F.coalesce(c, F.lit("")) for c in columns])
    fields = F.when(rest == 5, F.slice(kept, 1, len(columns) - 1))
    fields = fields.when(rest == 9, F.concat(kept, F.array(F.lit("LOST")))).otherwise(kept)
    header = ",".join(SALES_RAW.fieldNames())
    lines = _feed(spark, sf_dir).select(number.alias("f"), F.array_join(fields, ",").alias(header))
    # Each task writes the lines of one file as they arrive: nothing is sorted, so a task needs no
    # more memory for a larger file. A line is one field without quotes, and its name is the header.
    files = lines.repartitionById(_FILES, F.col("f")).drop("f")
    files.write.csv(
        folder, header=True, sep="\x01", quote="", escape="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


_FILE_SQL = f"""(
    SELECT *, CAST(order_id % {_FILES} AS VARCHAR) AS file, order_id % 97 IN (5, 9) AS broken,
           COALESCE(quantity > 0 AND unit_price > 0, FALSE) AND order_id % 97 NOT IN (5, 9) AS ok
    FROM product_sales_raw)"""

_FEED_TOTALS = """SELECT count(*) AS row_count,
                         CAST(sum(CAST(quantity AS DECIMAL(15,3))) AS DOUBLE) AS quantity
                  FROM product_sales_raw"""


def _feed_totals(loaded: DataFrame) -> DataFrame:
    return loaded.agg(
        F.count("*").alias("row_count"),
        F.sum(F.col("quantity").cast("decimal(15,3)")).alias("quantity"),
    )


def _file_number() -> Column:
    """The number of an entry's file, from its name."""
    return F.regexp_extract("file_path", "/part-0*([0-9]+)-[^/]*$", 1)


@query(
    "file_ledger",
    f"""SELECT file, count(*) FILTER (WHERE NOT broken) AS rows_loaded,
               count(*) FILTER (WHERE broken) AS rows_broken,
               CASE WHEN CAST(file AS INTEGER) < 5 THEN 'run-1' ELSE 'run-2' END AS loaded_by,
               3 AS second_run_files
        FROM {_FILE_SQL} AS files GROUP BY file""",
    ["product_sales_raw"],
)
def _file_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five files, then all eight, of which five are skipped: what each file's entry says."""
    folder = run_folder(spark, "file_ledger")
    _as_files(spark, sf_dir, f"{folder}/in")
    first = [f"{folder}/in/part-{n:05d}*" for n in range(5)]
    arguments = (SALES_RAW, f"{folder}/table", f"{folder}/ledger")
    file_ledger(spark, first, *arguments, RUN)
    second = file_ledger(spark, f"{folder}/in", *arguments, NEXT_RUN).count()
    by = F.when(F.col("loaded_at") == RUN.stamp(), RUN.run_id).otherwise(NEXT_RUN.run_id)
    return read_ledger(spark, f"{folder}/ledger").select(
        _file_number().alias("file"),
        "rows_loaded",
        "rows_broken",
        by.alias("loaded_by"),
        F.lit(second).alias("second_run_files"),
    )


_LOADED_SQL = f"""SELECT order_id, customer, product, quantity,
                         CAST(unit_price AS DOUBLE) AS unit_price, order_date
                  FROM {_FILE_SQL} AS files WHERE NOT broken"""


def _shown(loaded: DataFrame) -> DataFrame:
    # CSV writes and reads a blank product name without its outer blanks as it came.
    return loaded.select(*SALES_RAW.fieldNames())


@query("file_ledger_stream", _LOADED_SQL, ["product_sales_raw"])
def _file_ledger_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a stream of two batches, started twice: the rows that were loaded."""
    folder = run_folder(spark, "file_ledger_stream")
    _as_files(spark, sf_dir, f"{folder}/in")
    paths = (f"{folder}/table", f"{folder}/checkpoint")
    for _ in range(2):
        file_ledger_stream(spark, f"{folder}/in", SALES_RAW, *paths, _FILES // 2)
    return _shown(read_loaded(spark, f"{folder}/table", SALES_RAW))


@query(
    "chunked_load",
    f"""SELECT chunk, rows, valid_rows, rejected_rows,
               CAST(sum(rows) OVER (ORDER BY chunk) AS BIGINT) AS total_rows,
               CAST(sum(valid_rows) OVER (ORDER BY chunk) AS BIGINT) AS total_valid_rows,
               CAST(sum(rejected_rows) OVER (ORDER BY chunk) AS BIGINT) AS total_rejected_rows
        FROM (SELECT CASE WHEN CAST(file AS INTEGER) < 5 THEN 0 ELSE 1 END AS chunk,
                     count(*) AS rows, count(*) FILTER (WHERE ok) AS valid_rows,
                     count(*) FILTER (WHERE NOT ok) AS rejected_rows
              FROM {_FILE_SQL} AS files GROUP BY chunk) AS chunks""",
    ["product_sales_raw"],
)
def _chunked_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two arrivals of files, and a third start that finds nothing: the log of the chunks."""
    folder = run_folder(spark, "chunked_load")
    _as_files(spark, sf_dir, f"{folder}/all")
    for part in ("[0-4]", "[5-7]", "[5-7]"):
        chunked_load(
            spark,
            f"{folder}/all/part-0000{part}*",
            SALES_RAW,
            quantity_price_rules(),
            f"{folder}/table",
            f"{folder}/checkpoint",
            log=f"{folder}/log",
        )
    log = chunk_log(spark, f"{folder}/log")
    return log.withColumnRenamed("batch_id", "chunk")


@query(
    "chunked_load_rejects",
    f"""SELECT reason, count(*) AS rejected_rows FROM (
            SELECT unnest(CASE WHEN broken THEN ['line does not fit the schema']
                ELSE list_filter([
                    CASE WHEN NOT COALESCE(quantity > 0, FALSE) THEN 'quantity is not positive' END,
                    CASE WHEN NOT COALESCE(unit_price > 0, FALSE) THEN 'unit_price is not positive' END
                ], lambda r: r IS NOT NULL) END) AS reason
            FROM {_FILE_SQL} AS files WHERE NOT ok) AS reasons
        GROUP BY reason""",
    ["product_sales_raw"],
)
def _chunked_load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected rows of all chunks by the rules they failed, broken lines among them."""
    folder = run_folder(spark, "chunked_load_rejects")
    _as_files(spark, sf_dir, f"{folder}/in")
    loaded = chunked_load(
        spark,
        f"{folder}/in",
        SALES_RAW,
        quantity_price_rules(),
        f"{folder}/table",
        f"{folder}/checkpoint",
    )
    failed = loaded.where("row_status = 'rejected'").select(F.explode("failed_rules").alias("reason"))
    return failed.groupBy("reason").agg(F.count("*").alias("rejected_rows"))


@query(
    "flow_files",
    f"SELECT row_count, quantity FROM ({_FEED_TOTALS}) AS totals",
    ["product_sales_raw"],
)
def _flow_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files arriving in two folders, the first offered again with the second."""
    folder = run_folder(spark, "files")
    feed = _feed(spark, sf_dir)
    early = F.col("order_date") < "1998-01-01"
    write_csv(feed.where(early), f"{folder}/in/early")
    write_csv(feed.where(~F.coalesce(early, F.lit(False))), f"{folder}/in/late")
    early_in, late_in = f"{folder}/in/early", f"{folder}/in/late"
    order_flows.files(spark, early_in, SALES_RAW, f"{folder}/store", RUN)
    order_flows.files(spark, [early_in, late_in], SALES_RAW, f"{folder}/store", NEXT_RUN)
    return _feed_totals(read_loaded(spark, f"{folder}/store/orders_batched", SALES_RAW))


# --- e-commerce --------------------------------------------------------------------------------

# Which copy of an order counts: the first by all other columns, missing values last.
_COPY_ORDER = """customer_name, customer_email, order_date, product_category, product_name,
    quantity, unit_price, amount, discount_pct, coupon_code, payment_method, shipping_country,
    order_status"""

_SHOP_CLEAN_SQL = f"""(
    SELECT order_id, lower({strip_sql('product_category')}) AS product_category, amount_clean,
           lower({strip_sql('order_status')}) AS order_status,
           CAST({MIXED_DATE_SQL} AS VARCHAR) AS order_date, quantity_clean
    FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {_COPY_ORDER}) AS n
          FROM {CLEAN_ECOMMERCE_SQL} AS cleaned) AS numbered
    WHERE n = 1 AND customer_email IS NOT NULL AND shipping_country IS NOT NULL
      AND unit_price > 0 AND amount_clean > 0 AND quantity_clean > 0)"""


def _shop(spark: SparkSession, sf_dir: str) -> shop.Ecommerce:
    """The whole feed in one batch; overlapping batches and reruns are in the tests."""
    folder = run_folder(spark, "ecommerce")
    batch = inputs.ecommerce_raw(spark, sf_dir)
    return shop.ecommerce(spark, batch, f"{folder}/store", f"{folder}/stage")


@query(
    "flow_ecommerce",
    f"""SELECT order_id, product_category, CAST(amount_clean AS DOUBLE) AS amount_clean,
               order_status, order_date, quantity_clean FROM {_SHOP_CLEAN_SQL} AS clean""",
    ["ecommerce_raw"],
)
def _flow_ecommerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shop(spark, sf_dir).clean.select(
        "order_id", "product_category", "amount_clean", "order_status", "order_date",
        "quantity_clean",
    )


# Overlapping batches by the last two digits of the order id, the last of them sent twice.
_BATCHES = [(0, 49), (40, 89), (80, 99), (80, 99)]


def _batches_sql() -> str:
    """Per batch: rows, rows of orders stored before, copies dropped, and orders stored."""
    parts = []
    for n, (low, high) in enumerate(_BATCHES):
        seen = " OR ".join(f"order_id % 100 BETWEEN {a} AND {b}" for a, b in _BATCHES[:n])
        parts.append(
            f"""SELECT {n} AS batch, count(*) AS extracted, count(*) FILTER (WHERE known) AS skipped,
                   count(*) FILTER (WHERE NOT known)
                       - count(DISTINCT order_id) FILTER (WHERE NOT known) AS duplicates,
                   count(DISTINCT order_id) FILTER (WHERE clean AND NOT known) AS loaded
                FROM (SELECT order_id, clean, clean AND ({seen or "FALSE"}) AS known
                      FROM (SELECT order_id, order_id IN (SELECT order_id FROM {_SHOP_CLEAN_SQL} AS c)
                                AS clean FROM ecommerce_raw) AS marked
                      WHERE order_id % 100 BETWEEN {low} AND {high}) AS batch_rows"""
        )
    return " UNION ALL ".join(parts)


@query("flow_ecommerce_batches", _batches_sql(), ["ecommerce_raw"])
def _flow_ecommerce_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = run_folder(spark, "ecommerce_batches")
    feed, counts = inputs.ecommerce_raw(spark, sf_dir), []
    for n, (low, high) in enumerate(_BATCHES):
        batch = feed.where((F.col("order_id") % 100).between(low, high))
        result = shop.ecommerce(spark, batch, f"{folder}/store", f"{folder}/stage-{n}")
        summary = result.summary.head()
        counts.append(
            (n, summary.rows_extracted, result.skipped, result.duplicates, summary.rows_loaded)
        )
    names = "batch BIGINT, extracted BIGINT, skipped BIGINT, duplicates BIGINT, loaded BIGINT"
    return spark.createDataFrame(counts, names)


# Order ids by their remainder: 500 ids, 500 of which 100 come again, 700 of which 100 come again.
_DAYS = [(0, 499), (400, 899), (800, 1499)]


@query(
    "flow_shop_days",
    " UNION ALL ".join(
        f"""SELECT {n} AS day, count(*) FILTER (WHERE id BETWEEN {low} AND {high}) AS extracted,
                   count(*) FILTER (WHERE id BETWEEN {low} AND {seen}) AS skipped,
                   count(*) FILTER (WHERE id BETWEEN {max(low, seen + 1)} AND {high}) AS loaded,
                   count(*) FILTER (WHERE id <= {high}) AS stored
            FROM (SELECT order_id % 1500 AS id FROM orders_in) AS ids"""
        for n, ((low, high), seen) in enumerate(zip(_DAYS, [-1, 499, 899], strict=True))
    ),
    ["orders_in"],
)
def _flow_shop_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three days of a generated shop feed without dirt, each with orders of the day before."""
    folder = run_folder(spark, "shop_days")
    ids = inputs.orders(spark, sf_dir).select("order_id")
    rows = []
    for day, (low, high) in enumerate(_DAYS):
        batch = ids.where((F.col("order_id") % 1500).between(low, high))
        feed = gen_shop_orders(batch, batch=day, dirt=CLEAN)
        result = shop.ecommerce(spark, feed, f"{folder}/store", f"{folder}/stage-{day}")
        summary = result.summary.head()
        rows.append(
            (day, summary.rows_extracted, result.skipped, summary.rows_loaded, result.clean.count())
        )
    names = "day BIGINT, extracted BIGINT, skipped BIGINT, loaded BIGINT, stored BIGINT"
    return spark.createDataFrame(rows, names)


@query(
    "report_category_clean",
    f"""SELECT product_category, count(*) AS orders,
               CAST(sum(amount_clean) AS DOUBLE) AS total_revenue
        FROM {_SHOP_CLEAN_SQL} AS clean GROUP BY product_category ORDER BY total_revenue DESC""",
    ["ecommerce_raw"],
)
def _report_category_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shop(spark, sf_dir).report
