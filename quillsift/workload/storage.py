"""Sources and sinks: whole tables are written in a format and read back."""

from __future__ import annotations

import uuid
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsift.operators.ordering import union_ragged
from quillsift.schemas import BIGINT, DATE, INT, MONEY, TEXT, schema
from quillsift.session import run_folder
from quillsift.sources import readers, tables, writers
from quillsift.sources.generate import (
    CUSTOMERS,
    GOODS,
    KINDS,
    LANDS,
    PAYMENTS,
    PRODUCTS,
    SHOPPERS,
    STATES,
    Dirt,
    gen_dirty_orders,
    gen_shop_orders,
)
from quillsift.sources.snapshots import path_exists
from quillsift.workload import inputs
from quillsift.workload.registry import query

ORDER_TYPED = schema(
    order_id=BIGINT,
    customer_id=BIGINT,
    status=TEXT,
    amount=MONEY,
    order_date=DATE,
    priority=TEXT,
)
ORDER_TEXT = schema(**{f.name: TEXT if f.dataType == DATE else f.dataType for f in ORDER_TYPED})

_ORDERS_SQL = """SELECT order_id, customer_id, status, CAST(amount AS DOUBLE) AS amount,
                        CAST(order_date AS VARCHAR) AS order_date, priority FROM orders_in"""


@query(
    "rows_to_df",
    """SELECT priority, weight, count(*) AS orders FROM orders_in
       LEFT JOIN (VALUES ('1-URGENT', 5), ('2-HIGH', 3), ('5-LOW', 1)) AS w(level, weight)
         ON priority = level
       GROUP BY priority, weight""",
    ["orders_in"],
)
def _rows_to_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A literal lookup given by columns, applied to all orders; some levels have no weight."""
    weights = readers.rows_to_df(
        spark,
        {"priority": ["1-URGENT", "2-HIGH", "5-LOW"], "weight": [5, 3, 1]},
        schema(priority=TEXT, weight=INT),
    )
    joined = inputs.orders(spark, sf_dir).join(weights, "priority", "left")
    return joined.groupBy("priority", "weight").agg(F.count("*").alias("orders"))


@query(
    "read_csv",
    """SELECT order_id, nullif(status, 'P') AS status, CAST(order_date AS VARCHAR) AS order_date
       FROM orders_in""",
    ["orders_in"],
)
def _read_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipe-separated; three columns, a missing-value spelling and a parsed date."""
    path = run_folder(spark, "read_csv")
    writers.write_csv(inputs.orders(spark, sf_dir), path, sep="|")
    return readers.read_csv(
        spark,
        path,
        ORDER_TEXT,
        sep="|",
        usecols=["order_id", "status", "order_date"],
        na_values=["P"],
        parse_dates={"order_date": "yyyy-MM-dd"},
    )


# One line in eleven lacks a field, one has a field too many, and one an amount that is no number.
_LINES_SQL = """(
    SELECT order_id, status, amount, order_id || ',' || customer_id || ',' || status
           || CASE WHEN order_id % 11 = 1 THEN ''
                   WHEN order_id % 11 = 3 THEN ',' || CAST(amount AS VARCHAR) || ',LOST'
                   WHEN order_id % 11 = 6 THEN ',n/a'
                   ELSE ',' || CAST(amount AS VARCHAR) END AS line,
           order_id % 11 IN (1, 3, 6) AS broken
    FROM orders_in)"""


def _order_lines(orders: DataFrame) -> DataFrame:
    rest = F.col("order_id") % 11
    amount = F.col("amount").cast("string")
    end = F.when(rest == 1, F.array()).when(rest == 3, F.array(amount, F.lit("LOST")))
    end = end.when(rest == 6, F.array(F.lit("n/a"))).otherwise(F.array(amount))
    start = F.concat_ws(",", "order_id", "customer_id", "status")
    return orders.select(F.concat_ws(",", start, end).alias("value"))


LINE_FIELDS = schema(order_id=BIGINT, customer_id=BIGINT, status=TEXT, amount=MONEY)


@query(
    "read_csv_checked",
    f"""SELECT CASE WHEN NOT broken THEN order_id END AS order_id,
               CASE WHEN NOT broken THEN status END AS status,
               CASE WHEN NOT broken THEN CAST(amount AS DOUBLE) END AS amount,
               CASE WHEN broken THEN line END AS raw_line,
               CASE WHEN broken THEN 'line does not fit the schema' END AS reject_reason
        FROM {_LINES_SQL} AS written""",
    ["orders_in"],
)
def _read_csv_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of a feed, ragged and unparsable ones with their text and the reason."""
    path = run_folder(spark, "read_csv_checked")
    _order_lines(inputs.orders(spark, sf_dir)).write.text(path)
    rows = readers.read_csv_checked(spark, path, LINE_FIELDS, header=False)
    sound, broken = readers.split_broken(rows)
    kept = broken.select(F.col("broken_line").alias("raw_line"), "reject_reason")
    return union_ragged(sound.select("order_id", "status", "amount"), kept)


@query("read_csv_optional", _ORDERS_SQL, ["orders_in"])
def _read_csv_optional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file that is there, and one that is not."""
    path = run_folder(spark, "read_csv_optional")
    writers.write_csv(inputs.orders(spark, sf_dir), f"{path}/present")
    present = readers.read_csv_optional(spark, f"{path}/present", ORDER_TEXT)
    return present.unionByName(readers.read_csv_optional(spark, f"{path}/absent", ORDER_TEXT))


@query(
    "write_csv",
    """SELECT employee_id, name, department, CAST(salary AS DOUBLE) AS salary FROM employees_in""",
    ["employees_in"],
)
def _write_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_folder(spark, "write_csv")
    staff = inputs.employees(spark, sf_dir).select("employee_id", "name", "department", "salary")
    writers.write_csv(staff, path)
    return readers.read_csv(spark, path, staff.schema)


def _json_documents(orders: DataFrame, wrap: bool) -> DataFrame:
    """Each order as a JSON document of two records: the order, and its event of creation."""
    order = F.struct("order_id", "customer_id", "status")
    event = F.struct("order_id", "customer_id", F.lit("created").alias("status"))
    data = F.array(order, event).alias("data")
    return orders.select(F.to_json(F.struct(data) if wrap else data).alias("value"))


_RECORDS_SQL = """SELECT order_id, customer_id, status FROM orders_in
                  UNION ALL SELECT order_id, customer_id, 'created' FROM orders_in"""


_RECORD = schema(order_id=BIGINT, customer_id=BIGINT, status=TEXT)


@query("read_json_records", _RECORDS_SQL, ["orders_in"])
def _read_json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_folder(spark, "read_json_records")
    _json_documents(inputs.orders(spark, sf_dir), wrap=False).write.text(path)
    return readers.read_json_records(spark, path, _RECORD, lines=True)


@query("read_json_nested", _RECORDS_SQL, ["orders_in"])
def _read_json_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_folder(spark, "read_json_nested")
    _json_documents(inputs.orders(spark, sf_dir), wrap=True).write.text(path)
    return readers.read_json_nested(spark, path, _RECORD, lines=True)


@query("write_json", _ORDERS_SQL, ["orders_in"])
def _write_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_folder(spark, "write_json")
    writers.write_json(inputs.orders(spark, sf_dir), path)
    return readers.read_json_records(spark, path, ORDER_TYPED, lines=True)


@query("write_parquet", _ORDERS_SQL, ["orders_in"])
def _write_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_folder(spark, "write_parquet")
    writers.write_parquet(inputs.orders(spark, sf_dir), path)
    return readers.read_parquet(spark, path)


@query("read_parquet", "SELECT l_orderkey, l_extendedprice FROM lineitem")
def _read_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/lineitem.parquet"
    return readers.read_parquet(spark, path, ["l_orderkey", "l_extendedprice"])


@query(
    "read_many",
    """SELECT status, count(*) AS row_count, CAST(sum(amount) AS DOUBLE) AS amount,
              TRUE AS has_source FROM orders_in GROUP BY status""",
    ["orders_in"],
)
def _read_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many files in two folders, found by a pattern."""
    path = run_folder(spark, "read_many")
    orders = inputs.orders(spark, sf_dir)
    split = F.col("order_date") < "1997-01-01"
    writers.write_csv(orders.where(split), f"{path}/part_old")
    writers.write_csv(orders.where(~split), f"{path}/part_new")
    stacked = readers.read_many(spark, f"{path}/part_*", ORDER_TEXT)
    return stacked.groupBy("status").agg(
        F.count("*").alias("row_count"),
        F.sum("amount").alias("amount"),
        F.every(F.length("source_file") > 0).alias("has_source"),
    )


@query(
    "file_inventory",
    """SELECT format, TRUE AS has_files, TRUE AS has_size, format = 'parquet' AS is_smallest
       FROM (VALUES ('csv'), ('json'), ('parquet')) AS formats(format)""",
)
def _file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table in three formats. Sizes depend on the writer, their order does not."""
    path = run_folder(spark, "file_inventory")
    line = inputs.lines(spark, sf_dir)
    writers.write_csv(line, f"{path}/csv")
    writers.write_json(line, f"{path}/json")
    writers.write_parquet(line, f"{path}/parquet")
    files = readers.file_inventory(spark, [f"{path}/csv", f"{path}/json", f"{path}/parquet"])
    sizes = files.groupBy("format").agg(
        F.count("*").alias("files"), F.sum("size_kb").alias("size_kb")
    )
    least = sizes.agg(F.min("size_kb")).scalar()
    return sizes.select(
        "format",
        (F.col("files") > 0).alias("has_files"),
        (F.col("size_kb") > 0).alias("has_size"),
        (F.col("size_kb") == least).alias("is_smallest"),
    )


def _fresh_name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex[:12]}"


@query("save_table", f"{_ORDERS_SQL} UNION ALL {_ORDERS_SQL}", ["orders_in"])
def _save_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create, replace and append."""
    name, path = _fresh_name("saved"), run_folder(spark, "save_table")
    orders = inputs.orders(spark, sf_dir)
    writers.save_table(orders.limit(0), name, "fail", path)
    writers.save_table(orders, name, "replace", path)
    writers.save_table(orders, name, "append", path)
    return tables.read_table(spark, name)


@query(
    "insert_rows",
    f"""SELECT order_id, customer_id, status, amount, order_date, priority
        FROM ({_ORDERS_SQL}) AS o
        UNION ALL SELECT -1, -1, 'F', 10.5, '2024-01-15', '1-URGENT'
        UNION ALL SELECT -2, NULL, 'O', 20.25, '2024-01-16', NULL
        UNION ALL SELECT -3, -3, 'O', NULL, NULL, NULL""",
    ["orders_in"],
)
def _insert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row, several rows, and a whole table."""
    name = _fresh_name("inserted")
    tables.ensure_table(spark, name, ORDER_TEXT, run_folder(spark, "insert_rows"))
    first = {
        "order_id": -1,
        "customer_id": -1,
        "status": "F",
        "amount": Decimal("10.50"),
        "order_date": "2024-01-15",
        "priority": "1-URGENT",
    }
    more = [
        {"order_id": -2, "status": "O", "amount": Decimal("20.25"), "order_date": "2024-01-16"},
        {"order_id": -3, "customer_id": -3, "status": "O"},
    ]
    writers.insert_rows(spark, name, first)
    writers.insert_rows(spark, name, more)
    orders = inputs.orders(spark, sf_dir)
    writers.insert_rows(
        spark, name, orders.withColumn("order_date", F.col("order_date").cast("string"))
    )
    return tables.read_table(spark, name)


@query(
    "ensure_table",
    "SELECT status, count(*) AS row_count FROM orders_in GROUP BY status",
    ["orders_in"],
)
def _ensure_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Created once, filled, and left alone by the second call."""
    name, path = _fresh_name("ensured"), run_folder(spark, "ensure_table")
    tables.ensure_table(spark, name, ORDER_TYPED, path)
    writers.insert_rows(spark, name, inputs.orders(spark, sf_dir))
    again = tables.ensure_table(spark, name, ORDER_TYPED, path)
    return again.groupBy("status").agg(F.count("*").alias("row_count"))


@query(
    "catalog_columns",
    """SELECT * FROM (VALUES ('order_id', 'bigint'), ('customer_id', 'bigint'),
           ('status', 'string'), ('amount', 'decimal(12,2)'), ('order_date', 'date'),
           ('priority', 'string')) AS c(column_name, column_type)""",
)
def _catalog_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _fresh_name("columns")
    writers.save_table(inputs.orders(spark, sf_dir), name, "fail", run_folder(spark, name))
    found = tables.catalog_columns(spark, name).drop("nullable")
    tables.drop_table(spark, name)
    return found


@query(
    "catalog_tables",
    """SELECT 'kept' AS label, count(*) AS row_count FROM orders_in WHERE status = 'F'
       UNION ALL SELECT 'other', count(*) FROM orders_in WHERE status <> 'F'""",
    ["orders_in"],
)
def _catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tables are stored and one is dropped: the catalog lists the other two."""
    prefix, orders = _fresh_name("listed"), inputs.orders(spark, sf_dir)
    rules = {"kept": "status = 'F'", "other": "status <> 'F'", "dropped": "TRUE"}
    for label, rule in rules.items():
        name = f"{prefix}_{label}"
        writers.save_table(orders.where(rule), name, "fail", run_folder(spark, name))
    tables.drop_table(spark, f"{prefix}_dropped")
    found = tables.catalog_tables(spark).where(F.col("tableName").startswith(prefix)).collect()
    parts = [
        spark.table(r.tableName).agg(
            F.lit(r.tableName.rsplit("_", 1)[1]).alias("label"), F.count("*").alias("row_count")
        )
        for r in found
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query(
    "drop_table",
    """SELECT status, count(*) AS row_count, FALSE AS still_there, TRUE AS files_left
       FROM orders_in GROUP BY status""",
    ["orders_in"],
)
def _drop_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table dropped twice leaves the catalog; files at a path of their own stay."""
    name, path = _fresh_name("gone"), run_folder(spark, "drop_table")
    writers.save_table(inputs.orders(spark, sf_dir), name, "fail", path)
    tables.drop_table(spark, name)
    tables.drop_table(spark, name)
    left = spark.read.parquet(path)
    return left.groupBy("status").agg(
        F.count("*").alias("row_count"),
        F.lit(spark.catalog.tableExists(name)).alias("still_there"),
        F.lit(path_exists(spark, path)).alias("files_left"),
    )


@query("read_table", _ORDERS_SQL, ["orders_in"])
def _read_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _fresh_name("stored")
    writers.save_table(
        inputs.orders(spark, sf_dir), name, "fail", run_folder(spark, "read_table")
    )
    return tables.read_table(spark, name)


@query(
    "sql_query",
    """SELECT department, count(*) AS headcount FROM employees_in
       WHERE salary > 50000 GROUP BY department""",
    ["employees_in"],
)
def _sql_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.sql_query(
        spark,
        """SELECT department, count(*) AS headcount FROM {staff}
           WHERE salary > 50000 GROUP BY department""",
        staff=inputs.employees(spark, sf_dir),
    )


@query(
    "sql_params_named",
    """SELECT employee_id, name FROM employees_in
       WHERE department = 'BUILDING' AND salary > 50000""",
    ["employees_in"],
)
def _sql_params_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.sql_params_named(
        spark,
        "SELECT employee_id, name FROM {staff} WHERE department = :dept AND salary > :low",
        {"dept": "BUILDING", "low": 50000},
        staff=inputs.employees(spark, sf_dir),
    )


@query(
    "sql_params_positional",
    """SELECT employee_id, name FROM employees_in
       WHERE department = 'MACHINERY' AND salary > 70000""",
    ["employees_in"],
)
def _sql_params_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.sql_params_positional(
        spark,
        "SELECT employee_id, name FROM {staff} WHERE department = ? AND salary > ?",
        ["MACHINERY", 70000],
        staff=inputs.employees(spark, sf_dir),
    )


def _draw_sql(salt: int, sides: int) -> str:
    start = f"((order_id + {salt * 7919}) % 2147483647)"
    once = f"(({start} * 48271) % 2147483647)"
    return f"((({once} * 48271) % 2147483647) % {sides})"


def _pick_sql(values: list[str], number: str) -> str:
    items = ", ".join(f"'{v}'" for v in values)
    return f"([{items}])[{number} + 1]"


_NAME_SQL = _pick_sql(CUSTOMERS, _draw_sql(1, len(CUSTOMERS)))
_DAY_SQL = f"(DATE '2024-01-01' + CAST({_draw_sql(2, 366)} AS INTEGER))"


@query(
    "gen_dirty_orders",
    f"""SELECT order_id,
               CASE WHEN {_draw_sql(5, 3)} = 0 THEN '  ' || upper({_NAME_SQL}) || ' '
                    ELSE {_NAME_SQL} END AS customer,
               {_pick_sql(PRODUCTS, _draw_sql(6, len(PRODUCTS)))} AS product,
               CAST(CASE {_draw_sql(4, 10)} WHEN 0 THEN NULL WHEN 1 THEN -1
                    ELSE {_draw_sql(4, 10)} - 1 END AS DOUBLE) AS quantity,
               CASE WHEN {_draw_sql(7, 7)} = 0 THEN NULL
                    ELSE ({_draw_sql(8, 100000)} + 100) / 100.0::DOUBLE END AS unit_price,
               CASE {_draw_sql(3, 3)} WHEN 0 THEN strftime({_DAY_SQL}, '%Y-%m-%d')
                    WHEN 1 THEN strftime({_DAY_SQL}, '%m/%d/%Y')
                    ELSE strftime({_DAY_SQL}, '%d-%m-%Y') END AS order_date
        FROM orders_in""",
    ["orders_in"],
)
def _gen_dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gen_dirty_orders(inputs.orders(spark, sf_dir))


def _cased_sql(value: str, salt: int) -> str:
    upper, lower, padded = (Dirt().odd_case * i // 3 for i in (1, 2, 3))
    kind = _draw_sql(salt, 1000)
    return f"""CASE WHEN {kind} < {upper} THEN upper({value}) WHEN {kind} < {lower} THEN lower({value})
                    WHEN {kind} < {padded} THEN '  ' || {value} || ' ' ELSE {value} END"""


def _shop_sql(batch: int) -> str:
    """The rows of ``gen_shop_orders`` for the order ids of ``orders_in``."""
    d = Dirt()
    number, cents = f"({_draw_sql(1, 9)} + 1)", f"({_draw_sql(2, 200_000)} + 100)"
    day = f"(DATE '2022-01-01' + CAST({_draw_sql(3, 1461)} AS INTEGER))"
    shopper = _pick_sql(SHOPPERS, _draw_sql(4, len(SHOPPERS)))
    spelling, sign = _draw_sql(5, 1000), _draw_sql(6, 1000)
    price, total = f"CAST({cents} / 100.0 AS DECIMAL(12,2))", f"CAST({cents} * {number} / 100.0 AS DECIMAL(12,2))"
    return f"""
        SELECT order_id, {_cased_sql(shopper, 7)} AS customer_name,
               CASE WHEN {_draw_sql(8, 1000)} >= {d.no_email}
                    THEN lower(replace({shopper}, ' ', '.')) || '@example.org' END AS customer_email,
               CASE WHEN {spelling} < {d.us_dates} THEN strftime({day}, '%m/%d/%Y')
                    WHEN {spelling} < {d.us_dates + d.eu_dates} THEN strftime({day}, '%d-%m-%Y')
                    ELSE strftime({day}, '%Y-%m-%d') END AS order_date,
               {_cased_sql(_pick_sql(KINDS, _draw_sql(9, len(KINDS))), 10)} AS product_category,
               {_pick_sql(GOODS, _draw_sql(11, len(GOODS)))} AS product_name,
               {number} || CASE WHEN {_draw_sql(12, 1000)} < {d.units} THEN ' units' ELSE '' END
                   AS quantity,
               CAST(CASE WHEN {sign} < {d.negative_price} THEN -{price}
                         WHEN {sign} < {d.negative_price + d.zero_price} THEN 0
                         ELSE {price} END AS DOUBLE) AS unit_price,
               CASE WHEN {_draw_sql(13, 1000)} < {d.dollars}
                    THEN '$' || format('{{:,.2f}}', CAST({total} AS DOUBLE))
                    ELSE CAST({total} AS VARCHAR) END AS amount,
               CASE WHEN {_draw_sql(14, 1000)} >= {d.no_discount}
                    THEN CAST({_draw_sql(15, 30)} AS DOUBLE) END AS discount_pct,
               CASE WHEN {_draw_sql(16, 1000)} >= {d.no_coupon} THEN 'SAVE10' END AS coupon_code,
               {_cased_sql(_pick_sql(PAYMENTS, _draw_sql(17, len(PAYMENTS))), 18)} AS payment_method,
               CASE WHEN {_draw_sql(19, 1000)} >= {d.no_country}
                    THEN {_cased_sql(_pick_sql(LANDS, _draw_sql(20, len(LANDS))), 21)} END
                   AS shipping_country,
               {_pick_sql(STATES, _draw_sql(500 + batch, len(STATES)))} AS order_status
        FROM orders_in
        JOIN (VALUES (0), (1)) AS v(copy)
          ON copy = 0 OR {_draw_sql(100 + batch, 1000)} < {d.copies}"""


@query("gen_shop_orders", f"{_shop_sql(0)} UNION ALL {_shop_sql(1)}", ["orders_in"])
def _gen_shop_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of the same ids: the same orders, in other states and with other copies."""
    ids = inputs.orders(spark, sf_dir).select("order_id")
    return gen_shop_orders(ids).unionByName(gen_shop_orders(ids, batch=1))


# --- JSON documents ----------------------------------------------------------------------------

# Of 97 records one is no JSON, in the later documents only, and one has text in a column of numbers.
_DOCUMENTS = 8
_JSON_SQL = f"""(
    SELECT order_id, customer_id, status,
           CASE WHEN order_id % 97 = 5 AND order_id % {_DOCUMENTS} >= 4
                THEN '{{{{"order_id":' || order_id || ',"customer_id":oops,"status":"' || status || '"}}}}'
                WHEN order_id % 97 = 6
                THEN '{{{{"order_id":' || order_id || ',"customer_id":"n/a","status":"' || status || '"}}}}'
           END AS broken
    FROM orders_in)""".replace("{{", "{").replace("}}", "}")

_CHECKED_JSON_SQL = f"""SELECT CASE WHEN broken IS NULL THEN order_id END AS order_id,
                               CASE WHEN broken IS NULL THEN customer_id END AS customer_id,
                               CASE WHEN broken IS NULL THEN status END AS status,
                               broken AS broken_line
                        FROM {_JSON_SQL} AS written"""


def _record_texts(orders: DataFrame) -> DataFrame:
    """Each order as the text of a record, in the document its id says."""
    key = F.col("order_id")
    number = F.when((key % 97 == 5) & (key % _DOCUMENTS >= 4), "oops").when(key % 97 == 6, '"n/a"')
    text = F.format_string(
        '{"order_id":%d,"customer_id":%s,"status":"%s"}',
        key,
        F.coalesce(number, F.col("customer_id").cast("string")),
        "status",
    )
    return orders.select((key % _DOCUMENTS).cast("int").alias("d"), text.alias("record"))


def _write_documents(orders: DataFrame, path: str, start: str, end: str, between: str) -> None:
    """One document per folder d=0 to d=7, its records between ``start`` and ``end``."""
    records = _record_texts(orders).groupBy("d").agg(F.collect_list("record").alias("records"))
    body = F.concat(F.lit(start), F.array_join("records", between), F.lit(end))
    records.select("d", body.alias("value")).write.partitionBy("d").text(path)


@query("read_json_array", _CHECKED_JSON_SQL, ["orders_in"])
def _read_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that are arrays of records, some of them broken."""
    path = run_folder(spark, "read_json_array")
    _write_documents(inputs.orders(spark, sf_dir), path, "[", "]", ", ")
    return readers.read_json_checked(spark, f"{path}/*", _RECORD).drop("source_file")


@query("read_json_data_array", _CHECKED_JSON_SQL, ["orders_in"])
def _read_json_data_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold their records under a key."""
    path = run_folder(spark, "read_json_data_array")
    _write_documents(
        inputs.orders(spark, sf_dir), path, '{"source": "shop", "data": [\n', "\n]}", ",\n  "
    )
    return readers.read_json_checked(spark, f"{path}/*", _RECORD, key="data").drop("source_file")


@query("read_json_split", _CHECKED_JSON_SQL, ["orders_in"])
def _read_json_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large arrays, a record a line, of which tasks read parts."""
    path = run_folder(spark, "read_json_split")
    _write_documents(inputs.orders(spark, sf_dir), path, "[\n ", "\n]\n", ",\n ")
    return readers.read_json_split(spark, f"{path}/*", _RECORD, "},\n").drop("source_file")


@query("read_json_array_strict", _RECORDS_SQL, ["orders_in"])
def _read_json_array_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Array documents, two records each, by the plain reader's default path."""
    path = run_folder(spark, "read_json_array_strict")
    orders = inputs.orders(spark, sf_dir)
    number = F.pmod("order_id", F.lit(_DOCUMENTS)).cast("int").alias("d")
    records = orders.unionByName(orders.withColumn("status", F.lit("created")))
    texts = records.select(number, F.to_json(F.struct(*_RECORD.fieldNames())).alias("record"))
    documents = texts.groupBy("d").agg(
        F.concat(F.lit("[\n"), F.array_join(F.collect_list("record"), ",\n"), F.lit("\n]")).alias("value")
    )
    documents.write.partitionBy("d").text(path)
    return readers.read_json_records(spark, f"{path}/*", _RECORD)
