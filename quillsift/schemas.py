"""Declared schemas of the supported feeds; nothing is inferred.

Columns that may hold dirty values are STRING, so that a rejected row keeps its raw text.
"""

from __future__ import annotations

from pyspark.sql import types as T

TEXT = T.StringType()
INT = T.IntegerType()
BIGINT = T.LongType()
DOUBLE = T.DoubleType()
DATE = T.DateType()
STAMP = T.TimestampNTZType()
MONEY = T.DecimalType(12, 2)
# A quantity times a price.
TOTAL = T.DecimalType(24, 2)


def schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


EMPLOYEES_RAW = schema(
    name=TEXT,
    department=TEXT,
    salary=TEXT,
)

EMPLOYEES_FULL = schema(
    employee_id=INT,
    name=TEXT,
    department=TEXT,
    salary=TEXT,
    join_date=TEXT,
    manager=TEXT,
)

EMPLOYEES_HR = schema(
    employee_id=INT,
    name=TEXT,
    department=TEXT,
    join_date=TEXT,
)

SALARIES = schema(
    employee_id=INT,
    salary=TEXT,
)

SALES_RAW = schema(
    order_id=BIGINT,
    customer=TEXT,
    product=TEXT,
    quantity=DOUBLE,
    unit_price=MONEY,
    order_date=TEXT,
)

ORDERS_RAW = schema(
    order_id=BIGINT,
    customer_id=TEXT,
    product=TEXT,
    amount=MONEY,
)

CUSTOMERS = schema(
    customer_id=BIGINT,
    name=TEXT,
    region=TEXT,
)

ORDER_AMOUNTS = schema(
    order_id=BIGINT,
    customer=TEXT,
    amount=MONEY,
)

SALES_REPORT_RAW = schema(
    order_id=TEXT,
    customer=TEXT,
    region=TEXT,
    product_category=TEXT,
    product_name=TEXT,
    quantity=TEXT,
    unit_price=TEXT,
    order_date=TEXT,
)

SALES_REPORT_CLEAN = schema(
    order_id=BIGINT,
    customer=TEXT,
    region=TEXT,
    product_category=TEXT,
    product_name=TEXT,
    quantity=INT,
    unit_price=MONEY,
    order_date=DATE,
    total_price=TOTAL,
    loaded_at=STAMP,
)

ECOMMERCE_RAW = schema(
    order_id=BIGINT,
    customer_name=TEXT,
    customer_email=TEXT,
    order_date=TEXT,
    product_category=TEXT,
    product_name=TEXT,
    quantity=TEXT,
    unit_price=MONEY,
    amount=TEXT,
    discount_pct=DOUBLE,
    coupon_code=TEXT,
    payment_method=TEXT,
    shipping_country=TEXT,
    order_status=TEXT,
)

ECOMMERCE_CLEAN = schema(
    order_id=BIGINT,
    customer_name=TEXT,
    customer_email=TEXT,
    order_date=DATE,
    product_category=TEXT,
    product_name=TEXT,
    quantity=TEXT,
    quantity_clean=INT,
    unit_price=MONEY,
    amount=TEXT,
    amount_clean=MONEY,
    discount_pct=DOUBLE,
    coupon_code=TEXT,
    payment_method=TEXT,
    shipping_country=TEXT,
    order_status=TEXT,
)

LEDGER = schema(
    file_key=TEXT,
    file_name=TEXT,
    file_path=TEXT,
    batch=TEXT,
    status=TEXT,
    loaded_at=STAMP,
    rows_loaded=BIGINT,
    rows_broken=BIGINT,
)

# Files that make up a batch, written before the batch is loaded.
LEDGER_PLAN = schema(
    batch=TEXT,
    file_key=TEXT,
    file_name=TEXT,
    file_path=TEXT,
)

CHUNKS = schema(
    batch_id=BIGINT,
    rows=BIGINT,
    valid_rows=BIGINT,
    rejected_rows=BIGINT,
)

RUN_SUMMARY = schema(
    status=TEXT,
    rows_extracted=BIGINT,
    rows_valid=BIGINT,
    rows_rejected=BIGINT,
    rows_loaded=BIGINT,
    errors=T.ArrayType(TEXT),
)
