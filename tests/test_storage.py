"""Readers, writers, catalog tables, the file ledger and streams."""

import datetime as dt
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quillsift.functions import clean_text
from quillsift.operators.audit import Run, audit_columns
from quillsift.operators.ordering import union_ragged
from quillsift.operators.projections import map_column, project_ordered
from quillsift.operators.quality import quantity_price_rules
from quillsift.schemas import DOUBLE, INT, SALES_RAW, TEXT, schema
from quillsift.sources import readers, snapshots, tables, writers
from quillsift.streaming import file_stream, ledger

RUN1 = Run("run-1", dt.datetime(2026, 1, 1, 8))
RUN2 = Run("run-2", dt.datetime(2026, 1, 2, 8))

PEOPLE = schema(name=TEXT, salary=DOUBLE, join_date=TEXT)


def put(spark, path, text):
    """Write one text file at exactly this path."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(text.encode()))
    out.close()


def test_csv_options(spark, folder):
    put(spark, f"{folder}/a.csv", 'name|salary|join_date\nAnn|5.5|2024-01-15\nnone||x\n""|7|\n  |N/A|2024-2-3\n')
    df = readers.read_csv(
        spark, f"{folder}/a.csv", PEOPLE, sep="|", na_values=["none"], parse_dates={"join_date": "yyyy-M-d"}
    )
    assert [tuple(r) for r in df.collect()] == [
        ("Ann", 5.5, dt.date(2024, 1, 15)),
        (None, None, None),
        (None, 7.0, None),
        (None, None, dt.date(2024, 2, 3)),
    ]
    assert readers.read_csv(spark, f"{folder}/a.csv", PEOPLE, sep="|", usecols=["salary"]).columns == ["salary"]


def test_csv_header_must_fit(spark, folder):
    put(spark, f"{folder}/a.csv", "salary,name,join_date\n1,Ann,x\n")
    with pytest.raises(Exception, match="header does not conform"):
        readers.read_csv(spark, f"{folder}/a.csv", PEOPLE).collect()


def test_missing_file_is_empty(spark, folder):
    empty = readers.read_csv_optional(spark, f"{folder}/none.csv", PEOPLE)
    assert empty.count() == 0 and empty.schema == PEOPLE
    with pytest.raises(PySparkException):
        readers.read_csv(spark, f"{folder}/none.csv", PEOPLE)


def test_json_documents(spark, folder):
    record = schema(id=INT, name=TEXT)
    put(spark, f"{folder}/a.json", '[\n {"id": 1, "name": "a"},\n {"id": 2}\n]')
    put(spark, f"{folder}/b.json", '{"count": 2,\n "data": [{"id": 1, "name": "a"}, {"id": 2}]}')
    for df in (
        readers.read_json_records(spark, f"{folder}/a.json", record),
        readers.read_json_nested(spark, f"{folder}/b.json", record),
    ):
        assert [tuple(r) for r in df.collect()] == [(1, "a"), (2, None)]


def test_literal_rows_both_ways(spark):
    record = schema(name=TEXT, age=INT)
    by_row = readers.rows_to_df(spark, [{"name": "a", "age": 1}, {"name": "b"}], record)
    by_column = readers.rows_to_df(spark, {"age": [1, None], "name": ["a", "b"]}, record)
    assert by_row.collect() == by_column.collect()


def test_many_files_and_inventory(spark, folder):
    put(spark, f"{folder}/p1.csv", "name,salary,join_date\na,1,x\n")
    put(spark, f"{folder}/p2.csv", "name,salary,join_date\nb,2,y\nc,3,z\n")
    got = readers.read_many(spark, f"{folder}/p*.csv", PEOPLE)
    counts = {r.source_file: r["count"] for r in got.groupBy("source_file").count().collect()}
    assert counts == {"p1.csv": 1, "p2.csv": 2}
    files = {r.file_name: r for r in readers.file_inventory(spark, folder).collect()}
    assert files["p1.csv"].format == "csv"
    assert files["p1.csv"].size_kb == pytest.approx(len("name,salary,join_date\na,1,x\n") / 1024)


def test_catalog_tables(spark, folder):
    record = schema(id=INT, name=TEXT)
    tables.drop_table(spark, "kept")
    tables.ensure_table(spark, "kept", record, f"{folder}/kept")
    writers.insert_rows(spark, "kept", {"name": "a", "id": 1})
    tables.ensure_table(spark, "kept", record, f"{folder}/kept")
    assert tables.read_table(spark, "kept").count() == 1
    assert "kept" in [r.tableName for r in tables.catalog_tables(spark).collect()]
    columns = [tuple(r)[:2] for r in tables.catalog_columns(spark, "kept").collect()]
    assert columns == [("id", "int"), ("name", "string")]
    with pytest.raises(PySparkException):
        writers.save_table(spark.range(1), "kept", "fail")
    tables.drop_table(spark, "kept")
    tables.drop_table(spark, "kept")
    assert not spark.catalog.tableExists("kept")


def test_parameters_are_values(spark):
    df = spark.createDataFrame([("x' OR '1'='1",), ("y",)], "d STRING")
    query = "SELECT * FROM {t} WHERE d = :d"
    assert tables.sql_params_named(spark, query, {"d": "x' OR '1'='1"}, t=df).count() == 1
    assert tables.sql_params_named(spark, query, {"d": "' OR TRUE --"}, t=df).count() == 0


def test_ragged_union_and_missing_target_column(spark):
    a = spark.createDataFrame([(1, "x")], "i INT, a STRING")
    b = spark.createDataFrame([(2, "y")], "i INT, b STRING")
    rows = {r.i: (r.a, r.b) for r in union_ragged(a, b).collect()}
    assert rows == {1: ("x", None), 2: (None, "y")}
    with pytest.raises(PySparkException):
        project_ordered(a, ["i", "b"]).collect()


def test_column_functions_and_pandas_udf(spark):
    @F.pandas_udf("string")
    def title(values: pd.Series) -> pd.Series:
        return values.str.title()

    df = spark.createDataFrame([("  ann LEE ",)], "name STRING")
    cleaned = map_column(df, "name", "name", clean_text)
    assert map_column(cleaned, "name", "shown", title).head().shown == "Ann Lee"


def test_audit_values_are_fixed_once(spark):
    stamped = audit_columns(spark.range(1000, numPartitions=8), Run.start(), "f.csv")
    assert stamped.select("run_id", "loaded_at", "source_file").distinct().count() == 1


HEADER = "order_id,customer,product,quantity,unit_price,order_date\n"


def feed(start, count, quantity=1):
    return HEADER + "".join(
        f"{i},ann,lamp,{quantity if i % 2 else -1},2.50,2024-01-15\n" for i in range(start, start + count)
    )


def test_ledger_skips_loaded_files(spark, folder):
    put(spark, f"{folder}/in/2024-01-01.csv", feed(1, 100))
    arguments = (SALES_RAW, f"{folder}/table", f"{folder}/ledger")
    first = ledger.file_ledger(spark, f"{folder}/in", *arguments, RUN1)
    assert [(r.file_name, r.status, r.rows_loaded) for r in first.collect()] == [
        ("2024-01-01.csv", "success", 100)
    ]
    put(spark, f"{folder}/in/b.csv", feed(101, 50))
    put(spark, f"{folder}/in/empty.csv", HEADER)
    second = ledger.file_ledger(spark, f"{folder}/in", *arguments, RUN2)
    assert {(r.file_name, r.rows_loaded) for r in second.collect()} == {("b.csv", 50), ("empty.csv", 0)}
    assert ledger.file_ledger(spark, f"{folder}/in", *arguments, RUN2).count() == 0
    for name in ("c", "d", "e"):
        put(spark, f"{folder}/in/{name}.csv", feed(1, 2))
    third = ledger.file_ledger(spark, f"{folder}/in", *arguments, RUN2, files_per_batch=2)
    assert third.count() == 3
    loaded = ledger.read_loaded(spark, f"{folder}/table", SALES_RAW)
    assert loaded.count() == 156
    names = {r.source_file for r in loaded.select("source_file").distinct().collect()}
    assert names == {"2024-01-01.csv", "b.csv", "c.csv", "d.csv", "e.csv"}


def test_crash_before_the_ledger_entry_loads_once(spark, folder):
    put(spark, f"{folder}/in/a.csv", feed(1, 10))
    table = f"{folder}/table"
    ledger.file_ledger(spark, f"{folder}/in", SALES_RAW, table, f"{folder}/lost", RUN1)
    ledger.file_ledger(spark, f"{folder}/in", SALES_RAW, table, f"{folder}/ledger", RUN1)
    assert ledger.read_loaded(spark, table, SALES_RAW).count() == 10


ODD_NAMES = ["x/a.csv", "y/a.csv", "jan 2024.csv", "x[1].csv", "50%.csv", "a+b.csv", "{q}.csv"]


def test_ledger_takes_any_file_name(spark, folder):
    """Names alike in two folders, and names with blanks and signs that mean something in paths."""
    for i, name in enumerate(ODD_NAMES):
        put(spark, f"{folder}/in/{name}", feed(10 * i, i + 1))
    arguments = (SALES_RAW, f"{folder}/t", f"{folder}/l")
    first = ledger.file_ledger(spark, f"{folder}/in", *arguments, RUN1).collect()
    want = sorted((n.rsplit("/", 1)[-1], i + 1) for i, n in enumerate(ODD_NAMES))
    assert sorted((r.file_name, r.rows_loaded) for r in first) == want
    loaded = ledger.read_loaded(spark, f"{folder}/t", SALES_RAW)
    assert loaded.count() == sum(range(len(ODD_NAMES) + 1))
    assert {r.source_file for r in loaded.collect()} == {n for n, _ in want}
    assert ledger.file_ledger(spark, f"{folder}/in", *arguments, RUN2).count() == 0


def test_file_of_a_loaded_name_elsewhere_is_loaded(spark, folder):
    arguments = (SALES_RAW, f"{folder}/t", f"{folder}/l")
    for place in ("p", "q"):
        put(spark, f"{folder}/{place}/x.csv", feed(1, 3))
        assert ledger.file_ledger(spark, f"{folder}/{place}", *arguments, RUN1).count() == 1
    assert ledger.read_loaded(spark, f"{folder}/t", SALES_RAW).count() == 6


def test_stream_keeps_files_of_one_name(spark, folder):
    for place in ("a", "b"):
        put(spark, f"{folder}/in/{place}/x.csv", feed(1, 3))
    arguments = (f"{folder}/in/*", SALES_RAW, f"{folder}/table", f"{folder}/checkpoint", 1)
    file_stream.file_ledger_stream(spark, *arguments)
    assert ledger.read_loaded(spark, f"{folder}/table", SALES_RAW).count() == 6


def test_blank_text_is_missing_however_it_is_read(spark, folder):
    put(spark, f"{folder}/in/a.csv", HEADER + "1,   ,lamp,1,2.50,2024-01-15\n")
    assert readers.read_many(spark, f"{folder}/in", SALES_RAW).head().customer is None
    file_stream.file_ledger_stream(
        spark, f"{folder}/in", SALES_RAW, f"{folder}/table", f"{folder}/checkpoint"
    )
    assert ledger.read_loaded(spark, f"{folder}/table", SALES_RAW).head().customer is None


def test_snapshots_can_be_retired(spark, folder):
    for i in range(4):
        snapshots.write_snapshot(spark.range(i + 1), f"{folder}/s", keep=2)
    assert snapshots.read_snapshot(spark, f"{folder}/s", spark.range(1).schema).count() == 4
    assert not snapshots.path_exists(spark, f"{folder}/s/version=000002")
    assert snapshots.path_exists(spark, f"{folder}/s/version=000003")


def test_stream_loads_each_file_once(spark, folder):
    put(spark, f"{folder}/in/a.csv", feed(1, 10))
    put(spark, f"{folder}/in/b.csv", feed(11, 20))
    arguments = (f"{folder}/in", SALES_RAW, f"{folder}/table", f"{folder}/checkpoint", 1)
    file_stream.file_ledger_stream(spark, *arguments)
    file_stream.file_ledger_stream(spark, *arguments)
    put(spark, f"{folder}/in/c.csv", feed(31, 5))
    file_stream.file_ledger_stream(spark, *arguments)
    loaded = ledger.read_loaded(spark, f"{folder}/table", SALES_RAW)
    counts = {r.source_file: r["count"] for r in loaded.groupBy("source_file").count().collect()}
    assert counts == {"a.csv": 10, "b.csv": 20, "c.csv": 5}


def test_chunked_load_counts(spark, folder):
    for i in range(4):
        put(spark, f"{folder}/in/{i}.csv", feed(50 * i, 50))
    loaded = file_stream.chunked_load(
        spark, f"{folder}/in", SALES_RAW, quantity_price_rules(), f"{folder}/table",
        f"{folder}/checkpoint", 1,
    )
    counts = file_stream.chunk_counts(loaded).head()
    assert (counts.chunks, counts.valid_rows, counts.rejected_rows) == (4, 100, 100)
    bad = loaded.where("row_status = 'rejected'").head()
    assert bad.failed_rules == ["quantity is not positive"]
    assert bad.unit_price == Decimal("2.50")


def test_rejects_are_computed_once(spark, folder):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(100).selectExpr("id % 10 AS id").mapInArrow(counted, "id LONG")
    for load_id in (None, None, "other"):
        before = seen.value
        assert snapshots.append_distinct(spark, f"{folder}/rejected", rows, load_id) == 10
        assert seen.value == before + 100
    stored = snapshots.read_distinct(spark, f"{folder}/rejected", rows.schema).collect()
    # The second load is the first one again.
    assert sorted((r.id, r.copies) for r in stored) == [(i, 20) for i in range(10)]
