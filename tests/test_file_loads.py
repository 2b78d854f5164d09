"""Broken lines, batches of files, and chunk logs."""

import datetime as dt

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from test_storage import HEADER, RUN1, RUN2, feed, put

from quillsift.operators.quality import quantity_price_rules
from quillsift.plans.ecommerce import ecommerce
from quillsift.schemas import DOUBLE, ECOMMERCE_RAW, INT, SALES_RAW, TEXT, schema
from quillsift.sources import generate, readers, snapshots
from quillsift.streaming import file_stream, ledger

THREE = schema(id=INT, name=TEXT, price=DOUBLE)
LINES = [
    "1,ann,2.5",
    "4,5,6,LOST",
    "7,8",
    "x,ann,2.5",
    "2,ann,cheap",
    '3,"a, b",1',
    '5,"open,1',
    "6,,",
]


def test_every_line_is_sound_or_rejected(spark, folder):
    put(spark, f"{folder}/in/a.csv", "\n".join(["id,name,price", *LINES, "", ""]))
    put(spark, f"{folder}/in/b.csv", "id,name,price\n9\n")
    rows = readers.read_csv_checked(spark, f"{folder}/in", THREE)
    sound, broken = readers.split_broken(rows)
    assert sorted(tuple(r)[:3] for r in sound.collect()) == [
        (1, "ann", 2.5), (3, "a, b", 1.0), (6, None, None)
    ]
    want = {("a.csv", x) for x in (*LINES[1:5], LINES[6])} | {("b.csv", "9")}
    assert {(r.source_file, r.broken_line) for r in broken.collect()} == want
    assert {r.reject_reason for r in broken.collect()} == {readers.BROKEN_REASON}
    # Neither counts nor single columns may depend on what is selected.
    assert (sound.count(), broken.count()) == (3, 6)
    assert rows.select("id").where("id IS NOT NULL").count() == 3
    assert rows.where("broken_line IS NOT NULL AND (id IS NOT NULL OR price IS NOT NULL)").count() == 0


def test_checked_reads_take_the_options_of_plain_ones(spark, folder):
    put(spark, f"{folder}/a.csv", "1|none|2024-1-15\n2|  |x\n3\n")
    day = schema(id=INT, name=TEXT, day=TEXT)
    rows = readers.read_csv_checked(
        spark, f"{folder}/a.csv", day, sep="|", header=False, na_values=["none"],
        parse_dates={"day": "yyyy-M-d"},
    )
    found = [tuple(r) for r in rows.orderBy("id").collect()]
    assert found == [
        (None, None, None, "3", "a.csv"),
        (1, None, dt.date(2024, 1, 15), None, "a.csv"),
        (2, None, None, None, "a.csv"),
    ]
    put(spark, f"{folder}/b.csv", "name|id|day\n")
    with pytest.raises(Exception, match="header does not conform"):
        readers.read_csv_checked(spark, f"{folder}/b.csv", day, sep="|").collect()


def test_broken_lines_of_many_files(spark, folder):
    put(spark, f"{folder}/p1.csv", "id,name,price\n" + "\n".join(LINES))
    rows = readers.read_many(spark, f"{folder}/p*.csv", THREE, keep_broken=True)
    assert rows.where("broken_line IS NOT NULL").count() == 5
    with pytest.raises(ValueError):
        readers.read_many(spark, folder, THREE, "json", keep_broken=True)


BAD = "7,ann,lamp,1,2.50\n8,ann,lamp,1,2.50,2024-01-15,LOST\n"


def test_ledger_counts_sound_and_broken_lines(spark, folder):
    put(spark, f"{folder}/in/a.csv", feed(1, 10) + BAD)
    arguments = (SALES_RAW, f"{folder}/t", f"{folder}/l")
    entry = ledger.file_ledger(spark, f"{folder}/in", *arguments, RUN1).head()
    assert (entry.rows_loaded, entry.rows_broken, entry.status) == (10, 2, "success")
    assert ledger.read_loaded(spark, f"{folder}/t", SALES_RAW).count() == 10
    broken = ledger.read_broken(spark, f"{folder}/t", SALES_RAW).collect()
    assert {r.broken_line for r in broken} == set(BAD.splitlines())


def test_many_small_files_make_few_folders(spark, folder):
    for i in range(30):
        put(spark, f"{folder}/in/{i}.csv", feed(10 * i, 2))
    arguments = (SALES_RAW, f"{folder}/t", f"{folder}/l")
    entries = ledger.file_ledger(spark, f"{folder}/in", *arguments, RUN1, files_per_batch=10)
    sizes = {r.batch: r["count"] for r in entries.groupBy("batch").count().collect()}
    assert sum(sizes.values()) == 30 and max(sizes.values()) <= 10 and len(sizes) <= 6
    assert len(snapshots._names(spark, f"{folder}/t/batch=*")) == len(sizes)
    assert ledger.read_loaded(spark, f"{folder}/t", SALES_RAW).count() == 60
    # Bounded by bytes: each file reaches the bound by itself.
    arguments = (SALES_RAW, f"{folder}/t2", f"{folder}/l2")
    entries = ledger.file_ledger(spark, f"{folder}/in", *arguments, RUN1, bytes_per_batch=1)
    assert entries.select("batch").distinct().count() == 30


def test_a_killed_batch_is_replaced_whole(spark, folder, monkeypatch):
    for i in range(6):
        put(spark, f"{folder}/in/{i}.csv", feed(10 * i, 5))
    arguments = (SALES_RAW, f"{folder}/t", f"{folder}/l")
    load, calls = ledger._load_batch, []

    def killed(*args):
        calls.append(args[1])
        if len(calls) == 2:
            # Rows of the second batch are written, and some of them twice, but not entered.
            rows = readers.read_many(
                spark, f"{folder}/in", SALES_RAW, key_column="file_key", keep_broken=True
            )
            rows.write.parquet(f"{folder}/t/batch={args[1]}")
            raise RuntimeError("killed")
        load(*args)

    monkeypatch.setattr(ledger, "_load_batch", killed)
    with pytest.raises(RuntimeError):
        ledger.file_ledger(spark, f"{folder}/in", *arguments, RUN1, files_per_batch=2)
    monkeypatch.setattr(ledger, "_load_batch", load)
    put(spark, f"{folder}/in/late.csv", feed(100, 7))
    ledger.file_ledger(spark, f"{folder}/in", *arguments, RUN2, files_per_batch=2)
    loaded = ledger.read_loaded(spark, f"{folder}/t", SALES_RAW)
    counts = {r.source_file: r["count"] for r in loaded.groupBy("source_file").count().collect()}
    assert counts == {**{f"{i}.csv": 5 for i in range(6)}, "late.csv": 7}
    entries = ledger.read_ledger(spark, f"{folder}/l")
    assert entries.count() == 7 and entries.select("file_key").distinct().count() == 7
    first = entries.where(f"batch = '{calls[0]}'").select("loaded_at").distinct().collect()
    assert [r.loaded_at for r in first] == [RUN1.loaded_at]


def test_chunks_are_logged_once(spark, folder):
    paths = dict(target=f"{folder}/t", checkpoint=f"{folder}/c", log=f"{folder}/log")
    load = lambda: file_stream.chunked_load(
        spark, f"{folder}/in", SALES_RAW, quantity_price_rules(), **paths
    )
    put(spark, f"{folder}/in/a.csv", feed(0, 50))
    load()
    put(spark, f"{folder}/in/b.csv", feed(50, 20) + BAD)
    load()
    put(spark, f"{folder}/in/c.csv", HEADER)
    load()
    loaded = load()
    rows = [tuple(r) for r in file_stream.chunk_log(spark, f"{folder}/log").orderBy("batch_id").collect()]
    assert {(r[1], r[2], r[3]) for r in rows[:2]} == {(50, 25, 25), (22, 10, 12)}
    assert rows[-1][4:] == (72, 35, 37)
    bad = loaded.where("broken_line IS NOT NULL").collect()
    assert {r.broken_line for r in bad} == set(BAD.splitlines())
    assert {tuple(r.failed_rules) for r in bad} == {(readers.BROKEN_REASON,)}
    assert {r.row_status for r in bad} == {"rejected"}


def test_stream_batches_bounded_by_bytes(spark, folder):
    for i in range(3):
        put(spark, f"{folder}/in/{i}.csv", feed(10 * i, 5))
    file_stream.file_ledger_stream(
        spark, f"{folder}/in", SALES_RAW, f"{folder}/t", f"{folder}/c", bytes_per_batch=1
    )
    assert len(snapshots._names(spark, f"{folder}/t/batch=*")) == 3
    assert ledger.read_loaded(spark, f"{folder}/t", SALES_RAW).count() == 15


RECORD = schema(id=INT, name=TEXT)


def test_broken_records_leave_the_others(spark, folder):
    put(spark, f"{folder}/in/a.json", '[{"id": 1, "name": "a},{b"},\n {"id": oops}, {"id": 3}]')
    put(spark, f"{folder}/in/b.json", '[{"id": 4, "name": {"x": [{"y": 1}, {"y": 2}]}}, {"id": "n/a"}, 7]')
    put(spark, f"{folder}/in/c.json", " \n")
    put(spark, f"{folder}/in/d.json", "[]")
    put(spark, f"{folder}/in/e.json", "no records")
    rows = readers.read_json_checked(spark, f"{folder}/in", RECORD).collect()
    sound = {(r.source_file, r.id, r.name) for r in rows if r.broken_line is None}
    # The second document is JSON as a whole, so nothing is cut; in the first one a text looks like
    # an end of a record, and only its own record suffers.
    assert ("b.json", 4, '{"x":[{"y":1},{"y":2}]}') in sound and ("a.json", 3, None) in sound
    broken = {(r.source_file, r.broken_line) for r in rows if r.broken_line is not None}
    assert {("a.json", '{"id": oops}'), ("b.json", '{"id":"n/a"}'), ("b.json", "7"), ("e.json", "no records")} <= broken
    assert all(r.id is None and r.name is None for r in rows if r.broken_line is not None)


def test_records_under_a_key_and_split(spark, folder):
    put(spark, f"{folder}/k/a.json", '{"n": 2, "data": [{"id": 1}, {"id": 2, "name": "b"}], "more": [1]}')
    put(spark, f"{folder}/k/b.json", '{"n": 2, "data": [{"id": 3}, {"id": x}]}')
    rows = readers.read_json_checked(spark, f"{folder}/k", RECORD, key="data").collect()
    assert sorted(r.id for r in rows if r.id) == [1, 2, 3]
    assert [r.broken_line for r in rows if r.broken_line] == ['{"id": x}']
    put(spark, f"{folder}/s/a.json", '[\n{"id": 1, "name": "}"},\n{"id": {}},\n{"id": 3}\n]\n')
    put(spark, f"{folder}/s/b.json", '[{"id": 9}]')
    rows = readers.read_json_split(spark, f"{folder}/s", RECORD).collect()
    assert sorted((r.id, r.name) for r in rows if r.id) == [(1, "}"), (3, None), (9, None)]
    assert [r.broken_line for r in rows if r.broken_line] == ['{"id": {}}']
    with pytest.raises(ValueError):
        readers.read_json_split(spark, f"{folder}/s", RECORD, "\n")


def test_shop_recipe(spark, folder):
    ids = spark.range(1, 20_001).withColumnRenamed("id", "order_id")
    feed = generate.gen_shop_orders(ids)
    assert feed.schema.fieldNames() == ECOMMERCE_RAW.fieldNames()
    again = generate.gen_shop_orders(ids.repartition(7))
    assert feed.exceptAll(again).count() == 0
    n = feed.count()
    assert 0.02 < n / 20_000 - 1 < 0.04
    rates = feed.selectExpr(
        "avg(int(customer_email IS NULL))", "avg(int(shipping_country IS NULL))",
        "avg(int(unit_price < 0))", "avg(int(unit_price = 0))", "avg(int(amount LIKE '$%'))",
        "avg(int(quantity LIKE '% units'))", "avg(int(order_date LIKE '____-%'))",
    ).head()
    want = (0.07, 0.03, 0.01, 0.005, 0.1, 0.05, 0.4)
    assert all(abs(a - b) < 0.25 * b for a, b in zip(rates, want, strict=True))
    other = generate.gen_shop_orders(ids, batch=1)
    assert other.drop("order_status").distinct().exceptAll(feed.drop("order_status").distinct()).count() == 0
    assert generate.gen_shop_orders(ids, seed=1).exceptAll(feed).count() > 15_000


def test_three_days_of_the_shop(spark, folder):
    stored = []
    for day, (low, high) in enumerate([(1, 500), (401, 900), (801, 1500)]):
        ids = spark.range(low, high + 1).withColumnRenamed("id", "order_id")
        feed = generate.gen_shop_orders(ids, batch=day, dirt=generate.CLEAN)
        result = ecommerce(spark, feed, f"{folder}/store", f"{folder}/stage{day}")
        stored.append((result.summary.head().rows_loaded, result.skipped, result.clean.count()))
    assert stored == [(500, 0, 500), (400, 100, 900), (600, 100, 1500)]


def test_feed_files_are_written_without_gathering_or_sorting(spark, sf_dir, folder):
    """A file per remainder, each with one header, its first line, and only its own orders."""
    from quillsift.workload.flows import _FILES, _as_files

    _as_files(spark, sf_dir, folder)
    lines = spark.read.text(folder).selectExpr("value", "_metadata.file_name AS name")
    header = ",".join(SALES_RAW.fieldNames())
    number = "cast(regexp_extract(name, 'part-0*([0-9]+)-', 1) AS int)"
    found = lines.groupBy(F.expr(number).alias("f")).agg(
        F.count_if(F.col("value") == header).alias("headers"),
        F.count_if((F.col("value") != header) & F.expr(f"split(value, ',')[0] % {_FILES} <> {number}")),
        F.count_distinct("name"),
    )
    assert sorted(tuple(r) for r in found.collect()) == [(f, 1, 0, 1) for f in range(_FILES)]
    first = spark.read.text(folder, wholetext=True)
    assert first.where(~F.col("value").startswith(f"{header}\n")).count() == 0
    assert first.where(F.col("value").contains('"')).count() == 0


def test_chunks_write_both_parts_without_sorting(spark, folder):
    put(spark, f"{folder}/in/a.csv", feed(1, 8))
    sorts = []
    plain = DataFrameWriter.parquet

    def watched(self, path, *args, **kwargs):
        if "batch_id=" in path:
            sorts.append(self._spark.conf.get("spark.sql.maxConcurrentOutputFileWriters"))
        return plain(self, path, *args, **kwargs)

    DataFrameWriter.parquet = watched
    try:
        loaded = file_stream.chunked_load(
            spark, f"{folder}/in", SALES_RAW, quantity_price_rules(), f"{folder}/t", f"{folder}/c"
        )
    finally:
        DataFrameWriter.parquet = plain
    assert sorts == ["2"]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    assert {r[0]: r[1] for r in loaded.groupBy("row_status").count().collect()} == {
        "valid": 4, "rejected": 4
    }
