"""Tables in key ranges, the key index of appended tables, and rejects kept by load."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillsift.sources import key_index, ranged, snapshots

KINDS = "k LONG, v LONG"


def frame(spark, ids, v):
    return spark.createDataFrame([(int(i),) for i in ids], "k LONG").withColumn("v", F.lit(v).cast("long"))


def table(spark, root, kinds):
    return {r.k: r.v for r in ranged.read_ranged(spark, root, kinds).collect()}


def stages(spark, root):
    return {r.name: r.stage for r in ranged.directory(spark, root).values() if r.rows}


def test_a_batch_rewrites_only_its_ranges(spark, folder):
    first = spark.range(10_000).select(F.col("id").alias("k"), F.lit(0).cast("long").alias("v"))
    ranged.upsert_ranged(spark, folder, first, ["k"], ["v"], rows_per_range=1000)
    before = stages(spark, folder)
    assert len(before) >= 10
    assert max(r.rows for r in ranged.directory(spark, folder).values()) <= 1024
    # One in a hundred ids, next to each other.
    batch = frame(spark, range(5000, 5100), 1)
    ranged.upsert_ranged(spark, folder, batch, ["k"], ["v"], rows_per_range=2000)
    after = stages(spark, folder)
    assert after.keys() == before.keys()
    assert sum(after[n] != before[n] for n in after) == 1
    want = {i: int(5000 <= i < 5100) for i in range(10_000)}
    assert table(spark, folder, first.schema) == want
    # Once more, and with new ids beyond all ranges, far away, and below zero.
    more = frame(spark, [5, 10_000, 10_001, 2**40, -7, -(2**62)], 2)
    for _ in range(2):
        ranged.upsert_ranged(spark, folder, more, ["k"], ["v"], rows_per_range=2000)
        want |= {r.k: 2 for r in more.collect()}
        assert table(spark, folder, first.schema) == want


def test_ranges_split_as_they_fill(spark, folder):
    want = {}
    for n, start in enumerate([0, 300, 600, 100_000, 0, 950]):
        ids = range(start, start + 400)
        batch = frame(spark, ids, n)
        ranged.upsert_ranged(spark, folder, batch, ["k"], ["v"], rows_per_range=250)
        want |= {i: n for i in ids}
        assert table(spark, folder, batch.schema) == want
    ranges = ranged.directory(spark, folder).values()
    assert sum(r.rows for r in ranges) == len(want)
    assert all(r.rows <= 512 for r in ranges)
    # Every key lies in the narrowest range that has it, where a lookup finds it.
    stored = ranged._read(spark, folder, batch.schema, list(ranges))
    routed = ranged._routed(stored.select("k"), F.col("k"), list(ranges)).select("k", ranged.SHIFT)
    pairs = stored.select("k", ranged.SHIFT)
    assert pairs.exceptAll(routed).count() == 0


def test_split_width():
    top = ranged.Range(63, 0)
    assert ranged.split_width(top, 10, 0, 99, 10) is None
    assert ranged.split_width(top, 11, 0, 127, 10) == 6
    assert ranged.split_width(top, 80, 0, 127, 10) == 4
    assert ranged.split_width(top, 11, 5, 5, 10) is None
    assert ranged.split_width(ranged.Range(63, 0, "s", 9, 64, 70), 9, 0, 1, 10) == 6


def test_crash_between_stage_and_install(spark, folder, monkeypatch):
    first = frame(spark, range(100), 0)
    ranged.upsert_ranged(spark, folder, first, ["k"], ["v"], rows_per_range=50)

    def crash(*_):
        raise RuntimeError("killed")

    batch = frame(spark, range(90, 110), 1)
    with monkeypatch.context() as patched:
        patched.setattr(ranged, "_install", crash)
        with pytest.raises(RuntimeError):
            ranged.upsert_ranged(spark, folder, batch, ["k"], ["v"], rows_per_range=50)
    assert table(spark, folder, first.schema) == {i: 0 for i in range(100)}
    written = len(snapshots._names(spark, f"{folder}/data/*"))
    assert written == 2
    ranged.upsert_ranged(spark, folder, batch, ["k"], ["v"], keep=1, rows_per_range=50)
    want = {i: int(i >= 90) for i in range(110)}
    assert table(spark, folder, first.schema) == want
    # What the crash left, and what the batch replaced, is gone; one directory is left.
    used = {r.folder(folder).rsplit("/", 3)[1] for r in ranged.directory(spark, folder).values() if r.rows}
    left = {f.rsplit("/", 3)[1] for f in snapshots._names(spark, f"{folder}/data/*/*/*")}
    assert left == used
    assert len(snapshots._names(spark, f"{folder}/directory/version=*")) == 1


def test_update_and_delete_touch_their_ranges(spark, folder):
    first = frame(spark, range(1000), 0)
    ranged.upsert_ranged(spark, folder, first, ["k"], ["v"], rows_per_range=100)
    before = stages(spark, folder)
    kinds = first.schema
    assert ranged.update_ranged(spark, folder, kinds, ["k"], F.col("k") == 7, {"v": F.col("v") + 5}) == 1
    assert ranged.delete_ranged(spark, folder, kinds, ["k"], F.col("k") >= 995) == 1
    assert ranged.delete_ranged(spark, folder, kinds, ["k"], F.col("v") > 99) == 0
    after = stages(spark, folder)
    assert sum(after[n] != before[n] for n in after) == 2
    assert table(spark, folder, kinds) == {i: 5 * (i == 7) for i in range(995)}
    with pytest.raises(ValueError):
        ranged.update_ranged(spark, folder, kinds, ["k"], F.col("k") == 7, {"k": 8})
    # A range that loses all its rows stays, empty, and takes rows again.
    ranged.delete_ranged(spark, folder, kinds, ["k"], F.lit(True))
    assert table(spark, folder, kinds) == {}
    ranged.upsert_ranged(spark, folder, frame(spark, [3], 9), ["k"], ["v"])
    assert table(spark, folder, kinds) == {3: 9}


def test_other_keys_and_missing_ones(spark, folder):
    rows = spark.range(500).selectExpr("concat('n', id) AS name", "id AS v")
    ranged.upsert_ranged(spark, f"{folder}/t", rows, ["name"], ["v"], rows_per_range=100)
    ranged.upsert_ranged(spark, f"{folder}/t", rows.selectExpr("name", "v + 1 AS v"), ["name"], ["v"])
    got = ranged.read_ranged(spark, f"{folder}/t", rows.schema)
    assert got.count() == 500 and got.where("name = concat('n', v - 1)").count() == 500
    days = spark.range(300).selectExpr("date_add(DATE '1969-12-01', CAST(id AS INT)) AS day", "id AS v")
    ranged.upsert_ranged(spark, f"{folder}/d", days, ["day"], ["v"], rows_per_range=100)
    assert ranged.read_ranged(spark, f"{folder}/d", days.schema).where(
        F.col("day") == dt.date(1970, 1, 1)
    ).head().v == 31
    bad = spark.createDataFrame([(None, 1)], KINDS)
    with pytest.raises(Exception, match="k is missing"):
        ranged.upsert_ranged(spark, f"{folder}/n", bad, ["k"], ["v"])
    empty = bad.where("v < 0")
    ranged.upsert_ranged(spark, f"{folder}/n", empty, ["k"], ["v"])
    assert ranged.read_ranged(spark, f"{folder}/n", bad.schema).count() == 0


# --- key index ---------------------------------------------------------------------------------


def append(spark, path, ids, v=0):
    return snapshots.append_new(spark, path, frame(spark, ids, v), ["k"], ["v"])


def read_loads(spark, path, ids):
    rows = snapshots.read_candidates(spark, path, frame(spark, ids, 0), ["k"])
    return {f.rsplit("/", 2)[1] for f in rows.inputFiles()}


def test_loads_without_candidates_are_not_read(spark, folder):
    for start in (0, 1000, 2000, 3000):
        assert append(spark, folder, range(start, start + 1000, 2)) == 500
    assert len(snapshots._names(spark, f"{folder}/load=*")) == 4
    assert len(read_loads(spark, folder, [2100, 2200])) == 1
    assert len(read_loads(spark, folder, [9_000_000])) == 0
    # One old key among new ones does not bring back the loads between.
    assert len(read_loads(spark, folder, [4, 3500])) == 2
    # A key between others of a load is no match, though the load is read.
    assert len(read_loads(spark, folder, [2101])) == 1
    assert append(spark, folder, [2100, 2101, 2101, 5000]) == 2
    assert spark.read.parquet(folder).count() == 2002
    assert append(spark, folder, [2100, 2101, 5000]) == 0


def test_loads_without_an_entry_are_read(spark, folder):
    append(spark, folder, range(10))
    frame(spark, range(10, 20), 0).write.parquet(f"{folder}/load=crashed")
    assert read_loads(spark, folder, [15]) == {"load=crashed"}
    assert append(spark, folder, range(30)) == 10
    assert spark.read.parquet(folder).select("k").distinct().count() == 30


@pytest.mark.parametrize(
    "make", ["concat('n', lpad(id, 6, '0'))", "date_add(DATE '2020-01-01', CAST(id AS INT))",
             "CAST(id AS DECIMAL(20,3))", "id = 1"],
)
def test_keys_of_other_types(spark, folder, make):
    for start in (0, 500, 250):
        rows = spark.range(start, start + 500).selectExpr(f"{make} AS k", "id AS v")
        snapshots.append_new(spark, folder, rows, ["k"], ["v"])
    want = spark.range(1000).selectExpr(f"{make} AS k").distinct().count()
    assert spark.read.parquet(folder).count() == want
    # Rows of a batch without any key inside the stored span.
    far = spark.range(1).selectExpr(f"{make.replace('id', '5000')} AS k", "5L AS v")
    snapshots.read_candidates(spark, folder, far, ["k"]).count()


def test_index_is_no_part_of_the_table(spark, folder):
    append(spark, folder, [])
    append(spark, folder, range(5))
    assert spark.read.parquet(folder).columns[:2] == ["k", "v"]
    assert key_index._entries(spark, folder, T.LongType()).count() == 2


# --- rejects -----------------------------------------------------------------------------------


def test_copies_of_rejects_add_up_over_loads(spark, folder):
    def load(rows, load_id=None):
        df = spark.createDataFrame(rows, "a STRING, b INT")
        return df, snapshots.append_distinct(spark, folder, df, load_id)

    df, n = load([("x", 1)])
    assert n == 1
    load([("x", 1), ("x", 1), ("x", 1), (None, None), (None, None)])
    stored = lambda: {(r.a, r.b): r.copies for r in snapshots.read_distinct(spark, folder, df.schema).collect()}
    assert stored() == {("x", 1): 4, (None, None): 2}
    # The same load in another order is the same load; one that differs is another.
    load([("x", 1), (None, None), ("x", 1), (None, None), ("x", 1)])
    assert stored() == {("x", 1): 4, (None, None): 2}
    load([("x", 1), ("x", 1)])
    assert stored()["x", 1] == 6
    # Loads with a name of their own.
    for _ in range(2):
        load([("y", 2)], "monday")
    load([("y", 2)], "tuesday")
    assert stored()["y", 2] == 2
