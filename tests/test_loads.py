"""Keyed loads under hot keys, missing keys, reruns and any partitioning."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quillsift.operators import dedup, loads
from quillsift.operators.joins import anti_join_new, matched_keys, semi_join_skipped
from quillsift.sources import snapshots
from quillsift.sources.generate import gen_dirty_orders, order_ids


@pytest.fixture(scope="module")
def hot(spark):
    """A third of all rows share key 0."""
    ids = spark.range(9000)
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500)
    return ids.select(key.alias("k"), F.col("id").alias("v"))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_dedup_winner_does_not_depend_on_partitioning(hot):
    first = rows(dedup.dedup_keep_first(hot, ["k"], ["v"]))
    assert first == rows(dedup.dedup_keep_first(hot.repartition(13), ["k"], ["v"]))
    low: dict[int, int] = {}
    for k, v in rows(hot):
        low[k] = min(v, low.get(k, v))
    assert first == sorted(low.items())


def test_missing_keys_are_one_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k INT, v INT")
    assert rows(dedup.dedup_key(df, "k", ["v"]).select("v")) == [(1,), (3,)]
    assert dedup.count_duplicates(df, ["k"]).head().duplicates == 1
    assert dedup.count_duplicates(df.limit(0), ["k"]).head().duplicates == 0


def test_new_only_counts_copies_once(spark, hot):
    target = spark.range(100).select(F.col("id").alias("k"), F.lit(-1).cast("bigint").alias("v"))
    load = loads.load_new_only(target, hot, ["k"], ["v"])
    counts = loads.load_counts(load, hot).head()
    known = sum(1 for k, _ in rows(hot) if k < 100)
    assert counts.incoming_rows == 9000
    assert counts.skipped_rows == known
    assert counts.added_rows == 400
    assert counts.duplicate_rows == 9000 - known - 400
    assert load.table.groupBy("k").count().where("count > 1").count() == 0


def test_split_against_target_is_whole(spark, hot):
    target = spark.range(0, 500, 7).select(F.col("id").alias("k"))
    new, old = anti_join_new(hot, target, ["k"]), semi_join_skipped(hot, target, ["k"])
    assert rows(new.unionByName(old)) == rows(hot)
    held = {r.k for r in target.collect()}
    assert {k for k, _ in rows(old)} <= held
    assert not {k for k, _ in rows(new)} & held
    assert matched_keys(hot, target, ["k"]).count() == len(held)


def test_rows_without_a_key_are_new(spark):
    df = spark.createDataFrame([(None, 1), (2, 2)], "k INT, v INT")
    target = spark.createDataFrame([(None,), (2,)], "k INT")
    assert rows(anti_join_new(df, target, ["k"]).select("v")) == [(1,)]


def test_upsert_replace_last_row_wins(spark, hot):
    target = spark.range(400, 600).select(F.col("id").alias("k"), F.lit(-1).cast("bigint").alias("v"))
    got = dict(rows(loads.upsert_replace(target, hot, ["k"], ["v"])))
    want = {k: -1 for k in range(400, 600)}
    for k, v in rows(hot):
        want[k] = max(v, want.get(k, v) if want.get(k) != -1 else v)
    assert got == want


def test_upsert_update_touches_listed_columns_only(spark):
    schema = "k INT, a STRING, b STRING"
    target = spark.createDataFrame([(1, "a1", "b1"), (2, "a2", "b2")], schema)
    batch = spark.createDataFrame([(2, None, "new"), (3, "a3", "b3"), (3, "a0", "b0")], schema)
    got = loads.upsert_update(target, batch, ["k"], ["a"], ["a"])
    assert {tuple(r) for r in got.collect()} == {
        (1, "a1", "b1"),
        (2, None, "b2"),
        (3, "a3", "b3"),
    }


def test_snapshots_keep_what_a_failed_write_left(spark, folder):
    schema = spark.range(1).schema
    assert snapshots.read_snapshot(spark, folder, schema).count() == 0
    snapshots.write_snapshot(spark.range(3), folder)
    # A snapshot without its success mark is passed over, and its number is not used again.
    spark.range(9).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        f"{folder}/version=000002"
    )
    assert snapshots.read_snapshot(spark, folder, schema).count() == 3
    grown = snapshots.read_snapshot(spark, folder, schema).unionByName(spark.range(10, 12))
    assert snapshots.write_snapshot(grown, folder).endswith("version=000003")
    assert snapshots.read_snapshot(spark, folder, schema).count() == 5


def test_append_new_is_repeatable(spark, folder, hot):
    assert snapshots.append_new(spark, folder, hot, ["k"], ["v"]) == 500
    assert snapshots.append_new(spark, folder, hot, ["k"], ["v"]) == 0
    assert spark.read.parquet(folder).count() == 500


def test_partition_upsert_rewrites_touched_partitions_only(spark, folder):
    table, ranges = f"{folder}/table", F.expr("k div 100")
    first = spark.range(1000).select(F.col("id").alias("k"), F.lit(0).alias("v"))
    batch = spark.range(950, 1050).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    snapshots.upsert_partitions(spark, table, first, ["k"], ["v"], ranges, f"{folder}/s1")

    def files():
        read = spark.read.parquet(table).where("key_range < 9")
        return {r[0] for r in read.select("_metadata.file_path").distinct().collect()}

    before = files()
    snapshots.upsert_partitions(spark, table, batch, ["k"], ["v"], ranges, f"{folder}/s2")
    assert files() == before
    got = spark.read.parquet(table)
    assert got.count() == 1050
    assert got.where("v = 1").count() == 100
    # Putting the stage in place once more changes nothing.
    schema = batch.withColumn("key_range", ranges).schema
    snapshots.install_stage(spark, table, f"{folder}/s2", schema, "key_range")
    assert spark.read.parquet(table).count() == 1050


def test_partition_upsert_writes_a_file_per_partition(spark, folder):
    """Files go with the partitions touched, not with partitions times tasks, and are written once."""
    table, ranges = f"{folder}/table", F.expr("k div 100")
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, False)  # as many tasks write as with large tables
    try:
        for n in range(2):
            rows = spark.range(2000).select(F.col("id").alias("k"), F.lit(n).alias("v"))
            snapshots.upsert_partitions(spark, table, rows, ["k"], ["v"], ranges, f"{folder}/s{n}")
            stored = spark.read.parquet(table)
            assert stored.select("_metadata.file_path").distinct().count() == 20
            assert stored.where(F.col("v") == n).count() == stored.count() == 2000
    finally:
        spark.conf.unset(setting)


def test_generated_orders_depend_on_ids_alone(spark):
    once = gen_dirty_orders(order_ids(spark, 2000))
    again = gen_dirty_orders(order_ids(spark, 2000).repartition(5))
    assert once.exceptAll(again).count() == 0
    shares = once.agg(
        F.avg(F.col("quantity").isNull().cast("int")),
        F.avg((F.col("quantity") < 0).cast("int")),
        F.avg(F.col("unit_price").isNull().cast("int")),
    ).head()
    assert 0.07 < shares[0] < 0.13 and 0.07 < shares[1] < 0.15 and 0.1 < shares[2] < 0.19
    assert gen_dirty_orders(order_ids(spark, 50), seed=1).exceptAll(once).count() > 25
