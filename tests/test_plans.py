"""What the plans must and must not contain."""

from __future__ import annotations

import re

import pytest
from compare import plan_of
from pyspark.sql import functions as F

import __spark_entry__ as wiring
from quillsift.operators import loads, quality
from quillsift.operators.dedup import dedup_keep_first
from quillsift.operators.joins import anti_join_new, join_left_flag, semi_join_skipped
from quillsift.operators.loads import upsert_replace
from quillsift.operators.windows import group_filter_size, window_group_mean, window_rank_avg
from quillsift.sources.readers import read_parquet

QUERIES = wiring.queries()


def test_filter_and_columns_reach_the_scan(spark, sf_dir):
    plan = QUERIES["filter_cmp"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "GreaterThan(o_totalprice,250000" in plan
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert schema == "o_orderkey:bigint,o_totalprice:double"


def test_pruned_read(spark, sf_dir):
    plan = plan_of(read_parquet(spark, f"{sf_dir}/lineitem.parquet", ["l_orderkey"]))
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan


def test_dedup_reduces_before_the_shuffle(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    plan = plan_of(dedup_keep_first(df, ["k"], ["id"]))
    partial, shuffle = plan.rindex("row_number(), 1, Partial"), plan.index("Exchange")
    assert shuffle < partial  # the tree is printed from the result down


def test_group_value_uses_no_window(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    plan = plan_of(window_group_mean(df, ["k"], "id"))
    assert "Window" not in plan and "partial_avg" in plan


def test_small_upsert_does_not_shuffle_the_target(spark, folder):
    spark.range(100_000).select("id", (F.col("id") * 2).alias("v")).write.parquet(folder)
    target = spark.read.parquet(folder)
    batch = spark.createDataFrame([(5, 1), (100_001, 2)], "id BIGINT, v BIGINT")
    upserted = upsert_replace(target, batch, ["id"], ["v"])
    upserted.collect()
    final = plan_of(upserted)
    assert "BroadcastHashJoin" in final
    assert upserted.count() == 100_001


@pytest.fixture
def tiny_skew_limits(spark):
    """Skew limits scaled down to test data, and no broadcast, as between two large tables."""
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {name: spark.conf.get(name, None) for name in limits}
    for name, value in limits.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_joins_split_a_hot_key(spark, folder, tiny_skew_limits):
    """A third of all rows share a key; the join spreads them over several tasks."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5000)
    ids = spark.range(300_000, numPartitions=12)
    columns = [key.alias("k"), "id", F.lit(1).alias("v")]
    ids.select(*columns).write.parquet(f"{folder}/facts")
    spark.range(5000).select(F.col("id").alias("k")).write.parquet(f"{folder}/lookup")
    facts, lookup = spark.read.parquet(f"{folder}/facts"), spark.read.parquet(f"{folder}/lookup")
    joins = {
        "flag": (join_left_flag(facts, lookup, ["k"]), 300_000),
        "skipped": (semi_join_skipped(facts, lookup, ["k"]), 300_000),
        "new": (anti_join_new(facts, lookup.where("k > 0"), ["k"]), 100_040),
        "group mean": (window_group_mean(facts, ["k"], "id"), 300_000),
        "group size": (group_filter_size(facts, ["k"], 100), 100_040),
        "rank": (window_rank_avg(facts, ["k"], "v"), 300_000),
    }
    for name, (joined, rows) in joins.items():
        assert len(joined.collect()) == rows, name
        assert "skew=true" in plan_of(joined), name


def scans(df):
    """Scans of the plan as it is before it runs, so that none is hidden behind a reused exchange."""
    return df._jdf.queryExecution().sparkPlan().toString().count("FileScan")


@pytest.fixture
def feed(spark, folder):
    rows = spark.range(1000).selectExpr("id AS k", "id % 7 AS v", "IF(id % 5 = 0, NULL, id) AS w")
    rows.write.parquet(f"{folder}/feed")
    return spark.read.parquet(f"{folder}/feed")


def test_counts_by_status_read_the_input_once(spark, feed):
    rows = quality.routed(feed, {"w is missing": F.col("w").isNotNull(), "v is zero": F.col("v") != 0})
    check = quality.reconcile_routed(rows, ["valid", "rejected"])
    assert scans(check) == 1 and "Exchange" in plan_of(check)
    r = check.head()
    assert (r.source_rows, r.valid_rows + r.rejected_rows, r.balanced) == (1000, 1000, True)
    assert not quality.reconcile_routed(rows, ["valid"]).head().balanced
    lost = rows.withColumn("row_status", F.when(F.col("k") != 3, F.col("row_status")))
    assert not quality.reconcile_routed(lost, ["valid", "rejected"]).head().balanced


def test_counts_of_a_load_need_keys_only(spark, feed, folder):
    feed.where("k < 300").write.parquet(f"{folder}/target")
    target = spark.read.parquet(f"{folder}/target")
    batch = feed.where("k >= 200").unionByName(feed.where("k >= 900"))
    counts = loads.counts_of_keys(loads.keys_of_load(target, batch, ["k"]))
    assert tuple(counts.head()) == (900, 700, 100, 100)
    one = loads.counts_of_keys(loads.keys_of_load(target, feed, ["k"]))
    # The target once, the batch's keys for the match and for the counts.
    assert scans(one) == 3
    for line in one._jdf.queryExecution().sparkPlan().toString().splitlines():
        assert "FileScan" not in line or "ReadSchema: struct<k:bigint>" in line
    assert tuple(loads.counts_of_keys(loads.keys_of_load(target, feed.limit(0), ["k"])).head()) == (0, 0, 0, 0)
