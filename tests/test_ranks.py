"""Exact percentiles and average ranks against pandas, with hot keys, ties and gaps."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quillsift.operators import ranks
from quillsift.operators.aggregates import agg_median
from quillsift.operators.profile import profile_describe
from quillsift.operators.ranks import exact_median, exact_percentiles, fill_median
from quillsift.operators.windows import window_rank_avg


def _sample(seed: int, rows: int = 3000) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    group = rng.choice(["hot", "b", "c", "d"], rows, p=[0.6, 0.2, 0.15, 0.05])
    value = np.where(rng.random(rows) < 0.34, 500.25, rng.normal(0, 1e5, rows).round(2))
    frame = pd.DataFrame({"id": range(rows), "g": group, "v": value})
    frame.loc[rng.random(rows) < 0.1, "v"] = np.nan
    frame.loc[frame.g == "d", "v"] = np.nan  # a group without any value
    frame.loc[rng.random(rows) < 0.05, "g"] = None
    return frame


def _to_spark(spark, frame: pd.DataFrame, dtype: str):
    rows = [
        (int(r.id), r.g, None if pd.isna(r.v) else float(r.v)) for r in frame.itertuples()
    ]
    df = spark.createDataFrame(rows, "id BIGINT, g STRING, v DOUBLE")
    return df.withColumn("v", df.v.cast(dtype)).repartition(7)


@pytest.mark.parametrize("dtype", ["double", "decimal(12,2)"])
@pytest.mark.parametrize("seed", [1, 2])
def test_group_median(spark, seed, dtype):
    frame = _sample(seed)
    got = {r.g: r["median"] for r in agg_median(_to_spark(spark, frame, dtype), ["g"], "v").collect()}
    want = frame.groupby("g")["v"].median()
    assert set(got) == set(want.index)
    for group, value in want.items():
        if pd.isna(value):
            assert got[group] is None
        else:
            assert float(got[group]) == pytest.approx(value, abs=1e-9)


@pytest.mark.parametrize("dtype", ["double", "decimal(12,2)"])
def test_rank_average(spark, dtype):
    frame = _sample(3)
    got = {r.id: r["rank"] for r in window_rank_avg(_to_spark(spark, frame, dtype), ["g"], "v").collect()}
    want = frame.groupby("g")["v"].rank()
    assert len(got) == len(frame)
    for i, value in want.items():
        assert got[i] == (None if pd.isna(value) else value)


def test_percentiles_interpolate(spark):
    frame = _sample(4)
    shares = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p99": 0.99}
    row = exact_percentiles(_to_spark(spark, frame, "double"), "v", shares).head()
    for name, share in shares.items():
        assert row[name] == pytest.approx(frame.v.quantile(share), rel=1e-12)


def test_medians_of_whole_numbers_and_dates(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (10,), (None,)], "v INT")
    assert exact_median(df, "v").head()[0] == 2.5
    assert exact_median(df.where("v IS NULL"), "v").head()[0] is None
    assert exact_median(df.limit(0), "v").head()[0] is None
    big = spark.createDataFrame([(-(2**40),), (5,), (2**40,)], "v BIGINT")
    assert exact_median(big, "v").head()[0] == 5.0


def test_rank_of_dates_and_times(spark):
    days = [dt.date(2024, 1, 1), dt.date(1960, 5, 5), dt.date(2024, 1, 1), dt.date(2300, 1, 1)]
    df = spark.createDataFrame([(i, "a", d) for i, d in enumerate(days)], "id INT, g STRING, v DATE")
    ranks = {r.id: r["rank"] for r in window_rank_avg(df, ["g"], "v").collect()}
    assert ranks == {0: 2.5, 1: 1.0, 2: 2.5, 3: 4.0}


def test_fill_median_is_exact_and_keeps_the_type(spark):
    rows = [(i, Decimal(v) if v else None) for i, v in enumerate(["1.00", "2.00", "2.01", "9.00", None])]
    df = spark.createDataFrame(rows, "i INT, v DECIMAL(12,2)")
    filled = fill_median(df, "v")
    assert filled.schema["v"].dataType == df.schema["v"].dataType
    assert {r.i: r.v for r in filled.collect()}[4] == Decimal("2.01")  # 2.005 rounded half up


def test_describe_agrees_with_pandas(spark):
    frame = _sample(5)
    got = {r.column_name: r for r in profile_describe(_to_spark(spark, frame, "double")).collect()}
    want = frame[["id", "v"]].describe()
    for column in ("id", "v"):
        for ours, theirs in [("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"),
                             ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")]:
            assert got[column][ours] == pytest.approx(want.loc[theirs, column], rel=1e-9)


WIDE = [("bigint", 2**62), ("decimal(38,2)", 2**62), ("decimal(20,4)", 10**9), ("decimal(4,4)", 0)]


@pytest.mark.parametrize(("dtype", "spread"), WIDE)
def test_wide_types(spark, dtype, spread):
    """Values spread over the whole type, and over a small part of it."""
    rng = np.random.default_rng(6)
    for high in {spread, 900}:
        whole = [int(v) for v in rng.integers(-high, high + 1, 801)]
        values = [Decimal(v % 2000 - 1000) / 10**4 for v in whole] if spread == 0 else whole
        df = spark.createDataFrame([(i, str(v)) for i, v in enumerate(values)], "id INT, t STRING")
        df = df.selectExpr("id", f"CAST(t AS {dtype}) AS v", "'a' AS g")
        middle = exact_median(df, "v").head()[0]
        assert float(middle) == float(sorted(values)[400])
        got = {r.id: r["rank"] for r in window_rank_avg(df, ["g"], "v").collect()}
        want = pd.Series([float(v) for v in values]).rank() if high < 2**53 else None
        for i, value in enumerate(values):
            below = sum(v < value for v in values)
            same = sum(v == value for v in values)
            assert got[i] == below + (same + 1) / 2
            assert want is None or got[i] == want[i]


@pytest.mark.parametrize(
    "value",
    [
        "id * 1e-9D",
        "1.7e9D + id * 0.001D",
        "-id * 1e-300D",
        "(id - 50000) * 1e-4D",
        "pow(2D, id % 2000 - 1000) * (1 + id / 1e6D)",
    ],
)
def test_slices_of_doubles_are_bounded(spark, value):
    """Narrow, large, tiny, signed and very wide ranges of doubles."""
    df = spark.range(100_000).select(F.expr(value).alias("v"))
    levels = ranks.slice_levels(F.col("v"), df.schema["v"].dataType)
    most = df.groupBy(*levels).agg(F.count_distinct("v").alias("n")).agg(F.max("n")).head()[0]
    assert most <= 2_048
    # Rising values, rising slices.
    pairs = df.select("v", F.struct(*levels).alias("s"))
    apart = pairs.withColumn("before", F.lag("s").over(Window.orderBy("v")))
    assert apart.where("before > s").count() == 0


def test_ranks_pass_over_nan_and_take_endless_values(spark):
    nan, inf = float("nan"), float("inf")
    values = [-5.0, -4.0, 1.0, 2.0, 3.0, nan, None]
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    assert ranks.exact_median(df, "v").head()[0] == 1.0
    df = spark.createDataFrame([(1, v) for v in [*values, inf, -inf, 0.0, -0.0]], "k INT, v DOUBLE")
    got = [(r.v, r["rank"]) for r in ranks.window_rank_avg(df, ["k"], "v").collect()]
    known = sorted((v, n) for v, n in got if v is not None and v == v)
    assert [n for _, n in known] == [1, 2, 3, 4.5, 4.5, 6, 7, 8, 9]
    assert all(n is None for v, n in got if v is None or v != v)


def test_ranks_of_stamps_without_zone(spark):
    df = spark.sql(
        "SELECT 1 AS k, TIMESTAMP_NTZ'1969-12-31 23:59:59.5' + make_dt_interval(id % 7, id % 5) AS v"
        " FROM range(50)"
    )
    got = ranks.window_rank_avg(df, ["k"], "v").toPandas()
    assert got["rank"].tolist() == got["v"].rank().tolist()


@pytest.mark.parametrize("whole", [0, 300, 10**6])
def test_groups_ranked_whole_and_in_slices_agree(spark, monkeypatch, whole):
    """All groups in slices, some of them, and none."""
    monkeypatch.setattr(ranks, "WHOLE", whole)
    frame = _sample(5)
    df = _to_spark(spark, frame, "double")
    got = {r.id: r["rank"] for r in window_rank_avg(df, ["g"], "v").collect()}
    want = frame.groupby("g")["v"].rank(method="average")
    assert len(got) == len(frame)
    for i, rank in want.items():
        assert got[i] is None if pd.isna(rank) else got[i] == rank
    medians = {r.g: r["median"] for r in agg_median(df, ["g"], "v").collect()}
    assert medians["d"] is None
    for group, value in frame.groupby("g")["v"].median().dropna().items():
        assert medians[group] == pytest.approx(value, rel=1e-12)


def test_slices_leave_the_plan_where_no_group_is_large(spark):
    df = spark.range(2000).selectExpr("id % 7 AS g", "id / 3.0D AS v")
    ranked = window_rank_avg(df, ["g"], "v")
    ranked.collect()
    final = ranked._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Window" in final and "_slice_2" not in final
