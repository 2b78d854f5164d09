"""Percentiles of many columns at once against numpy, over awkward values."""

import random
from decimal import Decimal

import numpy as np
import pytest

from quillsift.operators import percentiles, profile

SCHEMA = "a LONG, b INT, m DECIMAL(12,2), w DECIMAL(30,4), x DOUBLE, f FLOAT, none DOUBLE, one LONG, t STRING"


def table(spark, n, seed=3):
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        wide = pick.choice([pick.getrandbits(62), -pick.getrandbits(62), pick.randrange(5)])
        x = pick.choice([pick.gauss(0, 1), pick.gauss(0, 1e200), -0.0, 0.0, 1e-310, None])
        rows.append((
            pick.choice([wide, None]), pick.randrange(-3, 3), Decimal(pick.randrange(-10**6, 10**9)).scaleb(-2),
            Decimal(pick.getrandbits(80)).scaleb(-4), x, float(np.float32(pick.random())), None, 7, "s",
        ))
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.mark.parametrize("small", [0, 50, 200_000])
def test_quartiles_agree_with_numpy(spark, monkeypatch, small):
    monkeypatch.setattr(percentiles, "SMALL", small)
    monkeypatch.setattr(percentiles, "SLICES", 16 if small < 100 else 4096)
    df = table(spark, 700)
    got = {r.column_name: r for r in profile.profile_describe(df).collect()}
    assert set(got) == set(profile.numeric_columns(df))
    for name, r in got.items():
        values = [v[0] for v in df.select(name).collect() if v[0] is not None]
        assert r["count"] == len(values)
        if not values:
            assert r.p50 is None and r.min is None
            continue
        want = np.quantile(np.array(values, dtype=float), [0.25, 0.5, 0.75])
        assert [r.p25, r.p50, r.p75] == pytest.approx(want, rel=1e-12)
        assert (r.min, r.max) == (float(min(values)), float(max(values)))
        assert r.mean == pytest.approx(float(sum(values) / len(values)), rel=1e-9, abs=1e-9)


def test_ranks_beyond_doubles(spark):
    """Neighbouring longs that no double tells apart keep their order."""
    base = 2**62
    df = spark.createDataFrame([(base + i,) for i in range(101)], "a LONG")
    found = percentiles.percentiles_at_once(df, {"a": (base, base + 100, 101)}, {"p": 0.25, "q": 0.5})
    assert found["a"] == {"p": (base + 25, base + 25, 0), "q": (base + 50, base + 50, 0)}


def test_endless_values_and_extremes(spark):
    inf = float("inf")
    rows = [(v,) for v in (-inf, -1.7e308, -1.0, 0.5, 2.0, 1.7e308, inf, inf, float("nan"), None)]
    df = spark.createDataFrame(rows, "x DOUBLE")
    r = profile.profile_describe(df).head()
    assert (r["count"], r.p25, r.p50) == (9, pytest.approx(-4.25e307), 1.25)
    edge = spark.createDataFrame([(-(2**63),), (2**63 - 1,), (0,)], "a LONG")
    r = profile.profile_describe(edge).head()
    assert (r.p50, r.min, r.max) == (0.0, -(2.0**63), 2.0**63)


def test_passes(spark, monkeypatch):
    """One pass for the sums and two for the quartiles of all columns, whatever their number."""
    calls = []
    counted = percentiles._counted
    monkeypatch.setattr(
        percentiles, "_counted", lambda *a: calls.append(a[3]) or counted(*a)
    )
    monkeypatch.setattr(percentiles, "SMALL", 1000)
    df = spark.range(300_000).selectExpr("id", "id * 7 % 1000 AS b", "rand(1) AS c", "-id AS d")
    r = {x.column_name: x for x in profile.profile_describe(df).collect()}
    assert calls == [False, True]
    assert (r["id"].p25, r["id"].p50, r["b"].p50) == (74999.75, 149999.5, 499.5)


def test_no_rows_and_no_columns(spark):
    empty = table(spark, 1).where("one = 0")
    assert {r["count"] for r in profile.profile_describe(empty).collect()} == {0}
    assert profile.profile_describe(empty.select("t")).count() == 0
