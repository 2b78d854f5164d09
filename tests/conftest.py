from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from quillsift.session import build_session, run_folder  # noqa: E402

TEST_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not Path(TEST_SF).exists():
        pytest.skip("test tables are not here")
    return TEST_SF


@pytest.fixture
def folder(spark):
    return run_folder(spark, "test")


@pytest.fixture
def one(spark):
    """Values of a Column function over a list of inputs, in order."""

    def apply(function, values, dtype="string"):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i INT, c {dtype}")
        from pyspark.sql import functions as F

        result = df.select("i", function(F.col("c")).alias("r")).orderBy("i")
        return [r.r for r in result.collect()]

    return apply
