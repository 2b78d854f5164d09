"""Which loads of a stored table may hold a key: one small entry per load, beside the table.

An entry holds the least and the largest value of the key's first column in a load. A batch is
checked not only against its own extremes, since one old key among new ones would then bring back
every load between: where values can be measured, the span of all loads is divided into cells, and a
load is ruled out if no value of the batch lies in a cell between its own ends. What is not ruled out
is joined key by key, so that entries only save work and never decide.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillsift.sources.readers import empty_table

FOLDER = "_key_index"
CELLS = 4096


def _schema(dtype: T.DataType) -> T.StructType:
    fields = [("load", T.StringType()), ("rows", T.LongType()), ("low", dtype), ("high", dtype)]
    return T.StructType([T.StructField(n, t) for n, t in fields])


def _entries(spark: SparkSession, path: str, dtype: T.DataType) -> DataFrame:
    # Spark leaves folders out that begin with an underscore, so the table never reads its index.
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{FOLDER}")
    system = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(pattern):
        return empty_table(spark, _schema(dtype))
    return spark.read.schema(_schema(dtype)).parquet(f"{path}/{FOLDER}")


def enter(path: str, folder: str, written: DataFrame, key: Sequence[str]) -> int:
    """Enter a load that has been written, and return its number of rows.

    A crash before this leaves a load without an entry, which is then always read.
    """
    first = F.col(key[0])
    load = F.lit(folder.rsplit("/", 1)[-1])
    entry = written.agg(
        load.alias("load"),
        F.count(F.lit(1)).alias("rows"),
        F.min(first).alias("low"),
        F.max(first).alias("high"),
    )
    row = entry.first()
    # One row from the driver: the entry is not computed a second time for the write.
    one = written.sparkSession.createDataFrame([row], _schema(written.schema[key[0]].dataType))
    one.coalesce(1).write.mode("append").parquet(f"{path}/{FOLDER}")
    return row.rows


def _measure(dtype: T.DataType, c: Column) -> Column | None:
    """A number that never falls as the value grows, or None where values are not measured."""
    if isinstance(dtype, T.NumericType):
        return c.cast("double")
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c).cast("double")
    return None


def without_candidates(
    spark: SparkSession, path: str, incoming: DataFrame, key: Sequence[str]
) -> set[str]:
    """Names of the loads that hold no key of ``incoming``.

    To the driver come one entry per load and at most CELLS numbers of the batch.
    """
    name, dtype = key[0], incoming.schema[key[0]].dataType
    entries = _entries(spark, path, dtype)
    span = entries.agg(F.min("low").alias("low"), F.max("high").alias("high")).first()
    if span.low is None:
        # No entries, or only of loads without rows.
        return {r.load for r in entries.where("rows = 0").collect()}
    empty = F.col("rows") == 0
    low, high = F.lit(span.low).cast(dtype), F.lit(span.high).cast(dtype)
    measured = _measure(dtype, F.col(name))
    if measured is None:
        ends = incoming.agg(F.min(name).alias("low"), F.max(name).alias("high")).first()
        if ends.low is None:
            return {r.load for r in entries.collect()}
        apart = (F.col("high") < F.lit(ends.low)) | (F.col("low") > F.lit(ends.high))
        return {r.load for r in entries.where(empty | apart).select("load").collect()}

    start, end = _measure(dtype, low), _measure(dtype, high)

    def cell(value: Column) -> Column:
        share = (_measure(dtype, value) - start) / F.greatest(end - start, F.lit(1e-300))
        return F.floor(share * CELLS).cast("int")

    inside = incoming.where(F.col(name).between(low, high))
    taken = sorted(r.cell for r in inside.select(cell(F.col(name)).alias("cell")).distinct().collect())
    ends = entries.select(
        "load", empty.alias("empty"), cell(F.col("low")).alias("a"), cell(F.col("high")).alias("b")
    )

    def misses(a: int, b: int) -> bool:
        at = bisect_left(taken, a)
        return at == len(taken) or taken[at] > b

    return {r.load for r in ends.collect() if r.empty or misses(r.a, r.b)}
