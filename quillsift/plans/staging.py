"""One written pass over the input, from which clean rows, rejects and counts are all read.

Caching would keep the rows in executor memory, and evaluating the plan per output would read the
source several times. A staged table does neither, survives the loss of executors, and its status
partitions let every reader skip the rows it does not want.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsift.operators.quality import OK

STATUS = "row_status"


def validity_status() -> Column:
    return F.when(F.col(OK), "valid").otherwise("rejected")


def stage(df: DataFrame, folder: str) -> DataFrame:
    """Write ``df`` by ``row_status`` and return the written table."""
    columns = [c for c in df.columns if c != STATUS]
    ordered = df.select(*columns, STATUS)
    ordered.write.mode("errorifexists").partitionBy(STATUS).parquet(folder)
    return df.sparkSession.read.schema(ordered.schema).parquet(folder)


def with_status(staged: DataFrame, status: str) -> DataFrame:
    return staged.where(F.col(STATUS) == status).drop(STATUS)


def run_summary(staged: DataFrame, rows_loaded: Column | int) -> DataFrame:
    """The run as one row. Counts come from the written stage, so a retried task or a lost
    executor cannot count a row twice, and they read partition names only."""

    def rows(status: str) -> Column:
        return F.count_if(F.col(STATUS) == status)

    loaded = rows_loaded if isinstance(rows_loaded, Column) else F.lit(rows_loaded)
    return staged.agg(
        F.lit("success").alias("status"),
        F.count("*").alias("rows_extracted"),
        rows("valid").alias("rows_valid"),
        rows("rejected").alias("rows_rejected"),
        loaded.cast("bigint").alias("rows_loaded"),
        F.array().cast("array<string>").alias("errors"),
    )
