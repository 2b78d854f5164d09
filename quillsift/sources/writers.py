"""Writers. Files are written by the tasks in parallel; a path names a folder."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from quillsift.sources.readers import rows_to_df

# Write modes by the names pipeline authors use.
MODES = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "fail") -> None:
    df.write.mode(MODES[mode]).csv(path, header=True, sep=sep)


def write_json(df: DataFrame, path: str, mode: str = "fail") -> None:
    """JSON Lines: one object per line, so that reading can be split."""
    df.write.mode(MODES[mode]).json(path)


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "fail",
    compression: str = "snappy",
    partition_by: Sequence[str] = (),
) -> None:
    df.write.mode(MODES[mode]).parquet(
        path, compression=compression, partitionBy=list(partition_by) or None
    )


def save_table(df: DataFrame, name: str, if_exists: str = "fail", path: str | None = None) -> None:
    """Store as a catalog table; ``path`` places its files in a given folder."""
    writer = df.write.format("parquet").mode(MODES[if_exists])
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def insert_rows(
    spark: SparkSession,
    table: str,
    rows: DataFrame | Sequence[Mapping[str, Any]] | Mapping[str, Any],
) -> None:
    """Append one row, many rows or a DataFrame to a table, matching columns by name."""
    schema = spark.table(table).schema
    if isinstance(rows, Mapping):
        rows = [rows]
    df = rows if isinstance(rows, DataFrame) else rows_to_df(spark, rows, schema)
    df.select(*schema.fieldNames()).write.insertInto(table)
