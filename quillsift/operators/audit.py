"""Audit columns and run summaries."""

from __future__ import annotations

import datetime as dt
import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Run(NamedTuple):
    """Identity of one run, fixed once so that every row of the run carries the same values."""

    run_id: str
    loaded_at: dt.datetime

    @classmethod
    def start(cls) -> Run:
        now = dt.datetime.now(dt.timezone.utc).replace(microsecond=0, tzinfo=None)
        return cls(str(uuid.uuid4()), now)

    def stamp(self) -> Column:
        """The load time as a column; text keeps it apart from every time zone setting."""
        return F.lit(self.loaded_at.isoformat(sep=" ")).cast("timestamp_ntz")


def audit_columns(df: DataFrame, run: Run, source: str | Column) -> DataFrame:
    return df.withColumns(
        {
            "loaded_at": run.stamp(),
            "source_file": source if isinstance(source, Column) else F.lit(source),
            "run_id": F.lit(run.run_id),
        }
    )


def audit_query(df: DataFrame, source_file: str | None = None, run_id: str | None = None) -> DataFrame:
    """Rows of one source, one run, or both."""
    if source_file is not None:
        df = df.where(F.col("source_file") == source_file)
    if run_id is not None:
        df = df.where(F.col("run_id") == run_id)
    return df
