"""Duplicate removal with a defined winner.

Spark has no row order, so the order that picks the winner is a required argument. The
``row_number() = 1`` filter lets Spark keep one row per key already before the shuffle (the
partial ``WindowGroupLimit`` in the plan), so a key holding a third of all rows still sends only
one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_RANK = "_dedup_rank"


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def dedup_keep_first(
    df: DataFrame, key: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """One row per key, the first in ``order``; end the order in a unique column.

    Rows without a key form one group, as a missing value equals itself here.
    """
    numbered = df.withColumn(
        _RANK, F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    )
    return numbered.where(F.col(_RANK) == 1).drop(_RANK)


def dedup_key(df: DataFrame, key: str, order: Sequence[str | Column]) -> DataFrame:
    return dedup_keep_first(df, [key], order)


def dedup_business_key(
    df: DataFrame, key: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """Deduplicate on what identifies the thing, after cleaning; ids may differ between copies."""
    return dedup_keep_first(df, key, order)


def count_duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows beyond the first of their key, as one row with ``duplicates``."""
    per_key = df.groupBy(*key).agg((F.count("*") - 1).alias("extra"))
    return per_key.agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("duplicates"))
