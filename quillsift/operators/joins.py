"""Joins of a fact table with a lookup, and key checks against a target.

No side carries a broadcast hint: Spark broadcasts by measured size and splits skewed join
partitions at run time, so a key holding a third of all rows is spread over several tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsift.operators.filters import holds

_MARK = "_lookup_mark"


def splittable(side: DataFrame) -> DataFrame:
    """Prepare the smaller side of a join with a skewed one.

    Spark splits a skewed partition only where both sides come straight out of a shuffle made for
    the join. A side grouped or joined by the same key already has no such shuffle, and the hot key
    would stay in one task; rebalancing the side, which is small, brings the shuffle back.
    """
    return side.hint("rebalance")


def join_inner(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    return left.join(right, list(key), "inner")


def join_left_flag(
    left: DataFrame, lookup: DataFrame, key: Sequence[str], flag: str = "customer_found"
) -> DataFrame:
    """Left join with a flag that tells a match even where the lookup's columns are NULL."""
    marked = lookup.withColumn(_MARK, F.lit(True))
    joined = left.join(marked, list(key), "left")
    return joined.withColumn(flag, holds(F.col(_MARK))).drop(_MARK)


def join_split(
    left: DataFrame, lookup: DataFrame, key: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Matched rows with the lookup's columns, and unmatched rows."""
    matched = left.join(lookup, list(key), "inner")
    unmatched = left.join(lookup.select(*key), list(key), "left_anti")
    return matched, unmatched


def matched_keys(incoming: DataFrame, target: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys of ``incoming`` that ``target`` holds.

    The target is the left side of a semi join: a small batch is then broadcast to it and the
    target is read once, keys only, without being shuffled. The batch's keys are made distinct
    first, as a key with many copies could not be split on that side of the join.
    """
    keys = list(key)
    return target.select(*keys).join(incoming.select(*keys).distinct(), keys, "left_semi")


def anti_join_new(
    incoming: DataFrame, target: DataFrame, key: Sequence[str], keys_from: DataFrame | None = None
) -> DataFrame:
    """Incoming rows whose key the target lacks; keys are joined, never collected.

    Where ``incoming`` has been deduplicated, ``keys_from`` names the plain input with the same
    keys, so that only its key columns are read again.
    """
    if keys_from is None:
        known = splittable(matched_keys(incoming, target, key))
    else:
        known = matched_keys(keys_from, target, key)
    return incoming.join(known, list(key), "left_anti")


def semi_join_skipped(incoming: DataFrame, target: DataFrame, key: Sequence[str]) -> DataFrame:
    """Incoming rows whose key the target already holds."""
    known = splittable(matched_keys(incoming, target, key))
    return incoming.join(known, list(key), "left_semi")
