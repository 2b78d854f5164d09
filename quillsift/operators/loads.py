"""Keyed loads and row changes as functions from a target to its next state.

Nothing is changed in place: the result is written as a new snapshot (``sources.snapshots``) and
readers switch afterwards.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsift.operators.dedup import dedup_keep_first
from quillsift.operators.filters import holds
from quillsift.operators.joins import (
    anti_join_new,
    join_left_flag,
    matched_keys,
    semi_join_skipped,
    splittable,
)

_HIT = "_change_row"
COPIES, KNOWN = "key_copies", "is_known"


class Load(NamedTuple):
    table: DataFrame
    added: DataFrame
    skipped: DataFrame


def load_new_only(
    target: DataFrame, incoming: DataFrame, key: Sequence[str], order: Sequence[str | Column]
) -> Load:
    """Add the rows whose key the target lacks; of several with one key the first in order.

    ``skipped`` holds every incoming row whose key was already loaded.
    """
    # Copies go before the join: a key with very many of them then joins as one row.
    unique = dedup_keep_first(incoming, key, order)
    added = anti_join_new(unique, target, key, keys_from=incoming).select(*target.columns)
    return Load(target.unionByName(added), added, semi_join_skipped(incoming, target, key))


load_do_nothing = load_new_only


def load_counts(load: Load, incoming: DataFrame) -> DataFrame:
    """Incoming, really added and skipped rows, and copies dropped within the batch."""
    parts = {"incoming": incoming, "added": load.added, "skipped": load.skipped}
    counts = None
    for name, df in parts.items():
        one = df.agg(F.count("*").alias("n")).withColumn("part", F.lit(name))
        counts = one if counts is None else counts.unionByName(one)
    total = {n: F.sum(F.when(F.col("part") == n, F.col("n")).otherwise(0)) for n in parts}
    return counts.agg(
        *[c.alias(f"{n}_rows") for n, c in total.items()],
        (total["incoming"] - total["added"] - total["skipped"]).alias("duplicate_rows"),
    )


def keys_of_load(target: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """Each different key of ``incoming`` with its ``copies`` and whether the target holds it
    (``is_known``).

    Copies are counted before anything is joined, so that a key with very many is one row; the keys
    alone are matched with the target, which is read once.
    """
    keys = incoming.groupBy(*key).agg(F.count(F.lit(1)).alias(COPIES))
    known = splittable(matched_keys(keys, target, key)).distinct()
    return join_left_flag(keys, known, key, KNOWN)


def counts_of_keys(keys: DataFrame) -> DataFrame:
    """What a load of new keys does, from ``keys_of_load`` alone: incoming, added and skipped rows,
    and copies dropped within the batch."""
    copies, new = F.col(COPIES), ~F.col(KNOWN)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return keys.agg(
        total(copies).alias("incoming_rows"),
        F.count_if(new).alias("added_rows"),
        total(F.when(~new, copies)).alias("skipped_rows"),
        total(F.when(new, copies - 1)).alias("duplicate_rows"),
    )


def upsert_replace(
    target: DataFrame, incoming: DataFrame, key: Sequence[str], latest: Sequence[str]
) -> DataFrame:
    """Replace whole rows by key; of several incoming rows the one with the highest ``latest`` wins.

    Only the incoming keys are joined to the target, so a small batch is broadcast and the target
    is not shuffled.
    """
    winners = dedup_keep_first(incoming, key, [F.desc_nulls_last(c) for c in latest])
    kept = target.join(winners.select(*key), list(key), "left_anti")
    return kept.unionByName(winners.select(*target.columns))


def upsert_update(
    target: DataFrame,
    incoming: DataFrame,
    key: Sequence[str],
    update: Sequence[str],
    latest: Sequence[str],
) -> DataFrame:
    """Overwrite the listed columns of known keys and add unknown ones.

    A left join and an insert instead of a full outer join: the latter must shuffle the whole
    target, while here a small batch is broadcast to it.
    """
    keys = list(key)
    winners = dedup_keep_first(incoming, keys, [F.desc_nulls_last(c) for c in latest])
    changes = winners.select(
        *keys, *[F.col(c).alias(f"_new_{c}") for c in update], F.lit(True).alias(_HIT)
    )
    joined = target.join(changes, keys, "left")
    changed = joined.withColumns(
        {
            c: F.when(holds(F.col(_HIT)), F.col(f"_new_{c}")).otherwise(F.col(c))
            for c in update
        }
    ).select(*target.columns)
    inserts = anti_join_new(winners, target, keys, keys_from=incoming)
    return changed.unionByName(inserts.select(*target.columns))


def update_where(target: DataFrame, rule: Column, values: Mapping[str, Any]) -> DataFrame:
    """Set columns where the rule holds; values may be expressions over the old row."""
    hit = holds(rule)
    return target.withColumns(
        {
            c: F.when(hit, v if isinstance(v, Column) else F.lit(v))
            .otherwise(F.col(c))
            .cast(target.schema[c].dataType)
            for c, v in values.items()
        }
    )


def update_expr_returning(
    target: DataFrame, rule: Column, values: Mapping[str, Any], returning: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """The next state, and the new values of the rows that changed."""
    # The rule is judged on the old row, so it is fixed before any column changes.
    marked = target.withColumn(_HIT, holds(rule))
    updated = update_where(marked, F.col(_HIT), values)
    return updated.drop(_HIT), updated.where(_HIT).select(*returning)


def delete_where(target: DataFrame, rule: Column) -> DataFrame:
    """Drop the rows where the rule holds; rows where it is unknown stay."""
    return target.where(~holds(rule))
