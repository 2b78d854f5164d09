"""A stored table kept in key ranges, of which a change rewrites only those it touches.

A range holds the keys that agree in their bits from some place (its shift) upwards, so that
neighbouring ids share a range. Ranges may lie within each other: a key belongs to the narrowest one.
A range that would come to hold too many rows is split into narrower ones when it is rewritten, and
stays as the range of the keys that none of those has. Rows lie in folders that never change; a
directory says which folders make up the table, one row per range. A change writes the folders of
the touched ranges (the stage) and then the next snapshot of the directory, which puts all of them in
place at once. One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillsift.operators.filters import holds
from quillsift.operators.loads import delete_where, update_where, upsert_replace
from quillsift.schemas import BIGINT, INT, TEXT, schema
from quillsift.sources.readers import empty_table
from quillsift.sources.snapshots import (
    _names,
    _remove,
    keyed,
    read_snapshot,
    write_snapshot,
)

ROWS_PER_RANGE = 4_000_000
SHIFT, PREFIX = "range_shift", "range_prefix"
_PLACE = "_place"
#: The widest ranges: one of the negative keys and one of the others.
TOP = 63

DIRECTORY = schema(
    range_shift=INT, range_prefix=BIGINT, stage=TEXT, rows=BIGINT, low=BIGINT, high=BIGINT
)


class Range(NamedTuple):
    """An entry of the directory; ``low`` and ``high`` are the ends of the keys it holds, and a
    range without rows has no stage."""

    range_shift: int
    range_prefix: int
    stage: str | None = None
    rows: int = 0
    low: int | None = None
    high: int | None = None

    @property
    def name(self) -> tuple[int, int]:
        return self.range_shift, self.range_prefix

    def folder(self, root: str) -> str:
        place = f"{SHIFT}={self.range_shift}/{PREFIX}={self.range_prefix}"
        return f"{root}/data/stage={self.stage}/{place}"


def directory(spark: SparkSession, root: str) -> dict[tuple[int, int], Range]:
    """The ranges of the table, a few for every ROWS_PER_RANGE rows."""
    rows = read_snapshot(spark, f"{root}/directory", DIRECTORY).collect()
    found = {r.name: r for r in (Range(*row) for row in rows)}
    return found or {r.name: r for r in (Range(TOP, 0), Range(TOP, -1))}


def _place(kinds: T.StructType, key: Sequence[str]) -> Column:
    """The number by which a key is placed: the key itself where it is one whole number or a date,
    otherwise its hash."""
    if len(key) == 1:
        dtype = kinds[key[0]].dataType
        if isinstance(dtype, T.IntegralType):
            return F.col(key[0]).cast("long")
        if isinstance(dtype, T.DateType):
            return F.unix_date(key[0]).cast("long")
    return F.xxhash64(*key)


def _prefix(place: Column, shift: Column) -> Column:
    return F.call_function("shiftright", place, shift)


def _read(
    spark: SparkSession, root: str, kinds: T.StructType, ranges: Sequence[Range]
) -> DataFrame:
    """The rows of some ranges, each with its range."""
    wanted = T.StructType([*kinds.fields, *DIRECTORY.fields[:2]])
    folders = [r.folder(root) for r in ranges if r.rows]
    if not folders:
        return empty_table(spark, wanted)
    stored = spark.read.schema(wanted).option("basePath", f"{root}/data").parquet(*folders)
    return stored.select(*wanted.fieldNames())


def read_ranged(spark: SparkSession, root: str, kinds: T.StructType) -> DataFrame:
    """The table as the newest directory has it, or an empty one before the first change."""
    ranges = list(directory(spark, root).values())
    return _read(spark, root, kinds, ranges).select(*kinds.fieldNames())


def _routed(rows: DataFrame, place: Column, ranges: Sequence[Range]) -> DataFrame:
    """Each row with its range: the narrowest that has its key. One join for each width there is,
    of which a table has a few."""
    spark, columns = rows.sparkSession, rows.columns
    rows = rows.withColumn(_PLACE, place)
    found = F.lit(TOP)
    for width in sorted({r.range_shift for r in ranges} - {TOP}, reverse=True):
        known = spark.createDataFrame(
            [(r.range_prefix, True) for r in ranges if r.range_shift == width],
            f"_prefix_{width} LONG, _in_{width} BOOLEAN",
        )
        prefix = _prefix(F.col(_PLACE), F.lit(width))
        rows = rows.join(known, prefix == F.col(f"_prefix_{width}"), "left")
        found = F.when(F.col(f"_in_{width}"), F.lit(width)).otherwise(found)
    rows = rows.withColumn(SHIFT, found)
    return rows.select(*columns, _PLACE, SHIFT, _prefix(F.col(_PLACE), F.col(SHIFT)).alias(PREFIX))


def split_width(r: Range, incoming: int, low: int, high: int, limit: int) -> int | None:
    """The width into which a range has to be split before it takes so many more rows with keys
    from ``low`` to ``high``; None if they fit or there is but one key."""
    expected = r.rows + incoming
    if expected <= limit:
        return None
    low = low if r.low is None else min(low, r.low)
    high = high if r.high is None else max(high, r.high)
    apart = (low ^ high).bit_length()
    wanted = (-(-expected // limit) - 1).bit_length()
    return max(0, apart - wanted) if apart else None


def _install(
    spark: SparkSession,
    root: str,
    stage: str,
    kinds: T.StructType,
    place: Column,
    replaced: Sequence[Range],
    keep: int | None,
) -> None:
    """Put a written stage in place of the ranges it was made from.

    The directory's next snapshot is the only thing that changes the table. Before it, a stage is
    unknown to all readers, and after a crash the next change retires it.
    """
    ranges = directory(spark, root)
    for r in replaced:
        ranges[r.name] = Range(*r.name)
    if _names(spark, f"{root}/data/stage={stage}/{SHIFT}=*"):
        wanted = T.StructType([*kinds.fields, *DIRECTORY.fields[:2]])
        written = spark.read.schema(wanted).parquet(f"{root}/data/stage={stage}")
        counts = written.groupBy(SHIFT, PREFIX).agg(
            F.count(F.lit(1)).alias("rows"), F.min(place).alias("low"), F.max(place).alias("high")
        )
        for c in counts.collect():
            ranges[c[0], c[1]] = Range(c[0], c[1], stage, c.rows, c.low, c.high)
    entries = spark.createDataFrame([tuple(r) for r in ranges.values()], DIRECTORY)
    write_snapshot(entries.coalesce(1), f"{root}/directory", keep)
    if keep is not None:
        _retire(spark, root)


def _retire(spark: SparkSession, root: str) -> None:
    """Remove the folders that no kept directory names; readers of older ones must have ended."""
    kept = spark.read.schema(DIRECTORY).parquet(f"{root}/directory").where("rows > 0")
    named = kept.select("stage", SHIFT, PREFIX).distinct().collect()
    used = {f"stage={r.stage}/{SHIFT}={r[SHIFT]}/{PREFIX}={r[PREFIX]}" for r in named}
    for folder in _names(spark, f"{root}/data/*/*/*"):
        if "/".join(folder.rsplit("/", 3)[1:]) not in used and PREFIX in folder.rsplit("/", 1)[1]:
            _remove(spark, folder)


def _write(rows: DataFrame, root: str) -> str:
    """Write rows by their range and return the stage; a range goes to one task and one file."""
    stage = uuid.uuid4().hex
    dealt = rows.repartition(SHIFT, PREFIX)
    dealt.write.partitionBy(SHIFT, PREFIX).parquet(f"{root}/data/stage={stage}")
    return stage


def upsert_ranged(
    spark: SparkSession,
    root: str,
    incoming: DataFrame,
    key: Sequence[str],
    latest: Sequence[str],
    keep: int | None = 2,
    rows_per_range: int = ROWS_PER_RANGE,
) -> None:
    """Replace or add whole rows by key; of several incoming rows the one with the highest
    ``latest`` wins.

    Only ranges that hold a key of the batch are read and written. ``keep`` is how many of the
    newest directories stay readable; None keeps all. A rerun of a batch changes nothing more.
    """
    kinds, key = incoming.schema, list(key)
    place = _place(kinds, key)
    ranges = directory(spark, root)
    routed = _routed(keyed(incoming, key), place, list(ranges.values()))
    met = routed.groupBy(SHIFT, PREFIX).agg(
        F.count(F.lit(1)).alias("rows"), F.min(_PLACE).alias("low"), F.max(_PLACE).alias("high")
    )
    met = {(r[0], r[1]): r for r in met.collect()}
    if not met:
        return
    touched = [ranges[name] for name in met]
    widths = {
        r.name: split_width(r, met[r.name].rows, met[r.name].low, met[r.name].high, rows_per_range)
        for r in touched
    }
    current = _read(spark, root, kinds, touched)
    merged = upsert_replace(current, routed.select(*current.columns), key, latest)
    split = [(*name, width) for name, width in widths.items() if width is not None]
    if split:
        new = spark.createDataFrame(split, f"{SHIFT} INT, {PREFIX} LONG, _width INT")
        merged = merged.join(new, [SHIFT, PREFIX], "left").withColumns(
            {SHIFT: F.coalesce("_width", SHIFT), _PLACE: place}
        )
        merged = merged.withColumn(PREFIX, _prefix(F.col(_PLACE), F.col(SHIFT)))
        merged = merged.select(*current.columns)
    _install(spark, root, _write(merged, root), kinds, place, touched, keep)


def _change_where(
    spark: SparkSession,
    root: str,
    kinds: T.StructType,
    key: Sequence[str],
    rule: Column,
    change: Callable[[DataFrame], DataFrame],
    keep: int | None,
) -> int:
    """Apply a change to the ranges that have a row for which the rule holds; returns how many."""
    ranges = directory(spark, root)
    every = _read(spark, root, kinds, list(ranges.values()))
    hit = every.where(holds(rule)).select(SHIFT, PREFIX).distinct().collect()
    touched = [ranges[r[0], r[1]] for r in hit]
    if touched:
        stage = _write(change(_read(spark, root, kinds, touched)), root)
        _install(spark, root, stage, kinds, _place(kinds, list(key)), touched, keep)
    return len(touched)


def update_ranged(
    spark: SparkSession,
    root: str,
    kinds: T.StructType,
    key: Sequence[str],
    rule: Column,
    values: Mapping[str, Any],
    keep: int | None = 2,
) -> int:
    """``update_where`` on a ranged table; returns how many ranges were rewritten. A key cannot be
    set, as its row might then belong to another range."""
    if set(values) & set(key):
        raise ValueError("a key of a ranged table cannot be set")
    change = lambda rows: update_where(rows, rule, values)
    return _change_where(spark, root, kinds, key, rule, change, keep)


def delete_ranged(
    spark: SparkSession,
    root: str,
    kinds: T.StructType,
    key: Sequence[str],
    rule: Column,
    keep: int | None = 2,
) -> int:
    """``delete_where`` on a ranged table; returns how many ranges were rewritten."""
    return _change_where(spark, root, kinds, key, rule, lambda rows: delete_where(rows, rule), keep)
