"""Exact percentiles of many columns at once, each in its own type.

A radix selection: one pass counts, for all columns together, the values in a few thousand slices
between a column's ends; only the slices that hold a wanted rank are looked at again, cut into finer
slices or, once they are small, into their values. What a pass groups and what comes to the driver
does not grow with the table: a bounded number of slices per column, and two per wanted rank.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from fractions import Fraction
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICES = 4096
#: Slices with so many rows or fewer are counted by value.
SMALL = 200_000


class Part(NamedTuple):
    """Values of a column from ``low`` to ``high``: ``below`` rows are smaller, ``rows`` lie within."""

    column: int
    low: Any
    high: Any
    below: int
    rows: int


def _is_whole(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.IntegralType) or (
        isinstance(dtype, T.DecimalType) and dtype.precision <= 18
    )


def measured(df: DataFrame, column: str) -> Column:
    """A column's values as they are selected: whole numbers as longs, money by its smallest unit,
    others as doubles without NaN, which counts as missing."""
    dtype, c = df.schema[column].dataType, F.col(column)
    if isinstance(dtype, T.IntegralType):
        return c.cast("bigint")
    if isinstance(dtype, T.DecimalType) and dtype.precision <= 18:
        return (c * F.lit(Decimal(10**dtype.scale))).cast("bigint")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        value = c.cast("double")
        # Minus zero equals zero and must not be a value beside it.
        return F.when(~F.isnan(value), F.when(value == 0, F.lit(0.0)).otherwise(value))
    raise TypeError(f"no percentiles at once for values of type {dtype.simpleString()}")


def as_selected(dtype: T.DataType, value: Any) -> Any:
    """A selected value in the type of its column."""
    if isinstance(dtype, T.DecimalType):
        return Decimal(value).scaleb(-dtype.scale)
    return value


def supported(dtype: T.DataType) -> bool:
    return _is_whole(dtype) or isinstance(dtype, (T.FloatType, T.DoubleType))


def _slice(value: Column, part: Part, whole: bool) -> Column:
    """A number from 0 to about SLICES that never falls as the value grows from low to high."""
    if whole:
        shift = max(0, (part.high - part.low).bit_length() - (SLICES - 1).bit_length())
        while (part.high >> shift) - (part.low >> shift) > SLICES:
            shift += 1
        return F.shiftright(value, shift) - F.lit(part.low >> shift)
    inf = float("inf")
    if part.low == -inf or part.high == inf:
        # Endless values get slices of their own; the others meet again in the next pass.
        return F.when(value == -inf, 0).when(value == inf, 2).otherwise(1).cast("bigint")
    half = 0.5 if part.high - part.low == inf else 1.0
    span = part.high * half - part.low * half
    share = (value * half - part.low * half) / F.lit(span)
    return F.least(F.floor(share * SLICES), F.lit(SLICES)).cast("bigint")


def _counted(df: DataFrame, names: Sequence[str], parts: Sequence[Part], by_value: bool) -> DataFrame:
    """part, rows, and least and largest value (``wl``, ``wh`` of whole numbers, ``rl``, ``rh`` of
    others) of each slice of each part, or of each value, with the rows of the part before it."""
    cells = []
    for at, name in enumerate(names):
        whole = _is_whole(df.schema[name].dataType)
        own = [(k, p) for k, p in enumerate(parts) if p.column == at]
        value = F.col(f"_{at}")
        part, place = F.lit(None).cast("int"), F.lit(None).cast("bigint")
        for k, p in own:
            inside = value.between(F.lit(p.low), F.lit(p.high))
            part = F.when(inside, F.lit(k)).otherwise(part)
            if not by_value:
                place = F.when(inside, _slice(value, p, whole)).otherwise(place)
        none_long, none_double = F.lit(None).cast("bigint"), F.lit(None).cast("double")
        if own:
            cells.append(
                F.struct(
                    part.alias("part"),
                    place.alias("slice"),
                    (value if whole else none_long).alias("w"),
                    (none_double if whole else value).alias("r"),
                )
            )
    values = df.select(*[measured(df, n).alias(f"_{i}") for i, n in enumerate(names)])
    rows = values.select(F.inline(F.array(*cells))).where("part IS NOT NULL")
    keys = ["part", "w", "r"] if by_value else ["part", "slice"]
    if by_value:
        ends = [F.col("w").alias("wl"), F.col("w").alias("wh"), F.col("r").alias("rl"), F.col("r").alias("rh")]
        sums = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).select("part", "rows", *ends)
    else:
        sums = rows.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("rows"),
            F.min("w").alias("wl"), F.max("w").alias("wh"),
            F.min("r").alias("rl"), F.max("r").alias("rh"),
        )
    # At most SLICES + 1 rows of a part, or SMALL.
    before = Window.partitionBy("part").orderBy("wl", "rl").rowsBetween(Window.unboundedPreceding, -1)
    return sums.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0)))


def percentiles_at_once(
    df: DataFrame,
    ends: Mapping[str, tuple[Any, Any, int]],
    shares: Mapping[str, float],
) -> dict[str, dict[str, tuple[Any, Any, Fraction]]]:
    """For each column and share the values at the ranks around it, and the weight of the upper one.

    ``ends`` maps each column to its least value, its largest value (as ``measured`` has them) and
    its number of values; columns without values are left out. Takes two passes over ``df`` up to
    hundreds of millions of rows spread evenly, and one more for every further thousandfold.
    """
    names = [n for n, (_, _, rows) in ends.items() if rows]
    wanted: dict[int, dict[int, Any]] = {}
    ranks: dict[str, dict[str, tuple[int, int, Fraction]]] = {}
    parts = []
    for at, name in enumerate(names):
        low, high, rows = ends[name]
        ranks[name] = {}
        for label, share in shares.items():
            exact = (rows - 1) * Fraction(share)
            first = exact.numerator // exact.denominator
            ranks[name][label] = (first, min(first + 1, rows - 1), exact - first)
        wanted[at] = {r: None for a, b, w in ranks[name].values() for r in ((a, b) if w else (a,))}
        if low == high:
            wanted[at] = dict.fromkeys(wanted[at], low)
        else:
            parts.append(Part(at, low, high, 0, rows))
    while parts:
        next_parts = []
        for by_value in (True, False):
            chosen = [p for p in parts if (p.rows <= SMALL) == by_value]
            if not chosen:
                continue
            slices = _counted(df, names, chosen, by_value)
            hit = F.lit(False)
            for k, p in enumerate(chosen):
                for rank in wanted[p.column]:
                    within = F.lit(rank - p.below)
                    inside = (F.col("before") <= within) & (within < F.col("before") + F.col("rows"))
                    hit = hit | ((F.col("part") == k) & inside)
            for s in slices.where(hit).collect():
                p = chosen[s.part]
                low, high = (s.wl, s.wh) if s.wl is not None else (s.rl, s.rh)
                below = p.below + s.before
                if low == high:
                    for rank in wanted[p.column]:
                        if below <= rank < below + s.rows:
                            wanted[p.column][rank] = low
                else:
                    next_parts.append(Part(p.column, low, high, below, s.rows))
        parts = next_parts
    found: dict[str, dict[str, tuple[Any, Any, Fraction]]] = {}
    for at, name in enumerate(names):
        value = {r: as_selected(df.schema[name].dataType, v) for r, v in wanted[at].items()}
        found[name] = {
            label: (value[a], value[b] if w else value[a], w) for label, (a, b, w) in ranks[name].items()
        }
    return found
