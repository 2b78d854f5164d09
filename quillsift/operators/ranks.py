"""Exact percentiles and ranks that do not gather a group in one task.

``percentile`` and ``median`` keep every distinct value of a group in one task's buffer, and a
window sorts the group there. Here values are cut into slices by a monotone rule, and slices of
wide types into finer ones. A running total over the slices of one parent gives each slice its
starting rank, so that ranks inside a slice need only that slice. Whatever the type and the row
count, no window sees more than a few million rows.

With many groups, equal values are counted first, map-side included, so that copies cost nothing.
With few groups, percentiles count slices straight from the rows, which shuffles next to nothing,
and then look again at the rows of the slices that hold the wanted ranks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

_VALUE, _COUNT, _SLICE = "_value", "_copies", "_slice"
_SLICE_COUNT, _BELOW, _TOTAL = "_slice_copies", "_below", "_total"

# A group of up to so many different values is ranked whole, by one window, and not cut into slices.
WHOLE = 1_000_000
_VALUES = "_values"

# Decimal digits that one level of slices tells apart.
_DIGITS = 6


def _decimal_slice(value: Column, step: int) -> Column:
    """Multiples of ``10 ** step`` below the value."""
    scaled = value * Decimal(10**-step) if step < 0 else value / Decimal(10**step)
    return F.floor(scaled).cast("decimal(38,0)")


def _double_slices(value: Column) -> list[Column]:
    """By exponent, then by 21 bits of the mantissa, then by 21 more; ten bits are left.

    A power of two scales exactly, so no level decreases as the value grows, even where the
    logarithm is rounded across a power of two. Sizes below 2 ** -1000 share one exponent.
    """
    size = F.abs(value)
    sign = F.when(value < 0, -1).when(value > 0, 1).otherwise(0)
    endless = size == float("inf")
    exponent = F.when(
        (size > 0) & ~endless, F.greatest(F.floor(F.log2(size)), F.lit(-1000))
    ).otherwise(F.lit(0))
    half = F.floor(exponent / 2)
    scaled = size * F.pow(F.lit(2.0), -half) * F.pow(F.lit(2.0), half - exponent)
    fraction = F.when(endless | (size == 0), F.lit(0.0)).otherwise(scaled)
    step = float(1 << 21)
    upper = F.floor(fraction * step)
    lower = F.floor((fraction * step - upper) * step)
    return [
        (sign * F.when(endless, 3000).otherwise(exponent + 1500)).cast("bigint"),
        (sign * upper).cast("bigint"),
        (sign * lower).cast("bigint"),
    ]


def slice_levels(value: Column, dtype: T.DataType) -> list[Column]:
    """Slice numbers of a value from coarse to fine; none decreases as the value grows."""
    if isinstance(dtype, T.DecimalType):
        left = range(dtype.precision - _DIGITS, 0, -_DIGITS) or [0]
        return [_decimal_slice(value, digits - dtype.scale) for digits in left]
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return _double_slices(value.cast("double"))
    if isinstance(dtype, T.DateType):
        return [F.floor(F.unix_date(value) / 1024).cast("bigint")]
    if isinstance(dtype, T.TimestampNTZType):
        # Built from the parts, which no time zone changes.
        day = F.unix_date(value.cast("date")).cast("bigint")
        clock = F.hour(value) * 3600 + F.minute(value) * 60
        micros = (F.date_part(F.lit("SECOND"), value) * 1_000_000).cast("bigint")
        return slice_levels((day * 86_400 + clock) * 1_000_000 + micros, T.LongType())
    if isinstance(dtype, T.TimestampType):
        return slice_levels(F.unix_micros(value), T.LongType())
    if isinstance(dtype, T.LongType):
        return [F.shiftright(value, 42), F.shiftright(value, 21)]
    if isinstance(dtype, T.IntegralType):
        return [F.shiftright(value.cast("bigint"), 12)]
    raise TypeError(f"no ranks for values of type {dtype.simpleString()}")


def _comparable(df: DataFrame, column: str) -> Column:
    """The values to rank: NaN counts as missing, and minus zero as zero."""
    c = F.col(column)
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c), F.when(c == 0, F.abs(c)).otherwise(c))
    return c


def _sliced(
    df: DataFrame, keys: Sequence[str], column: str, count_first: bool
) -> tuple[DataFrame, list[str]]:
    """Keys, value, number of copies and slices, and the names of the slice columns.

    Rows without a key are left out. A missing value stays as a row with 0 copies, so that a
    group of missing values is not lost; having no copies, it moves no rank.
    """
    keyed = df.na.drop(subset=list(keys)) if keys else df
    rows = keyed.select(*keys, _comparable(df, column).alias(_VALUE))
    if count_first:
        rows = rows.groupBy(*keys, _VALUE).agg(F.count(_VALUE).alias(_COUNT))
    else:
        rows = rows.withColumn(_COUNT, F.col(_VALUE).isNotNull().cast("bigint"))
    levels = slice_levels(F.col(_VALUE), df.schema[column].dataType)
    slices = {f"{_SLICE}_{n}": F.coalesce(s, F.lit(0)) for n, s in enumerate(levels)}
    return rows.withColumns(slices), list(slices)


def _slice_starts(
    rows: DataFrame,
    keys: Sequence[str],
    slices: Sequence[str],
    wanted: Column | None = None,
    few_groups: bool = False,
) -> DataFrame:
    """Per finest slice: rows below it in its key, and all rows of its key.

    ``wanted`` keeps, level by level, only the slices that matter. With few groups these are a
    handful, and rows outside them are passed over before the next level is counted. Otherwise the
    finest slices are counted from the rows, and each coarser level from the one below it.
    """
    counted = {}
    if not few_groups:
        finer = rows.select("*", F.col(_COUNT).alias(_SLICE_COUNT))
        for level in reversed(range(len(slices))):
            groups = finer.groupBy(*keys, *slices[: level + 1])
            finer = counted[level] = groups.agg(F.sum(_SLICE_COUNT).alias(_SLICE_COUNT))
    starts = None
    for level, column in enumerate(slices):
        parent = [*keys, *slices[:level]]
        # Without keys the top window runs in one task over the bounded list of top slices.
        within = Window.partitionBy(*(parent or [F.lit(0)]))
        lower = within.orderBy(column).rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum(_SLICE_COUNT).over(lower), F.lit(0))
        if few_groups:
            if starts is not None:
                rows = rows.join(F.broadcast(starts.select(*parent)), parent, "left_semi")
            sums = rows.groupBy(*parent, column).agg(F.sum(_COUNT).alias(_SLICE_COUNT))
        else:
            sums = counted[level]
        if starts is None:
            total = F.sum(_SLICE_COUNT).over(within)
            starts = sums.withColumns({_BELOW: before, _TOTAL: total})
        else:
            placed = sums.join(starts.select(*parent, _BELOW, _TOTAL), parent)
            starts = placed.withColumn(_BELOW, F.col(_BELOW) + before)
        if wanted is not None:
            starts = starts.where(wanted)
    return starts.drop(_SLICE_COUNT)


def _rank_bounds(keys: Sequence[str], slices: Sequence[str]) -> tuple[Column, Column]:
    """First and last zero-based rank taken by the copies of a value."""
    upto = (
        Window.partitionBy(*keys, *slices)
        .orderBy(_VALUE)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    last = F.col(_BELOW) + F.sum(_COUNT).over(upto) - 1
    return last - F.col(_COUNT) + 1, last


def _ranked(
    rows: DataFrame, keys: Sequence[str], slices: Sequence[str], wanted: Column | None = None
) -> DataFrame:
    """Keys, different values with their copies, copies in the group, and first and last rank.

    Only groups of more than WHOLE different values are sliced: where there is none, Spark finds the
    list of such groups empty while it runs, and drops all levels of slices from the plan.
    """

    def bounded(near: DataFrame, within: Sequence[str]) -> DataFrame:
        first, last = _rank_bounds(keys, within)
        ends = first.alias("_first"), last.alias("_last")
        return near.select(*keys, _VALUE, _COUNT, _TOTAL, *ends)

    def cut(part: DataFrame) -> DataFrame:
        starts = _slice_starts(part, keys, slices, wanted)
        return bounded(part.join(starts, [*keys, *slices]), slices)

    if not keys:
        return cut(rows)
    sizes = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(_VALUES), F.sum(_COUNT).alias(_TOTAL)
    )
    fits = F.col(_VALUES) <= WHOLE
    whole = rows.join(sizes.where(fits).select(*keys, _TOTAL), keys)
    whole = whole.withColumn(_BELOW, F.lit(0).cast("bigint"))
    large = rows.join(sizes.where(~fits).select(*keys), keys, "left_semi")
    return bounded(whole, []).unionByName(cut(large))


def _position(share: float) -> tuple[Column, Column, Column]:
    """Lower rank, upper rank and the weight of the upper one for a percentile."""
    if share == 0.5:  # integer arithmetic: exact for any row count
        low = F.expr(f"({_TOTAL} - 1) div 2")
        high = F.expr(f"{_TOTAL} div 2")
        return low, high, (high - low) * F.lit(0.5)
    exact = (F.col(_TOTAL) - 1) * F.lit(share)
    return F.floor(exact), F.ceil(exact), exact - F.floor(exact)


def exact_percentiles(
    df: DataFrame,
    column: str,
    shares: Mapping[str, float],
    keys: Sequence[str] = (),
    few_groups: bool | None = None,
) -> DataFrame:
    """Exact, linearly interpolated percentiles per key, e.g. ``{"median": 0.5}``.

    A group whose values are all missing keeps its row, with NULL. A median of decimals stays a
    decimal; other percentiles are doubles. Say ``few_groups`` only where the number of groups is
    bounded, as without keys: two slices per share and group are then broadcast.
    """
    dtype = df.schema[column].dataType
    keys = list(keys)
    few = not keys if few_groups is None else few_groups
    rows, slices = _sliced(df, keys, column, count_first=not few)

    def inside(rank: Column) -> Column:
        return (rank >= F.col(_BELOW)) & (rank < F.col(_BELOW) + F.col(_SLICE_COUNT))

    wanted = F.col(_TOTAL) == 0
    for share in shares.values():
        low, high, _ = _position(share)
        wanted = wanted | inside(low) | inside(high)
    # At most two slices per share and key go on to the value-level ranks.
    if few:
        starts = _slice_starts(rows, keys, slices, wanted, few)
        near = (
            rows.join(F.broadcast(starts), [*keys, *slices])
            .groupBy(*keys, *slices, _VALUE, _BELOW, _TOTAL)
            .agg(F.sum(_COUNT).alias(_COUNT))
        )
        first, last = _rank_bounds(keys, slices)
        ranked = near.withColumns({"_first": first, "_last": last})
    else:
        ranked = _ranked(rows, keys, slices, wanted)

    def value_at(rank: Column) -> Column:
        return F.max(F.when(rank.between(F.col("_first"), F.col("_last")), F.col(_VALUE)))

    picks = []
    for name, share in shares.items():
        low, high, weight = _position(share)
        picks += [
            value_at(low).alias(f"{name}_low"),
            value_at(high).alias(f"{name}_high"),
            F.max(weight).alias(f"{name}_weight"),
        ]
    picked = ranked.groupBy(*keys).agg(*picks)

    def blend(name: str, share: float) -> Column:
        low, high = F.col(f"{name}_low"), F.col(f"{name}_high")
        if isinstance(dtype, T.DecimalType) and share == 0.5:
            middle = (low + high) / 2
            precision = min(dtype.precision + 1, 38)
            return middle.cast(T.DecimalType(precision, min(dtype.scale + 1, precision)))
        low, high = low.cast("double"), high.cast("double")
        return low + (high - low) * F.col(f"{name}_weight")

    return picked.select(*keys, *[blend(n, s).alias(n) for n, s in shares.items()])


def exact_median(df: DataFrame, column: str) -> DataFrame:
    return exact_percentiles(df, column, {"median": 0.5})


def fill_median(df: DataFrame, column: str) -> DataFrame:
    """Fill missing values with the column's exact median, computed before any other change.

    The median enters as a scalar subquery: one value, evaluated once.
    """
    dtype = df.schema[column].dataType
    median = exact_median(df, column).scalar()
    if isinstance(dtype, T.DecimalType):
        median = F.round(median, dtype.scale).cast(dtype)
    return df.withColumn(column, F.coalesce(F.col(column), median))


def window_rank_avg(
    df: DataFrame, keys: Sequence[str], column: str, name: str = "rank"
) -> DataFrame:
    """Ascending rank within the group on every row; ties share the average of their ranks.

    A missing value, and a row without a group, has no rank. Ranks are computed once per distinct
    value and joined back, so neither a large group nor a frequent value is held by one task.
    """
    keys = list(keys)
    counted, slices = _sliced(df, keys, column, count_first=True)
    average = ((F.col("_first") + F.col("_last")) / 2 + 1).cast("double")
    ranks = _ranked(counted, keys, slices).select(*keys, F.col(_VALUE).alias(column), average.alias(name))
    return df.join(ranks, [*keys, column], "left").select(*df.columns, name)
