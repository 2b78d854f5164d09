"""Number cleaning. ANSI mode makes a plain cast fail the job, so every cast here is a try_cast."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillsift.functions.text import strip_text

MONEY = "decimal(12,2)"

# Spark also reads Java suffixes and hex floats ("5d", "0x1p3") as doubles; these are not numbers here.
_NUMBER = r"(?i)\A[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity)\z"


def to_number(c: Column) -> Column:
    """Double, or NULL for text that is no number. Never NaN."""
    text = strip_text(c.cast("string"))
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def to_int(c: Column) -> Column:
    """Whole number, or NULL; a decimal point makes the text no whole number."""
    return strip_text(c.cast("string")).try_cast("bigint")


def to_money(c: Column) -> Column:
    return c.try_cast(MONEY)


def clean_amount(c: Column, to: str = MONEY) -> Column:
    """Amount such as ``$1,299.99`` as a decimal."""
    return strip_text(F.regexp_replace(c, "[$,]", "")).try_cast(to)


def amount_is_dirty(c: Column) -> Column:
    return F.coalesce(c.rlike("[$,]"), F.lit(False))


def clean_quantity(c: Column) -> Column:
    """Quantity such as ``5 units`` as an integer.

    The sign and a decimal point are read, not deleted: ``-3`` stays negative, ``2.0`` is 2, and
    a value with a fraction is NULL, to be rejected rather than truncated.
    """
    text = strip_text(c.cast("string"))
    bare = F.regexp_replace(text, r"(?i)\s*units?\z", "")
    # Plain numbers, the usual case, are read without the regular expression.
    number = F.coalesce(text.try_cast("decimal(20,6)"), bare.try_cast("decimal(20,6)"))
    return F.when(number == F.floor(number), number.try_cast("int"))


def fill_const(c: Column, value: Any) -> Column:
    return F.coalesce(c, F.lit(value))


def round_dec(c: Column, digits: int = 2) -> Column:
    return F.round(c, digits)
