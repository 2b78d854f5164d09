"""Date parsing and date parts."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillsift.functions.text import strip_text

# The date spellings tried in this order. One-letter months and days accept one or
# two digits.
MIXED_DATE_PATTERNS = ("yyyy-M-d", "M/d/yyyy", "d-M-yyyy")

# Month spellings offered by format_month.
MONTH_PATTERNS = {
    "year_month": "yyyy-MM",
    "day": "yyyy-MM-dd",
    "year": "yyyy",
    "month_name": "MMMM yyyy",
}


# What the letters of a numeric date pattern stand for.
_DIGITS = {"yyyy": r"\d{4}", "MM": r"\d{2}", "M": r"\d{1,2}", "dd": r"\d{2}", "d": r"\d{1,2}"}


def date_shape(pattern: str) -> str | None:
    """Regular expression of the text a numeric pattern can read, None for other patterns."""
    parts = re.findall(r"[A-Za-z]+|[^A-Za-z]+", pattern)
    if any(p[0].isalpha() and p not in _DIGITS for p in parts):
        return None
    return r"\A" + "".join(_DIGITS.get(p) or re.escape(p) for p in parts) + r"\z"


def parse_date(c: Column, pattern: str = "yyyy-M-d") -> Column:
    """Date, or NULL for text in another form.

    Text of another shape is sorted out before parsing: a failed parse raises and catches an
    exception inside the engine for every row, which costs far more than the check.
    """
    shape = date_shape(pattern)
    parsed = F.try_to_date(c, pattern)
    return parsed if shape is None else F.when(c.rlike(shape), parsed)


def parse_mixed_dates(c: Column, patterns: Sequence[str] = MIXED_DATE_PATTERNS) -> Column:
    """Date by the first pattern that fits, or NULL."""
    text = strip_text(c)
    return F.coalesce(*[parse_date(text, p) for p in patterns])


def date_parts(c: Column, prefix: str = "") -> list[Column]:
    """Year, month and quarter as three named columns."""
    return [
        F.year(c).alias(f"{prefix}year"),
        F.month(c).alias(f"{prefix}month"),
        F.quarter(c).alias(f"{prefix}quarter"),
    ]


def format_month(c: Column, style: str = "year_month") -> Column:
    return F.date_format(c, MONTH_PATTERNS[style])


def years_since(c: Column, as_of_year: int) -> Column:
    """Difference of calendar years; the reporting year is an argument so reruns agree."""
    return F.lit(as_of_year) - F.year(c)
