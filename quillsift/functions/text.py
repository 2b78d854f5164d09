"""Text cleaning."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python counts as whitespace, the no-break space among them.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip_text(c: Column) -> Column:
    """Remove surrounding whitespace of every kind, not just spaces as plain ``trim`` does.

    A character set needs no regular expression, so only the ends of the text are looked at.
    """
    return F.btrim(c, F.lit(WHITESPACE))


def clean_text(c: Column) -> Column:
    return F.lower(strip_text(c))


def upper_text(c: Column) -> Column:
    return F.upper(c)


def blank_to_null(c: Column, na_values: Iterable[str] = ()) -> Column:
    """NULL for blank text and for the listed spellings of a missing value."""
    stripped = strip_text(c)
    return F.when(~stripped.isin("", *na_values), c)


def file_basename(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/\\]*)\z", 1)


def file_dirname(path: Column) -> Column:
    return F.regexp_extract(path, r"\A(.*)[/\\][^/\\]*\z", 1)


def file_stem(path: Column) -> Column:
    """Base name without its last extension; a leading dot is part of the name."""
    return F.regexp_replace(file_basename(path), r"(?<=[^.])\.[^.]*\z", "")
