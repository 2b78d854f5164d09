"""Threshold bands."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# Salary limits of the bands.
HIGH_FROM = 90000
MID_FROM = 60000


def derive_band(c: Column, high: Any = HIGH_FROM, mid: Any = MID_FROM) -> Column:
    """``high`` / ``mid`` / ``low``; a missing value compares false everywhere and is ``low``."""
    return F.when(c >= high, "high").when(c >= mid, "mid").otherwise("low")
