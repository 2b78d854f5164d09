"""Column functions: each takes and returns a Column and stays inside code generation."""

from quillsift.functions.bands import derive_band
from quillsift.functions.dates import (
    MIXED_DATE_PATTERNS,
    date_parts,
    format_month,
    parse_date,
    parse_mixed_dates,
    years_since,
)
from quillsift.functions.numbers import (
    amount_is_dirty,
    clean_amount,
    clean_quantity,
    fill_const,
    round_dec,
    to_int,
    to_money,
    to_number,
)
from quillsift.functions.text import (
    blank_to_null,
    clean_text,
    file_basename,
    file_dirname,
    file_stem,
    strip_text,
    upper_text,
)

__all__ = [
    "MIXED_DATE_PATTERNS",
    "amount_is_dirty",
    "blank_to_null",
    "clean_amount",
    "clean_quantity",
    "clean_text",
    "date_parts",
    "derive_band",
    "file_basename",
    "file_dirname",
    "file_stem",
    "fill_const",
    "format_month",
    "parse_date",
    "parse_mixed_dates",
    "round_dec",
    "strip_text",
    "to_int",
    "to_money",
    "to_number",
    "upper_text",
    "years_since",
]
