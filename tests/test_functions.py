"""Scalar cleaning, where most wrong answers hide."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from quillsift import functions as qf


def test_clean_text_strips_what_python_strips(one):
    values = ["  Ann \t", "\n Bob ", "\x1fEve\x1c", "a  b", "   ", "", None]
    assert one(qf.clean_text, values) == ["ann", "bob", "eve", "a  b", "", "", None]
    assert one(qf.strip_text, values[:3]) == [v.strip() for v in values[:3]]


def test_strip_agrees_with_python_on_every_character(one):
    values = [f"{chr(i)}x{chr(i)}" for i in range(1, 0x3100)]
    assert one(qf.strip_text, values) == [v.strip() for v in values]


def test_strip_handles_long_inner_runs(one):
    text = "a" + " " * 50_000 + "b"
    assert one(qf.strip_text, [text + "  "]) == [text]


def test_blank_to_null(one):
    values = ["x", " ", "", None, "N/A", " null ", "n/a"]
    got = one(lambda c: qf.blank_to_null(c, ["N/A", "null"]), values)
    assert got == ["x", None, None, None, None, None, "n/a"]


def test_to_number_coerces(one):
    values = ["85000", " 7.5 ", "-.5", "1e3", "N/A", "", "NaN", "5d", "0x1p3", "1,000", None]
    want = [85000.0, 7.5, -0.5, 1000.0, None, None, None, None, None, None, None]
    assert one(qf.to_number, values) == want
    assert one(qf.to_number, ["inf", "-Infinity"]) == [float("inf"), float("-inf")]


def test_to_int_wants_whole_numbers(one):
    values = ["42", " -7 ", "85.0", "85_000", "x", None, "99999999999999999999"]
    assert one(qf.to_int, values) == [42, -7, None, None, None, None, None]


def test_clean_amount(one):
    values = ["$1,299.99", "15.5", "-3", "free", None, "99999999999999"]
    want = [Decimal("1299.99"), Decimal("15.50"), Decimal("-3.00"), None, None, None]
    assert one(qf.clean_amount, values) == want
    assert one(qf.amount_is_dirty, values) == [True, False, False, False, False, False]


def test_clean_quantity_keeps_sign_and_point(one):
    values = ["5 units", "1 unit", " 7 ", "-3", "2.0", "2.5", "many", "", None, "99999999999"]
    assert one(qf.clean_quantity, values) == [5, 1, 7, -3, 2, None, None, None, None, None]


def test_parse_mixed_dates_in_order(one):
    values = ["2024-01-15", "01/15/2024", "15-01-2024", "2024-1-5", "03/04/2024", "soon", None]
    want = [
        dt.date(2024, 1, 15),
        dt.date(2024, 1, 15),
        dt.date(2024, 1, 15),
        dt.date(2024, 1, 5),
        dt.date(2024, 3, 4),
        None,
        None,
    ]
    assert one(qf.parse_mixed_dates, values) == want


def test_parse_date_rejects_other_forms(one):
    assert one(qf.parse_date, ["2024-02-30", "2024-02-28", "x"]) == [
        None,
        dt.date(2024, 2, 28),
        None,
    ]


def test_dates_to_text_and_years(one):
    days = [dt.date(2024, 3, 9), None]
    styles = ["year_month", "day", "year", "month_name"]
    got = [one(lambda c, s=s: qf.format_month(c, s), days, "date") for s in styles]
    assert got == [["2024-03", None], ["2024-03-09", None], ["2024", None], ["March 2024", None]]
    assert one(lambda c: qf.years_since(c, 2026), days, "date") == [2, None]


def test_band_limits_are_inclusive(one):
    values = [95000.0, 90000.0, 89999.99, 60000.0, 59999.0, None]
    want = ["high", "high", "mid", "mid", "low", "low"]
    assert one(qf.derive_band, values, "double") == want
    assert one(lambda c: qf.derive_band(c, high=80000), [80000.0], "double") == ["high"]


def test_path_parts(one):
    paths = ["data/files/jan.csv", r"data\files\feb.csv", "mar.csv", "a/b.tar.gz", "a/.hidden", "a/"]
    assert one(qf.file_basename, paths) == [
        "jan.csv",
        "feb.csv",
        "mar.csv",
        "b.tar.gz",
        ".hidden",
        "",
    ]
    assert one(qf.file_dirname, paths) == ["data/files", r"data\files", "", "a", "a", "a"]
    assert one(qf.file_stem, paths) == ["jan", "feb", "mar", "b.tar", ".hidden", ""]
