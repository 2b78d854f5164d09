"""Employee flows."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsift.functions import clean_text, parse_date, to_int, to_money, years_since
from quillsift.operators.dedup import dedup_business_key
from quillsift.operators.joins import join_inner
from quillsift.operators.projections import add_band
from quillsift.operators.quality import quarantine, validate_columns
from quillsift.operators.ranks import fill_median
from quillsift.sources.readers import read_json_records
from quillsift.sources.writers import write_csv, write_json, write_parquet


def cleaned_employees(raw: DataFrame) -> DataFrame:
    return raw.withColumns({"name": clean_text(F.col("name")), "salary": to_int(F.col("salary"))})


def clean_employees(spark: SparkSession, raw: DataFrame, path: str) -> DataFrame:
    """Clean, write as JSON Lines, and read back."""
    cleaned = cleaned_employees(raw)
    write_json(cleaned, path)
    return read_json_records(spark, path, cleaned.schema, lines=True)


# Fixed value: what makes two employee rows the same person.
PERSON = ("name", "department", "join_date")


def employee_features(raw: DataFrame, as_of_year: int) -> DataFrame:
    """Clean, fill salaries with the median of all rows, keep one row per person, add features.

    Of several rows for one person the one with the lowest id stays.
    """
    cleaned = raw.withColumns(
        {
            "name": clean_text(F.col("name")),
            "salary": to_money(F.col("salary")),
            "join_date": parse_date(F.col("join_date")),
        }
    )
    unique = dedup_business_key(fill_median(cleaned, "salary"), PERSON, ["employee_id"])
    return add_band(unique, "salary").withColumn(
        "years_at_company", years_since(F.col("join_date"), as_of_year)
    )


def write_features(raw: DataFrame, as_of_year: int, path: str) -> None:
    write_csv(employee_features(raw, as_of_year), path, mode="replace")


def enrich(raw: DataFrame, path: str) -> DataFrame:
    """Add the salary band, replace the stored table and return it."""
    write_parquet(add_band(raw, "salary"), path, mode="replace")
    return raw.sparkSession.read.parquet(path)


class HrTables(NamedTuple):
    employees: DataFrame
    rejected: DataFrame


def hr(employees: DataFrame, salaries: DataFrame) -> HrTables:
    """Validate two sources on their own, keep who is valid in both, and quarantine the rest."""
    people, no_name = validate_columns(employees, ["name"])
    typed = salaries.withColumn("salary", to_money(F.col("salary")))
    paid, no_salary = validate_columns(typed, ["salary"], ["salary"])
    named = people.withColumn("name", clean_text(F.col("name")))
    joined = add_band(join_inner(named, paid, ["employee_id"]), "salary", "salary_band")
    final = joined.withColumn("join_date", parse_date(F.col("join_date")))
    return HrTables(final, quarantine(no_name, no_salary))
