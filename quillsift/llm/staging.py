"""Tables that the operators write between their steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsift.session import run_folder


def staged(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """``df`` written below ``spark.checkpoint.dir`` and read again: lineage ends here, so that a
    lost executor costs a read and not the work before it."""
    path = run_folder(spark, label)
    df.write.parquet(path)
    return spark.read.parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def full_text(column: str = "text") -> Column:
    """The whole text; a null text counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def boxed(docs: DataFrame) -> DataFrame:
    """Each row as a struct ``row`` beside its text, so that no other column name can clash."""
    return docs.select(F.struct("*").alias("row"), F.col("text"))


def unboxed(df: DataFrame, columns: list[str], **fresh: Column) -> DataFrame:
    """The ``columns`` of ``row`` again, those in ``fresh`` replaced."""
    return df.select(*[fresh.get(c, F.col("row")[c]).alias(c) for c in columns])


def with_new_text(df: DataFrame, columns: list[str], text: Column, changed: Column) -> DataFrame:
    """``row`` unboxed with another text, and n_chars set where the text was changed."""
    fresh = {"text": F.when(changed, text).otherwise(F.col("row.text"))}
    if "n_chars" in columns:
        n = F.when(changed, F.length(text).cast("long")).otherwise(F.col("row.n_chars"))
        fresh["n_chars"] = n
    return unboxed(df, columns, **fresh)
