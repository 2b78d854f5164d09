"""Typed readers."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillsift.functions import blank_to_null, file_basename, parse_date

#: The raw text of a line that does not fit its schema; NULL on all others.
BROKEN = "broken_line"
_RAW = "_raw_line"
# The reason under which broken lines are rejected.
BROKEN_REASON = "line does not fit the schema"


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A table without rows, which the optimiser knows to be empty and drops from joins."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    return spark.range(1).select(*columns).where(F.lit(False))


def rows_to_df(
    spark: SparkSession,
    rows: Sequence[Mapping[str, Any]] | Mapping[str, Sequence[Any]],
    schema: T.StructType,
) -> DataFrame:
    """Literal rows, given as a list of records or as a mapping of columns."""
    names = schema.fieldNames()
    if isinstance(rows, Mapping):
        records = list(zip(*[rows[n] for n in names], strict=True))
    else:
        records = [tuple(row.get(n) for n in names) for row in rows]
    return spark.createDataFrame(records, schema)


def source_path() -> Column:
    """The path of each row's file as the file source writes it, with special signs encoded."""
    return F.col("_metadata.file_path")


def source_name() -> Column:
    """The base name of each row's file, decoded."""
    # A plus sign is itself in a path, and not an encoded blank.
    return file_basename(F.url_decode(F.replace(source_path(), F.lit("+"), F.lit("%2B"))))


def literal_path(path: str) -> str:
    """A path to be read as it is, although readers take paths for patterns."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def missing_to_null(
    df: DataFrame, na_values: Sequence[str] = (), skip: Sequence[str | None] = ()
) -> DataFrame:
    """Blank text and the listed spellings as NULL, in all text columns but those skipped."""
    text = [
        f.name
        for f in df.schema
        if isinstance(f.dataType, T.StringType) and f.name not in skip
    ]
    return df.withColumns({c: blank_to_null(F.col(c), na_values) for c in text})


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    sep: str = ",",
    header: bool = True,
    usecols: Sequence[str] | None = None,
    na_values: Sequence[str] = (),
    parse_dates: Mapping[str, str] | None = None,
) -> DataFrame:
    """CSV under a declared schema.

    Blank text and the listed spellings become NULL in text columns. ``parse_dates`` maps text
    columns to date patterns. Header names are checked against the schema, so reordered columns
    fail instead of being mixed up.
    """
    reader = spark.read.schema(schema).option("enforceSchema", not header)
    df = reader.csv(path, sep=sep, header=header)
    if usecols:
        df = df.select(*usecols)
    df = missing_to_null(df, na_values)
    dates = {c: parse_date(F.col(c), p) for c, p in (parse_dates or {}).items()}
    return df.withColumns(dates) if dates else df


def with_broken(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])


def keeping_broken(reader, schema: T.StructType):
    """A CSV reader, batch or stream, that keeps the text of lines that do not fit ``schema``; to be
    followed by :func:`without_halves`."""
    return (
        reader.schema(T.StructType([*schema.fields, T.StructField(_RAW, T.StringType())]))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _RAW)
        .option("columnPruning", False)
    )


def without_halves(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Broken lines without the values that were parsed from them: half a row must not pass for a
    whole one, and its text is kept."""
    names = schema.fieldNames()
    # Spark parses the columns that a query uses, and a field that is not parsed breaks no line. So
    # the text is tied to all of them, though it is the raw text whatever they hold.
    empty = reduce(Column.__and__, [F.col(c).isNull() for c in names])
    text = F.when(F.col(_RAW).isNotNull() | empty, F.col(_RAW))
    halves = {c: F.when(text.isNull(), F.col(c)).alias(c) for c in names}
    return df.select(*[text.alias(BROKEN) if c == _RAW else halves.get(c, F.col(c)) for c in df.columns])


def read_csv_checked(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    sep: str = ",",
    header: bool = True,
    na_values: Sequence[str] = (),
    parse_dates: Mapping[str, str] | None = None,
    source_column: str = "source_file",
) -> DataFrame:
    """CSV in which every line is accounted for: one row per line, blank lines and headers apart.

    A line with too few or too many fields, or with a field that its column's type cannot hold, is
    broken: it has its raw text in ``broken_line``, the name of its file, and NULL in all other
    columns. See :func:`split_broken`; to write both parts from one pass, stage the rows.
    """
    reader = keeping_broken(spark.read, schema).option("enforceSchema", not header)
    df = reader.csv(path, sep=sep, header=header)
    df = without_halves(df.select("*", source_name().alias(source_column)), schema)
    df = missing_to_null(df, na_values, skip=[BROKEN, source_column])
    dates = {c: parse_date(F.col(c), p) for c, p in (parse_dates or {}).items()}
    return df.withColumns(dates) if dates else df


def split_broken(df: DataFrame, source_column: str = "source_file") -> tuple[DataFrame, DataFrame]:
    """Sound rows, and rejects: the file, the raw text and the reason of each broken line."""
    sound = df.where(F.col(BROKEN).isNull()).drop(BROKEN)
    broken = df.where(F.col(BROKEN).isNotNull()).select(
        source_column, BROKEN, F.lit(BROKEN_REASON).alias("reject_reason")
    )
    return sound, broken


def read_csv_optional(
    spark: SparkSession, path: str, schema: T.StructType, **options: Any
) -> DataFrame:
    """As ``read_csv``; a path that does not exist gives an empty table."""
    try:
        return read_csv(spark, path, schema, **options)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_table(spark, schema)


def read_json_records(
    spark: SparkSession, path: str, schema: T.StructType, lines: bool = False
) -> DataFrame:
    """Records of a JSON array, or of JSON Lines with ``lines``.

    One array is one document and thus one task per file; large data belongs in JSON Lines.
    """
    return spark.read.schema(schema).json(path, multiLine=not lines)


def read_json_nested(
    spark: SparkSession, path: str, schema: T.StructType, key: str = "data", lines: bool = False
) -> DataFrame:
    """Records held in an array under a key of each document."""
    document = T.StructType([T.StructField(key, T.ArrayType(schema))])
    return spark.read.schema(document).json(path, multiLine=not lines).select(F.inline(key))


def _typed_records(texts: DataFrame, schema: T.StructType, source_column: str) -> DataFrame:
    """The records of ``record`` by the schema; a text that is no record, or has a value that its
    column cannot hold, stands in ``broken_line`` and has no values."""
    whole = T.StructType([*schema.fields, T.StructField(_RAW, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _RAW}
    parsed = texts.withColumn("typed", F.from_json("record", whole, options))
    # A text that is no object at all gives no struct.
    raw = F.when(F.col("typed").isNull(), F.col("record")).otherwise(F.col(f"typed.{_RAW}"))
    values = [F.when(raw.isNull(), F.col("typed")[c]).alias(c) for c in schema.fieldNames()]
    return parsed.select(*values, raw.alias(BROKEN), source_column)


def read_json_checked(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    key: str | None = None,
    source_column: str = "source_file",
) -> DataFrame:
    """Records of JSON documents that are arrays, or hold one under ``key``; none is lost.

    A record that is broken has its text in ``broken_line``, and the others of its document are read
    all the same: a document that is no JSON as a whole is cut between its records, at a comma
    between a closing and an opening brace. So a broken record must not hold records itself. A
    document without any record that can be told is one broken line.

    A document is one value of one task, so it has to fit there; see :func:`read_json_split`.
    """
    documents = spark.read.text(path, wholetext=True).select("value", source_name().alias(source_column))
    kind = "array<string>" if key is None else f"struct<`{key}`: array<string>>"
    parsed = F.from_json("value", kind)
    found = parsed if key is None else parsed[key]
    if key is None:
        body = F.regexp_extract("value", r"(?s)^\s*\[(.*)\]\s*$", 1)
    else:
        body = F.regexp_extract("value", rf'(?s)"{re.escape(key)}"\s*:\s*\[(.*)\]', 1)
    body = F.when(F.trim(body) == "", F.col("value")).otherwise(body)
    cut = F.transform(F.split(body, r"(?<=\})\s*,\s*(?=\{)"), lambda r: F.regexp_replace(r, r"^\s+|\s+$", ""))
    blank = F.col("value").rlike(r"^\s*$")
    records = F.when(blank, F.array().cast("array<string>")).otherwise(F.coalesce(found, cut))
    texts = documents.select(F.explode(records).alias("record"), source_column)
    return _typed_records(texts, schema, source_column)


def read_json_split(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    separator: str = "},\n",
    source_column: str = "source_file",
) -> DataFrame:
    """Records of large JSON arrays, of which several tasks read a part each.

    ``separator`` is how records end but the last: a closing brace, a comma and what follows, which
    must not occur within a record. Broken records are kept as :func:`read_json_checked` keeps them.
    """
    if not separator.startswith("}"):
        raise ValueError("a separator begins with the brace that closes a record")
    pieces = spark.read.text(path, lineSep=separator).select("value", source_name().alias(source_column))
    text = F.regexp_replace("value", r"^\s*\[?\s*", "")
    last = F.col("value").rlike(r"\]\s*$")
    record = F.when(last, F.regexp_replace(text, r"\s*\]\s*$", "")).otherwise(F.concat(text, F.lit("}")))
    texts = pieces.select(record.alias("record"), source_column)
    return _typed_records(texts.where("record <> ''"), schema, source_column)


def read_parquet(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None
) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_many(
    spark: SparkSession,
    pattern: str | list[str],
    schema: T.StructType,
    file_format: str = "csv",
    source_column: str | None = "source_file",
    key_column: str | None = None,
    keep_broken: bool = False,
) -> DataFrame:
    """All files matching the pattern as one table, with the name of each row's file.

    Blank text in CSV becomes NULL, as in ``read_csv``. ``key_column`` adds a hash of the file's
    whole path, which tells files of one name apart. ``keep_broken`` adds the text of CSV lines
    that do not fit the schema, as ``read_csv_checked`` does.
    """
    if keep_broken and file_format != "csv":
        raise ValueError("only CSV has broken lines")
    reader = keeping_broken(spark.read, schema) if keep_broken else spark.read.schema(schema)
    reader = reader.format(file_format)
    if file_format == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    df = reader.load(pattern)
    made = {source_column: source_name(), key_column: F.md5(source_path())}
    df = df.select("*", *[c.alias(name) for name, c in made.items() if name])
    if keep_broken:
        df = without_halves(df, schema)
    return missing_to_null(df, skip=[*made, BROKEN]) if file_format == "csv" else df


def file_inventory(spark: SparkSession, pattern: str | list[str]) -> DataFrame:
    """Path, name, format and size of each file; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(pattern)
    return files.select(
        source_path().alias("file_key"),
        "path",
        source_name().alias("file_name"),
        F.regexp_extract("path", r"\.([^./]+)\z", 1).alias("format"),
        (F.col("length") / 1024).alias("size_kb"),
    )
