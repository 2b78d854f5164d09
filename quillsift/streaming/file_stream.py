"""Structured Streaming over arriving files.

``availableNow`` works through what has arrived in batches of whole files and stops; the
checkpoint remembers the files. A failed batch is run again under the same id with the same files,
so each batch overwrites only the folder it owns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillsift.operators.quality import FAILED, OK, Rules, flag_valid
from quillsift.plans.staging import STATUS, validity_status
from quillsift.schemas import CHUNKS
from quillsift.sources.readers import (
    BROKEN,
    BROKEN_REASON,
    keeping_broken,
    missing_to_null,
    source_name,
    source_path,
    with_broken,
    without_halves,
)
from quillsift.sources.snapshots import read_stored
from quillsift.streaming.ledger import BATCH, KEY, SOURCE

CHUNK = "batch_id"


def _file_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    files_per_batch: int,
    bytes_per_batch: int | None,
) -> DataFrame:
    """Rows of arriving files with their file's name and key, and lines that are broken."""
    reader = (
        keeping_broken(spark.readStream, schema)
        .option("header", True)
        .option("enforceSchema", False)
    )
    # The file source takes one of the two limits.
    if bytes_per_batch is None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    else:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    rows = without_halves(reader.csv(folder), schema)
    named = rows.select("*", source_name().alias(SOURCE), F.md5(source_path()).alias(KEY))
    return missing_to_null(named, skip=[BROKEN, SOURCE, KEY])


def _run_available(stream: DataFrame, write, checkpoint: str) -> None:
    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def file_ledger_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    files_per_batch: int = 10_000,
    bytes_per_batch: int | None = None,
) -> None:
    """Load every file of the folder once, a folder per batch; rows keep the key of their file's
    path, which tells files of one name apart. ``bytes_per_batch`` bounds a batch by the size of its
    files instead of their number."""
    stream = _file_stream(spark, folder, schema, files_per_batch, bytes_per_batch)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/{BATCH}={batch_id}")

    _run_available(stream, write, checkpoint)


def chunked_load(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    rules: Rules,
    target: str,
    checkpoint: str,
    files_per_batch: int = 10_000,
    log: str | None = None,
    bytes_per_batch: int | None = None,
) -> DataFrame:
    """Validate and load arriving files chunk by chunk; returns the loaded table.

    Valid and rejected rows are written in one pass, kept apart by ``row_status``; a line that does
    not fit the schema is rejected with its text. Rows of a chunk stay in its own folder, so running
    it again replaces them.

    ``log`` gets one row per chunk, see :func:`chunk_log`. Its counts are metrics observed in the
    write itself, which has no shuffle: each task's rows count once, when it succeeds. A chunk that
    is run again replaces its row.
    """
    stream = _file_stream(spark, folder, schema, files_per_batch, bytes_per_batch).drop(KEY)
    sound = F.col(BROKEN).isNull()
    judged = flag_valid(stream, rules)
    judged = judged.withColumns(
        {
            OK: F.col(OK) & sound,
            FAILED: F.when(sound, F.col(FAILED)).otherwise(F.array(F.lit(BROKEN_REASON))),
        }
    )
    flagged = judged.withColumn(STATUS, validity_status()).drop(OK)

    def write(batch: DataFrame, batch_id: int) -> None:
        # Both kinds of rows are written as they come, by a writer each, and not sorted before. The
        # session is the stream's own.
        batch.sparkSession.conf.set("spark.sql.maxConcurrentOutputFileWriters", 2)
        seen = Observation()
        valid = F.count_if(F.col(STATUS) == "valid")
        observed = batch.observe(seen, F.count(F.lit(1)).alias("rows"), valid.alias("valid"))
        observed.write.mode("overwrite").partitionBy(STATUS).parquet(f"{target}/{CHUNK}={batch_id}")
        if log is not None:
            rows, good = seen.get["rows"], seen.get["valid"]
            entry = spark.createDataFrame([(batch_id, rows, good, rows - good)], CHUNKS)
            entry.drop(CHUNK).coalesce(1).write.mode("overwrite").parquet(f"{log}/{CHUNK}={batch_id}")

    _run_available(flagged, write, checkpoint)
    extra = [
        T.StructField(SOURCE, T.StringType()),
        T.StructField(FAILED, T.ArrayType(T.StringType())),
        T.StructField(CHUNK, T.LongType()),
        T.StructField(STATUS, T.StringType()),
    ]
    return read_stored(spark, target, T.StructType([*with_broken(schema).fields, *extra]))


def chunk_counts(loaded: DataFrame) -> DataFrame:
    """Chunks and their valid and rejected rows, from the partition names alone."""
    return loaded.agg(
        F.count_distinct(CHUNK).alias("chunks"),
        F.count_if(F.col(STATUS) == "valid").alias("valid_rows"),
        F.count_if(F.col(STATUS) == "rejected").alias("rejected_rows"),
    )


def chunk_log(spark: SparkSession, log: str) -> DataFrame:
    """Each chunk's rows, valid and rejected rows, and the running totals up to it."""
    entries = read_stored(spark, log, CHUNKS)
    # One row per chunk, whatever its size.
    upto = Window.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = {f"total_{c}": F.sum(c).over(upto) for c in CHUNKS.fieldNames()[1:]}
    return entries.withColumns(totals)
