"""Batch file ledger: each file is loaded once, a rerun skips what succeeded.

Files are packed into batches of bounded size. The files of a batch are planned before it is loaded,
its rows have one folder, and its entries are written last, so that a batch is either entered or, at
the next run, loaded again as a whole: the same files into the same folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillsift.operators.audit import Run
from quillsift.schemas import LEDGER, LEDGER_PLAN
from quillsift.sources.readers import BROKEN, file_inventory, literal_path, read_many
from quillsift.sources.snapshots import read_stored

SOURCE, KEY, BATCH = "source_file", "file_key", "batch"
_TEXT = T.StringType()


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """One entry per loaded file: its batch, and its sound and broken rows."""
    return read_stored(spark, f"{ledger}/entries", LEDGER)


def _read_plan(spark: SparkSession, ledger: str) -> DataFrame:
    return read_stored(spark, f"{ledger}/plan", LEDGER_PLAN)


def _stored(schema: T.StructType) -> T.StructType:
    extra = [T.StructField(c, _TEXT) for c in (BROKEN, SOURCE, KEY, BATCH)]
    return T.StructType([*schema.fields, *extra])


def read_loaded(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """Loaded rows with their file's name, which is always text whatever it looks like."""
    rows = read_stored(spark, target, _stored(schema)).where(F.col(BROKEN).isNull())
    return rows.select(*schema.fieldNames(), SOURCE)


def read_broken(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """Lines that did not fit the schema, as they came, with their file's name."""
    rows = read_stored(spark, target, _stored(schema)).where(F.col(BROKEN).isNotNull())
    return rows.select(SOURCE, BROKEN)


def pending_files(spark: SparkSession, pattern: str | list[str], ledger: str) -> DataFrame:
    """Files found that no batch has been planned with, by their whole paths."""
    found = file_inventory(spark, pattern).withColumn(KEY, F.md5(KEY))
    return found.join(_read_plan(spark, ledger).select(KEY), KEY, "left_anti")


def packed_files(pending: DataFrame, files_per_batch: int, bytes_per_batch: int) -> DataFrame:
    """``pending`` (file_key, file_name, path, size_kb) with a ``batch`` for each file.

    A file weighs its share of the larger of both bounds. Files are dealt to as many bins as the
    total weight needs, and a running total within its bin splits a bin that came out too heavy: a
    batch ends with the file that reaches the bound. No list of all files is sorted or held in one
    place. A batch is named after the keys of its files.
    """
    weight = F.greatest(
        F.lit(1.0 / files_per_batch), F.col("size_kb") * 1024.0 / F.lit(float(bytes_per_batch))
    )
    weighed = pending.withColumn("weight", weight)
    total = weighed.agg(F.sum("weight")).first()[0] or 0.0
    bins = max(1, -int(-total // 1))
    upto = Window.partitionBy("bin").orderBy(KEY).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("weight").over(upto), F.lit(0.0))
    placed = weighed.withColumn("bin", F.pmod(F.xxhash64(KEY), F.lit(bins))).withColumn(
        "part", F.floor(before + F.lit(1e-9))
    )
    files = F.struct(KEY, "file_name", F.col("path").alias("file_path"))
    batches = placed.groupBy("bin", "part").agg(F.sort_array(F.collect_list(files)).alias("files"))
    name = F.md5(F.array_join(F.col(f"files.{KEY}"), ""))
    return batches.select(name.alias(BATCH), F.inline("files"))


def _load_batch(
    spark: SparkSession,
    batch: str,
    files: Sequence[Row],
    schema: T.StructType,
    target: str,
    ledger: str,
    run: Run,
) -> None:
    """Load the files of a batch into its folder, then enter them.

    The folder is overwritten, so that a batch killed at any point is replaced as a whole.
    """
    paths = [literal_path(r.file_path) for r in files]
    rows = read_many(
        spark, paths, schema, source_column=SOURCE, key_column=KEY, keep_broken=True
    )
    folder = f"{target}/{BATCH}={batch}"
    rows.write.mode("overwrite").parquet(folder)
    names = spark.createDataFrame(
        [(r[KEY], r.file_name, r.file_path) for r in files],
        f"{KEY} STRING, file_name STRING, file_path STRING",
    )
    counted = T.StructType([T.StructField(KEY, _TEXT), T.StructField(BROKEN, _TEXT)])
    counts = (
        read_stored(spark, folder, counted)
        .groupBy(KEY)
        .agg(F.count("*").alias("n"), F.count(BROKEN).alias("broken"))
    )
    sound = F.col("n") - F.col("broken")
    entries = names.join(counts, KEY, "left").select(
        KEY,
        "file_name",
        "file_path",
        F.lit(batch).alias(BATCH),
        F.lit("success").alias("status"),
        run.stamp().alias("loaded_at"),
        F.coalesce(sound, F.lit(0)).alias("rows_loaded"),
        F.coalesce("broken", F.lit(0)).alias("rows_broken"),
    )
    # One file, which the commit puts in place at once: a batch is entered whole or not at all.
    entries.coalesce(1).write.mode("append").parquet(f"{ledger}/entries")


def file_ledger(
    spark: SparkSession,
    pattern: str | list[str],
    schema: T.StructType,
    target: str,
    ledger: str,
    run: Run,
    files_per_batch: int = 10_000,
    bytes_per_batch: int = 256 << 30,
) -> DataFrame:
    """Load the files not loaded before and return their new ledger rows.

    A file is known by its whole path, so files of one name in several folders are several files.
    Lines that do not fit the schema are kept as they came, see ``read_broken``.

    Batches planned but not entered, as after a crash, come first. The driver holds the names of
    the batches and the files of the batch at work. Two runs must not work on one ledger at once.
    """
    packed = packed_files(pending_files(spark, pattern, ledger), files_per_batch, bytes_per_batch)
    packed.write.mode("append").parquet(f"{ledger}/plan")
    plan = _read_plan(spark, ledger)
    done = read_ledger(spark, ledger).select(BATCH).distinct()
    waiting = plan.join(done, BATCH, "left_anti")
    batches = sorted(r[BATCH] for r in waiting.select(BATCH).distinct().collect())
    for batch in batches:
        files = plan.where(F.col(BATCH) == batch).collect()
        _load_batch(spark, batch, files, schema, target, ledger, run)
    worked = spark.createDataFrame([(b,) for b in batches], f"{BATCH} STRING")
    return read_ledger(spark, ledger).join(worked, BATCH, "left_semi").select(*LEDGER.fieldNames())
