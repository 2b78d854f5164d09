"""Stored tables that change: numbered snapshots, keyed appends and touched-partition rewrites.

A path is never overwritten by a plan that reads it.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillsift.operators.dedup import dedup_keep_first
from quillsift.operators.joins import anti_join_new
from quillsift.operators.loads import upsert_replace
from quillsift.sources import key_index
from quillsift.sources.readers import empty_table

_VERSION = "version="
LOAD, REJECT_LOAD = "load", "reject_load"
CONTENT, COPIES = "content_key", "copies"
# Spark leaves folders out that begin with an underscore.
_UNNAMED = "_unnamed"


def _names(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a pattern on the shared file system; folders only, so few."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [str(status.getPath()) for status in system.globStatus(path) or []]


def _number(path: str) -> int:
    return int(path.rsplit(_VERSION, 1)[1].split("/")[0])


def latest_snapshot(spark: SparkSession, root: str) -> str | None:
    """Folder of the newest completed snapshot; one without its success mark does not count."""
    complete = _names(spark, f"{root}/{_VERSION}*/_SUCCESS")
    return f"{root}/{_VERSION}{max(map(_number, complete)):06d}" if complete else None


def read_snapshot(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The newest snapshot, or an empty table before the first one."""
    folder = latest_snapshot(spark, root)
    if folder is None:
        return empty_table(spark, schema)
    return spark.read.schema(schema).parquet(folder)


def write_snapshot(df: DataFrame, root: str, keep: int | None = None) -> str:
    """Write the next snapshot beside the older ones and return its folder.

    ``keep`` is how many of the newest snapshots stay; readers of older ones must have ended.
    """
    spark = df.sparkSession
    used = [_number(p) for p in _names(spark, f"{root}/{_VERSION}*")]
    folder = f"{root}/{_VERSION}{max(used, default=0) + 1:06d}"
    df.write.mode("errorifexists").parquet(folder)
    if keep is not None:
        for number in sorted(used)[: max(0, len(used) + 1 - max(1, keep))]:
            _remove(spark, f"{root}/{_VERSION}{number:06d}")
    return folder


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _move(spark: SparkSession, folder: str, target: str) -> None:
    """Put a folder in the place of another."""
    jvm = spark._jvm.org.apache.hadoop.fs.Path
    system = jvm(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    system.delete(jvm(target), True)
    if not system.rename(jvm(folder), jvm(target)):
        raise OSError(f"{folder} could not be moved to {target}")


def path_exists(spark: SparkSession, path: str) -> bool:
    return bool(_names(spark, path))


def read_stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table under its declared schema, or an empty one before the first load."""
    if not path_exists(spark, path):
        return empty_table(spark, schema)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def append_rows(
    spark: SparkSession, path: str, rows: DataFrame, key: Sequence[str] = ()
) -> int:
    """Append rows known to be new and return how many were written.

    Each load gets a folder of its own below the table, so that counting what was written reads
    the footers of the new files and not of the whole table. With ``key`` the load is entered in
    the table's key index.
    """
    folder = f"{path}/{LOAD}={uuid.uuid4().hex}"
    rows.write.mode("errorifexists").parquet(folder)
    written = spark.read.schema(rows.schema).parquet(folder)
    return key_index.enter(path, folder, written, key) if key else written.count()


def keyed(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """``df``, whose job fails where a key column is missing: such rows belong to the rejects."""

    def checked(name: str) -> Column:
        missing = F.raise_error(F.lit(f"{name} is missing in a keyed load"))
        return F.coalesce(F.col(name), missing.cast(df.schema[name].dataType))

    return df.withColumns({name: checked(name) for name in key})


def distinct_schema(schema: T.StructType) -> T.StructType:
    """The stored form of rows kept by content, see ``append_distinct``."""
    extra = [T.StructField(CONTENT, T.StringType()), T.StructField(COPIES, T.LongType())]
    return T.StructType([*schema.fields, *extra])


def append_distinct(
    spark: SparkSession, path: str, rows: DataFrame, load_id: str | None = None
) -> int:
    """Store the different rows of a load, each once with its number of copies in the load.

    A load owns the folder named after its id and overwrites it, so that a rerun counts nothing
    twice, while copies in other loads add up (see ``read_distinct``). Without an id a load is known
    by what it holds: the same rows, as often as before, are the same load. Nothing stored is read.
    Returns how many different rows the load has; missing values equal each other.
    """
    kept = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    counted = (
        rows.withColumn(CONTENT, F.sha2(kept, 256))
        .groupBy(*rows.columns, CONTENT)
        .agg(F.count(F.lit(1)).alias(COPIES))
    )
    # Grouped and written once, where readers of the table do not look; what it holds is read from there.
    fresh = f"{path}/{_UNNAMED}/{uuid.uuid4().hex}"
    counted.write.mode("errorifexists").parquet(fresh)
    written = spark.read.schema(counted.schema).parquet(fresh)
    # A sum over hashes is the same in any order; two of them leave no room for chance.
    parts = [F.xxhash64(CONTENT, COPIES, F.lit(salt)).cast("decimal(38,0)") for salt in (1, 2)]
    sums = [F.sum(p) for p in parts] if load_id is None else []
    found = written.agg(F.count(F.lit(1)), *sums).first()
    if load_id is None:
        load_id = "-".join(str(v) for v in found)
    _move(spark, fresh, f"{path}/{REJECT_LOAD}={hashlib.md5(load_id.encode()).hexdigest()}")
    return found[0]


def read_distinct(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Every different row kept by ``append_distinct``, with its copies in all loads together."""
    stored = read_stored(spark, path, distinct_schema(schema))
    columns = [*schema.fieldNames(), CONTENT]
    return stored.groupBy(*columns).agg(F.sum(COPIES).alias(COPIES))


def append_new(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    key: Sequence[str],
    order: Sequence[str | Column] = (),
) -> int:
    """Append the rows whose key the stored table lacks and return how many were added.

    A row without a key fails the load; set such rows aside before. Of several incoming rows with
    one key the first in ``order`` is taken; leave the order out where keys are unique already. Only new rows are written. A rerun after a crash finds the keys
    already there and adds the rest, so the load can be repeated.
    """
    incoming = keyed(incoming, key)
    unique = dedup_keep_first(incoming, key, order) if order else incoming
    stored = read_candidates(spark, path, incoming, key)
    return append_rows(spark, path, anti_join_new(unique, stored, key, incoming), key)


def read_candidates(
    spark: SparkSession, path: str, incoming: DataFrame, key: Sequence[str]
) -> DataFrame:
    """The loads of a stored table that may hold a key of ``incoming``, by the table's key index.

    Other loads are not read. Loads without an entry, as after a crash, always are.
    """
    loads = _names(spark, f"{path}/{LOAD}=*")
    ruled_out = key_index.without_candidates(spark, path, incoming, key) if loads else set()
    folders = [f for f in loads if f.rsplit("/", 1)[-1] not in ruled_out]
    if not folders:
        return empty_table(spark, incoming.schema)
    # Folder names are the table's own, so none of them is a pattern.
    stored = spark.read.schema(incoming.schema).option("basePath", path).parquet(*folders)
    return stored.select(*incoming.columns)


def stage_upsert(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    key: Sequence[str],
    latest: Sequence[str],
    partition: Column,
    stage: str,
    partition_name: str = "key_range",
) -> None:
    """Write the new content of the partitions a batch touches to a stage of its own."""
    placed = keyed(incoming, key).withColumn(partition_name, partition)
    # The semi join prunes the stored table to the touched folders while it runs; the list of
    # their values is never held by the driver.
    touched = placed.select(partition_name).distinct()
    stored = read_stored(spark, path, placed.schema)
    current = stored.join(touched, partition_name, "left_semi").select(*placed.columns)
    # The rows of a partition come together before they are written: a task writes whole partitions,
    # and not a file for each partition it happens to hold rows of. A heavy one can still be split.
    merged = upsert_replace(current, placed, key, latest).hint("rebalance", partition_name)
    merged.write.mode("errorifexists").partitionBy(partition_name).parquet(stage)


def install_stage(
    spark: SparkSession, path: str, stage: str, schema: T.StructType, partition_name: str
) -> None:
    """Move staged partitions into the place of the stored ones.

    May be repeated after a crash: what was moved has left the stage, and the rest follows. Rows are
    written once, by the stage, so ``schema`` is not needed to move them.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    root.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(root)
    for folder in _names(spark, f"{stage}/{partition_name}=*"):
        _move(spark, folder, f"{path}/{folder.rsplit('/', 1)[1]}")


def upsert_partitions(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    key: Sequence[str],
    latest: Sequence[str],
    partition: Column,
    stage: str,
    partition_name: str = "key_range",
) -> None:
    """Upsert into a large stored table, rewriting only the partitions the batch touches.

    ``partition`` must be a function of the key, for instance a range of order ids, so that a key
    never moves between partitions.
    """
    stage_upsert(spark, path, incoming, key, latest, partition, stage, partition_name)
    schema = incoming.withColumn(partition_name, partition).schema
    install_stage(spark, path, stage, schema, partition_name)
