"""Parquet files of the lake: listing, picking, reading with provenance."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dataset_of, partition_value
from ..schemas import SOURCE_FILE

LISTING = "path string, modified timestamp, length bigint"

# --- fixed values -----------------------------------------------------------
LATEST_SUFFIX = "_latest.parquet"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Is there a file or folder at ``path``, or any that a pattern matches?"""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return bool(found)


def path_within(spark: SparkSession, path: str) -> str:
    """A path without its file system, as file names of Spark have it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toUri().getRawPath()


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Give a file or folder another name; the new one must be free."""
    place, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (old, new))
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(target) or not system.rename(place, target):
        raise OSError(f"cannot rename {old} to {new}")


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete files or folders."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def set_modified(spark: SparkSession, path: str, micros: int) -> None:
    """Give a file another modification time, where the store lets one."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).setTimes(place, micros // 1000, -1)


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies directly in a folder; none if there is no such folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(place):
        return []
    return [s.getPath().getName() for s in system.listStatus(place)]


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small text file, unless the name is taken."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        out = system.create(place, False)
    except Exception as e:
        if "FileAlreadyExists" in str(e) or "already exists" in str(e):
            return False
        raise
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """The whole of a small text file."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def is_complete(spark: SparkSession, dataset: str) -> bool:
    """Is a dataset a single file, or a folder whose writer has finished it?"""
    place = spark._jvm.org.apache.hadoop.fs.Path(dataset)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(place):
        return False
    return system.getFileStatus(place).isFile() or path_exists(spark, f"{dataset}/_SUCCESS")


def _first_complete(spark: SparkSession, datasets: DataFrame, what: str) -> str:
    """The first complete one of the column ``dataset``, in the order of the rows."""
    for row in datasets.toLocalIterator():
        if is_complete(spark, row["dataset"]):
            return row["dataset"]
    raise FileNotFoundError(what)


def list_files(spark: SparkSession, prefix: str) -> DataFrame:
    """path, modified, length of every Parquet file under ``prefix``.

    Nothing but file metadata is read. A prefix that does not exist is empty.
    """
    if not path_exists(spark, prefix):
        return spark.createDataFrame([], LISTING)
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True).load(prefix)
    )
    return files.select("path", F.col("modificationTime").alias("modified"), "length")


def tagged_latest(spark: SparkSession, prefix: str) -> str:
    """The first complete dataset by name whose name ends in ``_latest.parquet``."""
    tagged = F.regexp_extract("path", rf"^(.*{LATEST_SUFFIX.replace('.', '[.]')})(?:/[^/]*)?$", 1)
    names = list_files(spark, prefix).select(tagged.alias("dataset")).where("dataset <> ''").distinct()
    return _first_complete(spark, names.orderBy("dataset"), f"no complete '{LATEST_SUFFIX}' dataset under {prefix}")


def newest_snapshot(spark: SparkSession, prefix: str, by: str = "mtime") -> str:
    """The newest complete dataset under ``prefix``; one still being written is passed over.

    ``by='mtime'`` takes the one that holds the file modified last (ties: first
    by name); ``by='partition'`` the last ``snapshot_date``, then the last name.
    """
    if by not in ("mtime", "partition"):
        raise ValueError(f"by must be 'mtime' or 'partition', got '{by}'")
    datasets = list_files(spark, prefix).groupBy(dataset_of(F.col("path")).alias("dataset")).agg(
        F.max("modified").alias("modified"), F.max(partition_value(F.col("path"), "snapshot_date")).alias("day")
    )
    order = [F.col("modified").desc(), F.col("dataset")] if by == "mtime" else [F.col("day").desc(), F.col("dataset").desc()]
    return _first_complete(spark, datasets.orderBy(*order), f"no complete parquet dataset under {prefix}")


def read_files(spark: SparkSession, paths: Sequence[str], schema: str | None = None) -> DataFrame:
    """All rows of the given files or folders, each with its ``_source_file``.

    Columns are the union of the files' columns. No paths give an empty frame.
    Files of other writers may hold nanosecond times, which need the setting of
    ``session.CLUSTER_CONF``; ``conform`` turns them into timestamps.
    """
    if not paths:
        return spark.createDataFrame([], schema or f"{SOURCE_FILE} string")
    reader = spark.read.option("recursiveFileLookup", True)
    reader = reader.schema(schema) if schema else reader.option("mergeSchema", True)
    return reader.parquet(*paths).select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))


def read_alike(spark: SparkSession, paths: Sequence[str]) -> list[DataFrame]:
    """The given files as few frames as their column types allow.

    A column without any value has no type of its own in some files and clashes
    with the others; such files are set apart by halving the list.
    """
    try:
        return [read_files(spark, paths)]
    except Exception as e:
        if "CANNOT_MERGE_SCHEMAS" not in str(e) or len(paths) == 1:
            raise
    middle = len(paths) // 2
    return read_alike(spark, paths[:middle]) + read_alike(spark, paths[middle:])


def modified_since(spark: SparkSession, prefix: str, after: int, up_to: int) -> DataFrame:
    """Rows of the files modified after one moment and up to another, with file provenance.

    Moments are microseconds since 1970, which no time zone shifts. The one a file
    was modified at comes as ``_modified``.
    """
    second = f"{datetime.fromtimestamp(max(after // 1_000_000 - 1, 0), timezone.utc):%Y-%m-%dT%H:%M:%S}"
    modified = F.unix_micros("_metadata.file_modification_time")
    return (
        spark.read.option("recursiveFileLookup", True).option("mergeSchema", True)
        .option("pathGlobFilter", "*.parquet")
        .option("modifiedAfter", second).option("timeZone", "UTC")  # spares older files; the exact cut follows
        .parquet(prefix)
        .select("*", F.col("_metadata.file_path").alias(SOURCE_FILE), modified.alias("_modified"))
        .where((F.col("_modified") > after) & (F.col("_modified") <= up_to))
    )


def last_modified(spark: SparkSession, prefix: str) -> int | None:
    """When the newest file under ``prefix`` was modified, in microseconds since 1970."""
    return list_files(spark, prefix).agg(F.max(F.unix_micros("modified")).alias("m")).first()["m"]


def unprocessed_files(listing: DataFrame, ledger: DataFrame, table: str) -> DataFrame:
    """Listed files that the load ledger does not have for ``table``."""
    done = ledger.where(F.col("table_name") == table).select(F.col("file_key").alias("path"))
    return listing.join(done, "path", "left_anti")
