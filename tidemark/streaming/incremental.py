"""Exactly-once loading of files that keep arriving under a prefix."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.sets import concat_frames
from ..schemas import SOURCE_FILE, bronze_ddl
from ..session import CODEC
from ..sinks.conform import UnknownColumnsError, conform
from ..sources.files import path_exists, path_within, read_alike

BATCH_ID = "_batch_id"
REJECTED = "file_key string, message string"
LEDGER = "table_name string, file_key string, loaded_at timestamp, row_count bigint"
_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def batch_folder(folder: str, batch_id: int) -> str:
    return f"{folder}/{BATCH_ID}={batch_id}"


def overwrite_batch(df: DataFrame, folder: str, batch_id: int, *partitions: str) -> None:
    """Write ``df`` as partition ``_batch_id``. A repeated batch replaces itself as a whole."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", CODEC).partitionBy(*partitions).parquet(
        batch_folder(folder, batch_id))


def read_batches(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """All batches written so far."""
    with_id = f"{schema}, {BATCH_ID} bigint"
    if not path_exists(spark, folder):
        return spark.createDataFrame([], with_id)
    return spark.read.schema(with_id).parquet(folder)


class IncrementalTable:
    """An append-only bronze table with its load ledger and stream checkpoint."""

    def __init__(self, spark: SparkSession, warehouse: str, table: str):
        self.spark = spark
        self.table = table
        self.folder = f"{warehouse.rstrip('/')}/bronze/{table}"
        self.data = f"{self.folder}/data"
        self.ledger_folder = f"{self.folder}/ledger"
        self.rejected_folder = f"{self.folder}/rejected"
        self.checkpoint = f"{self.folder}/checkpoint"
        self.batches: list[int] = []
        self.rejections: list[tuple[str, str]] = []

    def read(self) -> DataFrame:
        return read_batches(self.spark, self.data, bronze_ddl(self.table)).drop(BATCH_ID)

    def ledger(self) -> DataFrame:
        """One row per loaded file."""
        return read_batches(self.spark, self.ledger_folder, LEDGER).drop(BATCH_ID)

    def rejected(self) -> DataFrame:
        """file_key and message of each file that did not fit the table."""
        return read_batches(self.spark, self.rejected_folder, REJECTED).drop(BATCH_ID)

    def _fitting(self, paths: list[str]) -> tuple[list[DataFrame], list[tuple[str, str]]]:
        """Conformed frames of the files that fit, and those that do not, found by halving."""
        try:
            return [conform(df, self.table) for df in read_alike(self.spark, paths)], []
        except UnknownColumnsError as e:
            if len(paths) == 1:
                return [], [(paths[0], str(e))]
        middle = len(paths) // 2
        first, second = self._fitting(paths[:middle]), self._fitting(paths[middle:])
        return first[0] + second[0], first[1] + second[1]

    def load_batch(self, paths: list[str], batch_id: int, archive: str = "") -> None:
        """Data first, then the ledger, taken from the data just written.

        Files that lie under ``archive`` (a path as in file names) keep the name they had
        before they were moved there.

        A crash between the two repeats the batch with the same files and the
        same id, which replaces what is there. Files without rows get no entry.
        Files with unknown columns are set aside and reported, the others load; a
        reset of the table tries them again.
        """
        if not paths:
            return
        frames, bad = self._fitting(paths)
        if archive:
            frames = [f.withColumn(SOURCE_FILE, F.replace(SOURCE_FILE, F.lit(archive), F.lit(""))) for f in frames]
            bad = [(path.replace(archive, "", 1), why) for path, why in bad]
        if bad:
            self.rejections += bad
            overwrite_batch(self.spark.createDataFrame(bad, REJECTED), self.rejected_folder, batch_id)
        if not frames:
            return
        overwrite_batch(concat_frames(*frames), self.data, batch_id)
        # This batch's own folder, however many there are.
        written = self.spark.read.schema(bronze_ddl(self.table)).parquet(batch_folder(self.data, batch_id))
        entries = (
            written.groupBy(F.col(SOURCE_FILE).alias("file_key"))
            .agg(F.count(F.lit(1)).alias("row_count"))
            .select(
                F.lit(self.table).alias("table_name"), "file_key",
                F.current_timestamp().alias("loaded_at"), "row_count",
            )
        )
        overwrite_batch(entries, self.ledger_folder, batch_id)
        self.batches.append(batch_id)

    def rows_loaded(self) -> int:
        """Rows of the batches loaded through this object."""
        if not self.batches:
            return 0
        mine = self.spark.read.schema(LEDGER).parquet(*[batch_folder(self.ledger_folder, b) for b in self.batches])
        return mine.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("n")).first()["n"]


def load_incremental(
    target: IncrementalTable, prefix: str, max_files: int = 2000, interval: str | None = None, archive: str | None = None,
) -> StreamingQuery | None:
    """Load every file under ``prefix`` that has not been loaded yet.

    The stream carries file names only; ``max_files`` bounds how many a batch
    names. Each batch reads its files with their own columns, so an unknown
    column is noticed and text timestamps are cast. Without ``interval`` the
    call returns when all present files are loaded; with one (``'5 minutes'``)
    it returns the running query.

    With an ``archive``, a folder of the same file system, files leave the prefix once
    the batch after theirs has begun, and keep their path beneath the archive. So a
    listing names what is new and one batch. A file that a crash left behind stays under
    the prefix and is not loaded twice. A table that starts anew, after a reset, first
    takes what the archive has of the prefix. One table may use an archive of a prefix.
    """
    spark = target.spark
    if archive is not None and not path_exists(spark, target.checkpoint):
        old, moved = f"{archive.rstrip('/')}{path_within(spark, prefix)}", path_within(spark, archive).rstrip("/")
        # Finished before the table's own stream begins; repeated from where it was if it died.
        _load(target, old, f"{target.checkpoint}-archive", max_files, None, None, lambda i: -1 - i, moved)
    return _load(target, prefix, target.checkpoint, max_files, interval, archive, lambda i: i)


def _load(target: IncrementalTable, prefix: str, checkpoint: str, max_files: int, interval: str | None,
          archive: str | None, number: Callable[[int], int], moved: str = "") -> StreamingQuery | None:
    if not path_exists(target.spark, prefix):
        return None  # nothing has arrived yet
    names = (
        target.spark.readStream.format("binaryFile").schema(_FILES)
        .option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files).option("maxFileAge", "36500d")
    )
    if archive is not None:
        names = names.option("cleanSource", "archive").option("sourceArchiveDir", archive)

    def load(batch: DataFrame, batch_id: int) -> None:
        target.load_batch([r["path"] for r in batch.collect()], number(batch_id), moved)

    writer = names.load(prefix).select("path").writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    if interval is not None:
        return writer.trigger(processingTime=interval).start()
    writer.trigger(availableNow=True).start().awaitTermination()
    return None
