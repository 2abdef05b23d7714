"""Extraction into the raw lake, driven by a table of what to extract how."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import partition_value
from ..schemas import SOURCE_FILE
from ..sinks.landing import DROPS, ENDPOINTS, land_delta, place, snapshot_if_changed
from ..sinks.state import StateLog
from .capture import ChangeCapture
from ..sources.files import is_complete, list_files, path_exists, read_files, rename

RESULT = "name string, kind string, status string, message string"


@dataclass(frozen=True)
class Delta:
    """A table followed by a timestamp, its own or that of its parent."""

    ts: str
    parent: str | None = None
    on: str | None = None


@dataclass(frozen=True)
class Extracts:
    # --- fixed values: what is extracted, and by which column ----------------
    snapshots: tuple[str, ...] = ("customers", "sellers", "products")
    deltas: Mapping[str, Delta] = field(default_factory=lambda: {
        "orders": Delta("order_purchase_timestamp"),
        "order_items": Delta("order_purchase_timestamp", "orders", "order_id"),
    })
    drops: tuple[str, ...] = ("order_payments", "order_reviews")
    endpoints: tuple[str, ...] = ("translations", "geolocation")
    # Not part of the fixed values: tables whose changed and deleted rows are wanted too,
    # by their keys. Such a table is best left out of ``deltas``.
    captures: Mapping[str, tuple[str, ...]] = field(default_factory=dict)


MANIFEST = "path string, modified bigint, length bigint, run bigint"


def manifest(spark: SparkSession, state: StateLog, table: str) -> DataFrame:
    """Every file that was synced: its path, modification time (microseconds), size and run."""
    folder, last = _manifest_folder(state, table), int(state.get(table, "0"))
    if not last:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(folder).where(F.col("run") <= last)


def _manifest_folder(state: StateLog, table: str) -> str:
    return f"{state.folder}/manifest/{table}"


def unsynced(spark: SparkSession, prefix: str, synced: DataFrame) -> DataFrame:
    """path, modified, length of the files that no sync has seen as they are now.

    A file counts by its path, time and size, whatever the time is: one that has the
    time of an earlier one, or an older time, is new, and one replaced in place is too.
    """
    listed = list_files(spark, prefix).select("path", F.unix_micros("modified").alias("modified"), "length")
    return listed.join(synced.select("path", "modified", "length"), ["path", "modified", "length"], "left_anti")


def sync_drop(spark: SparkSession, inbox: str, lake: str, table: str, state: StateLog, max_files: int = 2000) -> bool:
    """Bring over what was dropped and not synced yet; False if nothing was.

    The listing is compared with a manifest of all files synced. What is new comes in
    runs of at most ``max_files`` files: a run's files are written to the manifest, then
    their rows to a folder of the run, and the run counts once its number is saved. A run
    that dies before is repeated, or, if its rows were written, only saved. Rows keep the
    ``batch_date`` of their folder; those without one go under Spark's name for a
    missing value.
    """
    prefix, target = f"{inbox.rstrip('/')}/{table}", place(lake, DROPS, table)
    brought = False
    while True:
        before = state.last(table)
        run = int(before.value or 0) + 1
        folder, planned = f"{target}/synced={run}", f"{_manifest_folder(state, table)}/run={run}"
        resumed = is_complete(spark, folder)
        if not resumed:
            new = unsynced(spark, prefix, manifest(spark, state, table))
            files = new.orderBy("modified", "path").limit(max_files).collect()  # names of a bounded number
            if not files:
                return brought
            spark.createDataFrame(files, "path string, modified bigint, length bigint").coalesce(1).write.mode("overwrite").parquet(planned)
            rows = read_files(spark, [f["path"] for f in files])
            day = partition_value(F.col(SOURCE_FILE), "batch_date")
            rows.withColumn("batch_date", day).drop(SOURCE_FILE).write.mode("overwrite").partitionBy("batch_date").parquet(folder)
        state.put(table, str(run), after=before.seq)
        brought = True
        if resumed:
            return True  # what was dropped since comes with the next sync


def refresh_endpoint(
    spark: SparkSession, rows: Callable[[], DataFrame], lake: str, name: str,
    force: bool = False, now: datetime | None = None,
) -> bool:
    """Land a reference table as ``<name>_latest.parquet``.

    A table that has landed is left alone, and its source not even asked, unless
    ``force`` is set: then the present one is kept as ``<name>_old_<time>`` and
    replaced. The source is asked once, and its rows are written beside the present
    table; only a finished write with rows takes its place, by renaming. What an
    earlier run had finished writing but not put in place counts as landed.
    """
    folder = place(lake, ENDPOINTS, name)
    latest, staged = f"{folder}/{name}_latest.parquet", f"{folder}/_staged_{name}.parquet"
    if not path_exists(spark, latest) and is_complete(spark, f"{staged}.ready"):
        rename(spark, f"{staged}.ready", latest)
    landed = is_complete(spark, latest)
    if landed and not force:
        return False
    counted = Observation()
    rows().observe(counted, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(staged)
    if not counted.get["n"]:
        return False
    now = now or datetime.now()
    rename(spark, staged, f"{staged}.ready")
    if path_exists(spark, latest):
        rename(spark, latest, f"{folder}/{name}_old_{now:%Y%m%d_%H%M%S}.parquet")
    rename(spark, f"{staged}.ready", latest)
    return True


class Extractor:
    """``tables`` gives an OLTP table or None, ``endpoints`` a reference table."""

    def __init__(
        self, spark: SparkSession, lake: str, tables: Callable[[str], DataFrame | None],
        inbox: str, endpoints: Mapping[str, Callable[[], DataFrame]],
        extracts: Extracts = Extracts(), version_column: str | None = None,
    ):
        self.spark, self.lake, self.tables, self.inbox = spark, lake.rstrip("/"), tables, inbox
        self.endpoints, self.extracts, self.version_column = endpoints, extracts, version_column

    def _state(self, kind: str) -> StateLog:
        return StateLog(self.spark, f"{self.lake}/metadata/{kind}")

    def _table(self, name: str) -> DataFrame:
        df = self.tables(name)
        if df is None:
            raise LookupError(f"table '{name}' does not exist")
        return df

    def _capture(self, name: str, keys: tuple[str, ...]) -> bool:
        table = self._table(name)
        capture = ChangeCapture(self.spark, f"{self.lake}/metadata/captures", name, keys, table.schema)
        capture.look(table)
        return capture.land(self.lake) > 0

    def _jobs(self, force: bool) -> Iterable[tuple[str, str, Callable[[], bool]]]:
        e, lake = self.extracts, self.lake
        for n in e.snapshots:
            yield n, "snapshot", lambda n=n: snapshot_if_changed(
                self._table(n), lake, n, self._state("snapshots"), self.version_column)
        for n, d in e.deltas.items():
            yield n, "delta", lambda n=n, d=d: land_delta(
                self._table(n), d.ts, lake, n, self._state("deltas"),
                parent=self._table(d.parent) if d.parent else None, on=d.on) is not None
        for n, keys in e.captures.items():
            yield n, "capture", lambda n=n, keys=keys: self._capture(n, keys)
        for n in e.drops:
            yield n, "drop", lambda n=n: sync_drop(self.spark, self.inbox, lake, n, self._state("drops"))
        for n in e.endpoints:
            yield n, "endpoint", lambda n=n: refresh_endpoint(self.spark, self.endpoints[n], lake, n, force)

    def run(self, only: Iterable[str] | None = None, force: bool = False, parallel: int = 4) -> DataFrame:
        """Extract everything, or the given names or kinds; a row per extract.

        One that fails, or whose table is missing, does not stop the others.
        """
        wanted = None if only is None else set(only)

        def attempt(item: tuple[str, str, Callable[[], bool]]) -> tuple:
            name, kind, job = item
            try:
                return name, kind, "landed" if job() else "unchanged", None
            except LookupError as e:
                return name, kind, "missing", str(e)
            except Exception as e:  # the failure is the result
                return name, kind, "failed", f"{type(e).__name__}: {e}"

        jobs = [j for j in self._jobs(force) if wanted is None or wanted & {j[0], j[1]}]
        with ThreadPoolExecutor(parallel) as pool:
            outcome = list(pool.map(attempt, jobs))
        return self.spark.createDataFrame(outcome, RESULT)
