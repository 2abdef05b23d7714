"""Loading the raw lake into bronze tables, driven by a table of sources."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators.sets import concat_frames
from ..schemas import bronze_ddl
from ..sinks.conform import conform
from ..sinks.state import StateLog
from ..sinks.versioned import VersionedTable
from ..sources.files import newest_snapshot, read_alike, tagged_latest
from ..streaming.incremental import LEDGER, IncrementalTable, load_incremental


@dataclass(frozen=True)
class Source:
    pattern: str
    prefix: str


# --- fixed values: how and from where each bronze table is loaded -------------
SOURCES: dict[str, Source] = {
    "api_geolocation": Source("snapshot_tagged", "api/api_endpoint=geolocation/"),
    "api_translations": Source("snapshot_tagged", "api/api_endpoint=translations/"),
    "pg_customers": Source("snapshot_partition", "postgres/snapshots/table_name=customers/"),
    "pg_products": Source("snapshot_partition", "postgres/snapshots/table_name=products/"),
    "pg_sellers": Source("snapshot_partition", "postgres/snapshots/table_name=sellers/"),
    "pg_orders": Source("incremental", "postgres/batches/table_name=orders/"),
    "pg_order_items": Source("incremental", "postgres/batches/table_name=order_items/"),
    "stream_order_payments": Source("incremental", "external_s3/stream_event=order_payments/"),
    "stream_order_reviews": Source("incremental", "external_s3/stream_event=order_reviews/"),
}

RESULT = "table_name string, status string, row_count bigint, message string"


class BronzeLoader:
    """Loads tables of ``sources`` from ``lake`` into ``warehouse``.

    Everything of a table lives under its current generation. A reset starts
    the next one, so rows, ledger and stream checkpoint are emptied in one step.
    With an ``archive`` the files of incremental tables go there when they are loaded.
    """

    def __init__(
        self, spark: SparkSession, lake: str, warehouse: str,
        sources: Mapping[str, Source] = SOURCES, max_files: int = 2000, archive: str | None = None,
    ):
        self.spark = spark
        self.lake = lake.rstrip("/")
        self.warehouse = warehouse.rstrip("/")
        self.sources = sources
        self.max_files = max_files
        self.archive = archive
        self.generations = StateLog(spark, f"{self.warehouse}/generations")
        self._notes: dict[str, str | None] = {}
        self.refresh()

    def refresh(self) -> None:
        """See the resets that other loaders have made."""
        self._generation = self.generations.all()

    def _root(self, table: str) -> str:
        return f"{self.warehouse}/generation={self._generation.get(table, '0')}"

    def _snapshot(self, table: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self._root(table)}/bronze/{table}")

    def _incremental(self, table: str) -> IncrementalTable:
        return IncrementalTable(self.spark, self._root(table), table)

    def _source(self, table: str) -> Source:
        if table not in self.sources:
            raise KeyError(f"no source is defined for '{table}'")
        return self.sources[table]

    def load_table(self, table: str) -> int:
        """Load one table; the number of rows that came in."""
        source = self._source(table)
        prefix = f"{self.lake}/{source.prefix}"
        if source.pattern == "snapshot_tagged":
            return self._replace(table, tagged_latest(self.spark, prefix))
        if source.pattern == "snapshot_partition":
            return self._replace(table, newest_snapshot(self.spark, prefix))
        if source.pattern == "incremental":
            target = self._incremental(table)
            load_incremental(target, prefix, self.max_files, archive=self.archive)
            self._notes[table] = "; ".join(f"rejected {path}: {why}" for path, why in target.rejections) or None
            return target.rows_loaded()
        raise ValueError(f"unknown pattern '{source.pattern}' for '{table}'")

    def _replace(self, table: str, path: str) -> int:
        frames = [conform(df, table) for df in read_alike(self.spark, [path])]
        return self._snapshot(table).replace(concat_frames(*frames))

    def run(self, tables: Iterable[str] | None = None, parallel: int = 4) -> DataFrame:
        """Load all tables, or the given ones; a failing table does not stop the rest.

        The message of a loaded table names the files that were set aside.
        """
        self.refresh()

        def attempt(table: str) -> tuple:
            try:
                return table, "loaded", self.load_table(table), self._notes.get(table)
            except Exception as e:  # the failure is the result
                return table, "failed", None, f"{type(e).__name__}: {e}"

        with ThreadPoolExecutor(parallel) as pool:
            outcome = list(pool.map(attempt, tables or self.sources))
        return self.spark.createDataFrame(outcome, RESULT)

    def read(self, table: str) -> DataFrame:
        if self._source(table).pattern == "incremental":
            return self._incremental(table).read()
        target = self._snapshot(table)
        if target.current() is None:
            return self.spark.createDataFrame([], bronze_ddl(table))
        return target.read()

    def rejected(self, table: str) -> DataFrame:
        """Files of an incremental table that did not fit it."""
        return self._incremental(table).rejected()

    def ledger(self, table: str) -> DataFrame:
        if self._source(table).pattern != "incremental":
            return self.spark.createDataFrame([], LEDGER)
        return self._incremental(table).ledger()

    def reset(self, tables: Iterable[str] | None = None) -> None:
        """Empty the given tables, or all; their files load again on the next run."""
        tables = list(tables or self.sources)
        for table in tables:
            self._source(table)
        self.refresh()
        self.generations.put_all({t: str(int(self._generation.get(t, "0")) + 1) for t in tables})
        self.refresh()


def reset_tables(spark: SparkSession, database: str, tables: Iterable[str], drop: bool = False) -> None:
    """TRUNCATE or DROP catalog tables."""
    for table in tables:
        spark.sql(f"{'DROP' if drop else 'TRUNCATE'} TABLE `{database}`.`{table}`")
