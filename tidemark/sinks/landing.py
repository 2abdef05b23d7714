"""Writers into the raw lake."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.changes import content_fingerprint, has_changed, max_version
from ..operators.delta import EPOCH, TRACKING, delta_since
from ..session import CODEC
from .state import StateLog

# --- fixed values: places in the lake ---------------------------------------
SNAPSHOTS = "postgres/snapshots/table_name={table}"
BATCHES = "postgres/batches/table_name={table}"
DROPS = "external_s3/stream_event={table}"
ENDPOINTS = "api/api_endpoint={table}"


def place(lake: str, pattern: str, table: str) -> str:
    return f"{lake.rstrip('/')}/{pattern.format(table=table)}"


def land_snapshot(df: DataFrame, lake: str, table: str, now: datetime | None = None) -> str:
    """The whole table as one dataset ``snapshot_date=D/snapshot_HHMMSS.parquet``."""
    now = now or datetime.now()
    folder = place(lake, SNAPSHOTS, table)
    path = f"{folder}/snapshot_date={now:%Y-%m-%d}/snapshot_{now:%H%M%S}.parquet"
    df.write.option("compression", CODEC).parquet(path)
    return path


def land_batch(df: DataFrame, lake: str, table: str, now: datetime | None = None) -> None:
    """Append rows under ``batch_date=D``. No rows leave no file."""
    now = now or datetime.now()
    (
        df.withColumn("batch_date", F.lit(f"{now:%Y-%m-%d}"))
        .write.mode("append").option("compression", CODEC).partitionBy("batch_date").parquet(place(lake, BATCHES, table))
    )


def land_delta(
    df: DataFrame, ts: str, lake: str, table: str, state: StateLog, *,
    parent: DataFrame | None = None, on: str | None = None, overlap: str | None = None,
    now: datetime | None = None,
) -> str | None:
    """Land what is past the saved watermark; the new watermark, None if no rows.

    The watermark is the greatest timestamp of the rows written, measured by the
    write itself, and saved after it. A run that dies in between repeats its
    rows; keyed de-duplication absorbs them. So does one beside another run that
    was faster, which ends in ``LostRace``.
    """
    before = state.last(table)
    delta = delta_since(df, ts, before.value or EPOCH, parent, on, overlap)
    seen = Observation()
    # A delta is a small part of many scan tasks: rebalance it into few files.
    observed = delta.hint("rebalance").observe(seen, F.max(TRACKING).cast("string").alias("high"))
    land_batch(observed.drop(TRACKING), lake, table, now)
    high = seen.get["high"]
    if high is not None:
        state.put(table, high, after=before.seq)
    return high


def snapshot_if_changed(
    df: DataFrame, lake: str, table: str, state: StateLog,
    version_column: str | None = None, now: datetime | None = None,
) -> bool:
    """Land a snapshot unless the table is as it was at the last one.

    With ``version_column`` its greatest value decides; deletes go unnoticed.
    Without, a fingerprint of all rows decides, and they do not.
    """
    version = max_version(df, version_column) if version_column else content_fingerprint(df)
    current = version.first()["version"]
    last = state.last(table)
    if not has_changed(current, int(last.value) if last.value else None, monotone=version_column is not None):
        return False
    land_snapshot(df, lake, table, now)
    state.put(table, current, after=last.seq)
    return True


def seed_if_empty(spark: SparkSession, table: str, rows: DataFrame) -> bool:
    """Fill a catalog table that has no rows yet."""
    if not spark.table(table).isEmpty():
        return False
    rows.select(*spark.table(table).columns).write.insertInto(table)
    return True
