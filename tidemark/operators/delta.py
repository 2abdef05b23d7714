"""Watermark deltas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRACKING = "tracking_ts"
EPOCH = "1970-01-01 00:00:00"


def delta_since(
    df: DataFrame,
    ts: str,
    watermark: str = EPOCH,
    parent: DataFrame | None = None,
    on: str | None = None,
    overlap: str | None = None,
) -> DataFrame:
    """Rows strictly past ``watermark``, with their timestamp as ``tracking_ts``.

    Rows of a child table without a timestamp of its own follow their
    ``parent``, matched by ``on``; only the child columns are returned. The
    comparison reaches the scan of the table that holds the timestamp.

    Rows that arrive late, at or before the watermark, are not seen again.
    ``overlap`` (an interval such as ``'1 day'``) re-reads that stretch; keyed
    de-duplication absorbs the repeats.
    """
    low = F.lit(watermark).cast("timestamp_ntz")
    if overlap is not None:
        low = low - F.expr(f"interval {overlap}")
    if parent is None:
        return df.where(F.col(ts) > low).withColumn(TRACKING, F.col(ts))
    recent = parent.where(F.col(ts) > low).select(F.col(on), F.col(ts).alias(TRACKING))
    return df.join(recent, on).select(*df.columns, TRACKING)
