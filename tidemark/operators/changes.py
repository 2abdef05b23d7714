"""Has a table changed since its last snapshot?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def max_version(df: DataFrame, column: str) -> DataFrame:
    """One row ``version``: the greatest row version, 0 for an empty table."""
    return df.agg(F.coalesce(F.max(column).cast("bigint"), F.lit(0).cast("bigint")).alias("version"))


def content_fingerprint(df: DataFrame) -> DataFrame:
    """One row ``version``: a hash over all rows, independent of their order.

    Unlike a greatest row version this also notices deletes. Hashes pass over
    nulls, so each value goes in beside whether it is null: one that moves to
    another column is a change.
    """
    h = F.xxhash64(*[x for c in df.columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))])
    sums = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(h).alias("x"),
        F.sum(h.cast("decimal(38,0)")).alias("s"),
    )
    return sums.select(F.xxhash64("n", "x", "s").alias("version"))


def has_changed(current: int, last: int | None, monotone: bool = True) -> bool:
    """Decide on a snapshot. A first run (no or zero state) always takes one."""
    if not last:
        return True
    return current > last if monotone else current != last
