"""Time slices and the rows that go with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _moment(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp_ntz")


def time_slice(df: DataFrame, ts: str, after, until) -> DataFrame:
    """Rows of the half-open interval ``(after, until]``."""
    return df.where((F.col(ts) > _moment(after)) & (F.col(ts) <= _moment(until)))


def up_to(df: DataFrame, ts: str, cut) -> DataFrame:
    """History up to and including ``cut``."""
    return df.where(F.col(ts) <= _moment(cut))


def children_of(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Rows of ``children`` whose key occurs in ``parents``."""
    return children.join(parents.select(key), key, "left_semi")
