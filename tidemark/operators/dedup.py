"""Keyed de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_first_per_key_rank"


def first_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column] = (),
    total_order: bool = True,
) -> DataFrame:
    """One row per key: the first in ``order``.

    With ``total_order`` every remaining column breaks ties, so the kept row
    does not depend on partitioning. The filter on the rank lets Spark keep a
    single row per key and task before the shuffle, so a key that holds a large
    share of the rows sends at most one row per map task.
    """
    ordering = list(order)
    if total_order or not ordering:
        ordering += [F.col(c).asc_nulls_first() for c in df.columns if c not in keys]
    ordering = ordering or [F.lit(1)]
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*ordering)))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)
