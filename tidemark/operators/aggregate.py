"""Aggregations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def centroid_and_modes(
    df: DataFrame,
    key: str,
    means: Sequence[str],
    modes: Sequence[str],
    size: str | None = None,
) -> DataFrame:
    """Per key: the mean of each column in ``means`` and the most frequent
    non-null value of each column in ``modes`` (ties go to the smallest value;
    null when the column is null throughout). ``size`` adds the group size.

    A ``mode`` aggregate would hold all distinct values of a group in one
    buffer. Here the values are counted as rows first: each input row becomes
    one row per mode column, counted by (key, column, value) with a map-side
    partial sum, and only those counts are reduced by key. Neither step gathers
    a group, so one key may hold any share of the rows. The sums behind the
    means travel with the first mode column.
    """
    return modes_from_counts(mode_counts(df, key, means, modes), key, means, modes, size)


def mode_counts(df: DataFrame, key: str, means: Sequence[str], modes: Sequence[str]) -> DataFrame:
    """The first step of ``centroid_and_modes``: key, slot (of the mode column), val, n, and
    for each mean its sum and count. Such counts may be added up, see ``merge_mode_counts``."""
    entries = F.array(*[
        F.struct(
            F.lit(slot).alias("slot"),
            F.col(name).cast("string").alias("val"),
            *[(F.lit(None) if slot else F.col(m)).cast("double").alias(m) for m in means],
        )
        for slot, name in enumerate(modes)
    ])
    long = df.select(F.col(key), F.explode(entries).alias("e")).select(key, "e.*")
    return long.groupBy(key, "slot", "val").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(m).alias(f"sum_{m}") for m in means],
        *[F.count(m).alias(f"cnt_{m}") for m in means],
    )


def merge_mode_counts(counted: DataFrame, key: str, means: Sequence[str]) -> DataFrame:
    """Counts of several parts of a table as those of the whole."""
    sums = [c for m in means for c in (f"sum_{m}", f"cnt_{m}")]
    return counted.groupBy(key, "slot", "val").agg(*[F.sum(c).alias(c) for c in ("n", *sums)])


def modes_from_counts(counted: DataFrame, key: str, means: Sequence[str], modes: Sequence[str], size: str | None = None) -> DataFrame:
    """The second step of ``centroid_and_modes``."""

    def most_frequent(slot: int, name: str) -> Column:
        rank = F.struct((-F.col("n")).alias("less"), F.col("val").alias("val"))
        usable = (F.col("slot") == slot) & F.col("val").isNotNull()
        return F.min(F.when(usable, rank)).getField("val").alias(name)

    extra = [] if size is None else [F.sum(F.when(F.col("slot") == 0, F.col("n"))).alias(size)]
    return counted.groupBy(key).agg(
        *[(F.sum(f"sum_{m}") / F.nullif(F.sum(f"cnt_{m}"), F.lit(0))).alias(m) for m in means],
        *[most_frequent(slot, name) for slot, name in enumerate(modes)],
        *extra,
    )


def value_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Frequency of each value, null included, most frequent first."""
    return (
        df.groupBy(column).agg(F.count(F.lit(1)).alias(name))
        .orderBy(F.col(name).desc(), F.col(column).asc_nulls_first())
    )


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def max_or_default(df: DataFrame, column: str, default, name: str) -> DataFrame:
    """One row: the greatest value, or ``default`` for an empty table."""
    return df.agg(F.coalesce(F.max(column), F.lit(default)).alias(name))


def count_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
