"""Paging and top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _require_positive(**values: int) -> None:
    for name, value in values.items():
        if value < 1:
            raise ValueError(f"{name} must be a positive integer, got {value}")


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows in ``order``."""
    return df.orderBy(*order).limit(k)


def page_by_key(df: DataFrame, key: str, page: int = 1, limit: int = 1000) -> DataFrame:
    """One page of the table in key order.

    Every task keeps ``page * limit`` rows, so this suits the first pages. Deep
    pages go through ``page_after``, whole tables through ``number_pages``.
    """
    _require_positive(page=page, limit=limit)
    return df.orderBy(key).offset((page - 1) * limit).limit(limit)


def page_after(df: DataFrame, key: str, last_key, limit: int = 1000) -> DataFrame:
    """The ``limit`` rows that follow ``last_key``; costs the same at any depth."""
    _require_positive(limit=limit)
    return df.where(F.col(key) > F.lit(last_key)).orderBy(key).limit(limit)


def page_answer(rows: DataFrame, page: int, limit: int) -> DataFrame:
    """Envelope of one page: its size, and whether another page may follow."""
    return rows.agg(F.count(F.lit(1)).alias("count")).select(
        F.lit(page).alias("page"),
        F.lit(limit).alias("limit"),
        "count",
        (F.col("count") == limit).alias("has_next"),
    )


def number_pages(spark: SparkSession, df: DataFrame, key: str, limit: int, folder: str) -> DataFrame:
    """Every row of the table with its ``page`` in key order (from 1).

    The rows are written once, in key ranges. The place of a row is then its
    index within its file plus the row counts of the files before it. The only
    thing sorted in one task is the list of files, one per key range.
    """
    _require_positive(limit=limit)
    df.repartitionByRange(key).sortWithinPartitions(key).write.parquet(folder)
    stored = spark.read.parquet(folder)
    rows = stored.select("*", "_metadata.file_path", "_metadata.row_index")
    in_name_order = Window.orderBy("file_path")
    starts = (
        rows.groupBy("file_path").agg(F.count(F.lit(1)).alias("n"))
        .select("file_path", (F.sum("n").over(in_name_order) - F.col("n")).alias("start"))
    )
    place = F.col("start") + F.col("row_index")
    return (
        # One row per file, and the write made one file per key range.
        rows.join(F.broadcast(starts), "file_path")
        .withColumn("page", (F.floor(place / limit) + 1).cast("bigint"))
        .select(*df.columns, "page")
    )
