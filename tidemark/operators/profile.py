"""Profiling reports, from which cleaning rules are derived."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import parse_timestamp

#: Distinct counts by sketches of 2^12 registers, whose standard error is 1.04 / sqrt(2^12).
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)
#: Values that a summary of frequent values keeps per column.
MOST_VALUES = 100
#: Longer values stand in such a summary by their digest.
LONGEST_VALUE = 100
#: Bytes of a SHA-256 digest.
DIGEST_BYTES = 32
SKETCHES = "column_name string, row_count bigint, nulls bigint, sketch binary"
FREQUENT = "column_name string, is_error boolean, value string, n bigint"


def _per_column(df: DataFrame, columns: Sequence[str], **measures) -> DataFrame:
    """One pass over the table, one output row per column."""
    aggregates = [m(F.col(f"`{c}`")).alias(f"{name}_{i}")
                  for i, c in enumerate(columns) for name, m in measures.items()]
    entries = F.array(*[
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"{name}_{i}").alias(name) for name in measures])
        for i, c in enumerate(columns)
    ])
    return df.agg(*aggregates).select(F.explode(entries).alias("e")).select("e.*")


def shape(df: DataFrame) -> DataFrame:
    """Rows, and per column its position, type and number of non-null values."""
    kinds = dict(df.dtypes)
    report = _per_column(df, df.columns, non_null=F.count, row_count=lambda c: F.count(F.lit(1)))
    position = F.create_map(*[x for i, c in enumerate(df.columns) for x in (F.lit(c), F.lit(i))])
    kind = F.create_map(*[x for c in df.columns for x in (F.lit(c), F.lit(kinds[c]))])
    return report.select(
        F.element_at(position, F.col("column_name")).alias("position"),
        "column_name",
        F.element_at(kind, F.col("column_name")).alias("data_type"),
        "non_null",
        "row_count",
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Null values per column, most first."""
    report = _per_column(df, df.columns, nulls=lambda c: F.count_if(c.isNull()))
    return report.orderBy(F.col("nulls").desc(), "column_name")


def _short(c: Column, kind: str) -> Column:
    """Texts longer than their digest by length and SHA-256, so that a shuffle need not carry
    them; shorter ones as they are, in a field of their own."""
    if kind != "string":
        return c
    long = F.length(c) > DIGEST_BYTES
    digest = F.unhex(F.sha2(c, 256))
    return F.when(c.isNotNull(), F.struct(F.when(~long, c).alias("text"), F.when(long, F.length(c)).alias("length"), F.when(long, digest).alias("digest")))


def duplicate_rows(df: DataFrame, *keys: str) -> DataFrame:
    """Rows beyond the first of their key; without keys, of the whole row.

    A null counts as a key value like any other.
    """
    kinds = dict(df.dtypes)
    grouping = [_short(F.col(f"`{k}`"), kinds[k]).alias(k) for k in (keys or df.columns)]
    grouped = df.groupBy(*grouping).agg(F.count(F.lit(1)).alias("n"))
    return grouped.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("row_count"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicates"),
    )


def timestamp_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Earliest and latest moment per column, and how many are missing or unparsable."""
    return _per_column(
        df.select(*[parse_timestamp(c).alias(c) for c in columns]),
        columns,
        earliest=F.min,
        latest=F.max,
        nulls=lambda c: F.count_if(c.isNull()),
    )


def key_lengths(df: DataFrame, column: str) -> DataFrame:
    """Each length that occurs in a text column."""
    return df.groupBy(F.length(column).alias("key_length")).agg(F.count(F.lit(1)).alias("n"))


def has_fractions(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Does a numeric column hold anything but whole numbers?"""
    def fractional(c: Column) -> Column:
        return F.coalesce(F.bool_or(c % 1 != 0), F.lit(False))

    return _per_column(df, columns, fractional=fractional)


def column_sketches(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, nulls and a sketch of the distinct values per column, in one pass (``SKETCHES``).

    As large as there are columns, however many values these have.
    """
    return _per_column(
        df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns]), columns,
        row_count=lambda c: F.count(F.lit(1)), nulls=lambda c: F.count_if(c.isNull()),
        sketch=lambda c: F.hll_sketch_agg(c, SKETCH_BITS))


def merge_column_sketches(parts: DataFrame) -> DataFrame:
    """Sketches of several parts of a table as those of the whole."""
    return parts.groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("nulls").alias("nulls"), F.hll_union_agg("sketch").alias("sketch"))


def distinct_estimates(sketches: DataFrame) -> DataFrame:
    """Distinct values per column, nulls aside; off by SKETCH_ERROR as a standard deviation."""
    return sketches.select("column_name", "row_count", "nulls", F.hll_sketch_estimate("sketch").alias("distinct_values"))


def _value(c: str) -> Column:
    text = F.col(f"`{c}`").cast("string")
    return F.when(F.length(text) > LONGEST_VALUE, F.concat(F.lit("sha256:"), F.sha2(text, 256))).otherwise(text)


def frequent_parts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How often each value of the columns occurs, null included (``FREQUENT``), counted
    before the shuffle; an error of 0 stands beside each column."""
    entry = lambda c, is_error, value, n: F.struct(
        F.lit(c).alias("column_name"), F.lit(is_error).alias("is_error"), value.alias("value"), F.lit(n).cast("bigint").alias("n"))
    entries = [e for c in columns for e in (entry(c, False, _value(c), 1), entry(c, True, F.lit(None).cast("string"), 0))]
    each = df.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    return each.groupBy("column_name", "is_error", "value").agg(F.sum("n").alias("n"))


def merge_frequent(parts: DataFrame, most: int = MOST_VALUES) -> DataFrame:
    """The ``most`` most frequent values per column of several parts, less the count of the next one.

    What is taken off is added to the column's error, so a value's true count lies
    between ``n`` and ``n`` + error, and that of a value not kept is at most the error.
    Each time ``most`` + 1 values lose as much, so the error is at most the number of
    rows over ``most`` + 1, in whatever order and however often parts are merged.
    """
    counted = parts.groupBy("column_name", "is_error", "value").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("column_name", "is_error").orderBy(F.col("n").desc(), "value")
    top = counted.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most + 1)
    next_one = F.max(F.when(~F.col("is_error") & (F.col("place") == most + 1), F.col("n")))
    cut = F.coalesce(next_one.over(Window.partitionBy("column_name")), F.lit(0))
    n = F.when(F.col("is_error"), F.col("n") + cut).otherwise(F.col("n") - cut)
    return top.select("column_name", "is_error", "value", n.alias("n")).where("is_error OR n > 0")


def frequent_values(summary: DataFrame) -> DataFrame:
    """Values that may be frequent, with the bounds of their counts."""
    error = summary.where("is_error").select("column_name", F.col("n").alias("error"))  # a row per column
    return summary.where("NOT is_error").join(F.broadcast(error), "column_name").select(
        "column_name", "value", F.col("n").alias("at_least"), (F.col("n") + F.col("error")).alias("at_most"))
