"""Digests of buckets of rows, and what changed between two states of a table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET, OP = "_bucket", "_op"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def row_hash(columns: Iterable[str]) -> Column:
    """A hash of a row. Hashes pass over nulls, so each value goes in beside whether it is null."""
    return F.xxhash64(*[x for c in columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))])


def digests(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """A row per bucket that holds rows: their number, and two sums over their hashes."""
    h = row_hash(df.columns)
    return df.groupBy(bucket_of(keys, buckets).alias(BUCKET)).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("mixed"), F.sum(h.cast("decimal(38,0)")).cast("decimal(38,0)").alias("total")
    )


def differences(before: DataFrame, now: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What became of each key: ``_op`` (insert, update, delete), the row as it is now, or
    for a delete as it was, and as ``before`` the row it replaces. Keys are unique."""
    columns = now.columns
    old = before.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("old"))
    new = now.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("new"))
    same_key = [F.col(f"old.`{k}`").eqNullSafe(F.col(f"new.`{k}`")) for k in keys]
    both = old.join(new.hint("merge"), same_key, "full_outer")
    op = (
        F.when(F.col("old").isNull(), "insert").when(F.col("new").isNull(), "delete")
        .when(~F.col("old").eqNullSafe(F.col("new")), "update")
    )
    row = F.coalesce("new", "old")
    return both.select(op.alias(OP), row.alias("row"), F.col("old").alias("before")).where(F.col(OP).isNotNull()).select(
        OP, "row.*", F.when(F.col(OP) == "update", F.col("before")).alias("before")
    )
