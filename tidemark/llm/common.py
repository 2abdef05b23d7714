"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_folder
from ..sources.files import remove

#: A word: a run of anything but space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows that one sorted group of a prefix sum holds on average.
GROUP_ROWS = 4_096
#: A table of at most so many (narrow) rows may be broadcast.
SMALL_ROWS = 20_000
#: Characters and rows that a Python step works on before it hands on what it has.
PART_CHARS, PART_ROWS = 250_000, 1_000


def load(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


@contextmanager
def _dropping_shuffles(spark: SparkSession):
    """While it holds, a finished job's shuffle files go; nothing else changes."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession):
    """What ``written`` writes while this holds is deleted at its end, but for the folders
    taken out of the list that it gives. Frames that read from them are of no use then."""
    folders: list[str] = []
    token = _scratch.set(folders)
    try:
        yield folders
    finally:
        _scratch.reset(token)
        remove(spark, *folders)


def written(df: DataFrame, purpose: str, codec: str = "snappy") -> DataFrame:
    """``df`` written to the folder all executors share, and read from there.

    Cuts the lineage: what was written survives the loss of executors, and the
    shuffle files behind it are no longer needed.
    """
    spark = df.sparkSession
    folder = shared_folder(spark, purpose)
    if (inner := _scratch.get()) is not None:
        inner.append(folder)
    with _dropping_shuffles(spark):
        df.write.option("compression", codec).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def sample_ids(rows: DataFrame, by: str, most: int, most_groups: int | None = None) -> DataFrame:
    """A bounded sample: of each value of ``by`` at most ``most`` distinct ids, by a hash of the id.

    Columns doc_id and ``by``; null ids and values are left out, and ids with several
    values. Groups are counted first; their number must be within ``most_groups`` if
    that is given, and else the counts are written and joined, however many there are.
    The hash is cut off at twice the share wanted before any rows are ranked, so
    a rank is taken over few rows whatever the size of the table.
    """
    spark = rows.sparkSession
    ids = (
        rows.where(F.col("doc_id").isNotNull() & F.col(by).isNotNull()).groupBy("doc_id")
        .agg(F.min(by).alias(by), F.max(by).alias("__most")).where(F.col(by) == F.col("__most"))
        .select("doc_id", by, F.xxhash64("doc_id").alias("__key"))
    )
    counts = ids.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    ranked = Window.partitionBy(by).orderBy("__key", "doc_id")
    if most_groups is None:
        above = (F.lit(float(most << 65)) / F.col("n")).cast("long")  # of 2^64, twice the share
        cut = F.when(F.col("n") <= 4 * most, F.lit((1 << 63) - 1)).otherwise(above + F.lit(-(1 << 63)))
        found = attach(ids, written(counts, "groups").select(by, cut.alias("__cut")), by)
        return (
            found.where(F.col("__key") <= F.col("__cut"))
            .withColumn("__rank", F.row_number().over(ranked)).where(F.col("__rank") <= most).select("doc_id", by)
        )
    counts = counts.limit(most_groups + 1).collect()
    if len(counts) > most_groups:
        raise ValueError(f"more than {most_groups} values of {by}")
    if not counts:
        return ids.select("doc_id", by)
    cuts = [(r[by], (1 << 63) - 1 if r["n"] <= 4 * most else -(1 << 63) + (1 << 64) * 2 * most // r["n"]) for r in counts]
    cuts = spark.createDataFrame(cuts, f"`{by}` {rows.schema[by].dataType.simpleString()}, __cut long")
    return (
        ids.join(F.broadcast(cuts), by).where(F.col("__key") <= F.col("__cut"))
        .withColumn("__rank", F.row_number().over(ranked)).where(F.col("__rank") <= most).select("doc_id", by)
    )


def in_parts(texts: Iterable, most_chars: int, most_rows: int) -> Iterator[slice]:
    """Cuts a batch into stretches of bounded size, whatever its own size is.

    A stretch ends with the row that brings it to ``most_chars`` characters or
    ``most_rows`` rows; so a longer text ends one. Null texts count as empty.
    """
    begun = size = end = 0
    for end, text in enumerate(texts, 1):
        size += len(text) if isinstance(text, str) else 0
        if size >= most_chars or end - begun >= most_rows:
            yield slice(begun, end)
            begun, size = end, 0
    if begun < end:
        yield slice(begun, end)


def unused(columns: Iterable[str], name: str) -> str:
    """A name like ``name`` that none of the columns has, whatever their case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def attach(rows: DataFrame, table: DataFrame, *keys: str, salts: int = 32) -> DataFrame:
    """Left join with a table that has one row per key; equal nulls meet.

    A table of few rows, counted first, is broadcast. A larger one is copied
    ``salts`` times and joined on key and salt, so a key with a third of all rows
    is spread over that many tasks.
    """
    table = table.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in table.columns if c not in keys])
    meet = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    if table.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS:
        joined = rows.join(F.broadcast(table), meet, "left")
    else:
        table = table.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        rows = rows.withColumn("__at", F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int"))
        joined = rows.join(table, [*meet, F.col("__at") == F.col("__salt")], "left").drop("__salt", "__at")
    return joined.drop(*[f"__{k}" for k in keys])


def with_start(rows: DataFrame, group: str, bucket: str, order: list[Column], value: str) -> DataFrame:
    """Adds ``start``: the sum of ``value`` over the earlier rows of the group, and
    ``place``, the row's number in its bucket.

    ``bucket`` must follow ``order``. Sums per bucket are made before the shuffle;
    only a list of bucket sums is ever sorted by group, and rows only by bucket, so
    a group that holds most rows is spread over its buckets.
    """
    sums = rows.groupBy(group, bucket).agg(F.sum(value).alias("__sum"))
    before = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col(group).alias("__group"), F.col(bucket).alias("__bucket"),
        F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"),
    )
    inside = Window.partitionBy(group, bucket).orderBy(*order)
    rows = rows.select(
        "*",
        F.coalesce(F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__inside"),
        F.row_number().over(inside).alias("place"),
    )
    meet = [F.col(group).eqNullSafe(F.col("__group")), F.col(bucket).eqNullSafe(F.col("__bucket"))]
    return (
        rows.join(sums, meet, "left")
        .withColumn("start", (F.col("__before") + F.col("__inside")).cast("long"))
        .drop("__group", "__bucket", "__before", "__inside")
    )
