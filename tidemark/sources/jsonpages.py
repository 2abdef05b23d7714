"""JSON sources: full dumps and landed pages. Malformed input is an error."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: envelope of one page -------------------------------------
ENVELOPE = "page bigint, limit bigint, count bigint, next_url string, data array<struct<{record}>>"


def read_json_dump(spark: SparkSession, path: str, record: str, one_document: bool = False) -> DataFrame:
    """Rows of JSON arrays of records.

    By default every line is an array, so a file can be read in splits. With
    ``one_document`` a whole file is one array, read by one task.
    """
    return spark.read.schema(record).option("mode", "FAILFAST").option("multiLine", one_document).json(path)


def read_json_pages(spark: SparkSession, path: str, record: str, one_document: bool = False) -> DataFrame:
    """The records of all landed pages ``{page, limit, count, next_url, data}``.

    The pages must be the whole answer: numbered from 1 without a gap or repeat, all
    but the last full and followed by another, and none shorter than it says.
    """
    pages = (
        spark.read.schema(ENVELOPE.format(record=record)).option("mode", "FAILFAST")
        .option("multiLine", one_document).json(path)
    )
    last = pages.agg(F.max("page").alias("last")).first()["last"]
    if last is None:
        return pages.select(F.explode("data").alias("r")).select("r.*")
    cut_off = (
        (F.size("data") != F.col("count"))
        | ((F.col("page") < last) & ((F.col("count") < F.col("limit")) | F.col("next_url").isNull()))
    )
    found = pages.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("page").alias("numbers"), F.min("page").alias("first"),
        F.count_if(F.coalesce(cut_off, F.lit(True))).alias("cut_off"),
        F.max(F.when(F.col("page") == last, F.col("next_url"))).alias("more"),
    ).first()
    if (found["n"], found["numbers"], found["first"], found["cut_off"], found["more"]) != (last, last, 1, 0, None):
        raise ValueError(f"pages under {path} are not a whole answer: {found.asDict()} of {last}")
    return pages.select(F.explode("data").alias("r")).select("r.*")
