"""Column functions over file paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def dir_name(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def split_name(path: Column) -> Column:
    """struct(directory, name, extension) of a path."""
    return F.struct(
        dir_name(path).alias("directory"),
        F.regexp_extract(path, r"([^/]*?)(\.[^./]*)?$", 1).alias("name"),
        F.regexp_extract(path, r"\.([^./]*)$", 1).alias("extension"),
    )


def partition_value(path: Column, key: str) -> Column:
    """The value of ``key=value`` in a hive-style path, null when absent."""
    return F.nullif(F.regexp_extract(path, rf"(?:^|/){key}=([^/]*)", 1), F.lit(""))


def dataset_of(path: Column) -> Column:
    """The dataset a Parquet file belongs to.

    A part file written by Spark belongs to its folder; any other file is a
    dataset of its own.
    """
    return F.when(base_name(path).startswith("part-"), dir_name(path)).otherwise(path)
