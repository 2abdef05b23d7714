"""Set operations on frames and on table names."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame


def concat_frames(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, columns matched by name, missing ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def split_known(configured: Iterable[str], existing: Iterable[str]) -> tuple[list[str], list[str]]:
    """Configured names that exist, and those that do not, in configured order."""
    have = set(existing)
    names = list(dict.fromkeys(configured))
    return [n for n in names if n in have], [n for n in names if n not in have]
