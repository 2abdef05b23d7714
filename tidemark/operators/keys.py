"""Keys and foreign keys that a table's rows bear out.

Sketches rule out most candidates in one pass over each table: distinct counts (HLL),
null counts and ranges. What they leave is tested exactly: a key by grouping, a foreign
key by an anti join of distinct values.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, StringType

from .checks import Check, not_null, relationship, unique

#: Relative deviation of the distinct counts; a count may be off by so many of them.
RSD, DEVIATIONS = 0.02, 5


@dataclass(frozen=True)
class ColumnSketch:
    """What one pass tells of a column. Least and greatest are text, as long as comparable."""

    table: str
    column: str
    kind: str
    rows: int
    nulls: int
    distinct: int
    least: object
    greatest: object

    def may_have(self, distinct: int) -> bool:
        """Whether it may have that many different values."""
        return self.distinct * (1 + DEVIATIONS * RSD) + 2 >= distinct


def sketches(name: str, df: DataFrame) -> list[ColumnSketch]:
    """A sketch per column that can be part of a key: whole numbers, texts and days. One
    pass, whose result is a row."""
    fields = [f for f in df.schema.fields if isinstance(f.dataType, (IntegralType, StringType, DateType))]
    if not fields:
        return []
    aggs = [F.count(F.lit(1)).alias("rows")]
    for k, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        aggs += [F.count_if(c.isNull()).alias(f"nulls{k}"), F.approx_count_distinct(c, RSD).alias(f"distinct{k}"),
                 F.min(c).alias(f"least{k}"), F.max(c).alias(f"greatest{k}")]
    r = df.agg(*aggs).first()
    kind = lambda t: "whole" if isinstance(t, IntegralType) else t.simpleString()
    return [
        ColumnSketch(name, f.name, kind(f.dataType), r["rows"], r[f"nulls{k}"], r[f"distinct{k}"], r[f"least{k}"], r[f"greatest{k}"])
        for k, f in enumerate(fields)
    ]


def is_key(df: DataFrame, columns: Iterable[str]) -> bool:
    """Exactly: no null, and no values twice. Values are counted before they are compared."""
    named = df.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(columns)])
    nulls = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in named.columns])
    if not named.where(nulls).limit(1).isEmpty():
        return False
    return named.groupBy(*named.columns).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).isEmpty()


def find_keys(tables: Mapping[str, DataFrame], found: Mapping[str, list[ColumnSketch]], width: int = 2) -> list[tuple[str, tuple[str, ...]]]:
    """Least keys of up to ``width`` columns: (table, columns in the order of the table).

    A set of columns that holds a key is no least one. Empty tables have none.
    """
    keys = []
    for name, df in tables.items():
        usable, mine = [s for s in found[name] if not s.nulls and s.rows], []
        for size in range(1, width + 1):
            for some in combinations(usable, size):
                names = tuple(s.column for s in some)
                if any(set(k) <= set(names) for k in mine):
                    continue
                # As many combinations at most as the distinct counts multiply to.
                most = reduce(lambda a, s: a * (s.distinct * (1 + DEVIATIONS * RSD) + 2), some, 1.0)
                if most >= some[0].rows and is_key(df, names):
                    mine.append(names)
        keys += [(name, k) for k in mine]
    return keys


def find_references(
    tables: Mapping[str, DataFrame], found: Mapping[str, list[ColumnSketch]], keys: Iterable[tuple[str, tuple[str, ...]]],
) -> list[tuple[str, str, str, str]]:
    """(table, column, parent table, parent key): columns all of whose values are in a key
    of one column of another table. Columns without a value refer to nothing."""
    out = []
    sketch = {(s.table, s.column): s for mine in found.values() for s in mine}
    for parent, columns in keys:
        if len(columns) != 1:
            continue
        p = sketch[parent, columns[0]]
        for s in sketch.values():
            if s.table == parent or s.kind != p.kind or s.nulls == s.rows or not p.may_have(int(s.distinct * (1 - DEVIATIONS * RSD)) - 2):
                continue
            if s.least < p.least or s.greatest > p.greatest:
                continue
            child = tables[s.table].select(F.col(f"`{s.column}`").alias("k")).where("k IS NOT NULL").distinct()
            if child.join(tables[parent].select(F.col(f"`{p.column}`").alias("k")), "k", "left_anti").limit(1).isEmpty():
                out.append((s.table, s.column, parent, p.column))
    return out


def as_checks(keys: Iterable[tuple[str, tuple[str, ...]]], references: Iterable[tuple[str, str, str, str]]) -> list[Check]:
    """What was found, as data tests to hold later rows against."""
    keys = list(keys)
    return [
        *(not_null(table, c) for table, columns in keys for c in columns), *(unique(table, *columns) for table, columns in keys),
        *(relationship(table, column, parent, field) for table, column, parent, field in references),
    ]
