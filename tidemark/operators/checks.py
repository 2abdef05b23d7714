"""Declarative data tests, reported as one DataFrame."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Check:
    model: str
    test: str
    columns: tuple[str, ...]
    severity: str = "error"
    to: str | None = None
    field: str | None = None
    values: tuple[str, ...] = ()

    @property
    def label(self) -> str:
        return ",".join(self.columns)

    def warn(self) -> "Check":
        return replace(self, severity="warn")


def not_null(model: str, column: str) -> Check:
    """Counts null rows."""
    return Check(model, "not_null", (column,))


def unique(model: str, *columns: str) -> Check:
    """Counts keys that occur more than once; keys with a null part are ignored."""
    return Check(model, "unique", columns)


def relationship(model: str, column: str, to: str, field: str) -> Check:
    """Counts rows whose non-null value is absent from the parent column."""
    return Check(model, "relationships", (column,), to=to, field=field)


def accepted(model: str, column: str, values: Iterable[str]) -> Check:
    """Counts distinct non-null values outside the list."""
    return Check(model, "accepted_values", (column,), values=tuple(values))


def _text(value: str) -> str:
    """A SQL string literal."""
    plain = value.replace("\\", "\\\\").replace("'", "\\'")
    return "'" + plain.replace("{", "{{").replace("}", "}}") + "'"


def _head(check: Check) -> str:
    return ", ".join(_text(t) for t in (check.model, check.test, check.label, check.severity))


def _null_counts(checks: list[Check]) -> str:
    """All not-null tests of a table in one pass."""
    counts = ", ".join(f"count_if(`{c.columns[0]}` IS NULL) AS c{i}" for i, c in enumerate(checks))
    rows = ", ".join(f"{_head(c)}, c{i}" for i, c in enumerate(checks))
    return f"SELECT stack({len(checks)}, {rows}) FROM (SELECT {counts} FROM {{{checks[0].model}}})"


def _failures(check: Check) -> str:
    """One test as a row.

    Values are counted before any join or comparison, so a value that fills
    much of the table is one row per map task from there on.
    """
    keys = [f"`{c}`" for c in check.columns]
    table = f"{{{check.model}}}"
    if check.test == "unique":
        present = " AND ".join(f"{k} IS NOT NULL" for k in keys)
        return (f"SELECT {_head(check)}, count(*) FROM (SELECT 1 FROM {table} WHERE {present} "
                f"GROUP BY {', '.join(keys)} HAVING count(*) > 1)")
    if check.test == "accepted_values":
        values = ", ".join(_text(v) for v in check.values)
        return (f"SELECT {_head(check)}, count(*) FROM (SELECT DISTINCT {keys[0]} FROM {table} "
                f"WHERE {keys[0]} NOT IN ({values}))")
    if check.test == "relationships":
        return (f"SELECT {_head(check)}, coalesce(sum(child.n), 0) FROM "
                f"(SELECT {keys[0]} AS k, count(*) AS n FROM {table} WHERE {keys[0]} IS NOT NULL GROUP BY 1) child "
                f"LEFT ANTI JOIN (SELECT `{check.field}` AS k FROM {{{check.to}}}) parent ON child.k = parent.k")
    raise ValueError(f"unknown test '{check.test}'")


def run_checks(models: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """model, test, column_name, severity, failures, status - one row per test.

    ``status`` is pass without failures; otherwise warn or fail, by severity.
    All tests make one query, which Spark analyses once and whose branches it
    runs side by side.
    """
    checks = list(checks)
    rows: list[str] = []
    for model in dict.fromkeys(c.model for c in checks):
        mine = [c for c in checks if c.model == model]
        nulls = [c for c in mine if c.test == "not_null"]
        rows += [_null_counts(nulls)] if nulls else []
        rows += [_failures(c) for c in mine if c.test != "not_null"]
    used = {c.model for c in checks} | {c.to for c in checks if c.to}
    spark = models[checks[0].model].sparkSession
    report = spark.sql("\nUNION ALL\n".join(rows), **{name: models[name] for name in used})
    report = report.toDF("model", "test", "column_name", "severity", "failures")
    status = (
        F.when(F.col("failures") == 0, "pass")
        .when(F.col("severity") == "warn", "warn")
        .otherwise("fail")
    )
    return report.withColumn("status", status)


def check_contract(name: str, df: DataFrame, contract: T.StructType) -> DataFrame:
    """Raise unless column names and types are exactly those of the contract."""
    want = [(f.name, f.dataType.simpleString()) for f in contract]
    have = [(f.name, f.dataType.simpleString()) for f in df.schema]
    if want != have:
        raise TypeError(f"{name} breaks its contract: expected {want}, got {have}")
    return df
