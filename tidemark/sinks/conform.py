"""Fit a frame to the declared columns of a bronze table."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import BRONZE, INGESTED_AT, SOURCE_FILE, plain_type


class UnknownColumnsError(ValueError):
    pass


def _moment(c: Column, kind: str) -> Column:
    """Times as text, where ``NaT`` stands for a missing one, or as nanoseconds."""
    if kind == "bigint":
        billion = F.lit(1_000_000_000).cast("decimal(10,0)")
        seconds = (c.cast("decimal(20,0)") / billion).cast("decimal(18,6)")
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    if not kind.startswith(("timestamp", "date")):
        return F.nullif(c.cast("string"), F.lit("NaT"))
    return c


def _typed(c: Column, name: str, kind: str) -> Column:
    c = c.cast(plain_type(kind))
    limit = re.fullmatch(r"varchar\((\d+)\)", kind)
    if limit:
        message = F.concat(F.lit(f"value too long for {name} {kind}: "), c)
        c = F.when(F.length(c) > int(limit.group(1)), F.raise_error(message)).otherwise(c)
    return c.alias(name)


def conform(df: DataFrame, table: str) -> DataFrame:
    """Cast by name; missing columns are null, unknown columns are an error.

    Text longer than its declared length is an error too, as are values that do
    not cast. Times may be timestamps, text or nanoseconds since 1970. Lineage
    columns are added.
    """
    declared = BRONZE[table]
    unknown = [c for c in df.columns if c not in declared and c != SOURCE_FILE]
    if unknown:
        raise UnknownColumnsError(f"{table} has no column {', '.join(unknown)}")
    kinds = dict(df.dtypes)
    out = []
    for name, kind in declared.items():
        c = F.col(name) if name in kinds else F.lit(None)
        if kind == "timestamp_ntz" and name in kinds:
            c = _moment(c, kinds[name])
        out.append(_typed(c, name, kind))
    source = F.col(SOURCE_FILE) if SOURCE_FILE in kinds else F.lit(None).cast("string")
    return df.select(*out, source.alias(SOURCE_FILE), F.current_timestamp().alias(INGESTED_AT))
