"""JSON records out of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def json_record(df: DataFrame) -> Column:
    """One JSON object per row: NaN as null, timestamps as text, nulls kept."""
    fields = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("double", "float"):
            c = nan_to_null(c)
        elif kind.startswith("timestamp"):
            c = c.cast("string")
        fields.append(c.alias(name))
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
