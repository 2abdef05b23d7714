"""Tables of a catalog or database, CSV tables, parameterised SQL."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parse_timestamp
from ..operators.sets import split_known


def existing_tables(spark: SparkSession, database: str) -> list[str]:
    return [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]


def tables_present(
    spark: SparkSession, database: str, configured: Iterable[str]
) -> tuple[dict[str, DataFrame], list[str]]:
    """The configured tables that exist, and the names of those that do not."""
    found, missing = split_known(configured, existing_tables(spark, database))
    return {t: spark.table(f"{database}.{t}") for t in found}, missing


def describe_columns(spark: SparkSession, database: str) -> DataFrame:
    """table_name, position, column_name, data_type, nullable for every table."""
    rows = [
        (t, i, c.name, c.dataType, c.nullable)
        for t in existing_tables(spark, database)
        for i, c in enumerate(spark.catalog.listColumns(f"{database}.{t}"))
    ]
    return spark.createDataFrame(
        rows, "table_name string, position int, column_name string, data_type string, nullable boolean"
    )


def jdbc_options(
    url: str, table: str, *, split_on: str | None = None, lower=None, upper=None, splits: int = 1,
    one_task: bool = False, properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a read over JDBC in ``splits`` ranges of ``split_on``.

    A table that is not split is read by one task; that has to be asked for.
    """
    if one_task == (split_on is not None):
        raise ValueError(f"'{table}' needs either split_on with bounds or one_task=True")
    options = {"url": url, "dbtable": table, **(properties or {})}
    if split_on is not None:
        if lower is None or upper is None or splits < 2:
            raise ValueError(f"split_on='{split_on}' needs lower, upper and at least 2 splits")
        options |= {
            "partitionColumn": split_on, "lowerBound": str(lower), "upperBound": str(upper), "numPartitions": str(splits),
        }
    return options


def jdbc_table(spark: SparkSession, url: str, table: str, **how) -> DataFrame:
    """A database table, read as ``jdbc_options`` says.

    Filters on the result, such as a watermark, are evaluated by the database.
    """
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **how)).load()


def child_delta_sql(child: str, parent: str, on: str, ts: str, watermark: str) -> str:
    """A ``dbtable`` with the child rows whose parent lies past the watermark.

    Join and watermark are evaluated by the database, which sends only those rows;
    the parent's time comes as ``tracking_ts``.
    """
    names = (child, parent, on, ts)
    if not all(re.fullmatch(r"[A-Za-z_][A-Za-z0-9_.]*", n) for n in names):
        raise ValueError(f"not plain names: {names}")
    moment = watermark.replace("'", "''")
    return (
        f"(SELECT c.*, p.{ts} AS tracking_ts FROM {child} c JOIN {parent} p ON c.{on} = p.{on} "
        f"WHERE p.{ts} > TIMESTAMP '{moment}') AS delta"
    )


def query(spark: SparkSession, sql: str, params: Mapping | None = None, **frames: DataFrame) -> DataFrame:
    """SQL with ``:name`` parameters over frames named ``{name}`` in the text."""
    return spark.sql(sql, args=dict(params or {}), **frames)


def read_csv_table(
    spark: SparkSession, path: str, schema: str, timestamps: Iterable[str] = ()
) -> DataFrame:
    """CSV with a header. Columns in ``timestamps`` are text in ``schema`` and
    become timestamps; what cannot be parsed there becomes null. Anything else that
    does not fit the schema, or a row with a field too many or too few, is an error."""
    df = (
        spark.read.schema(schema).option("header", True).option("enforceSchema", False)
        .option("mode", "FAILFAST").csv(path)
    )
    for name in timestamps:
        df = df.withColumn(name, parse_timestamp(F.col(name)))
    return df
