"""Aggregates and data tests that a day's rows are merged into."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import to_zip, varchar
from ..operators import profile
from ..operators.aggregate import merge_mode_counts, mode_counts, modes_from_counts
from ..operators.checks import Check
from ..sinks.merged import MergedTable
from . import silver

ZIP, MEANS, MODES = "geolocation_zip_code_prefix", ["geolocation_lat", "geolocation_lng"], ["geolocation_city", "geolocation_state"]


class GeolocationState:
    """Sums, counts and counts per value behind ``silver_geolocation``: as large as there
    are zip prefixes and spellings of their places, however many points there are."""

    def __init__(self, spark: SparkSession, folder: str):
        schema = StructType.fromDDL(
            f"{ZIP} decimal(5,0), slot int, val string, n bigint, "
            + ", ".join(f"sum_{m} double, cnt_{m} bigint" for m in MEANS))
        self.table = MergedTable(spark, folder, schema, [ZIP], lambda rows: merge_mode_counts(rows, ZIP, MEANS))

    def add(self, batch_id: int, points: DataFrame) -> None:
        zipped = points.withColumn(ZIP, to_zip(ZIP))
        self.table.merge(batch_id, mode_counts(zipped, ZIP, MEANS, MODES))

    def result(self) -> DataFrame:
        grouped = modes_from_counts(self.table.read(), ZIP, MEANS, MODES)
        return grouped.select(
            ZIP, *MEANS, varchar("geolocation_city", 50).alias("geolocation_city"), varchar("geolocation_state", 2).alias("geolocation_state"))


class LatestOrders:
    """``silver_orders`` kept up to date: one row per order, in buckets by order id."""

    def __init__(self, spark: SparkSession, folder: str, orders: DataFrame, buckets: int = 64):
        """``orders`` shows the columns of a batch; no row of it is read."""
        schema = silver.typed_orders(orders).schema
        self.table = MergedTable(spark, folder, schema, ["order_id"], silver.latest_typed_orders, buckets)

    def add(self, batch_id: int, orders: DataFrame) -> list[int]:
        return self.table.merge(batch_id, silver.typed_orders(orders))

    def result(self) -> DataFrame:
        return silver.latest_orders(self.table.read())


class ProfileState:
    """Profile of a table too large to group: per column rows, nulls, a sketch of the distinct
    values and a summary of the frequent ones. As large as there are columns."""

    def __init__(self, spark: SparkSession, folder: str, columns: Sequence[str], most: int = profile.MOST_VALUES):
        self.columns, at = list(columns), folder.rstrip("/")
        self.sketches = MergedTable(
            spark, f"{at}/sketches", StructType.fromDDL(profile.SKETCHES), ["column_name"], profile.merge_column_sketches, 1)
        self.values = MergedTable(
            spark, f"{at}/values", StructType.fromDDL(profile.FREQUENT), ["column_name"],
            lambda rows: profile.merge_frequent(rows, most), min(len(self.columns), 64))

    def add(self, batch_id: int, rows: DataFrame) -> None:
        """A batch counts once in each part, also if it died between the two."""
        self.sketches.merge(batch_id, profile.column_sketches(rows, self.columns))
        self.values.merge(batch_id, profile.frequent_parts(rows, self.columns))

    def distinct(self) -> DataFrame:
        return profile.distinct_estimates(self.sketches.read())

    def frequent(self) -> DataFrame:
        return profile.frequent_values(self.values.read())


class TestState:
    """Data tests over batches of rows, each of which is read once.

    For each test and value there is a row: how many rows have it and whether the parent
    table does. A batch of children adds to the one, a batch of parents to the other, so
    a child whose parent comes later passes from then on, and none is read again. Rows
    are only ever added; a model whose rows are replaced is tested anew.
    """

    __test__ = False  # no test of this repository

    def __init__(self, spark: SparkSession, folder: str, checks: Sequence[Check]):
        self.spark, self.checks = spark, list(checks)
        schema = StructType.fromDDL("test int, value string, n bigint, parent int")
        self.table = MergedTable(spark, folder, schema, ["test", "value"], self._sums)

    @staticmethod
    def _sums(rows: DataFrame) -> DataFrame:
        return rows.groupBy("test", "value").agg(F.sum("n").alias("n"), F.max("parent").alias("parent"))

    def _entries(self, model: str, rows: DataFrame) -> DataFrame | None:
        """What the rows of a model add to the tests, summed before the shuffle."""
        entry = lambda k, value, n, parent: F.struct(
            F.lit(k).alias("test"), value.cast("string").alias("value"), F.lit(n).cast("bigint").alias("n"), F.lit(parent).alias("parent"))
        found = []
        for k, c in enumerate(self.checks):
            column = F.col(f"`{c.columns[0]}`") if c.model == model else None
            if c.model == model and c.test == "not_null":
                found.append(F.when(column.isNull(), entry(k, F.lit(""), 1, 0)))
            elif c.model == model and c.test == "unique":
                keys = [F.col(f"`{x}`") for x in c.columns]
                found.append(F.when(reduce(lambda a, b: a & b, [x.isNotNull() for x in keys]), entry(k, F.to_json(F.struct(*keys)), 1, 0)))
            elif c.model == model and c.test == "accepted_values":
                found.append(F.when(~column.isin(*c.values), entry(k, column, 1, 0)))
            elif c.model == model and c.test == "relationships":
                found.append(F.when(column.isNotNull(), entry(k, column, 1, 0)))
            if c.test == "relationships" and c.to == model:
                parent = F.col(f"`{c.field}`")
                found.append(F.when(parent.isNotNull(), entry(k, parent, 0, 1)))
        if not found:
            return None
        return self._sums(rows.select(F.explode(F.array_compact(F.array(*found))).alias("e")).select("e.*"))

    def add(self, batch_id: int, models: Mapping[str, DataFrame]) -> None:
        """The rows that a batch adds to the models."""
        parts = [p for p in (self._entries(name, rows) for name, rows in models.items()) if p is not None]
        if parts:
            self.table.merge(batch_id, reduce(DataFrame.unionByName, parts))

    def report(self) -> DataFrame:
        """The report that the tests would give on all rows so far."""
        heads = [(k, c.model, c.test, c.label, c.severity) for k, c in enumerate(self.checks)]
        tests = self.spark.createDataFrame(heads, "test_id int, model string, test string, column_name string, severity string")
        kept = self.table.read().withColumnRenamed("test", "test_id")
        counted = kept.join(F.broadcast(tests.select("test_id", "test")), "test_id")  # a row per test
        n = (
            F.when(F.col("test") == "unique", (F.col("n") > 1).cast("bigint")).when(F.col("test") == "accepted_values", F.lit(1))
            .when(F.col("test") == "relationships", F.when(F.col("parent") == 0, F.col("n"))).otherwise(F.col("n"))
        )
        sums = counted.groupBy("test_id").agg(F.sum(n).alias("failures"))
        out = tests.join(sums, "test_id", "left").withColumn("failures", F.coalesce("failures", F.lit(0)).cast("bigint"))
        status = F.when(F.col("failures") == 0, "pass").when(F.col("severity") == "warn", "warn").otherwise("fail")
        return out.select("model", "test", "column_name", "severity", "failures", status.alias("status"))
