"""The given tables in batches, merged into states; the result is that of the whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import concat_frames
from ..operators.profile import MOST_VALUES, SKETCH_ERROR
from ..plans import inputs
from ..plans.build import compose
from ..plans.data_tests import SILVER
from ..plans.partials import GeolocationState, LatestOrders, ProfileState, TestState
from ..session import CODEC, shared_folder

BATCHES = 3


def _batch(df: DataFrame, k: int) -> DataFrame:
    return df.where(F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(BATCHES)) == k)


def merged_geolocation(spark: SparkSession, sf: str) -> DataFrame:
    """Silver geolocation from three batches of points, each taken in twice."""
    state, points = GeolocationState(spark, shared_folder(spark, "merged")), inputs.geolocation(spark, sf)
    for k in range(BATCHES):
        for _ in range(2):
            state.add(k, _batch(points, k))
    rounded = {c: F.round(c, 6) for c in ("geolocation_lat", "geolocation_lng")}  # sums differ by their order
    return state.result().withColumns(rounded)


def merged_orders(spark: SparkSession, sf: str) -> DataFrame:
    """The latest order of each customer from three batches, in which later orders may
    come earlier."""
    orders = inputs.orders(spark, sf, key="o_custkey")
    state = LatestOrders(spark, shared_folder(spark, "merged"), orders)
    for k in range(BATCHES):
        state.add(k, _batch(orders, k))
    return state.result().select(F.col("order_id").alias("customer"), "order_status", "order_purchase_ts")


def merged_tests(spark: SparkSession, sf: str) -> DataFrame:
    """The data tests of the silver models over three batches of their rows. The models are
    worked out once and stored, and the batches taken from there."""
    composed, root = compose(inputs.bronze(spark, sf)), shared_folder(spark, "models")
    wanted, models = sorted({c.model for c in SILVER}), {}
    for m in wanted:
        composed[m].write.option("compression", CODEC).parquet(f"{root}/{m}")
        models[m] = spark.read.schema(composed[m].schema).parquet(f"{root}/{m}")
    state = TestState(spark, shared_folder(spark, "merged"), SILVER)
    for k in range(BATCHES):
        state.add(k, {m: _batch(models[m], k) for m in wanted})
    return state.report()


PROFILED = {
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag"],
    "events": ["user_id", "event_type"],
}


def _profiled(spark: SparkSession, sf: str, table: str) -> ProfileState:
    state, rows = ProfileState(spark, shared_folder(spark, "merged"), PROFILED[table]), inputs.table(spark, sf, table)
    for k in range(BATCHES):
        state.add(k, _batch(rows, k))
    return state


def merged_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct values per column, exact, and whether the sketches of three batches are within
    three standard errors of them."""
    found = []
    for table, columns in PROFILED.items():
        exact = inputs.table(spark, sf, table).agg(*[F.count_distinct(c).alias(c) for c in columns])
        exact = exact.unpivot([], columns, "column_name", "exact")
        off = F.abs(F.col("distinct_values") - F.col("exact"))
        found.append(_profiled(spark, sf, table).distinct().join(exact, "column_name").select(
            F.lit(table).alias("table_name"), "column_name", "row_count", "nulls", F.col("exact").alias("distinct_values"),
            (off <= F.col("exact") * (3 * SKETCH_ERROR)).alias("within")))
    return concat_frames(*found)


def merged_frequent(spark: SparkSession, sf: str) -> DataFrame:
    """Values that more than one row in MOST_VALUES + 1 has, counted exactly, and whether the
    summary of three batches has them within its bounds."""
    found = []
    for table, columns in PROFILED.items():
        rows = inputs.table(spark, sf, table).select(*[F.col(c).cast("string").alias(c) for c in columns])
        counted = rows.unpivot([], columns, "column_name", "value").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
        total = rows.agg(F.count(F.lit(1)).alias("total"))  # one row
        often = counted.join(F.broadcast(total)).where(F.col("n") * (MOST_VALUES + 1) > F.col("total")).drop("total")
        kept = _profiled(spark, sf, table).frequent().withColumnsRenamed({"column_name": "c", "value": "v"})
        meet = (F.col("column_name") == F.col("c")) & F.col("value").eqNullSafe(F.col("v"))
        found.append(often.join(kept, meet, "left").select(
            F.lit(table).alias("table_name"), "column_name", "value", "n",
            F.coalesce(F.col("n").between(F.col("at_least"), F.col("at_most")), F.lit(False)).alias("within")))
    return concat_frames(*found)


QUERIES = {f.__name__: f for f in (merged_geolocation, merged_orders, merged_tests, merged_distinct, merged_frequent)}
