"""Staged builds, and the shape of plans."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF, values
from tidemark.plans import gold, inputs, silver
from tidemark.plans.build import LAYERS, build, compose, table_of
from tidemark.queries import QUERIES


@pytest.fixture(scope="module")
def bronze(spark):
    return inputs.bronze(spark, SF)


def test_build_publishes_all_and_reports_every_test(spark, bronze, tmp_path):
    done = build(spark, str(tmp_path), bronze)
    assert done.failed_layer is None and len(done.published) == 15
    assert done.report.count() == 80
    assert done.report.where("severity = 'warn'").count() == 10
    for layer, waves, _ in LAYERS:
        for name in (n for wave in waves for n in wave):
            assert table_of(spark, str(tmp_path), layer, name).read().count() == done.rows[name]
    lazily = compose(bronze, ["fact_order_items", "fact_reviews"])
    for name, df in lazily.items():
        assert values(df) == values(done.models[name])


def test_failing_test_stops_the_next_layer_and_keeps_what_was(spark, bronze, tmp_path):
    root = str(tmp_path)
    good = build(spark, root, bronze)
    twice = {**bronze, "pg_sellers": bronze["pg_sellers"].union(bronze["pg_sellers"])}
    bad = build(spark, root, twice)
    assert bad.failed_layer == "silver" and bad.published == [] and "fact_orders" not in bad.models
    failed = bad.report.where("status = 'fail'").select("model", "test")
    assert values(failed) == [("silver_sellers", "unique")]
    sellers = table_of(spark, root, "silver", "silver_sellers").read()
    assert sellers.count() == good.rows["silver_sellers"]


def test_warnings_do_not_stop_a_build(spark, bronze, tmp_path):
    lost = bronze["pg_order_items"].withColumn("product_id", F.when(F.col("order_item_id") == 1, "gone").otherwise(F.col("product_id")))
    done = build(spark, str(tmp_path), {**bronze, "pg_order_items": lost})
    assert done.failed_layer is None
    warned = done.report.where("status = 'warn'").select("model", "column_name")
    assert values(warned) == [("silver_order_items", "product_id")]
    assert done.rows["fact_order_items"] < done.rows["silver_order_items"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_keeps_one_row_per_key_before_the_shuffle(spark):
    text = plan(silver.silver_order_items(inputs.order_items(spark, SF)))
    limit, exchange, early = (m.start() for m in (
        re.search("WindowGroupLimit.*Final", text), re.search("Exchange hashpartitioning", text),
        re.search("WindowGroupLimit.*Partial", text)))
    assert limit < exchange < early


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    inputs.order_items(spark, SF).withColumn("unused", F.lit("x")).write.parquet(f"{tmp_path}/items")
    df = silver.silver_order_items(spark.read.parquet(f"{tmp_path}/items"))
    scan = [line for line in plan(df).splitlines() if "FileScan" in line][0]
    assert "unused" not in scan
    explained = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    pushed = re.search(r"PushedFilters: \[(.*)\]", explained).group(1)
    assert "IsNotNull(order_id)" in pushed and "IsNotNull(order_item_id)" in pushed


LAZY = [n for n in QUERIES if n.startswith(("silver_", "dim_", "fact_", "dq_", "profile_")) and n != "dq_report"]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "BatchEval", "MapInPandas"):
        assert bad not in text


def test_facts_join_large_tables_by_merge(spark):
    for name in ("fact_order_items", "fact_payments", "fact_reviews"):
        text = plan(QUERIES[name](spark, SF))
        joins = re.findall(r"(\w+Join) \[order_id#\d+\]", text)
        assert joins and set(joins) == {"SortMergeJoin"}, name


def test_a_third_of_all_rows_under_one_key(spark, tmp_path):
    """One order, customer, product and seller hold a third of the items; the
    hot partitions are split and nothing is lost or doubled."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    n = 30000
    hot = F.when(F.col("id") % 3 == 0, F.lit(7))
    items = spark.range(n).select(
        F.coalesce(hot, F.col("id") % 5000).cast("string").alias("order_id"),
        F.col("id").cast("int").alias("order_item_id"),
        F.coalesce(hot, F.col("id") % 300).cast("string").alias("product_id"),
        F.coalesce(hot, F.col("id") % 200).cast("string").alias("seller_id"),
        F.lit(None).cast("timestamp_ntz").alias("shipping_limit_date"),
        F.lit(1).cast("decimal(12,2)").alias("price"), F.lit(1).cast("decimal(12,2)").alias("freight_value"))
    items.repartition(16).write.parquet(f"{tmp_path}/items")
    key = lambda k, m: spark.range(m).select(F.col("id").cast("string").alias(f"{k}_id"))
    orders = key("order", 5000).withColumn("customer_id", F.when(F.col("order_id") % 3 == 0, "7").otherwise(F.col("order_id") % 100))
    kept = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = gold.fact_order_items(
            silver.silver_order_items(spark.read.parquet(f"{tmp_path}/items")), orders,
            gold.dimension_keys(key("customer", 100), "customer_id"),
            gold.dimension_keys(key("product", 300), "product_id"),
            gold.dimension_keys(key("seller", 200), "seller_id"))
        got = df.collect()
        assert len(got) == n and len({r["order_item_key"] for r in got}) == n
        final = df._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in final
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_tables_are_written_with_entropy_coding(spark, rows, tmp_path):
    import glob
    from tidemark.sinks import VersionedTable
    table = VersionedTable(spark, f"{tmp_path}/t")
    table.replace(rows("k string", ("a",)))
    files = glob.glob(f"{tmp_path}/t/**/*.parquet", recursive=True)
    assert files and all(f.endswith(".zstd.parquet") for f in files) and values(table.read()) == [("a",)]
