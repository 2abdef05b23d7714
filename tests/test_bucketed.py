"""Facts from tables stored by order id: no shuffle of the history, whole results."""

import re
import uuid

import pytest
from conftest import SF, values
from pyspark.sql import functions as F

from tidemark.plans import gold, inputs, silver
from tidemark.plans.bucketed import BucketedStore


@pytest.fixture
def store(spark):
    database = f"by_order_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {database}")
    yield BucketedStore(spark, database, 4)
    spark.sql(f"DROP DATABASE {database} CASCADE")


def loaded(store, given):
    for table in ("pg_orders", "pg_order_items", "stream_order_payments"):
        for part in given[table].randomSplit([1.0, 1.0, 1.0], 5):
            store.append(table, part)
    store.key_orders(gold.dimension_keys(silver.silver_customers(given["pg_customers"]), "customer_id"))


def dimensions(given):
    products = silver.silver_products(given["pg_products"], given["api_translations"])
    return gold.dimension_keys(products, "product_id"), gold.dimension_keys(silver.silver_sellers(given["pg_sellers"]), "seller_id")


def exchanged(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Scan parquet" in plan
    return re.findall(r"Exchange hashpartitioning\(([a-z_]+)#", plan)


def test_no_exchange_on_the_order(spark, store):
    given = inputs.bronze(spark, SF)
    loaded(store, given)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if all tables were large
    try:
        assert "order_id" not in exchanged(store.fact_payments()) + exchanged(store.orders())
        assert exchanged(store.items()) == exchanged(store.payments()) == []
        by = exchanged(store.fact_order_items(*dimensions(given)))
        assert "order_id" not in by and "product_id" in by
        # The plain way shuffles both sides.
        items = silver.silver_order_items(given["pg_order_items"])
        customers = gold.dimension_keys(silver.silver_customers(given["pg_customers"]), "customer_id")
        assert "order_id" in exchanged(gold.fact_order_items(items, silver.silver_orders(given["pg_orders"]), customers, *dimensions(given)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_same_facts_with_a_third_under_one_order(spark, store):
    given = inputs.bronze(spark, SF)
    hot = F.when(F.xxhash64("order_id", "order_item_id") % 3 == 0, F.lit("1")).otherwise(F.col("order_id"))
    items = given["pg_order_items"].withColumn("order_id", hot)
    given["pg_order_items"] = items.union(items.limit(50))  # repeated rows too
    loaded(store, given)
    customers = gold.dimension_keys(silver.silver_customers(given["pg_customers"]), "customer_id")
    orders = silver.silver_orders(given["pg_orders"])
    want = gold.fact_order_items(silver.silver_order_items(given["pg_order_items"]), orders, customers, *dimensions(given))
    assert values(store.fact_order_items(*dimensions(given))) == values(want)
    assert values(store.fact_payments()) == values(gold.fact_payments(silver.silver_order_payments(given["stream_order_payments"]), orders, customers))


def test_the_order_loaded_last_counts(spark, store):
    orders = inputs.orders(spark, SF).limit(20)
    for k, status in enumerate(("created", "shipped")):
        store.append("pg_orders", orders.withColumn("order_status", F.lit(status)).withColumn("_ingested_at", F.expr(f"timestamp'2024-01-0{k + 1} 00:00:00'")))
    assert values(store.orders().select("order_status").distinct()) == [("shipped",)]
    with pytest.raises(KeyError):
        store.append("pg_customers", orders)


def test_buckets_follow_the_rows():
    from tidemark.plans.bucketed import BUCKET_ROWS, buckets_for
    assert buckets_for(0) == buckets_for(8 * BUCKET_ROWS) == 8 and buckets_for(216_000_000) == 216
