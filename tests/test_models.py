"""Rules of the models on literal rows: nulls, ties, orphans, order of rows."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import values
from tidemark.plans import gold, silver
from tidemark.sinks import conform


@pytest.fixture
def bronze(spark):
    """bronze('pg_orders', {...}, …) with declared types; columns left out are null."""
    def make(table, *records):
        names = sorted({k for r in records for k in r})
        df = spark.createDataFrame([tuple(None if r.get(n) is None else str(r[n]) for n in names) for r in records],
                                   ", ".join(f"{n} string" for n in names))
        return conform(df, table)
    return make


def test_null_keys_are_dropped(bronze):
    assert silver.silver_orders(bronze("pg_orders", {"order_id": None, "customer_id": "c"})).count() == 0
    items = bronze("pg_order_items", {"order_id": "o", "price": 1}, {"order_item_id": 1, "price": 1})
    assert silver.silver_order_items(items).count() == 0
    assert silver.silver_customers(bronze("pg_customers", {"customer_city": "x"})).count() == 0
    assert silver.silver_sellers(bronze("pg_sellers", {"seller_city": "x"})).count() == 0


def test_latest_order_wins_and_missing_time_is_latest(bronze):
    df = silver.silver_orders(bronze(
        "pg_orders",
        {"order_id": "a", "order_status": "created", "order_purchase_timestamp": "2024-01-01"},
        {"order_id": "a", "order_status": "shipped", "order_purchase_timestamp": "2024-01-02"},
        {"order_id": "b", "order_status": "created", "order_purchase_timestamp": "2024-01-01"},
        {"order_id": "b", "order_status": "canceled"},
    ))
    assert values(df, "order_id", "order_status") == [("a", "shipped"), ("b", "canceled")]


def test_dedup_key_is_the_cut_id(bronze):
    long = "x" * 32
    df = silver.silver_orders(bronze(
        "pg_orders",
        {"order_id": long + "1", "order_purchase_timestamp": "2024-01-01"},
        {"order_id": long + "2", "order_purchase_timestamp": "2024-01-02"},
    ))
    assert values(df, "order_id", "order_purchase_ts") == [(long, datetime(2024, 1, 2))]


def test_item_total_is_null_when_a_part_is(bronze):
    df = silver.silver_order_items(bronze(
        "pg_order_items",
        {"order_id": "a", "order_item_id": 1, "price": "1.10", "freight_value": "2.20"},
        {"order_id": "a", "order_item_id": 2, "price": "1.10"},
    ))
    assert values(df, "order_item_id", "item_total_value") == [(1, Decimal("3.30")), (2, None)]


def test_latest_review_where_order_is_known(bronze):
    reviews = bronze(
        "stream_order_reviews",
        {"review_id": "r", "order_id": "o", "review_score": 1},
        {"review_id": "r", "order_id": "o", "review_score": 2, "review_creation_date": "2024-01-01"},
        {"review_id": "r", "order_id": "gone", "review_score": 3, "review_creation_date": "2024-01-01"},
        {"review_id": "r", "order_id": "p", "review_score": 4, "review_creation_date": "2024-01-01"},
    )
    orders = bronze("pg_orders", {"order_id": "o", "customer_id": "c"}, {"order_id": "p", "customer_id": "c"})
    cleaned = silver.silver_order_reviews(reviews, silver.order_ids(orders))
    assert values(cleaned, "order_id", "review_score") == [("o", 2), ("p", 4)]
    assert values(cleaned) == values(silver.silver_order_reviews(reviews, silver.silver_orders(orders)))
    customers = gold.dimension_keys(silver.silver_customers(bronze("pg_customers", {"customer_id": "c"})), "customer_id")
    facts = gold.fact_reviews(cleaned, silver.silver_orders(orders), customers)
    assert values(facts, "review_id", "order_id") == [("r", "p")]


def test_category_falls_back(bronze):
    products = bronze("pg_products", {"product_id": "1", "product_category_name": "a"},
                      {"product_id": "2", "product_category_name": "b", "product_weight_g": "2.5"},
                      {"product_id": "3"})
    words = bronze("api_translations", {"product_category_name": "a", "product_category_name_english": "toys_games"})
    df = silver.silver_products(products, words)
    assert values(df, "product_id", "product_category", "product_weight_g") == [
        ("1", "toys_games", None), ("2", "b", 3), ("3", "unknown", None)]
    assert values(gold.dim_products(df), "product_category") == [("B",), ("Toys Games",), ("Unknown",)]


def test_geolocation_spellings_of_a_zip_are_one(bronze):
    df = silver.silver_geolocation(bronze(
        "api_geolocation",
        {"geolocation_zip_code_prefix": "01037", "geolocation_lat": 1, "geolocation_lng": 2, "geolocation_city": "b"},
        {"geolocation_zip_code_prefix": "1037", "geolocation_lat": 3, "geolocation_lng": 2, "geolocation_city": "a"},
    ))
    assert values(df) == [(Decimal(1037), 2.0, 2.0, "a", None)]


def test_orphans(bronze):
    orders = silver.silver_orders(bronze(
        "pg_orders", {"order_id": "o", "customer_id": "c"}, {"order_id": "lost", "customer_id": "nobody"},
        {"order_id": "anon"}))
    customers = gold.dimension_keys(silver.silver_customers(bronze("pg_customers", {"customer_id": "c"})), "customer_id")
    products = gold.dimension_keys(silver.silver_products(
        bronze("pg_products", {"product_id": "p"}), bronze("api_translations", {"product_category_name": "a"})), "product_id")
    sellers = gold.dimension_keys(silver.silver_sellers(bronze("pg_sellers", {"seller_id": "s"})), "seller_id")
    full = {"order_id": "o", "order_item_id": 1, "product_id": "p", "seller_id": "s", "price": 1, "freight_value": 1}
    items = bronze("pg_order_items", full, {**full, "order_item_id": 2, "seller_id": "x"},
                   {**full, "order_item_id": 3, "product_id": "x"}, {**full, "order_id": "x"},
                   {**full, "order_id": "lost"})
    facts = gold.fact_order_items(silver.silver_order_items(items), orders, customers, products, sellers)
    assert values(facts, "order_id", "order_item_id") == [("o", 1)]

    pays = silver.silver_order_payments(bronze(
        "stream_order_payments", {"order_id": "o", "payment_sequential": 1},
        {"order_id": "x", "payment_sequential": 1}, {"order_id": "lost", "payment_sequential": 1}))
    known = gold.fact_payments(pays, orders, customers).select("order_id", F.col("customer_key").isNotNull())
    assert values(known) == [("lost", False), ("o", True), ("x", False)]
    assert values(gold.fact_orders(orders, customers).select("order_id", F.col("customer_key").isNull())) == [
        ("anon", True), ("lost", True), ("o", False)]


def test_dimension_keys_are_those_of_the_dimension(bronze):
    customers = silver.silver_customers(bronze(
        "pg_customers", {"customer_id": "a", "customer_zip_code_prefix": "1"},
        {"customer_id": "b", "customer_zip_code_prefix": "2"}))
    places = silver.silver_geolocation(bronze(
        "api_geolocation", {"geolocation_zip_code_prefix": "1", "geolocation_lat": 1, "geolocation_lng": 1}))
    dim = gold.dim_customers(customers, places)
    assert values(gold.dimension_keys(customers, "customer_id")) == values(dim, "customer_id", "customer_key")
    assert values(dim, "customer_id", "customer_lat") == [("a", 1.0), ("b", None)]


def test_joins_of_facts_carry_no_digest(spark):
    from tidemark.queries import models
    for fact in (models.fact_order_items, models.fact_orders, models.fact_payments):
        plan = fact(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "md5(" in plan.split("Join", 1)[0] and "md5(" not in plan.split("Join", 1)[1]
