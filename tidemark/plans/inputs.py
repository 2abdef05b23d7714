"""The given test tables, shaped like bronze tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Category names are given in English already; a few get another spelling so
# that translated and untranslated categories both occur.
TRANSLATIONS = [
    ("economy", "budget_line"),
    ("small", "small_goods"),
    ("medium", "medium_goods"),
    ("promo", "special_offer"),
]


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Its schema is read from the file once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _text(name: str, alias: str):
    return F.col(name).cast("string").alias(alias)


def _no_time(alias: str):
    return F.lit(None).cast("timestamp_ntz").alias(alias)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        _text("c_custkey", "customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        _text("c_nationkey", "customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        F.substring("c_mktsegment", 1, 2).alias("customer_state"),
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        _text("s_suppkey", "seller_id"),
        _text("s_nationkey", "seller_zip_code_prefix"),
        F.col("s_name").alias("seller_city"),
        F.substring("s_name", 1, 2).alias("seller_state"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("decimal(20,4)")
    length = F.col("p_size").cast("decimal(10,2)")
    return table(spark, sf_dir, "part").select(
        _text("p_partkey", "product_id"),
        F.lower("p_type").alias("product_category_name"),
        size.alias("product_name_lenght"),
        size.alias("product_description_lenght"),
        size.alias("product_photos_qty"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("product_weight_g"),
        length.alias("product_length_cm"),
        length.alias("product_height_cm"),
        length.alias("product_width_cm"),
    )


def translations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ", ".join(f"('{given}', '{english}')" for given, english in TRANSLATIONS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(product_category_name, product_category_name_english)")


def geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        _text("c_nationkey", "geolocation_zip_code_prefix"),
        F.col("c_acctbal").alias("geolocation_lat"),
        (-F.col("c_acctbal")).alias("geolocation_lng"),
        F.col("c_mktsegment").alias("geolocation_city"),
        F.substring("c_mktsegment", 1, 2).alias("geolocation_state"),
    )


def orders(spark: SparkSession, sf_dir: str, key: str = "o_orderkey") -> DataFrame:
    status = (
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "created")
        .when(F.col("o_orderstatus") == "P", "shipped")
    )
    return table(spark, sf_dir, "orders").select(
        _text(key, "order_id"),
        _text("o_custkey", "customer_id"),
        status.alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        _no_time("order_approved_at"),
        _no_time("order_delivered_carrier_date"),
        _no_time("order_delivered_customer_date"),
        _no_time("order_estimated_delivery_date"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    tax = F.col("l_tax").cast("decimal(4,2)")
    return table(spark, sf_dir, "lineitem").select(
        _text("l_orderkey", "order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        _text("l_partkey", "product_id"),
        _text("l_suppkey", "seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        price.alias("price"),
        (price * tax).cast("decimal(12,2)").alias("freight_value"),
    )


def order_payments(spark: SparkSession, sf_dir: str, *extra: Column) -> DataFrame:
    return table(spark, sf_dir, "events").where("event_type = 'purchase'").select(
        _text("user_id", "order_id"),
        F.regexp_extract("props", r"(\d+)", 1).cast("int").alias("payment_sequential"),
        F.col("event_type").alias("payment_type"),
        F.lit(1).alias("payment_installments"),
        F.col("value").cast("decimal(12,2)").alias("payment_value"),
        *extra,
    )


def order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where("event_type <> 'purchase'").select(
        F.concat("event_type", F.lit("-"), (F.col("user_id") % 50).cast("string")).alias("review_id"),
        _text("user_id", "order_id"),
        (F.floor("value").cast("int") % 5 + 1).cast("smallint").alias("review_score"),
        F.col("event_type").alias("review_comment_title"),
        F.col("props").alias("review_comment_message"),
        F.col("ts").alias("review_creation_date"),
        _no_time("review_answer_timestamp"),
    )


def bronze(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    makers = {
        "api_geolocation": geolocation,
        "api_translations": translations,
        "stream_order_payments": order_payments,
        "stream_order_reviews": order_reviews,
        "pg_orders": orders,
        "pg_order_items": order_items,
        "pg_customers": customers,
        "pg_products": products,
        "pg_sellers": sellers,
    }
    return {name: make(spark, sf_dir) for name, make in makers.items()}
