"""Table definitions of the three layers."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: bronze tables, their columns and types -------------------
BRONZE: dict[str, dict[str, str]] = {
    "api_geolocation": {
        "geolocation_zip_code_prefix": "varchar(10)",
        "geolocation_lat": "double",
        "geolocation_lng": "double",
        "geolocation_city": "varchar(100)",
        "geolocation_state": "varchar(2)",
    },
    "api_translations": {
        "product_category_name": "varchar(100)",
        "product_category_name_english": "varchar(100)",
    },
    "stream_order_payments": {
        "order_id": "varchar(64)",
        "payment_sequential": "int",
        "payment_type": "varchar(30)",
        "payment_installments": "int",
        "payment_value": "decimal(12,2)",
    },
    "stream_order_reviews": {
        "review_id": "varchar(64)",
        "order_id": "varchar(64)",
        "review_score": "smallint",
        "review_comment_title": "string",
        "review_comment_message": "string",
        "review_creation_date": "timestamp_ntz",
        "review_answer_timestamp": "timestamp_ntz",
    },
    "pg_orders": {
        "order_id": "varchar(64)",
        "customer_id": "varchar(64)",
        "order_status": "varchar(20)",
        "order_purchase_timestamp": "timestamp_ntz",
        "order_approved_at": "timestamp_ntz",
        "order_delivered_carrier_date": "timestamp_ntz",
        "order_delivered_customer_date": "timestamp_ntz",
        "order_estimated_delivery_date": "timestamp_ntz",
    },
    "pg_order_items": {
        "order_id": "varchar(64)",
        "order_item_id": "int",
        "product_id": "varchar(64)",
        "seller_id": "varchar(64)",
        "shipping_limit_date": "timestamp_ntz",
        "price": "decimal(12,2)",
        "freight_value": "decimal(12,2)",
    },
    "pg_customers": {
        "customer_id": "varchar(64)",
        "customer_unique_id": "varchar(64)",
        "customer_zip_code_prefix": "varchar(10)",
        "customer_city": "varchar(100)",
        "customer_state": "varchar(2)",
    },
    "pg_products": {
        "product_id": "varchar(64)",
        "product_category_name": "varchar(100)",
        "product_name_lenght": "decimal(20,4)",
        "product_description_lenght": "decimal(20,4)",
        "product_photos_qty": "decimal(20,4)",
        "product_weight_g": "decimal(10,2)",
        "product_length_cm": "decimal(10,2)",
        "product_height_cm": "decimal(10,2)",
        "product_width_cm": "decimal(10,2)",
    },
    "pg_sellers": {
        "seller_id": "varchar(64)",
        "seller_zip_code_prefix": "varchar(10)",
        "seller_city": "varchar(100)",
        "seller_state": "varchar(2)",
    },
}

# Lineage columns every bronze table carries.
SOURCE_FILE = "_source_file"
INGESTED_AT = "_ingested_at"

# --- fixed values: enforced output contracts --------------------------------
CONTRACTS: dict[str, T.StructType] = {
    "silver_sellers": T.StructType()
        .add("seller_id", T.StringType())
        .add("seller_zip_code_prefix", T.DecimalType(5, 0))
        .add("seller_city", T.StringType())
        .add("seller_state", T.StringType()),
    "silver_customers": T.StructType()
        .add("customer_id", T.StringType())
        .add("customer_unique_id", T.StringType())
        .add("customer_zip_code_prefix", T.DecimalType(5, 0))
        .add("customer_city", T.StringType())
        .add("customer_state", T.StringType()),
    "silver_order_payments": T.StructType()
        .add("order_id", T.StringType())
        .add("payment_sequential", T.IntegerType())
        .add("payment_type", T.StringType())
        .add("payment_installments", T.IntegerType())
        .add("payment_value", T.DecimalType(10, 2)),
}


def plain_type(declared: str) -> str:
    """The Spark type that stores a declared type (varchar(n) is stored as string)."""
    return "string" if declared.startswith("varchar") else declared


def bronze_ddl(table: str) -> str:
    """Reader schema of a bronze table, lineage columns included."""
    columns = [f"{name} {plain_type(kind)}" for name, kind in BRONZE[table].items()]
    return ", ".join([*columns, f"{SOURCE_FILE} string", f"{INGESTED_AT} timestamp"])
