"""Silver models: typed, filtered, de-duplicated, normalised."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import int_round, to_money, to_zip, varchar, word_case
from ..operators.aggregate import centroid_and_modes
from ..operators.dedup import first_per_key
from ..schemas import INGESTED_AT


def present(*columns: str) -> Column:
    """None of the columns is null; reaches the scan, which ``dropna`` does not."""
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])


def silver_customers(customers: DataFrame) -> DataFrame:
    return customers.where(present("customer_id")).select(
        varchar("customer_id", 32).alias("customer_id"),
        varchar("customer_unique_id", 32).alias("customer_unique_id"),
        to_zip("customer_zip_code_prefix").alias("customer_zip_code_prefix"),
        varchar(word_case("customer_city"), 50).alias("customer_city"),
        varchar(F.upper("customer_state"), 2).alias("customer_state"),
    )


def silver_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.where(present("seller_id")).select(
        varchar("seller_id", 32).alias("seller_id"),
        to_zip("seller_zip_code_prefix").alias("seller_zip_code_prefix"),
        varchar(word_case("seller_city"), 100).alias("seller_city"),
        varchar(F.upper("seller_state"), 2).alias("seller_state"),
    )


def silver_products(products: DataFrame, translations: DataFrame) -> DataFrame:
    """Category in English, else as given, else ``unknown``."""
    category = F.coalesce("product_category_name_english", "product_category_name", F.lit("unknown"))
    named = products.where(present("product_id")).join(
        translations.select("product_category_name", "product_category_name_english"),
        "product_category_name",
        "left",
    )
    return named.select(
        varchar("product_id", 32).alias("product_id"),
        varchar(category, 50).alias("product_category"),
        int_round("product_name_lenght").alias("product_name_length"),
        int_round("product_description_lenght").alias("product_description_length"),
        int_round("product_photos_qty").alias("product_photos_qty"),
        int_round("product_height_cm").alias("product_height_cm"),
        int_round("product_length_cm").alias("product_length_cm"),
        int_round("product_width_cm").alias("product_width_cm"),
        int_round("product_weight_g").alias("product_weight_g"),
    )


def silver_geolocation(geolocation: DataFrame) -> DataFrame:
    """One row per zip prefix: mean coordinates, most frequent city and state."""
    zipped = geolocation.withColumn(
        "geolocation_zip_code_prefix", to_zip("geolocation_zip_code_prefix")
    )
    grouped = centroid_and_modes(
        zipped,
        "geolocation_zip_code_prefix",
        means=["geolocation_lat", "geolocation_lng"],
        modes=["geolocation_city", "geolocation_state"],
    )
    return grouped.select(
        "geolocation_zip_code_prefix",
        "geolocation_lat",
        "geolocation_lng",
        varchar("geolocation_city", 50).alias("geolocation_city"),
        varchar("geolocation_state", 2).alias("geolocation_state"),
    )


def typed_orders(orders: DataFrame) -> DataFrame:
    """Orders with an id, in the types of the silver table, not yet de-duplicated; with
    the time at which they were loaded, where bronze tells."""
    loaded = [INGESTED_AT] if INGESTED_AT in orders.columns else []
    return orders.where(present("order_id")).select(
        varchar("order_id", 32).alias("order_id"),
        varchar("customer_id", 32).alias("customer_id"),
        varchar("order_status", 20).alias("order_status"),
        F.col("order_purchase_timestamp").cast("timestamp_ntz").alias("order_purchase_ts"),
        F.col("order_approved_at").cast("timestamp_ntz").alias("order_approved_ts"),
        F.col("order_delivered_carrier_date").cast("timestamp_ntz").alias("order_delivered_carrier_ts"),
        F.col("order_delivered_customer_date").cast("timestamp_ntz").alias("order_delivered_customer_ts"),
        F.col("order_estimated_delivery_date").cast("timestamp_ntz").alias("order_estimated_delivery_ts"),
        *loaded,
    )


def latest_orders(typed: DataFrame) -> DataFrame:
    """The latest purchase per order id; a missing purchase time counts as latest.

    Of rows of the same purchase the one loaded last counts, where that is known: an
    order whose status changes keeps its purchase time.
    """
    return latest_typed_orders(typed).drop(INGESTED_AT)


def latest_typed_orders(typed: DataFrame) -> DataFrame:
    loaded = [F.col(INGESTED_AT).desc_nulls_last()] if INGESTED_AT in typed.columns else []
    return first_per_key(typed, ["order_id"], [F.col("order_purchase_ts").desc_nulls_first(), *loaded])


def silver_orders(orders: DataFrame) -> DataFrame:
    return latest_orders(typed_orders(orders))


def order_ids(orders: DataFrame) -> DataFrame:
    """The order ids that ``silver_orders`` holds, not yet de-duplicated.

    Enough where only existence is asked.
    """
    return orders.where(present("order_id")).select(varchar("order_id", 32).alias("order_id"))


def typed_order_items(items: DataFrame) -> DataFrame:
    return items.where(present("order_id", "order_item_id")).select(
        varchar("order_id", 32).alias("order_id"),
        F.col("order_item_id").cast("int").alias("order_item_id"),
        varchar("product_id", 32).alias("product_id"),
        varchar("seller_id", 32).alias("seller_id"),
        F.col("shipping_limit_date").cast("timestamp_ntz").alias("shipping_limit_ts"),
        to_money("price").alias("price"),
        to_money("freight_value").alias("freight_value"),
        to_money(F.col("price") + F.col("freight_value")).alias("item_total_value"),
    )


def silver_order_items(items: DataFrame) -> DataFrame:
    return first_per_key(typed_order_items(items), ["order_id", "order_item_id"])


def typed_order_payments(payments: DataFrame) -> DataFrame:
    return payments.where(present("order_id", "payment_sequential")).select(
        varchar("order_id", 32).alias("order_id"),
        F.col("payment_sequential").cast("int").alias("payment_sequential"),
        varchar("payment_type", 20).alias("payment_type"),
        F.col("payment_installments").cast("int").alias("payment_installments"),
        to_money("payment_value").alias("payment_value"),
    )


def silver_order_payments(payments: DataFrame) -> DataFrame:
    return first_per_key(typed_order_payments(payments), ["order_id", "payment_sequential"])


def silver_order_reviews(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    """The latest review per review and order id, where the order is known."""
    usable = reviews.where(present("review_id", "order_id")).select(
        "review_id",
        "order_id",
        F.col("review_score").cast("smallint").alias("review_score"),
        "review_comment_title",
        "review_comment_message",
        F.col("review_creation_date").cast("timestamp_ntz").alias("review_creation_date"),
        F.col("review_answer_timestamp").cast("timestamp_ntz").alias("review_answer_timestamp"),
    )
    latest = first_per_key(
        usable, ["review_id", "order_id"], [F.col("review_creation_date").desc_nulls_last()]
    )
    # Both sides grow with the data, so neither is to be broadcast.
    known = latest.join(orders.select("order_id").hint("merge"), "order_id", "left_semi")
    return known.select(
        varchar("review_id", 32).alias("review_id"),
        varchar("order_id", 32).alias("order_id"),
        "review_score",
        "review_comment_title",
        "review_comment_message",
        "review_creation_date",
        "review_answer_timestamp",
    )
