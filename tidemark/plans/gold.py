"""Gold star schema: three dimensions, four facts.

Joins with a dimension carry no hint: Spark broadcasts it when its size, from
file statistics or measured at run time, is under the session's threshold, and
otherwise shuffles both sides and splits hot partitions. Joins of two tables
that both grow with the data ask for a merge join, since a compressed file can
look small enough to broadcast and not be.

Joins carry natural keys, which are short. A dimension's surrogate key is the digest of
its natural one, so facts work it out after their last join, and no shuffle carries it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import display_name, surrogate_key
from ..operators.dedup import first_per_key


def key_of(column: str) -> Column:
    """The surrogate key of the dimension row with this natural key; none for null."""
    return F.when(F.col(column).isNotNull(), surrogate_key(column)).alias(f"{column.removesuffix('_id')}_key")


def dimension_keys(silver: DataFrame, column: str) -> DataFrame:
    """The natural and the surrogate key of a dimension, all that facts use of it.

    Stands in for the dimension where it is not stored: places join at most
    once per row, so the dimension has these rows.
    """
    return silver.select(column, surrogate_key(column).alias(f"{column.removesuffix('_id')}_key"))


def _with_place(df: DataFrame, geolocation: DataFrame, zip_column: str, lat: str, lng: str) -> DataFrame:
    # One row per zip prefix, and a decimal(5,0) has fewer than 200,000 values:
    # the broadcast is bounded by the key type, however large the other side.
    points = geolocation.select(
        F.col("geolocation_zip_code_prefix").alias(zip_column),
        F.col("geolocation_lat").alias(lat),
        F.col("geolocation_lng").alias(lng),
    )
    return df.join(F.broadcast(points), zip_column, "left")


def dim_customers(customers: DataFrame, geolocation: DataFrame) -> DataFrame:
    placed = _with_place(customers, geolocation, "customer_zip_code_prefix", "customer_lat", "customer_lng")
    return placed.select(
        surrogate_key("customer_id").alias("customer_key"),
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
        "customer_lat",
        "customer_lng",
    )


def dim_sellers(sellers: DataFrame, geolocation: DataFrame) -> DataFrame:
    placed = _with_place(sellers, geolocation, "seller_zip_code_prefix", "seller_lat", "seller_lng")
    return placed.select(
        surrogate_key("seller_id").alias("seller_key"),
        "seller_id",
        "seller_zip_code_prefix",
        "seller_city",
        "seller_state",
        "seller_lat",
        "seller_lng",
    )


def dim_products(products: DataFrame) -> DataFrame:
    return products.select(
        surrogate_key("product_id").alias("product_key"),
        "product_id",
        display_name("product_category").alias("product_category"),
        "product_name_length",
        "product_description_length",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
        "product_photos_qty",
    )


def fact_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """``customers`` is dim_customers; an unknown customer leaves a null key."""
    known = customers.select(F.col("customer_id").alias("_known"))
    keyed = orders.join(known, orders["customer_id"] == F.col("_known"), "left").drop("customer_id")
    return keyed.withColumnRenamed("_known", "customer_id").select(
        "order_id",
        key_of("customer_id"),
        "order_status",
        "order_purchase_ts",
        "order_approved_ts",
        "order_delivered_carrier_ts",
        "order_delivered_customer_ts",
        "order_estimated_delivery_ts",
    )


def order_customers(orders: DataFrame, customers: DataFrame, how: str) -> DataFrame:
    """order_id to customer_id, null where ``customers`` does not have it.

    Facts look customers up through their order. Joining the two first keeps
    the larger table out of the join on customer_id.
    """
    known = customers.select(F.col("customer_id").alias("_known"))
    keyed = orders.select("order_id", "customer_id").join(known, F.col("customer_id") == F.col("_known"), how)
    return keyed.select("order_id", F.col("_known").alias("customer_id")).hint("merge")


def fact_order_items(
    items: DataFrame, orders: DataFrame, customers: DataFrame, products: DataFrame, sellers: DataFrame
) -> DataFrame:
    """Items whose order, customer, product and seller are all known."""
    return keyed_order_items(items, order_customers(orders, customers, "inner"), products, sellers)


def keyed_order_items(items: DataFrame, keyed: DataFrame, products: DataFrame, sellers: DataFrame) -> DataFrame:
    """``keyed`` leads from an order to its customer."""
    joined = (
        items.join(keyed, "order_id")
        .join(products.select("product_id"), "product_id")
        .join(sellers.select("seller_id"), "seller_id")
    )
    return joined.select(
        surrogate_key("order_id", "order_item_id").alias("order_item_key"),
        "order_id",
        key_of("customer_id"),
        key_of("product_id"),
        key_of("seller_id"),
        "order_item_id",
        "shipping_limit_ts",
        "price",
        "freight_value",
        "item_total_value",
    )


def fact_payments(payments: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """All payments; without a known order or customer the key is null."""
    return keyed_payments(payments, order_customers(orders, customers, "left"))


def keyed_payments(payments: DataFrame, keyed: DataFrame) -> DataFrame:
    return payments.join(keyed, "order_id", "left").select(
        surrogate_key("order_id", "payment_sequential").alias("payment_key"),
        "order_id",
        key_of("customer_id"),
        "payment_sequential",
        "payment_type",
        "payment_installments",
        "payment_value",
    )


def fact_reviews(reviews: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per review id, the latest, where order and customer are known."""
    latest = first_per_key(
        reviews,
        ["review_id"],
        [F.col("review_creation_date").desc_nulls_last(), F.col("order_id").desc_nulls_first()],
    )
    return latest.join(order_customers(orders, customers, "inner"), "order_id").select(
        "review_id",
        "order_id",
        key_of("customer_id"),
        "review_score",
        "review_comment_title",
        "review_comment_message",
        "review_creation_date",
        "review_answer_timestamp",
    )
