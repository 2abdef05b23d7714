"""Every silver and gold model, composed into one plan from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import centroid_and_modes, first_per_key
from ..plans import gold, inputs, silver


# Coordinates are means of doubles, whose last digits depend on the order of
# addition; the queries round them so that engines can be compared.
def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def silver_customers(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_customers(inputs.customers(spark, sf))


def silver_sellers(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_sellers(inputs.sellers(spark, sf))


def silver_products(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_products(inputs.products(spark, sf), inputs.translations(spark, sf))


def _geolocation(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_geolocation(inputs.geolocation(spark, sf))


def silver_geolocation(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_geolocation(spark, sf), "geolocation_lat", "geolocation_lng")


def silver_orders(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_orders(inputs.orders(spark, sf))


def latest_order_per_customer(spark: SparkSession, sf: str) -> DataFrame:
    """The orders de-duplication on a key that does repeat."""
    keyed = inputs.table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice")
    return first_per_key(keyed, ["o_custkey"], [F.col("o_orderdate").desc_nulls_first()])


def silver_order_items(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_order_items(inputs.order_items(spark, sf))


def silver_order_payments(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_order_payments(inputs.order_payments(spark, sf))


def silver_order_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_order_reviews(
        inputs.order_reviews(spark, sf), silver.order_ids(inputs.orders(spark, sf)))


def dim_customers(spark: SparkSession, sf: str) -> DataFrame:
    dim = gold.dim_customers(silver_customers(spark, sf), _geolocation(spark, sf))
    return _rounded(dim, "customer_lat", "customer_lng")


def dim_sellers(spark: SparkSession, sf: str) -> DataFrame:
    dim = gold.dim_sellers(silver_sellers(spark, sf), _geolocation(spark, sf))
    return _rounded(dim, "seller_lat", "seller_lng")


def dim_products(spark: SparkSession, sf: str) -> DataFrame:
    return gold.dim_products(silver_products(spark, sf))


def _customer_keys(spark: SparkSession, sf: str) -> DataFrame:
    return gold.dimension_keys(silver_customers(spark, sf), "customer_id")


def fact_orders(spark: SparkSession, sf: str) -> DataFrame:
    return gold.fact_orders(silver_orders(spark, sf), _customer_keys(spark, sf))


def fact_order_items(spark: SparkSession, sf: str) -> DataFrame:
    return gold.fact_order_items(
        silver_order_items(spark, sf),
        silver_orders(spark, sf),
        _customer_keys(spark, sf),
        gold.dimension_keys(silver_products(spark, sf), "product_id"),
        gold.dimension_keys(silver_sellers(spark, sf), "seller_id"),
    )


def fact_payments(spark: SparkSession, sf: str) -> DataFrame:
    return gold.fact_payments(
        silver_order_payments(spark, sf), silver_orders(spark, sf), _customer_keys(spark, sf))


def fact_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return gold.fact_reviews(
        silver_order_reviews(spark, sf), silver_orders(spark, sf), _customer_keys(spark, sf))


def geolocation_preview(spark: SparkSession, sf: str) -> DataFrame:
    """Centroid, modes and size per zip prefix as written, before any cast."""
    grouped = centroid_and_modes(
        inputs.geolocation(spark, sf),
        "geolocation_zip_code_prefix",
        means=["geolocation_lat", "geolocation_lng"],
        modes=["geolocation_city", "geolocation_state"],
        size="n_rows",
    )
    return _rounded(grouped, "geolocation_lat", "geolocation_lng")


QUERIES = {
    f.__name__: f
    for f in (
        silver_customers, silver_sellers, silver_products, silver_geolocation,
        silver_orders, latest_order_per_customer, silver_order_items,
        silver_order_payments, silver_order_reviews,
        dim_customers, dim_sellers, dim_products,
        fact_orders, fact_order_items, fact_payments, fact_reviews,
        geolocation_preview,
    )
}
