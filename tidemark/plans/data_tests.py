"""The data tests of the silver and gold models."""

from __future__ import annotations

from ..operators.checks import accepted, not_null, relationship, unique

# --- fixed values: accepted order statuses ----------------------------------
ORDER_STATUSES = (
    "shipped", "canceled", "delivered", "invoiced",
    "unavailable", "processing", "approved", "created",
)

# --- fixed values: which tests hold for which column, and how severely -------
SILVER = [
    unique("silver_sellers", "seller_id"),
    not_null("silver_sellers", "seller_id"),
    not_null("silver_sellers", "seller_zip_code_prefix"),

    not_null("silver_customers", "customer_id"),
    unique("silver_customers", "customer_id"),
    not_null("silver_customers", "customer_unique_id"),

    not_null("silver_products", "product_id"),
    unique("silver_products", "product_id"),

    not_null("silver_orders", "order_id"),
    unique("silver_orders", "order_id"),
    relationship("silver_orders", "customer_id", "silver_customers", "customer_id").warn(),
    accepted("silver_orders", "order_status", ORDER_STATUSES),

    not_null("silver_order_items", "order_id"),
    not_null("silver_order_items", "order_item_id"),
    relationship("silver_order_items", "product_id", "silver_products", "product_id").warn(),
    relationship("silver_order_items", "seller_id", "silver_sellers", "seller_id").warn(),
    unique("silver_order_items", "order_id", "order_item_id"),

    not_null("silver_order_payments", "order_id"),
    relationship("silver_order_payments", "order_id", "silver_orders", "order_id").warn(),
    not_null("silver_order_payments", "payment_sequential"),
    unique("silver_order_payments", "order_id", "payment_sequential"),

    unique("silver_order_reviews", "review_id", "order_id"),
    not_null("silver_order_reviews", "review_id"),
    not_null("silver_order_reviews", "order_id"),
    relationship("silver_order_reviews", "order_id", "silver_orders", "order_id").warn(),

    not_null("silver_geolocation", "geolocation_zip_code_prefix"),
    unique("silver_geolocation", "geolocation_zip_code_prefix"),
]

GOLD = [
    unique("dim_customers", "customer_key"),
    not_null("dim_customers", "customer_key"),
    unique("dim_customers", "customer_id"),
    not_null("dim_customers", "customer_id"),
    relationship("dim_customers", "customer_id", "silver_customers", "customer_id").warn(),
    not_null("dim_customers", "customer_zip_code_prefix"),

    unique("dim_sellers", "seller_key"),
    not_null("dim_sellers", "seller_key"),
    unique("dim_sellers", "seller_id"),
    not_null("dim_sellers", "seller_id"),
    not_null("dim_sellers", "seller_zip_code_prefix"),

    unique("dim_products", "product_key"),
    not_null("dim_products", "product_key"),
    unique("dim_products", "product_id"),
    not_null("dim_products", "product_id"),
    relationship("dim_products", "product_id", "silver_products", "product_id"),
    not_null("dim_products", "product_category"),

    not_null("fact_orders", "order_id"),
    unique("fact_orders", "order_id"),
    not_null("fact_orders", "customer_key"),
    relationship("fact_orders", "customer_key", "dim_customers", "customer_key"),
    not_null("fact_orders", "order_status"),
    not_null("fact_orders", "order_purchase_ts"),

    not_null("fact_order_items", "order_item_key"),
    unique("fact_order_items", "order_item_key"),
    not_null("fact_order_items", "order_id"),
    relationship("fact_order_items", "order_id", "fact_orders", "order_id"),
    not_null("fact_order_items", "customer_key"),
    relationship("fact_order_items", "customer_key", "dim_customers", "customer_key"),
    not_null("fact_order_items", "product_key"),
    relationship("fact_order_items", "product_key", "dim_products", "product_key"),
    not_null("fact_order_items", "seller_key"),
    relationship("fact_order_items", "seller_key", "dim_sellers", "seller_key"),
    not_null("fact_order_items", "order_item_id"),
    not_null("fact_order_items", "price"),
    not_null("fact_order_items", "freight_value"),

    not_null("fact_payments", "payment_key"),
    unique("fact_payments", "payment_key"),
    not_null("fact_payments", "order_id"),
    relationship("fact_payments", "order_id", "fact_orders", "order_id"),
    not_null("fact_payments", "customer_key"),
    relationship("fact_payments", "customer_key", "dim_customers", "customer_key"),
    not_null("fact_payments", "payment_sequential"),
    not_null("fact_payments", "payment_type"),
    not_null("fact_payments", "payment_installments"),
    not_null("fact_payments", "payment_value"),

    not_null("fact_reviews", "review_id"),
    unique("fact_reviews", "review_id").warn(),
    not_null("fact_reviews", "order_id"),
    relationship("fact_reviews", "order_id", "fact_orders", "order_id").warn(),
    not_null("fact_reviews", "customer_key").warn(),
    relationship("fact_reviews", "customer_key", "dim_customers", "customer_key").warn(),
    not_null("fact_reviews", "review_score"),
]
