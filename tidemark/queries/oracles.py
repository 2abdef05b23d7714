"""SQL (DuckDB) that the queries must agree with, over the same tables."""

from __future__ import annotations

import re

from ..operators.checks import Check

# ---- bronze-shaped inputs ----------------------------------------------------

_MODELS: dict[str, str] = {}

_MODELS["pg_customers"] = """
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_unique_id,
         CAST(c_nationkey AS VARCHAR) AS customer_zip_code_prefix,
         c_mktsegment AS customer_city, left(c_mktsegment, 2) AS customer_state
  FROM customer"""
_MODELS["pg_sellers"] = """
  SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, CAST(s_nationkey AS VARCHAR) AS seller_zip_code_prefix,
         s_name AS seller_city, left(s_name, 2) AS seller_state
  FROM supplier"""
_MODELS["pg_products"] = """
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, lower(p_type) AS product_category_name,
         CAST(p_size AS DECIMAL(20,4)) AS product_name_lenght,
         CAST(p_size AS DECIMAL(20,4)) AS product_description_lenght,
         CAST(p_size AS DECIMAL(20,4)) AS product_photos_qty,
         CAST(p_retailprice AS DECIMAL(10,2)) AS product_weight_g,
         CAST(p_size AS DECIMAL(10,2)) AS product_length_cm,
         CAST(p_size AS DECIMAL(10,2)) AS product_height_cm,
         CAST(p_size AS DECIMAL(10,2)) AS product_width_cm
  FROM part"""
_MODELS["api_translations"] = """
  SELECT * FROM (VALUES ('economy', 'budget_line'), ('small', 'small_goods'),
                        ('medium', 'medium_goods'), ('promo', 'special_offer'))
    AS t(product_category_name, product_category_name_english)"""
_MODELS["api_geolocation"] = """
  SELECT CAST(c_nationkey AS VARCHAR) AS geolocation_zip_code_prefix,
         c_acctbal AS geolocation_lat, -c_acctbal AS geolocation_lng,
         c_mktsegment AS geolocation_city, left(c_mktsegment, 2) AS geolocation_state
  FROM customer"""
_MODELS["pg_orders"] = """
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
         CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'created' WHEN 'P' THEN 'shipped' END
           AS order_status,
         o_orderdate AS order_purchase_timestamp,
         CAST(NULL AS TIMESTAMP) AS order_approved_at,
         CAST(NULL AS TIMESTAMP) AS order_delivered_carrier_date,
         CAST(NULL AS TIMESTAMP) AS order_delivered_customer_date,
         CAST(NULL AS TIMESTAMP) AS order_estimated_delivery_date
  FROM orders"""
_MODELS["pg_order_items"] = """
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id,
         CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
         l_shipdate AS shipping_limit_date,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(12,2))
           AS freight_value
  FROM lineitem"""
_MODELS["stream_order_payments"] = """
  SELECT CAST(user_id AS VARCHAR) AS order_id,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS payment_sequential,
         event_type AS payment_type, CAST(1 AS INTEGER) AS payment_installments,
         CAST(value AS DECIMAL(12,2)) AS payment_value
  FROM events WHERE event_type = 'purchase'"""
_MODELS["stream_order_reviews"] = """
  SELECT event_type || '-' || CAST(user_id % 50 AS VARCHAR) AS review_id,
         CAST(user_id AS VARCHAR) AS order_id,
         CAST(CAST(floor(value) AS INTEGER) % 5 + 1 AS SMALLINT) AS review_score,
         event_type AS review_comment_title, props AS review_comment_message,
         ts AS review_creation_date, CAST(NULL AS TIMESTAMP) AS review_answer_timestamp
  FROM events WHERE event_type <> 'purchase'"""


# ---- silver and gold ---------------------------------------------------------

def _worded(text: str) -> str:
    runs = r"'[\p{L}\p{N}]+|[^\p{L}\p{N}]+'"
    return (f"array_to_string(list_transform(regexp_extract_all({text}, {runs}), "
            f"lambda x: CASE WHEN x[1] = 'ß' THEN 'ß' ELSE upper(x[1]) END || lower(x[2:])), '')")


def _surrogate(*parts: str) -> str:
    texts = [f"coalesce(CAST({p} AS VARCHAR), '_dbt_utils_surrogate_key_null_')" for p in parts]
    return "md5(" + " || '-' || ".join(texts) + ")"


_MODELS["silver_customers"] = f"""
  SELECT left(customer_id, 32) AS customer_id, left(customer_unique_id, 32) AS customer_unique_id,
         CAST(customer_zip_code_prefix AS DECIMAL(5,0)) AS customer_zip_code_prefix,
         left({_worded('customer_city')}, 50) AS customer_city,
         left(upper(customer_state), 2) AS customer_state
  FROM pg_customers WHERE customer_id IS NOT NULL"""
_MODELS["silver_sellers"] = f"""
  SELECT left(seller_id, 32) AS seller_id,
         CAST(seller_zip_code_prefix AS DECIMAL(5,0)) AS seller_zip_code_prefix,
         left({_worded('seller_city')}, 100) AS seller_city, left(upper(seller_state), 2) AS seller_state
  FROM pg_sellers WHERE seller_id IS NOT NULL"""
_MODELS["silver_products"] = """
  SELECT left(p.product_id, 32) AS product_id,
         left(coalesce(t.product_category_name_english, p.product_category_name, 'unknown'), 50)
           AS product_category,
         CAST(round(p.product_name_lenght) AS INTEGER) AS product_name_length,
         CAST(round(p.product_description_lenght) AS INTEGER) AS product_description_length,
         CAST(round(p.product_photos_qty) AS INTEGER) AS product_photos_qty,
         CAST(round(p.product_height_cm) AS INTEGER) AS product_height_cm,
         CAST(round(p.product_length_cm) AS INTEGER) AS product_length_cm,
         CAST(round(p.product_width_cm) AS INTEGER) AS product_width_cm,
         CAST(round(p.product_weight_g) AS INTEGER) AS product_weight_g
  FROM pg_products p LEFT JOIN api_translations t USING (product_category_name)
  WHERE p.product_id IS NOT NULL"""
_MODELS["geo_points"] = """
  SELECT CAST(geolocation_zip_code_prefix AS DECIMAL(5,0)) AS zip, geolocation_lat AS lat,
         geolocation_lng AS lng, geolocation_city AS city, geolocation_state AS state
  FROM api_geolocation"""
_MODELS["geo_city"] = """
  SELECT zip, city FROM (
    SELECT zip, city, row_number() OVER (PARTITION BY zip ORDER BY count(*) DESC, city) AS r
    FROM geo_points WHERE city IS NOT NULL GROUP BY zip, city) WHERE r = 1"""
_MODELS["geo_state"] = """
  SELECT zip, state FROM (
    SELECT zip, state, row_number() OVER (PARTITION BY zip ORDER BY count(*) DESC, state) AS r
    FROM geo_points WHERE state IS NOT NULL GROUP BY zip, state) WHERE r = 1"""
_MODELS["silver_geolocation"] = """
  SELECT g.zip AS geolocation_zip_code_prefix, g.lat AS geolocation_lat, g.lng AS geolocation_lng,
         left(c.city, 50) AS geolocation_city, left(s.state, 2) AS geolocation_state
  FROM (SELECT zip, avg(lat) AS lat, avg(lng) AS lng FROM geo_points GROUP BY zip) g
  LEFT JOIN geo_city c ON g.zip = c.zip LEFT JOIN geo_state s ON g.zip = s.zip"""
_MODELS["silver_orders"] = """
  SELECT order_id, customer_id, order_status, order_purchase_ts, order_approved_ts,
         order_delivered_carrier_ts, order_delivered_customer_ts, order_estimated_delivery_ts
  FROM (
    SELECT left(order_id, 32) AS order_id, left(customer_id, 32) AS customer_id,
           left(order_status, 20) AS order_status, order_purchase_timestamp AS order_purchase_ts,
           order_approved_at AS order_approved_ts,
           order_delivered_carrier_date AS order_delivered_carrier_ts,
           order_delivered_customer_date AS order_delivered_customer_ts,
           order_estimated_delivery_date AS order_estimated_delivery_ts,
           row_number() OVER (PARTITION BY left(order_id, 32)
             ORDER BY order_purchase_timestamp DESC NULLS FIRST, customer_id NULLS FIRST,
                      order_status NULLS FIRST) AS r
    FROM pg_orders WHERE order_id IS NOT NULL) WHERE r = 1"""
_MODELS["silver_order_items"] = """
  SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_ts, price, freight_value,
         item_total_value
  FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id, order_item_id
             ORDER BY product_id NULLS FIRST, seller_id NULLS FIRST, shipping_limit_ts NULLS FIRST,
                      price NULLS FIRST, freight_value NULLS FIRST, item_total_value NULLS FIRST) AS r
    FROM (
      SELECT left(order_id, 32) AS order_id, order_item_id, left(product_id, 32) AS product_id,
             left(seller_id, 32) AS seller_id, shipping_limit_date AS shipping_limit_ts,
             CAST(price AS DECIMAL(10,2)) AS price, CAST(freight_value AS DECIMAL(10,2)) AS freight_value,
             CAST(price + freight_value AS DECIMAL(10,2)) AS item_total_value
      FROM pg_order_items WHERE order_id IS NOT NULL AND order_item_id IS NOT NULL)) WHERE r = 1"""
_MODELS["silver_order_payments"] = """
  SELECT order_id, payment_sequential, payment_type, payment_installments, payment_value
  FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id, payment_sequential
             ORDER BY payment_type NULLS FIRST, payment_installments NULLS FIRST,
                      payment_value NULLS FIRST) AS r
    FROM (
      SELECT left(order_id, 32) AS order_id, payment_sequential, left(payment_type, 20) AS payment_type,
             payment_installments, CAST(payment_value AS DECIMAL(10,2)) AS payment_value
      FROM stream_order_payments
      WHERE order_id IS NOT NULL AND payment_sequential IS NOT NULL)) WHERE r = 1"""
# The latest answer of a review and order, if the order is known.
_MODELS["silver_order_reviews"] = """
  SELECT left(v.review_id, 32) AS review_id, left(v.order_id, 32) AS order_id, v.review_score,
         v.review_comment_title, v.review_comment_message, v.review_creation_date, v.review_answer_timestamp
  FROM (
    SELECT first(answers ORDER BY review_creation_date DESC NULLS LAST, review_score NULLS FIRST,
                 review_comment_title NULLS FIRST, review_comment_message NULLS FIRST) AS v
    FROM stream_order_reviews answers
    WHERE review_id IS NOT NULL GROUP BY answers.review_id, answers.order_id)
  WHERE v.order_id IN (SELECT order_id FROM silver_orders)"""
# A place's point is looked up by its zip prefix.
_MODELS["dim_customers"] = f"""
  SELECT {_surrogate('customer_id')} AS customer_key, *,
         (SELECT geolocation_lat FROM silver_geolocation
          WHERE geolocation_zip_code_prefix = customer_zip_code_prefix) AS customer_lat,
         (SELECT geolocation_lng FROM silver_geolocation
          WHERE geolocation_zip_code_prefix = customer_zip_code_prefix) AS customer_lng
  FROM silver_customers"""
_MODELS["dim_sellers"] = f"""
  SELECT {_surrogate('seller_id')} AS seller_key, *,
         (SELECT geolocation_lat FROM silver_geolocation
          WHERE geolocation_zip_code_prefix = seller_zip_code_prefix) AS seller_lat,
         (SELECT geolocation_lng FROM silver_geolocation
          WHERE geolocation_zip_code_prefix = seller_zip_code_prefix) AS seller_lng
  FROM silver_sellers"""
_MODELS["dim_products"] = f"""
  SELECT {_surrogate('product_id')} AS product_key, product_id,
         {_worded("replace(product_category, '_', ' ')")} AS product_category,
         product_name_length, product_description_length, product_weight_g, product_length_cm,
         product_height_cm, product_width_cm, product_photos_qty
  FROM silver_products"""
_MODELS["fact_orders"] = """
  SELECT o.order_id, c.customer_key, o.order_status, o.order_purchase_ts, o.order_approved_ts,
         o.order_delivered_carrier_ts, o.order_delivered_customer_ts, o.order_estimated_delivery_ts
  FROM silver_orders o LEFT JOIN dim_customers c ON o.customer_id = c.customer_id"""
# Who an order belongs to, as the key that dim_customers must have for that customer.
_MODELS["order_owner"] = f"""
  SELECT order_id, {_surrogate('customer_id')} AS owner_key FROM silver_orders
  WHERE customer_id IN (SELECT customer_id FROM silver_customers)"""
# Grain: an item whose order, customer, product and seller are all known. Keys are made from
# the ids, not looked up.
_MODELS["fact_order_items"] = f"""
  SELECT {_surrogate('order_id', 'order_item_id')} AS order_item_key, order_id,
         (SELECT owner_key FROM order_owner w WHERE w.order_id = i.order_id) AS customer_key,
         {_surrogate('product_id')} AS product_key, {_surrogate('seller_id')} AS seller_key,
         order_item_id, shipping_limit_ts, price, freight_value, item_total_value
  FROM silver_order_items i
  WHERE order_id IN (SELECT order_id FROM order_owner)
    AND product_id IN (SELECT product_id FROM silver_products)
    AND seller_id IN (SELECT seller_id FROM silver_sellers)"""
# Grain: a payment, of an order that may be unknown.
_MODELS["fact_payments"] = f"""
  SELECT {_surrogate('order_id', 'payment_sequential')} AS payment_key, order_id,
         (SELECT owner_key FROM order_owner w WHERE w.order_id = paid.order_id) AS customer_key,
         payment_sequential, payment_type, payment_installments, payment_value
  FROM silver_order_payments paid"""
# Grain: a review in its latest answer, kept if the customer is known.
_MODELS["fact_reviews"] = """
  SELECT v.review_id, v.order_id,
         (SELECT owner_key FROM order_owner w WHERE w.order_id = v.order_id) AS customer_key,
         v.review_score, v.review_comment_title, v.review_comment_message, v.review_creation_date,
         v.review_answer_timestamp
  FROM (
    SELECT arg_max(answers, (coalesce(review_creation_date, TIMESTAMP '0001-01-01'), order_id)) AS v
    FROM silver_order_reviews answers GROUP BY answers.review_id)
  WHERE v.order_id IN (SELECT order_id FROM order_owner)"""
_MODELS["labelled"] = "SELECT d.doc_id, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)"


def _sql(body: str, **extra: str) -> str:
    """``body`` behind a WITH clause of the models it needs, directly or not."""
    known = {**_MODELS, **extra}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in known:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(known[name])
                needed.append(name)

    visit(body)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({known[n]})" for n in needed) + "\n" + body


# ---- data tests --------------------------------------------------------------

def _failures(check: Check) -> str:
    first = check.columns[0]
    if check.test == "not_null":
        return f"SELECT count(*) FROM {check.model} WHERE {first} IS NULL"
    if check.test == "unique":
        cols = ", ".join(check.columns)
        some = " AND ".join(f"{c} IS NOT NULL" for c in check.columns)
        return (f"SELECT count(*) FROM (SELECT 1 FROM {check.model} WHERE {some} "
                f"GROUP BY {cols} HAVING count(*) > 1)")
    if check.test == "accepted_values":
        values = ", ".join(f"'{v}'" for v in check.values)
        return f"SELECT count(DISTINCT {first}) FROM {check.model} WHERE {first} NOT IN ({values})"
    return (f"SELECT count(*) FROM {check.model} x WHERE x.{first} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {check.to} y WHERE y.{check.field} = x.{first})")


def _report(checks: list[Check]) -> str:
    rows = [
        f"SELECT '{c.model}' AS model, '{c.test}' AS test, '{c.label}' AS column_name, "
        f"'{c.severity}' AS severity, ({_failures(c)}) AS failures"
        for c in checks
    ]
    union = "\nUNION ALL ".join(rows)
    return _sql(
        "SELECT model, test, column_name, severity, failures, CASE WHEN failures = 0 THEN 'pass' "
        f"WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status FROM (\n{union})"
    )


def _check(model, test, *columns, severity="error", to=None, field=None, values=()):
    return Check(model, test, columns, severity, to, field, tuple(values))


# --- fixed values: the data tests that dq_report must run, stated apart from the code that runs
# them: model, test, columns, severity, and what a relationship refers to -----------------------
_EXPECTED = [
    ("silver_sellers", "unique", "seller_id", "error"),
    ("silver_sellers", "not_null", "seller_id", "error"),
    ("silver_sellers", "not_null", "seller_zip_code_prefix", "error"),
    ("silver_customers", "not_null", "customer_id", "error"),
    ("silver_customers", "unique", "customer_id", "error"),
    ("silver_customers", "not_null", "customer_unique_id", "error"),
    ("silver_products", "not_null", "product_id", "error"),
    ("silver_products", "unique", "product_id", "error"),
    ("silver_orders", "not_null", "order_id", "error"),
    ("silver_orders", "unique", "order_id", "error"),
    ("silver_orders", "relationships", "customer_id", "warn", "silver_customers.customer_id"),
    ("silver_orders", "accepted_values", "order_status", "error"),
    ("silver_order_items", "not_null", "order_id", "error"),
    ("silver_order_items", "not_null", "order_item_id", "error"),
    ("silver_order_items", "relationships", "product_id", "warn", "silver_products.product_id"),
    ("silver_order_items", "relationships", "seller_id", "warn", "silver_sellers.seller_id"),
    ("silver_order_items", "unique", "order_id, order_item_id", "error"),
    ("silver_order_payments", "not_null", "order_id", "error"),
    ("silver_order_payments", "relationships", "order_id", "warn", "silver_orders.order_id"),
    ("silver_order_payments", "not_null", "payment_sequential", "error"),
    ("silver_order_payments", "unique", "order_id, payment_sequential", "error"),
    ("silver_order_reviews", "unique", "review_id, order_id", "error"),
    ("silver_order_reviews", "not_null", "review_id", "error"),
    ("silver_order_reviews", "not_null", "order_id", "error"),
    ("silver_order_reviews", "relationships", "order_id", "warn", "silver_orders.order_id"),
    ("silver_geolocation", "not_null", "geolocation_zip_code_prefix", "error"),
    ("silver_geolocation", "unique", "geolocation_zip_code_prefix", "error"),
    ("dim_customers", "unique", "customer_key", "error"),
    ("dim_customers", "not_null", "customer_key", "error"),
    ("dim_customers", "unique", "customer_id", "error"),
    ("dim_customers", "not_null", "customer_id", "error"),
    ("dim_customers", "relationships", "customer_id", "warn", "silver_customers.customer_id"),
    ("dim_customers", "not_null", "customer_zip_code_prefix", "error"),
    ("dim_sellers", "unique", "seller_key", "error"),
    ("dim_sellers", "not_null", "seller_key", "error"),
    ("dim_sellers", "unique", "seller_id", "error"),
    ("dim_sellers", "not_null", "seller_id", "error"),
    ("dim_sellers", "not_null", "seller_zip_code_prefix", "error"),
    ("dim_products", "unique", "product_key", "error"),
    ("dim_products", "not_null", "product_key", "error"),
    ("dim_products", "unique", "product_id", "error"),
    ("dim_products", "not_null", "product_id", "error"),
    ("dim_products", "relationships", "product_id", "error", "silver_products.product_id"),
    ("dim_products", "not_null", "product_category", "error"),
    ("fact_orders", "not_null", "order_id", "error"),
    ("fact_orders", "unique", "order_id", "error"),
    ("fact_orders", "not_null", "customer_key", "error"),
    ("fact_orders", "relationships", "customer_key", "error", "dim_customers.customer_key"),
    ("fact_orders", "not_null", "order_status", "error"),
    ("fact_orders", "not_null", "order_purchase_ts", "error"),
    ("fact_order_items", "not_null", "order_item_key", "error"),
    ("fact_order_items", "unique", "order_item_key", "error"),
    ("fact_order_items", "not_null", "order_id", "error"),
    ("fact_order_items", "relationships", "order_id", "error", "fact_orders.order_id"),
    ("fact_order_items", "not_null", "customer_key", "error"),
    ("fact_order_items", "relationships", "customer_key", "error", "dim_customers.customer_key"),
    ("fact_order_items", "not_null", "product_key", "error"),
    ("fact_order_items", "relationships", "product_key", "error", "dim_products.product_key"),
    ("fact_order_items", "not_null", "seller_key", "error"),
    ("fact_order_items", "relationships", "seller_key", "error", "dim_sellers.seller_key"),
    ("fact_order_items", "not_null", "order_item_id", "error"),
    ("fact_order_items", "not_null", "price", "error"),
    ("fact_order_items", "not_null", "freight_value", "error"),
    ("fact_payments", "not_null", "payment_key", "error"),
    ("fact_payments", "unique", "payment_key", "error"),
    ("fact_payments", "not_null", "order_id", "error"),
    ("fact_payments", "relationships", "order_id", "error", "fact_orders.order_id"),
    ("fact_payments", "not_null", "customer_key", "error"),
    ("fact_payments", "relationships", "customer_key", "error", "dim_customers.customer_key"),
    ("fact_payments", "not_null", "payment_sequential", "error"),
    ("fact_payments", "not_null", "payment_type", "error"),
    ("fact_payments", "not_null", "payment_installments", "error"),
    ("fact_payments", "not_null", "payment_value", "error"),
    ("fact_reviews", "not_null", "review_id", "error"),
    ("fact_reviews", "unique", "review_id", "warn"),
    ("fact_reviews", "not_null", "order_id", "error"),
    ("fact_reviews", "relationships", "order_id", "warn", "fact_orders.order_id"),
    ("fact_reviews", "not_null", "customer_key", "warn"),
    ("fact_reviews", "relationships", "customer_key", "warn", "dim_customers.customer_key"),
    ("fact_reviews", "not_null", "review_score", "error"),
]
# --- fixed values: accepted order statuses ------------------------------------------------------
_STATUSES = ["shipped", "canceled", "delivered", "invoiced", "unavailable", "processing", "approved", "created"]


def _expected() -> list[Check]:
    checks = []
    for model, test, columns, severity, *target in _EXPECTED:
        to, field = target[0].split(".") if target else (None, None)
        values = _STATUSES if test == "accepted_values" else ()
        checks.append(_check(model, test, *columns.split(", "), severity=severity, to=to, field=field, values=values))
    return checks


_CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
_ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
_BUILT = [
    "silver_customers", "silver_sellers", "silver_products", "silver_geolocation", "silver_orders",
    "silver_order_items", "silver_order_payments", "silver_order_reviews", "dim_customers",
    "dim_sellers", "dim_products", "fact_orders", "fact_order_items", "fact_payments", "fact_reviews",
]
_ALL_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
_SHAPES = {
    "customer": _CUSTOMER,
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": _ORDERS,
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
}
_PROFILED = [
    ("lineitem", "l_orderkey"), ("lineitem", "l_partkey"), ("lineitem", "l_suppkey"), ("lineitem", "l_quantity"),
    ("lineitem", "l_returnflag"), ("events", "user_id"), ("events", "event_type"),
]
_NULL_TABLES = {
    "labelled": ["doc_id", "quality", "toxic"],
    "pg_orders": ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
                  "order_delivered_carrier_date", "order_delivered_customer_date",
                  "order_estimated_delivery_date"],
    "stream_order_reviews": ["review_id", "order_id", "review_score", "review_comment_title",
                             "review_comment_message", "review_creation_date", "review_answer_timestamp"],
}


# Names that the same types have in Spark.
_TYPE_NAMES = ("CASE t WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' "
               "WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'DATE' THEN 'date' ELSE t END")


def _union(rows: list[str]) -> str:
    return "\nUNION ALL ".join(rows)


def _duplicates(what: str, table: str, keys: str) -> str:
    return (f"SELECT '{what}' AS what, CAST(sum(n) AS BIGINT) AS row_count, "
            f"CAST(sum(n - 1) AS BIGINT) AS duplicates "
            f"FROM (SELECT count(*) AS n FROM {table} GROUP BY {keys})")


_PART_LABEL = "(' ' || upper(p_name) || '-' || lower(p_brand) || '''_' || lower(p_type))"
_CUT = "TIMESTAMP '1998-06-30 00:00:00'"
_RAW_ORDER = ("SELECT order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at, "
              "order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date "
              "FROM pg_orders")

_ROW_COUNTS = _sql(_union([
    f"SELECT '{m}' AS model, (SELECT count(*) FROM {m}) AS row_count" for m in _BUILT]))

# The whole-number columns of the tables whose keys are looked for.
_WHOLE = {
    "region": ["r_regionkey"],
    "nation": ["n_nationkey", "n_regionkey"],
    "customer": ["c_custkey", "c_nationkey"],
    "supplier": ["s_suppkey", "s_nationkey"],
    "part": ["p_partkey", "p_size"],
    "orders": ["o_orderkey", "o_custkey"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"],
}


def _is_key(table: str, *columns: str) -> str:
    present = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    return (f"(SELECT count(*) > 0 AND bool_and({present}) FROM {table}) AND "
            f"NOT EXISTS (SELECT 1 FROM {table} GROUP BY {', '.join(columns)} HAVING count(*) > 1)")


def _found_keys() -> str:
    rows = []
    for table, columns in _WHOLE.items():
        rows += [f"SELECT '{table}' AS table_name, '{c}' AS key_columns WHERE {_is_key(table, c)}" for c in columns]
        rows += [f"SELECT '{table}', '{a},{b}' WHERE {_is_key(table, a, b)} AND NOT ({_is_key(table, a)}) AND NOT ({_is_key(table, b)})"
                 for i, a in enumerate(columns) for b in columns[i + 1:]]
    return _union(rows)


def _found_references() -> str:
    return _union([
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{p}' AS parent, '{k}' AS parent_key, "
        f"{str(c.split('_', 1)[1] == k.split('_', 1)[1]).lower()} AS named_alike WHERE {_is_key(p, k)} "
        f"AND EXISTS (SELECT 1 FROM {t} WHERE {c} IS NOT NULL) AND NOT EXISTS (SELECT 1 FROM {t} WHERE {c} NOT IN (SELECT {k} FROM {p}))"
        for t, columns in _WHOLE.items() for c in columns for p, keys in _WHOLE.items() if p != t for k in keys
    ])


ORACLES: dict[str, str] = {
    # models as they are
    **{name: _sql(f"SELECT * FROM {name}") for name in _BUILT
       if name not in ("silver_geolocation", "dim_customers", "dim_sellers")},
    "silver_geolocation": _sql(
        "SELECT * REPLACE (round(geolocation_lat, 6) AS geolocation_lat, "
        "round(geolocation_lng, 6) AS geolocation_lng) FROM silver_geolocation"),
    "dim_customers": _sql(
        "SELECT * REPLACE (round(customer_lat, 6) AS customer_lat, round(customer_lng, 6) AS customer_lng) "
        "FROM dim_customers"),
    "dim_sellers": _sql(
        "SELECT * REPLACE (round(seller_lat, 6) AS seller_lat, round(seller_lng, 6) AS seller_lng) "
        "FROM dim_sellers"),
    "latest_order_per_customer": """
        SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus, o_totalprice FROM (
          SELECT *, row_number() OVER (PARTITION BY o_custkey
            ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey NULLS FIRST) AS r FROM orders) WHERE r = 1""",
    "geolocation_preview": _sql("""
        SELECT CAST(CAST(g.geolocation_zip_code_prefix AS INTEGER) AS VARCHAR) AS geolocation_zip_code_prefix,
               round(g.geolocation_lat, 6) AS geolocation_lat, round(g.geolocation_lng, 6) AS geolocation_lng,
               g.geolocation_city, g.geolocation_state, n.n_rows
        FROM silver_geolocation g JOIN (SELECT zip, count(*) AS n_rows FROM geo_points GROUP BY zip) n
          ON g.geolocation_zip_code_prefix = n.zip"""),

    # data tests
    "dq_not_null": _report(
        [_check("customer", "not_null", c) for c in _CUSTOMER]
        + [_check("orders", "not_null", c) for c in _ORDERS]
        + [_check("labelled", "not_null", "quality", severity="warn"), _check("labelled", "not_null", "doc_id")]),
    "dq_unique": _report([
        _check("orders", "unique", "o_orderkey"), _check("customer", "unique", "c_custkey"),
        _check("lineitem", "unique", "l_orderkey"), _check("events", "unique", "user_id", severity="warn")]),
    "dq_unique_expr": _report([
        _check("lineitem", "unique", "l_orderkey", "l_linenumber"),
        _check("conversations", "unique", "conv_id", "turn"),
        _check("events", "unique", "user_id", "event_type", severity="warn")]),
    "dq_accepted": _report([
        _check("orders", "accepted_values", "o_orderstatus", values=["F", "O", "P"]),
        _check("orders", "accepted_values", "o_orderpriority", values=["1-URGENT", "2-HIGH"]),
        _check("events", "accepted_values", "event_type", severity="warn", values=["view", "click"])]),
    "dq_relationships": _report([
        _check("orders", "relationships", "o_custkey", to="customer", field="c_custkey"),
        _check("lineitem", "relationships", "l_orderkey", to="orders", field="o_orderkey"),
        _check("lineitem", "relationships", "l_partkey", to="part", field="p_partkey"),
        _check("documents", "relationships", "doc_id", severity="warn", to="labels", field="doc_id"),
        _check("events", "relationships", "event_id", to="orders", field="o_custkey")]),
    "dq_report": _report(_expected()),
    "gated_build": _ROW_COUNTS,
    "found_keys": _found_keys(),
    "found_references": _found_references(),
    "merged_tests": _report([c for c in _expected() if c.model.startswith("silver_")]),
    "merged_geolocation": _sql(
        "SELECT * REPLACE (round(geolocation_lat, 6) AS geolocation_lat, "
        "round(geolocation_lng, 6) AS geolocation_lng) FROM silver_geolocation"),
    "merged_orders": """
        SELECT customer, order_status, order_purchase_ts FROM (
          SELECT o_custkey::VARCHAR AS customer, o_orderdate AS order_purchase_ts,
            CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'created' WHEN 'P' THEN 'shipped' END AS order_status
          FROM orders)
        QUALIFY row_number() OVER (PARTITION BY customer ORDER BY order_purchase_ts DESC NULLS FIRST, order_status NULLS FIRST) = 1""",
    "merged_distinct": _union([
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS nulls, "
        f"count(DISTINCT {c}) AS distinct_values, TRUE AS within FROM {t}" for t, c in _PROFILED]),
    "merged_frequent": _union([
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n, TRUE AS within "
        f"FROM {t} GROUP BY {c} HAVING count(*) * 101 > (SELECT count(*) FROM {t})" for t, c in _PROFILED]),

    # profiles
    "profile_shape": _union([
        f"SELECT '{t}' AS table_name, CAST({i} AS INTEGER) AS position, '{c}' AS column_name, "
        f"(SELECT {_TYPE_NAMES} FROM (SELECT typeof(any_value({c})) AS t FROM {t})) AS data_type, "
        f"(SELECT count({c}) FROM {t}) AS non_null, (SELECT count(*) FROM {t}) AS row_count"
        for t, cols in _SHAPES.items() for i, c in enumerate(cols)]),
    "profile_nulls": _sql(_union([
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, (SELECT count(*) FROM {t} WHERE {c} IS NULL) AS nulls"
        for t, cols in _NULL_TABLES.items() for c in cols])),
    "profile_dups": _sql(_union([
        _duplicates("pg_order_items by key", "pg_order_items", "order_id, order_item_id"),
        _duplicates("pg_order_items by row", "pg_order_items",
                    "order_id, order_item_id, product_id, seller_id, shipping_limit_date, price, freight_value"),
        _duplicates("pg_orders by key", "pg_orders", "order_id"),
        _duplicates("documents by text", "documents", "text"),
        _duplicates("labelled by quality", "labelled", "quality"),
        _duplicates("texts and digests", "(SELECT text FROM documents UNION ALL SELECT sha256(text) FROM documents)", "text")])),
    "profile_values": _sql("SELECT quality, count(*) AS n FROM labelled GROUP BY quality"),
    "profile_distinct": "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem",
    "profile_ts_range": """
        SELECT 'ts' AS column_name, min(ts) AS earliest, max(ts) AS latest,
               count(*) FILTER (WHERE ts IS NULL) AS nulls FROM events
        UNION ALL
        SELECT 'answered', min(ts) FILTER (WHERE event_type <> 'error'),
               max(ts) FILTER (WHERE event_type <> 'error'),
               count(*) FILTER (WHERE event_type = 'error') FROM events""",
    "profile_key_length": _sql(
        "SELECT CAST(length(order_id) AS INTEGER) AS key_length, count(*) AS n FROM pg_orders GROUP BY 1"),
    "profile_integral": _union([
        f"SELECT '{c}' AS column_name, bool_or({c} <> floor({c})) AS fractional FROM lineitem"
        for c in ("l_quantity", "l_extendedprice", "l_discount")]),
    "table_counts": _union([
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _ALL_TABLES]),

    # slices, pages, top-k
    "time_slice_orders": _sql(
        f"{_RAW_ORDER} WHERE order_purchase_timestamp > TIMESTAMP '1997-01-01' "
        "AND order_purchase_timestamp <= TIMESTAMP '1997-07-01'"),
    "time_slice_children": _sql(
        "SELECT * FROM pg_order_items WHERE order_id IN (SELECT order_id FROM pg_orders "
        "WHERE order_purchase_timestamp > TIMESTAMP '1997-01-01' "
        "AND order_purchase_timestamp <= TIMESTAMP '1997-07-01')"),
    "history_up_to": _sql(f"{_RAW_ORDER} WHERE order_purchase_timestamp <= TIMESTAMP '1996-12-31'"),
    "latest_orders_topk": "SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 5",
    "page_of_customers": "SELECT * FROM customer ORDER BY c_custkey LIMIT 100 OFFSET 200",
    "page_after_key": "SELECT * FROM orders WHERE o_orderkey > 4999 ORDER BY o_orderkey LIMIT 50",
    "page_envelopes": _union([
        f"SELECT CAST({p} AS INTEGER) AS page, CAST(5 AS INTEGER) AS \"limit\", count(*) AS count, "
        f"count(*) = 5 AS has_next FROM (SELECT * FROM nation ORDER BY n_nationkey LIMIT 5 OFFSET {(p - 1) * 5})"
        for p in (1, 5, 6)]),
    "all_pages": """
        SELECT o_orderkey, o_custkey,
               CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 + 1 AS BIGINT) AS page FROM orders""",
    "latest_order_time": """
        SELECT 'all' AS scope, max(o_orderkey) AS max_key, max(o_orderdate) AS latest FROM orders
        UNION ALL SELECT 'none', CAST(0 AS BIGINT), CAST(NULL AS TIMESTAMP)""",
    "orders_since": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01'""",
    "concat_tables": _sql("""
        SELECT customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state,
               CAST(NULL AS VARCHAR) AS seller_id, CAST(NULL AS VARCHAR) AS seller_zip_code_prefix,
               CAST(NULL AS VARCHAR) AS seller_city, CAST(NULL AS VARCHAR) AS seller_state FROM pg_customers
        UNION ALL
        SELECT NULL, NULL, NULL, NULL, NULL, seller_id, seller_zip_code_prefix, seller_city, seller_state
        FROM pg_sellers"""),

    # text rules
    "labels_cased": f"""
        SELECT p_partkey, {_worded(_PART_LABEL)} AS worded,
               {_worded(f"replace({_PART_LABEL}, '_', ' ')")} AS displayed,
               lower(trim({_PART_LABEL})) AS cleaned
        FROM part""",
    "texts_cased": f"SELECT doc_id, md5({_worded('text')}) AS cased_md5, CAST(length(text) AS INTEGER) AS chars FROM documents",
    "path_parts": """
        WITH p AS (
          SELECT page_id, 'lake/page_date=2024-01-0' || (page_id % 9 + 1) || '/'
            || regexp_replace(split_part(split_part(url, '#', 1), '?', 1), '^[a-z]+://', '') AS path FROM pages
        ), f AS (
          SELECT *, regexp_extract(path, '[^/]*$') AS file FROM p
        )
        SELECT page_id, left(path, greatest(length(path) - length(file) - 1, 0)) AS directory,
               CASE WHEN contains(ltrim(file, '.'), '.') THEN regexp_replace(file, '[.][^.]*$', '') ELSE file END AS name,
               CASE WHEN contains(ltrim(file, '.'), '.') THEN regexp_extract(file, '[.]([^.]*)$', 1) ELSE '' END AS extension,
               '2024-01-0' || (page_id % 9 + 1) AS page_date
        FROM f""",
    "json_export": """
        SELECT event_id, '{"event_id":' || event_id || ',"ts":"'
               || regexp_replace(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '[.]?0*$', '')
               || '","event_type":"' || event_type || '","value":'
               || CASE WHEN event_type = 'error' THEN 'null' ELSE CAST(value AS VARCHAR) END || '}' AS record
        FROM events""",

    # ingestion
    "ingest_latest_snapshot": _sql("SELECT *, '2026-08-25' AS snapshot_date FROM pg_customers"),
    "ingest_tagged_latest": _sql("SELECT * FROM api_geolocation"),
    "ingest_incremental": _sql("SELECT * FROM stream_order_payments"),
    "ingest_ledger": """
        SELECT 'stream_order_payments' AS table_name, CAST(CAST(ts AS DATE) AS VARCHAR) AS batch_date,
               count(*) AS row_count
        FROM events WHERE event_type = 'purchase' GROUP BY 2""",
    "ingest_archived": """
        SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS batch_date, count(*) AS row_count, FALSE AS renamed
        FROM events WHERE event_type = 'purchase' GROUP BY 1""",
    "ingest_unprocessed": """
        SELECT DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR) AS batch_date FROM events WHERE event_type <> 'purchase'""",
    "ingest_watermark_delta": _sql(
        "SELECT order_id, customer_id, order_status, order_purchase_timestamp, "
        f"CASE WHEN order_purchase_timestamp <= {_CUT} THEN '2026-08-24' ELSE '2026-08-25' END AS batch_date "
        "FROM pg_orders"),
    "ingest_child_delta": _sql(
        "SELECT i.*, o.order_purchase_timestamp AS tracking_ts FROM pg_order_items i "
        f"JOIN pg_orders o ON i.order_id = o.order_id WHERE o.order_purchase_timestamp > {_CUT}"),
    "ingest_overlap_delta":
        f"SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > {_CUT} - INTERVAL 30 DAY",
    "ingest_paged_json": "SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "ingest_json_dump": "SELECT p_partkey, p_name, p_retailprice FROM part",
    "ingest_versioned_latest": """
        SELECT s_suppkey, s_name, s_nationkey, s_acctbal, CAST(NULL AS BIGINT) AS n_versions FROM supplier
        UNION ALL SELECT NULL, NULL, NULL, NULL, CAST(2 AS BIGINT)""",
    "snapshot_changed": """
        SELECT 'content' AS decided_by, '2026-08-24' AS snapshot_date, count(*) AS row_count FROM customer
        UNION ALL SELECT 'content', '2026-08-26', count(*) FROM customer
        UNION ALL SELECT 'content', '2026-08-27', count(*) FROM customer WHERE c_nationkey + 1 > 5
        UNION ALL SELECT 'content', '2026-08-28', count(*) FROM customer WHERE c_nationkey + 1 > 5
        UNION ALL SELECT 'version', '2026-08-24', count(*) FROM customer
        UNION ALL SELECT 'version', '2026-08-26', count(*) FROM customer""",
    "ingest_modified_since": _sql(
        "SELECT review_id, order_id, review_score, review_creation_date, "
        "strftime(review_creation_date, '%Y-%m-%d') AS batch_date FROM stream_order_reviews"),
    "ingest_replaced_drop": """
        SELECT event_id, event_type, value, event_id % 4 + 1 AS synced, NULL::INT AS sync, NULL::BOOLEAN AS brought FROM events
        UNION ALL SELECT NULL, NULL, NULL, NULL, sync, sync < 4 FROM (SELECT unnest(range(5))::INT AS sync)""",
    "ingest_clock_set_back": _sql(
        "SELECT order_id, order_purchase_timestamp, NULL::BIGINT AS s_suppkey, NULL::DOUBLE AS s_acctbal FROM pg_orders "
        "UNION ALL SELECT NULL, NULL, s_suppkey, s_acctbal FROM supplier"),
    "capture_changes": _sql(
        "SELECT CASE WHEN k % 13 = 2 THEN 'delete' WHEN k % 10 = 0 THEN 'insert' ELSE 'update' END AS op, order_id, "
        "CASE WHEN k % 13 <> 2 AND k % 7 = 1 THEN 'canceled' ELSE order_status END AS order_status, "
        "CASE WHEN k % 13 <> 2 AND k % 10 <> 0 THEN order_status END AS status_before "
        "FROM (SELECT *, order_id::BIGINT AS k FROM pg_orders) "
        "WHERE CASE WHEN k % 13 = 2 THEN k % 10 <> 0 ELSE k % 10 = 0 OR (k % 7 = 1 AND order_status IS DISTINCT FROM 'canceled') END"),
    "capture_to_silver": _sql(
        "SELECT order_id, customer_id, CASE WHEN k % 13 <> 2 AND k % 7 = 1 THEN 'canceled' ELSE order_status END AS order_status, "
        "order_purchase_timestamp AS order_purchase_ts FROM (SELECT *, order_id::BIGINT AS k FROM pg_orders) "
        "WHERE NOT (k % 13 = 2 AND k % 10 = 0)"),
    "ingest_mixed_drop": _sql(
        "SELECT *, CAST(NULL AS BIGINT) AS n_rejected FROM stream_order_payments "
        "UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, 1"),
    "ingest_lineage": """
        SELECT strftime(ts, '%Y-%m-%d') AS batch_date, count(*) AS row_count, count(*) AS stamped
        FROM events WHERE event_type = 'purchase' GROUP BY ALL""",
    "catalog_seed_and_reset": """
        SELECT step, CASE WHEN step LIKE 'seeded%' THEN n ELSE 0 END AS row_count
        FROM (SELECT count(*) AS n FROM customer),
             (VALUES ('created'), ('seeded'), ('seeded again'), ('truncated'), ('seeded anew'), ('dropped')) AS t(step)""",
    "bucketed_fact_order_items": _sql("SELECT * FROM fact_order_items"),
    "bucketed_fact_payments": _sql("SELECT * FROM fact_payments"),
    "lake_to_gold": _ROW_COUNTS,
    "ingest_csv": """
        SELECT o_orderkey, o_custkey, o_totalprice,
               CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END AS o_orderdate FROM orders""",
    "ingest_preload": """
        SELECT 'orders' AS table_name, count(*) AS row_count FROM orders WHERE o_orderdate <= TIMESTAMP '1997-01-15'
        UNION ALL
        SELECT 'order_items', count(*) FROM lineitem WHERE l_orderkey IN
          (SELECT o_orderkey FROM orders WHERE o_orderdate <= TIMESTAMP '1997-01-15')""",
    "ingest_timestamps":
        "SELECT event_id, CASE WHEN event_type = 'click' THEN NULL ELSE ts END AS ts FROM events",

    # streams
    "stream_dedup": "SELECT * FROM events",
    "stream_parent_child": _sql(
        "SELECT i.order_id, i.order_item_id, i.product_id, i.price, o.customer_id "
        "FROM pg_order_items i JOIN pg_orders o ON i.order_id = o.order_id"),
    "stream_waiting_children": _sql(
        "SELECT i.order_id, i.order_item_id, i.product_id, i.price, o.customer_id, "
        "CASE WHEN o.order_id IS NULL THEN true END AS waits FROM pg_order_items i "
        "LEFT JOIN (SELECT * FROM pg_orders WHERE order_id::BIGINT % 11 <> 0) o ON i.order_id = o.order_id"),
    "stream_land_records": _sql(
        "SELECT *, CAST(NULL AS BIGINT) AS n_rejected FROM stream_order_payments "
        "UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, 2"),
    "stream_commit_pairs": _sql(
        "SELECT o.order_id, o.customer_id, o.order_purchase_timestamp, i.n_items, i.total "
        "FROM pg_orders o LEFT JOIN (SELECT order_id, count(*) AS n_items, CAST(sum(price) AS DECIMAL(22,2)) AS total "
        "FROM pg_order_items GROUP BY order_id) i ON o.order_id = i.order_id"),
}
