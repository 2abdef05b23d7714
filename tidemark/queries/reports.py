"""Data tests, profiles, slices, pages, text rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import clean_label, dataset_of, display_name, json_record, partition_value, split_name, word_case
from ..operators import (
    accepted, children_of, concat_frames, count_rows, distinct_values, max_or_default, not_null,
    page_after, page_answer, page_by_key, relationship, run_checks, time_slice, top_k, unique, up_to,
    value_counts,
)
from ..operators import keys, profile
from ..operators.paging import number_pages
from ..plans import inputs
from ..plans.build import build
from ..session import shared_folder
from ..sources.tables import query

ALL_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def _tables(spark: SparkSession, sf: str, *names: str) -> dict[str, DataFrame]:
    return {n: inputs.table(spark, sf, n) for n in names}


# ---- data tests --------------------------------------------------------------

def dq_not_null(spark: SparkSession, sf: str) -> DataFrame:
    """Every column of two tables, one pass each, and a column that has nulls."""
    models = _tables(spark, sf, "customer", "orders")
    models["labelled"] = models_labelled(spark, sf)
    checks = [not_null("customer", c) for c in models["customer"].columns]
    checks += [not_null("orders", c) for c in models["orders"].columns]
    checks += [not_null("labelled", "quality").warn(), not_null("labelled", "doc_id")]
    return run_checks(models, checks)


def models_labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with their labels; many have none."""
    docs = inputs.table(spark, sf, "documents").select("doc_id")
    return docs.join(inputs.table(spark, sf, "labels"), "doc_id", "left")


def dq_unique(spark: SparkSession, sf: str) -> DataFrame:
    models = _tables(spark, sf, "orders", "lineitem", "customer", "events")
    return run_checks(models, [
        unique("orders", "o_orderkey"),
        unique("customer", "c_custkey"),
        unique("lineitem", "l_orderkey"),
        unique("events", "user_id").warn(),
    ])


def dq_unique_expr(spark: SparkSession, sf: str) -> DataFrame:
    """Uniqueness over several columns."""
    models = _tables(spark, sf, "lineitem", "conversations", "events")
    return run_checks(models, [
        unique("lineitem", "l_orderkey", "l_linenumber"),
        unique("conversations", "conv_id", "turn"),
        unique("events", "user_id", "event_type").warn(),
    ])


def dq_accepted(spark: SparkSession, sf: str) -> DataFrame:
    models = _tables(spark, sf, "orders", "events")
    return run_checks(models, [
        accepted("orders", "o_orderstatus", ["F", "O", "P"]),
        accepted("orders", "o_orderpriority", ["1-URGENT", "2-HIGH"]),
        accepted("events", "event_type", ["view", "click"]).warn(),
    ])


def dq_relationships(spark: SparkSession, sf: str) -> DataFrame:
    models = _tables(spark, sf, "orders", "lineitem", "customer", "part", "documents", "labels", "events")
    return run_checks(models, [
        relationship("orders", "o_custkey", "customer", "c_custkey"),
        relationship("lineitem", "l_orderkey", "orders", "o_orderkey"),
        relationship("lineitem", "l_partkey", "part", "p_partkey"),
        relationship("documents", "doc_id", "labels", "doc_id").warn(),
        relationship("events", "event_id", "orders", "o_custkey"),
    ])


def _build(spark: SparkSession, sf: str):
    return build(spark, shared_folder(spark, "build"), inputs.bronze(spark, sf))


def dq_report(spark: SparkSession, sf: str) -> DataFrame:
    """All data tests of all models, run on the tables a build has written."""
    return _build(spark, sf).report


def gated_build(spark: SparkSession, sf: str) -> DataFrame:
    """Models of a complete build that were published, with their row counts."""
    done = _build(spark, sf)
    return count_rows({n: done.models[n] for n in done.published}).withColumnRenamed(
        "table_name", "model")


# ---- profiles ----------------------------------------------------------------

def profile_shape(spark: SparkSession, sf: str) -> DataFrame:
    reports = [
        profile.shape(df).select(F.lit(name).alias("table_name"), "position", "column_name", "data_type", "non_null", "row_count")
        for name, df in _tables(spark, sf, "customer", "supplier", "part", "orders", "lineitem", "events").items()
    ]
    return concat_frames(*reports)


def profile_nulls(spark: SparkSession, sf: str) -> DataFrame:
    return concat_frames(
        *[profile.null_counts(df).select(F.lit(name).alias("table_name"), "*") for name, df in {
            "labelled": models_labelled(spark, sf),
            "pg_orders": inputs.orders(spark, sf),
            "stream_order_reviews": inputs.order_reviews(spark, sf),
        }.items()]
    )


def profile_dups(spark: SparkSession, sf: str) -> DataFrame:
    """Repeats by key, and rows repeated as a whole."""
    items = inputs.order_items(spark, sf)
    texts = inputs.table(spark, sf, "documents").select("text")
    parts = {
        "pg_order_items by key": profile.duplicate_rows(items, "order_id", "order_item_id"),
        "pg_order_items by row": profile.duplicate_rows(items),
        "pg_orders by key": profile.duplicate_rows(inputs.orders(spark, sf), "order_id"),
        "documents by text": profile.duplicate_rows(inputs.table(spark, sf, "documents"), "text"),
        "labelled by quality": profile.duplicate_rows(models_labelled(spark, sf), "quality"),
        # No text is a repeat of another text's digest.
        "texts and digests": profile.duplicate_rows(texts.union(texts.select(F.sha2("text", 256))), "text"),
    }
    return concat_frames(*[df.select(F.lit(k).alias("what"), "*") for k, df in parts.items()])


def profile_values(spark: SparkSession, sf: str) -> DataFrame:
    """Value counts, nulls included."""
    return value_counts(models_labelled(spark, sf), "quality")


def profile_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_values(inputs.table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")


def profile_ts_range(spark: SparkSession, sf: str) -> DataFrame:
    """Ranges of text timestamps; words among them count as unparsable."""
    events = inputs.table(spark, sf, "events")
    as_text = events.select(
        F.col("ts").cast("string").alias("ts"),
        F.when(F.col("event_type") == "error", "NaT").otherwise(F.col("ts").cast("string")).alias("answered"),
    )
    return profile.timestamp_ranges(as_text, ["ts", "answered"])


def profile_key_length(spark: SparkSession, sf: str) -> DataFrame:
    return profile.key_lengths(inputs.orders(spark, sf), "order_id")


def profile_integral(spark: SparkSession, sf: str) -> DataFrame:
    return profile.has_fractions(
        inputs.table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])


def table_counts(spark: SparkSession, sf: str) -> DataFrame:
    return count_rows(_tables(spark, sf, *ALL_TABLES))


# ---- slices, pages, top-k ----------------------------------------------------

def time_slice_orders(spark: SparkSession, sf: str) -> DataFrame:
    return time_slice(inputs.orders(spark, sf), "order_purchase_timestamp",
                      "1997-01-01 00:00:00", "1997-07-01 00:00:00")


def time_slice_children(spark: SparkSession, sf: str) -> DataFrame:
    """Items of the orders of one slice."""
    return children_of(inputs.order_items(spark, sf), time_slice_orders(spark, sf), "order_id")


def history_up_to(spark: SparkSession, sf: str) -> DataFrame:
    return up_to(inputs.orders(spark, sf), "order_purchase_timestamp", "1996-12-31 00:00:00")


def latest_orders_topk(spark: SparkSession, sf: str) -> DataFrame:
    orders = inputs.table(spark, sf, "orders")
    return top_k(orders, 5, F.col("o_orderdate").desc(), F.col("o_orderkey").asc())


def page_of_customers(spark: SparkSession, sf: str) -> DataFrame:
    return page_by_key(inputs.table(spark, sf, "customer"), "c_custkey", page=3, limit=100)


def page_after_key(spark: SparkSession, sf: str) -> DataFrame:
    return page_after(inputs.table(spark, sf, "orders"), "o_orderkey", 4999, limit=50)


def page_envelopes(spark: SparkSession, sf: str) -> DataFrame:
    """A full page, the last page, and the empty one after it."""
    nation = inputs.table(spark, sf, "nation")
    return concat_frames(*[page_answer(page_by_key(nation, "n_nationkey", p, 5), p, 5) for p in (1, 5, 6)])


def all_pages(spark: SparkSession, sf: str) -> DataFrame:
    """The page of every order, 1,000 to a page."""
    orders = inputs.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return number_pages(spark, orders, "o_orderkey", 1000, shared_folder(spark, "pages"))


def latest_order_time(spark: SparkSession, sf: str) -> DataFrame:
    """The last order time and key, and the default for a selection without rows."""
    orders = inputs.table(spark, sf, "orders")
    known = orders.agg(F.max("o_orderkey").alias("max_key"), F.max("o_orderdate").alias("latest"))
    none = max_or_default(up_to(orders, "o_orderdate", "1900-01-01 00:00:00"), "o_orderkey", 0, "max_key")
    return concat_frames(
        known.select(F.lit("all").alias("scope"), "*"),
        none.select(F.lit("none").alias("scope"), "*"),
    )


def orders_since(spark: SparkSession, sf: str) -> DataFrame:
    """SQL with a bound parameter."""
    return query(
        spark,
        "SELECT o_orderkey, o_custkey, o_totalprice FROM {orders} WHERE o_orderdate >= :target_date",
        {"target_date": "2001-01-01"},
        orders=inputs.table(spark, sf, "orders"),
    )


def concat_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of two tables under one set of columns; what one lacks is null."""
    return concat_frames(inputs.customers(spark, sf), inputs.sellers(spark, sf))


# ---- text rules --------------------------------------------------------------

def labels_cased(spark: SparkSession, sf: str) -> DataFrame:
    """Word case, display form and the trim-and-lower rule."""
    part = inputs.table(spark, sf, "part")
    raw = F.concat(F.lit(" "), F.upper("p_name"), F.lit("-"), F.lower("p_brand"), F.lit("'_"), F.lower("p_type"))
    return part.select(
        "p_partkey",
        word_case(raw).alias("worded"),
        display_name(raw).alias("displayed"),
        clean_label(raw).alias("cleaned"),
    )


def texts_cased(spark: SparkSession, sf: str) -> DataFrame:
    """Word case over whole documents."""
    docs = inputs.table(spark, sf, "documents")
    return docs.select("doc_id", F.md5(word_case("text")).alias("cased_md5"), F.length("text").alias("chars"))


def path_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Directory, name, extension and partition value of the paths that page urls have in a lake."""
    day = F.concat(F.lit("lake/page_date=2024-01-0"), (F.col("page_id") % 9 + 1).cast("string"), F.lit("/"))
    place = F.regexp_replace(F.split_part(F.split_part("url", F.lit("#"), F.lit(1)), F.lit("?"), F.lit(1)), "^[a-z]+://", "")
    pages = inputs.table(spark, sf, "pages").select("page_id", F.concat(day, place).alias("path"))
    parts = split_name(F.col("path"))
    return pages.select(
        "page_id",
        parts.getField("directory").alias("directory"),
        parts.getField("name").alias("name"),
        parts.getField("extension").alias("extension"),
        partition_value(F.col("path"), "page_date").alias("page_date"),
    )


def json_export(spark: SparkSession, sf: str) -> DataFrame:
    """Events as JSON records; a value that is no number is null."""
    events = inputs.table(spark, sf, "events").withColumn(
        "value", F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value")))
    slim = events.select("event_id", "ts", "event_type", "value")
    return slim.select("event_id", json_record(slim).alias("record"))


KEYED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def _keys(spark: SparkSession, sf: str):
    # Numbers and days; texts of the given tables are no keys.
    tables = {
        n: df.select(*[f.name for f in df.schema.fields if not isinstance(f.dataType, StringType)])
        for n, df in _tables(spark, sf, *KEYED).items()
    }
    found = {n: keys.sketches(n, df) for n, df in tables.items()}
    return tables, found, keys.find_keys(tables, found)


def found_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Least keys of one or two numbers that the tables' rows bear out."""
    rows = [(table, ",".join(columns)) for table, columns in _keys(spark, sf)[2]]
    return spark.createDataFrame(rows, "table_name string, key_columns string")


def found_references(spark: SparkSession, sf: str) -> DataFrame:
    """Columns whose values are all in another table's key; ``named_alike`` where they also
    have its name, as true foreign keys do."""
    rows = [(*r, r[1].split("_", 1)[-1] == r[3].split("_", 1)[-1]) for r in keys.find_references(*_keys(spark, sf))]
    return spark.createDataFrame(rows, "table_name string, column_name string, parent string, parent_key string, named_alike boolean")


QUERIES = {
    f.__name__: f
    for f in (
        dq_not_null, dq_unique, dq_unique_expr, dq_accepted, dq_relationships, dq_report, gated_build,
        profile_shape, profile_nulls, profile_dups, profile_values, profile_distinct, profile_ts_range,
        profile_key_length, profile_integral, table_counts,
        time_slice_orders, time_slice_children, history_up_to, latest_orders_topk,
        page_of_customers, page_after_key, page_envelopes, all_pages, latest_order_time,
        orders_since, found_keys, found_references, concat_tables, labels_cased, texts_cased, path_parts, json_export,
    )
}
