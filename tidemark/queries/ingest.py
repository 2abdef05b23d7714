"""Ingestion: the given tables go into a lake of their own and come back loaded."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parse_timestamp, partition_value
from ..operators import children_of, concat_frames, count_rows, number_pages, up_to
from ..operators.capture import OP
from ..operators.delta import delta_since
from ..plans import inputs
from ..plans.bucketed import BucketedStore, buckets_for
from ..plans.bronze import BronzeLoader, reset_tables
from ..plans.build import build
from ..plans.capture import ChangeCapture
from ..plans.extract import Extractor, Extracts, sync_drop
from ..plans.gold import dimension_keys
from ..plans.silver import silver_customers, silver_orders, silver_products, silver_sellers
from ..schemas import INGESTED_AT, SOURCE_FILE
from ..session import CODEC, shared_folder
from ..sinks import StateLog, VersionedTable, land_delta, land_snapshot, seed_if_empty, snapshot_if_changed
from ..sinks.landing import BATCHES, DROPS, ENDPOINTS, SNAPSHOTS, place
from ..sources.files import create_new, list_names, remove, rename, set_modified
from ..sources import existing_tables, list_files, read_csv_table, read_json_dump, read_json_pages, unprocessed_files

FIRST_DAY = datetime(2026, 8, 24, 6, 30, 0)
SECOND_DAY = datetime(2026, 8, 25, 6, 30, 0)


def _loader(spark: SparkSession, root: str) -> BronzeLoader:
    return BronzeLoader(spark, f"{root}/lake", f"{root}/warehouse")


def ingest_latest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Customers, of two snapshots the newer one."""
    root = shared_folder(spark, "ingest")
    customers = inputs.customers(spark, sf)
    land_snapshot(customers.withColumn("customer_city", F.lit("moved since")), f"{root}/lake", "customers", FIRST_DAY)
    land_snapshot(customers, f"{root}/lake", "customers", SECOND_DAY)
    loader = _loader(spark, root)
    loader.load_table("pg_customers")
    loaded = loader.read("pg_customers")
    return loaded.withColumn("snapshot_date", partition_value(F.col(SOURCE_FILE), "snapshot_date")).drop(
        SOURCE_FILE, INGESTED_AT)


def ingest_tagged_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Geolocation, of an archived and a latest dataset the latest."""
    root = shared_folder(spark, "ingest")
    folder = place(f"{root}/lake", ENDPOINTS, "geolocation")
    points = inputs.geolocation(spark, sf)
    points.withColumn("geolocation_lat", F.lit(0.0)).write.parquet(f"{folder}/geolocation_old_20260824_063000.parquet")
    points.write.parquet(f"{folder}/geolocation_latest.parquet")
    loader = _loader(spark, root)
    loader.load_table("api_geolocation")
    return loader.read("api_geolocation").drop(SOURCE_FILE, INGESTED_AT)


def _drop_payments(spark: SparkSession, sf: str, root: str) -> BronzeLoader:
    """Payments arrive in two drops and are loaded after each, then once more."""
    payments = inputs.order_payments(spark, sf, F.to_date("ts").alias("batch_date"))
    folder = place(f"{root}/lake", DROPS, "order_payments")
    loader = _loader(spark, root)
    for drop in (payments.where("batch_date <= '2024-01-15'"), payments.where("batch_date > '2024-01-15'")):
        drop.write.mode("append").partitionBy("batch_date").parquet(folder)
        loader.load_table("stream_order_payments")
    loader.load_table("stream_order_payments")
    return loader


def ingest_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Each payment once, whatever the number of loads."""
    loader = _drop_payments(spark, sf, shared_folder(spark, "ingest"))
    return loader.read("stream_order_payments").drop(SOURCE_FILE, INGESTED_AT)


def ingest_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Rows loaded per day, as the load ledger has them."""
    loader = _drop_payments(spark, sf, shared_folder(spark, "ingest"))
    day = partition_value(F.col("file_key"), "batch_date")
    return loader.ledger("stream_order_payments").groupBy("table_name", day.alias("batch_date")).agg(
        F.sum("row_count").alias("row_count"))


def ingest_archived(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of each day's payments, loaded in three drops whose files are archived, and once
    more after a reset. Names of files are those they had when they came."""
    root = shared_folder(spark, "ingest")
    payments = inputs.order_payments(spark, sf, F.to_date("ts").alias("batch_date"))
    folder = place(f"{root}/lake", DROPS, "order_payments")
    loader = BronzeLoader(spark, f"{root}/lake", f"{root}/warehouse", archive=f"{root}/archive")
    for days in ("< '2024-01-10'", "BETWEEN '2024-01-10' AND '2024-01-19'", "> '2024-01-19'"):
        payments.where(f"batch_date {days}").write.mode("append").partitionBy("batch_date").parquet(folder)
        loader.load_table("stream_order_payments")
    loader.reset(["stream_order_payments"])
    loader.load_table("stream_order_payments")
    name = F.col(SOURCE_FILE)
    loaded = loader.read("stream_order_payments").groupBy(partition_value(name, "batch_date").alias("batch_date"))
    return loaded.agg(F.count(F.lit(1)).alias("row_count"), F.bool_or(F.contains(name, F.lit("/archive/"))).alias("renamed"))


def ingest_unprocessed(spark: SparkSession, sf: str) -> DataFrame:
    """Days with files the ledger does not have yet: those of a third drop."""
    root = shared_folder(spark, "ingest")
    loader = _drop_payments(spark, sf, root)
    folder = place(f"{root}/lake", DROPS, "order_payments")
    late = inputs.table(spark, sf, "events").where("event_type <> 'purchase'").select(
        F.col("user_id").cast("string").alias("order_id"), F.to_date("ts").alias("batch_date"))
    late.write.mode("append").partitionBy("batch_date").parquet(folder)
    left = unprocessed_files(
        list_files(spark, folder), loader.ledger("stream_order_payments"), "stream_order_payments")
    return left.select(partition_value(F.col("path"), "batch_date").alias("batch_date")).distinct()


CUT = "1998-06-30 00:00:00"


def ingest_watermark_delta(spark: SparkSession, sf: str) -> DataFrame:
    """Orders landed by two runs; the second brings what is past the first."""
    root = shared_folder(spark, "ingest")
    state = StateLog(spark, f"{root}/metadata")
    orders = inputs.orders(spark, sf)
    ts = "order_purchase_timestamp"
    land_delta(up_to(orders, ts, CUT), ts, f"{root}/lake", "orders", state, now=FIRST_DAY)
    land_delta(orders, ts, f"{root}/lake", "orders", state, now=SECOND_DAY)
    land_delta(orders, ts, f"{root}/lake", "orders", state, now=SECOND_DAY)
    landed = spark.read.parquet(place(f"{root}/lake", BATCHES, "orders"))
    return landed.select("order_id", "customer_id", "order_status", ts, F.col("batch_date").cast("string").alias("batch_date"))


def ingest_child_delta(spark: SparkSession, sf: str) -> DataFrame:
    """Items of the orders past a watermark."""
    return delta_since(
        inputs.order_items(spark, sf), "order_purchase_timestamp", CUT,
        parent=inputs.orders(spark, sf), on="order_id",
    )


def ingest_overlap_delta(spark: SparkSession, sf: str) -> DataFrame:
    """Orders past a watermark and of the thirty days before it."""
    orders = inputs.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return delta_since(orders, "o_orderdate", CUT, overlap="30 days").drop("tracking_ts")


def _rows_as(df: DataFrame) -> Column:
    return F.struct(*[F.col(c) for c in df.columns])


RECORD_POINT = "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string"


def ingest_paged_json(spark: SparkSession, sf: str) -> DataFrame:
    """Customers served as pages of 200 records and read back from them."""
    root = shared_folder(spark, "ingest")
    rows = inputs.table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    numbered = number_pages(spark, rows, "c_custkey", 200, f"{root}/numbered")
    # A page holds at most 200 records.
    pages = numbered.groupBy("page").agg(F.collect_list(_rows_as(rows)).alias("data"))
    envelope = pages.select(
        "page", F.lit(200).alias("limit"), F.size("data").alias("count"),
        F.when(F.col("page") * 200 < rows.count(), F.concat(F.lit("page="), (F.col("page") + 1).cast("string"))).alias("next_url"),
        "data",
    )
    envelope.select(F.to_json(F.struct("*")).alias("value")).write.text(f"{root}/pages")
    return read_json_pages(spark, f"{root}/pages", RECORD_POINT)


def ingest_json_dump(spark: SparkSession, sf: str) -> DataFrame:
    """Parts dumped as JSON arrays of up to 500 records and read back."""
    root = shared_folder(spark, "ingest")
    rows = inputs.table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    numbered = number_pages(spark, rows, "p_partkey", 500, f"{root}/numbered")
    arrays = numbered.groupBy("page").agg(F.collect_list(_rows_as(rows)).alias("data"))
    arrays.select(F.to_json("data").alias("value")).write.text(f"{root}/dump")
    return read_json_dump(spark, f"{root}/dump", "p_partkey bigint, p_name string, p_retailprice double")


def ingest_versioned_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Write once, skip, refresh, and a refresh without rows: the refresh counts."""
    table = VersionedTable(spark, f"{shared_folder(spark, 'ingest')}/suppliers")
    suppliers = inputs.table(spark, sf, "supplier")
    table.write_once(suppliers.withColumn("s_acctbal", F.lit(0.0)))
    table.write_once(suppliers.withColumn("s_acctbal", F.lit(1.0)))
    table.replace(suppliers)
    table.replace(suppliers.where("s_suppkey < 0"))
    kept = table.versions().agg(F.count(F.lit(1)).alias("n_versions"))
    return concat_frames(table.read(), kept)


def snapshot_changed(spark: SparkSession, sf: str) -> DataFrame:
    """Five looks at customers: first, unchanged, one column changed, rows deleted,
    and a value moved from one column to another.

    Snapshots are taken by content, and beside it by greatest version, which
    does not see the deletes. Counts come from the landed snapshots.
    """
    root = shared_folder(spark, "ingest")
    customers = inputs.table(spark, sf, "customer")
    moved = customers.withColumn("c_nationkey", F.col("c_nationkey") + 1).withColumn("c_custkey", F.col("c_custkey") + 1)
    left = moved.where("c_nationkey > 5").withColumn("was", F.lit(None).cast("int"))
    swapped = left.withColumn("was", F.col("c_nationkey")).withColumn("c_nationkey", F.lit(None).cast("int"))
    looks = [customers, customers, moved, left, swapped]
    counts = []
    for by, column in (("content", None), ("version", "c_custkey")):
        lake, state = f"{root}/{by}", StateLog(spark, f"{root}/state-{by}")
        for i, look in enumerate(looks):
            snapshot_if_changed(look, lake, "customer", state, column, datetime(2026, 8, 24 + i, 6, 0, 0))
        landed = spark.read.option("recursiveFileLookup", True).parquet(place(lake, SNAPSHOTS, "customer"))
        day = partition_value(F.col("_metadata.file_path"), "snapshot_date")
        counts.append(
            landed.groupBy(day.alias("snapshot_date")).agg(F.count(F.lit(1)).alias("row_count"))
            .select(F.lit(by).alias("decided_by"), "*")
        )
    return concat_frames(*counts)


def ingest_modified_since(spark: SparkSession, sf: str) -> DataFrame:
    """Two drops of reviews, synced after each and once more; every row once, with
    the day of its folder."""
    root = shared_folder(spark, "ingest")
    state = StateLog(spark, f"{root}/metadata")
    reviews = inputs.order_reviews(spark, sf).select("review_id", "order_id", "review_score", "review_creation_date").withColumn(
        "batch_date", F.to_date("review_creation_date"))
    for drop in (reviews.where("review_creation_date < timestamp_ntz'2024-01-20 00:00:00'"),
                 reviews.where("review_creation_date >= timestamp_ntz'2024-01-20 00:00:00'")):
        drop.write.mode("append").partitionBy("batch_date").parquet(f"{root}/inbox/order_reviews")
        sync_drop(spark, f"{root}/inbox", f"{root}/lake", "order_reviews", state)
    sync_drop(spark, f"{root}/inbox", f"{root}/lake", "order_reviews", state)
    landed = spark.read.parquet(place(f"{root}/lake", DROPS, "order_reviews")).drop("synced")
    return landed.withColumn("batch_date", F.col("batch_date").cast("string"))


def _drop_at(df: DataFrame, folder: str, micros: int) -> None:
    """Put the rows down as files 0.parquet, 1.parquet, … of one modification time, in
    place of any of these names."""
    spark, staged = df.sparkSession, f"{folder}-staged-{uuid.uuid4().hex}"
    df.write.parquet(staged)
    for k, name in enumerate(sorted(n for n in list_names(spark, staged) if n.startswith("part-"))):
        target = f"{folder}/{k}.parquet"
        remove(spark, target)
        create_new(spark, f"{folder}/.there", "")  # so that the folder is there to rename into
        rename(spark, f"{staged}/{name}", target)
        set_modified(spark, target, micros)
    remove(spark, staged)


def ingest_replaced_drop(spark: SparkSession, sf: str) -> DataFrame:
    """Events in four drops, synced after each and once more: a second one with the
    time of the first, one with an older time, and one in place of the first. Every row
    once, and whether each sync brought something."""
    root = shared_folder(spark, "ingest")
    state, inbox = StateLog(spark, f"{root}/metadata"), f"{root}/inbox/events"
    events = inputs.table(spark, sf, "events").select("event_id", "event_type", "value")
    hour = 3_600_000_000
    noon = 1_750_000_000_000_000
    brought = []
    for k, (folder, at) in enumerate(((f"{inbox}/a", noon), (f"{inbox}/b", noon), (f"{inbox}/c", noon - 9 * hour), (f"{inbox}/a", noon + hour))):
        _drop_at(events.where(F.col("event_id") % 4 == k), folder, at)
        brought.append((k, sync_drop(spark, f"{root}/inbox", f"{root}/lake", "events", state)))
    brought.append((4, sync_drop(spark, f"{root}/inbox", f"{root}/lake", "events", state)))
    landed = spark.read.parquet(place(f"{root}/lake", DROPS, "events")).drop("batch_date")
    landed = landed.withColumn("synced", F.col("synced").cast("bigint"))
    return concat_frames(landed, spark.createDataFrame(brought, "sync int, brought boolean"))


def ingest_clock_set_back(spark: SparkSession, sf: str) -> DataFrame:
    """Orders landed by three runs on hosts whose clocks go backwards, and suppliers
    published twice by such hosts: the value written last counts, not the latest time."""
    root = shared_folder(spark, "ingest")
    orders, suppliers = inputs.orders(spark, sf), inputs.table(spark, sf, "supplier").select("s_suppkey", "s_acctbal")
    ts = "order_purchase_timestamp"
    for k, rows in enumerate((up_to(orders, ts, CUT), orders, orders)):
        host = lambda k=k: datetime(2026, 8, 24, 12 - k, tzinfo=timezone.utc)
        land_delta(rows, ts, f"{root}/lake", "orders", StateLog(spark, f"{root}/metadata", host), now=FIRST_DAY)
        table = VersionedTable(spark, f"{root}/suppliers", StateLog(spark, f"{root}/published", host))
        table.replace(suppliers.withColumn("s_acctbal", F.lit(float(k))) if k < 2 else suppliers)
    landed = spark.read.parquet(place(f"{root}/lake", BATCHES, "orders"))
    return concat_frames(landed.select("order_id", ts), table.read())


def _later_orders(orders: DataFrame) -> DataFrame:
    """Orders as they stand later: every seventh is canceled, every thirteenth gone, and
    every tenth, left out before, is there."""
    key = F.col("order_id").cast("bigint")
    status = F.when(key % 7 == 1, F.lit("canceled")).otherwise(F.col("order_status"))
    return orders.withColumn("order_status", status).where(key % 13 != 2)


def capture_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Orders looked at twice, with changes behind the watermark between; and a look at
    nothing new. Every insert, update and delete, with the status before and after."""
    orders = inputs.orders(spark, sf).drop("order_approved_at")
    capture = ChangeCapture(spark, shared_folder(spark, "ingest"), "orders", ["order_id"], orders.schema, buckets=64)
    capture.look(orders.where(F.col("order_id").cast("bigint") % 10 != 0))
    seen = [capture.look(_later_orders(orders)), capture.look(_later_orders(orders))]
    if seen[1].differing:
        raise AssertionError("an unchanged table was read again")
    return capture.changes(seen[0].run).select(
        F.col(OP).alias("op"), "order_id", "order_status", F.col("before.order_status").alias("status_before"))


def capture_to_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Silver orders after two extractions that follow changes: each order as it is
    now; deleted ones, which the lake keeps, as they were."""
    root = shared_folder(spark, "ingest")
    orders = inputs.orders(spark, sf)
    wanted = Extracts(snapshots=(), deltas={}, drops=(), endpoints=(), captures={"orders": ("order_id",)})
    loader = _loader(spark, root)
    for now in (orders.where(F.col("order_id").cast("bigint") % 10 != 0), _later_orders(orders)):
        Extractor(spark, f"{root}/lake", {"orders": now}.get, f"{root}/inbox", {}, wanted).run()
        loader.load_table("pg_orders")
    return silver_orders(loader.read("pg_orders")).select("order_id", "customer_id", "order_status", "order_purchase_ts")


def ingest_mixed_drop(spark: SparkSession, sf: str) -> DataFrame:
    """Payments dropped in one go with a file of another table: the payments load,
    the other file is reported."""
    root = shared_folder(spark, "ingest")
    folder = place(f"{root}/lake", DROPS, "order_payments")
    inputs.order_payments(spark, sf).repartition(3).write.parquet(folder)
    inputs.table(spark, sf, "region").coalesce(1).write.mode("append").parquet(folder)
    loader = _loader(spark, root)
    loader.load_table("stream_order_payments")
    rejected = loader.rejected("stream_order_payments").agg(F.count(F.lit(1)).alias("n_rejected"))
    return concat_frames(loader.read("stream_order_payments").drop(SOURCE_FILE, INGESTED_AT), rejected)


def ingest_lineage(spark: SparkSession, sf: str) -> DataFrame:
    """Payments per day with a source file of that day, and with a load time of this run."""
    begun = spark.sql("SELECT current_timestamp() AS t").first()["t"]
    loader = _drop_payments(spark, sf, shared_folder(spark, "ingest"))
    day = partition_value(F.col(SOURCE_FILE), "batch_date")
    return loader.read("stream_order_payments").groupBy(day.alias("batch_date")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if((F.col(INGESTED_AT) >= F.lit(begun)) & (F.col(INGESTED_AT) <= F.current_timestamp())).alias("stamped"),
    )


def catalog_seed_and_reset(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of a catalog table that starts empty, is seeded twice from customers, truncated,
    and seeded once more; and whether it is gone after a drop."""
    database = f"tidemark_{uuid.uuid4().hex[:12]}"
    customers = inputs.table(spark, sf, "customer").select("c_custkey", "c_name")
    spark.sql(f"CREATE DATABASE {database}")
    try:
        spark.sql(f"CREATE TABLE {database}.customers (c_custkey BIGINT, c_name STRING) USING parquet")
        name, seen = f"{database}.customers", []
        for step in ("created", "seeded", "seeded again", "truncated", "seeded anew"):
            if step.startswith("seeded"):
                seed_if_empty(spark, name, customers)
            elif step == "truncated":
                reset_tables(spark, database, ["customers"])
            seen.append((step, spark.table(name).count()))
        reset_tables(spark, database, ["customers"], drop=True)
        seen.append(("dropped", len(existing_tables(spark, database))))
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    return spark.createDataFrame(seen, "step string, row_count bigint")


def _stored_by_order(spark: SparkSession, sf: str, take: Callable[[BucketedStore, dict], DataFrame]) -> DataFrame:
    """Bronze appended in two loads to tables by order; what ``take`` makes of them is
    written, since the tables are dropped."""
    database, root, given = f"tidemark_{uuid.uuid4().hex[:12]}", shared_folder(spark, "ingest"), inputs.bronze(spark, sf)
    spark.sql(f"CREATE DATABASE {database}")
    try:
        store = BucketedStore(spark, database, buckets_for(given["pg_order_items"].count()))
        for table in ("pg_orders", "pg_order_items", "stream_order_payments"):
            for half in (0, 1):
                store.append(table, given[table].where(F.abs(F.xxhash64("order_id")) % 2 == half))
        store.key_orders(dimension_keys(silver_customers(given["pg_customers"]), "customer_id"))
        fact = take(store, given)
        fact.write.option("compression", CODEC).parquet(f"{root}/fact")
        return spark.read.schema(fact.schema).parquet(f"{root}/fact")
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def bucketed_fact_order_items(spark: SparkSession, sf: str) -> DataFrame:
    """Item facts from tables stored by order, without a shuffle of the items."""
    def fact(store: BucketedStore, given: dict) -> DataFrame:
        products = silver_products(given["pg_products"], given["api_translations"])
        return store.fact_order_items(
            dimension_keys(products, "product_id"), dimension_keys(silver_sellers(given["pg_sellers"]), "seller_id"))
    return _stored_by_order(spark, sf, fact)


def bucketed_fact_payments(spark: SparkSession, sf: str) -> DataFrame:
    """Payment facts from tables stored by order."""
    return _stored_by_order(spark, sf, lambda store, _: store.fact_payments())


def lake_to_gold(spark: SparkSession, sf: str) -> DataFrame:
    """Extract all sources, load bronze, build silver and gold; rows per model."""
    root = shared_folder(spark, "ingest")
    given = inputs.bronze(spark, sf)
    tables = {n: given[f"pg_{n}"] for n in ("customers", "sellers", "products", "orders", "order_items")}
    for n in ("order_payments", "order_reviews"):
        given[f"stream_{n}"].write.option("compression", CODEC).parquet(f"{root}/inbox/{n}")
    endpoints = {n: (lambda n=n: given[f"api_{n}"]) for n in ("translations", "geolocation")}
    Extractor(spark, f"{root}/lake", tables.get, f"{root}/inbox", endpoints).run()
    loader = _loader(spark, root)
    loader.run()
    done = build(spark, f"{root}/warehouse", {t: loader.read(t) for t in given})
    return count_rows({n: done.models[n] for n in done.published}).withColumnRenamed("table_name", "model")


def ingest_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Orders through CSV with a header; one time in some rows is no time."""
    root = shared_folder(spark, "ingest")
    orders = inputs.table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice",
        F.when(F.col("o_orderstatus") == "P", "soon").otherwise(F.col("o_orderdate").cast("string")).alias("o_orderdate"),
    )
    orders.write.option("header", True).csv(f"{root}/orders")
    return read_csv_table(
        spark, f"{root}/orders", "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate string",
        timestamps=["o_orderdate"],
    )


def ingest_preload(spark: SparkSession, sf: str) -> DataFrame:
    """History up to a cut with the items that go with it, as one row count each."""
    orders = up_to(inputs.orders(spark, sf), "order_purchase_timestamp", "1997-01-15 00:00:00")
    items = children_of(inputs.order_items(spark, sf), orders, "order_id")
    return concat_frames(
        orders.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit("orders").alias("table_name"), "row_count"),
        items.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit("order_items").alias("table_name"), "row_count"),
    )


def ingest_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    """Text times to timestamps, what is no time to null."""
    events = inputs.table(spark, sf, "events")
    text = F.when(F.col("event_type") == "click", "NaT").otherwise(F.col("ts").cast("string"))
    return events.select("event_id", parse_timestamp(text).alias("ts"))


QUERIES = {
    f.__name__: f
    for f in (
        ingest_latest_snapshot, ingest_tagged_latest, ingest_incremental, ingest_ledger, ingest_archived, ingest_unprocessed,
        ingest_watermark_delta, ingest_child_delta, ingest_overlap_delta,
        ingest_paged_json, ingest_json_dump, ingest_versioned_latest, snapshot_changed,
        ingest_modified_since, ingest_replaced_drop, ingest_clock_set_back, capture_changes, capture_to_silver, ingest_mixed_drop, ingest_lineage, catalog_seed_and_reset, bucketed_fact_order_items, bucketed_fact_payments, lake_to_gold, ingest_csv, ingest_preload, ingest_timestamps,
    )
}
