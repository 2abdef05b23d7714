"""Structured Streaming over files made of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import concat_frames
from ..plans import inputs
from ..session import shared_folder
from ..sinks import StateLog
from ..streaming import (
    commit_parent_and_child, dedup_stream, join_when_parent_arrives, land_record_batches, read_committed,
    run_to_folder,
)
from ..streaming.waiting import WaitingJoin

EVENT = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Events landed twice, as a repeated batch would, and read in several
    micro-batches, in which old events follow new ones; each comes out once."""
    root = shared_folder(spark, "stream")
    events = inputs.table(spark, sf, "events")
    for _ in range(2):
        events.repartition(2).write.mode("append").parquet(f"{root}/in")
    stream = (
        spark.readStream.schema(EVENT).option("maxFileAge", "36500d").option("maxFilesPerTrigger", 1)
        .parquet(f"{root}/in").withColumn("arrived", F.col("_metadata.file_modification_time"))
    )
    run_to_folder(dedup_stream(stream, ["event_id"], "arrived", "1 day"), f"{root}/out", f"{root}/checkpoint")
    return spark.read.schema(EVENT).parquet(f"{root}/out")


def stream_parent_child(spark: SparkSession, sf: str) -> DataFrame:
    """Items joined to their order by landing time, two streams against each other.

    The state holds both tables whole, so it lies on disk; there is one run, after which
    nothing needs to be dropped from it.
    """
    root = shared_folder(spark, "stream")
    items = inputs.order_items(spark, sf).select("order_id", "order_item_id", "product_id", "price")
    orders = inputs.orders(spark, sf).select("order_id", "customer_id")
    items.withColumn("item_landed", F.current_timestamp()).write.parquet(f"{root}/items")
    orders.withColumn("order_landed", F.current_timestamp()).write.parquet(f"{root}/orders")

    def stream(name: str, df: DataFrame, ts: str) -> DataFrame:
        schema = df.withColumn(ts, F.current_timestamp()).schema
        return spark.readStream.schema(schema).option("maxFileAge", "36500d").parquet(f"{root}/{name}")

    joined = join_when_parent_arrives(
        stream("items", items, "item_landed"), stream("orders", orders, "order_landed"),
        "order_id", "item_landed", "order_landed", "2 days",
    )
    run_to_folder(joined.select("order_id", "order_item_id", "product_id", "price", "customer_id"),
                  f"{root}/out", f"{root}/checkpoint", on_disk=True, eager=False)
    return spark.read.parquet(f"{root}/out")


def stream_waiting_children(spark: SparkSession, sf: str) -> DataFrame:
    """Items streamed in while only every third order is there, the last batch of them
    taken in twice; the other orders come later, but for every eleventh. Items with the
    customer of their order, and those that still wait."""
    root = shared_folder(spark, "stream")
    items = inputs.order_items(spark, sf).select("order_id", "order_item_id", "product_id", "price")
    orders = inputs.orders(spark, sf).select("order_id", "customer_id")
    key = F.col("order_id").cast("bigint")
    join = WaitingJoin(spark, f"{root}/joined", "order_id", orders.schema, items.schema)
    join.add(0, parents=orders.where((key % 3 == 0) & (key % 11 != 0)))
    items.repartition(3).write.parquet(f"{root}/items")

    def take(batch: DataFrame, batch_id: int) -> None:
        for _ in range(2):
            join.add(batch_id + 1, children=batch)

    stream = (
        spark.readStream.schema(items.schema).option("maxFileAge", "36500d").option("maxFilesPerTrigger", 1)
        .parquet(f"{root}/items")
    )
    running = stream.writeStream.foreachBatch(take).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    running.awaitTermination()
    batches = running.lastProgress.batchId + 2
    for k, late in enumerate((orders.where((key % 3 == 1) & (key % 11 != 0)), orders.where(key % 11 != 0))):
        join.add(batches + k, parents=late)
    return concat_frames(join.placed(), join.waiting().withColumn("waits", F.lit(True)))


def stream_land_records(spark: SparkSession, sf: str) -> DataFrame:
    """Payments pushed as JSON envelopes, landed as rows, and how many pushes were
    rejected: one cut off, and one with a word for a number."""
    root = shared_folder(spark, "stream")
    payments = inputs.order_payments(spark, sf, F.col("event_id"))
    # 500 consecutive event ids make an envelope, so none grows with the table.
    envelopes = payments.groupBy(F.floor(F.col("event_id") / 500).alias("push")).agg(
        F.collect_list(F.struct("order_id", "payment_sequential", "payment_type",
                                "payment_installments", "payment_value")).alias("records"))
    pushed = envelopes.select(
        F.to_json(F.struct(F.lit("order_payments").alias("source_table"), "records")).alias("value"))
    broken = spark.createDataFrame([
        ('{"source_table": "order_payments", "records": [{"order_id": "1", "paym',),
        ('{"source_table": "order_payments", "records": [{"order_id": "1", "payment_sequential": "one"}]}',),
    ], "value string")
    pushed.union(broken).write.text(f"{root}/inbox")
    folder = land_record_batches(
        spark, f"{root}/inbox", f"{root}/drop", "order_payments",
        "order_id string, payment_sequential int, payment_type string, payment_installments int, "
        "payment_value decimal(12,2)",
        f"{root}/checkpoint",
    )
    rejected = spark.read.parquet(f"{root}/drop/_rejected_order_payments").agg(F.count(F.lit(1)).alias("n_rejected"))
    return concat_frames(spark.read.parquet(folder).drop("_batch_id", "batch_date"), rejected)


def stream_commit_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Orders stream in and are committed with their items, one batch id for both.

    The last batch is committed a second time, as after a crash.
    """
    root = shared_folder(spark, "stream")
    orders = inputs.orders(spark, sf).select("order_id", "customer_id", "order_purchase_timestamp")
    items = inputs.order_items(spark, sf).select("order_id", "order_item_id", "price")
    orders.write.parquet(f"{root}/in")
    folders, log = (f"{root}/orders", f"{root}/items"), StateLog(spark, f"{root}/committed")

    def commit(batch: DataFrame, batch_id: int) -> None:
        for _ in range(2):
            commit_parent_and_child(batch, items, "order_id", folders, batch_id, log)

    stream = spark.readStream.schema(orders.schema).option("maxFileAge", "36500d").parquet(f"{root}/in")
    running = (
        stream.writeStream.foreachBatch(commit).option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True).start()
    )
    running.awaitTermination()
    schemas = ("order_id string, customer_id string, order_purchase_timestamp timestamp_ntz",
               "order_id string, order_item_id int, price decimal(12,2)")
    parents, children = read_committed(spark, folders, schemas, log)
    counted = children.groupBy("order_id").agg(F.count(F.lit(1)).alias("n_items"), F.sum("price").alias("total"))
    return parents.join(counted, "order_id", "left")


QUERIES = {
    f.__name__: f
    for f in (stream_dedup, stream_parent_child, stream_waiting_children, stream_land_records, stream_commit_pairs)
}
