"""Landing of pushed record batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .incremental import overwrite_batch

# --- fixed values: envelope of a pushed batch --------------------------------
ENVELOPE = "source_table string, records array<struct<{record}>>"

BROKEN = "_broken"


def land_record_batches(
    spark: SparkSession, inbox: str, lake: str, table: str, record: str, checkpoint: str,
    rejected: str | None = None,
):
    """Turn JSON envelopes ``{source_table, records}`` for ``table`` into Parquet
    rows under ``<table>/batch_date=D``. Envelopes without records add nothing.

    A malformed envelope, or one with a value that does not fit, is not landed in
    part: its text goes to ``rejected`` (by default beside the table, as
    ``_rejected_<table>``). Both folders hold a batch once, also if it is repeated.
    """
    folder = f"{lake.rstrip('/')}/{table}"
    rejected = rejected or f"{lake.rstrip('/')}/_rejected_{table}"
    schema = ENVELOPE.format(record=record) + f", {BROKEN} string"

    def land(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        good = batch.where(F.col(BROKEN).isNull() & (F.col("source_table") == table))
        rows = good.select(F.explode("records").alias("r")).select("r.*")
        overwrite_batch(rows.withColumn("batch_date", F.current_date()), folder, batch_id, "batch_date")
        bad = batch.where(F.col(BROKEN).isNotNull()).select(F.col(BROKEN).alias("value"))
        if not bad.isEmpty():
            overwrite_batch(bad, rejected, batch_id)
        batch.unpersist()

    envelopes = (
        spark.readStream.schema(schema).option("maxFileAge", "36500d")
        .option("columnNameOfCorruptRecord", BROKEN).json(inbox)
    )
    running = (
        envelopes.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    running.awaitTermination()
    return folder
