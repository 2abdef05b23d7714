"""Stateful streams: replay removal, parent and child, joint commits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import STATE_ON_DISK, held
from ..sinks.state import StateLog
from .incremental import BATCH_ID, overwrite_batch, read_batches


def dedup_stream(
    stream: DataFrame, keys: Sequence[str], ts: str, within: str, spread: int = 1
) -> DataFrame:
    """Drop rows whose key was seen within the watermark delay; first seen wins.

    ``ts`` must be the time a row arrived (of its file, or of its push), which goes
    up with the stream. A time of the event itself would not do: rows older than
    the watermark are discarded unseen, and old events may well arrive late. State
    is kept per key until the watermark passes it, so it is bounded by the keys
    that arrive within one delay; a copy that comes after it passes.

    With ``spread`` over 1 copies are first removed within that many groups of
    input partitions, for keys with very many copies; it doubles the state.
    """
    marked = stream.withWatermark(ts, within)
    if spread > 1:
        marked = (
            marked.withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(spread)))
            .dropDuplicatesWithinWatermark([*keys, "_group"]).drop("_group")
        )
    return marked.dropDuplicatesWithinWatermark(list(keys))


def join_when_parent_arrives(
    children: DataFrame, parents: DataFrame, key: str, child_ts: str, parent_ts: str, wait: str,
    spread: int = 1,
) -> DataFrame:
    """Child rows joined to their parent, whichever arrives first.

    Both sides wait for each other up to ``wait``; a child whose parent has not
    come by then is given up, and picked up by the next batch rebuild. State holds
    each row once.

    Adaptive execution does not reach streaming joins. With ``spread`` over 1 the
    children of one parent are spread over that many tasks and each parent is sent to
    all of them, for parents with very many children; the state of the parents grows
    as many times.
    """
    c = children.withWatermark(child_ts, wait)
    p = parents.withColumnRenamed(key, "_parent_key").withWatermark(parent_ts, wait)
    near = (
        (F.col(child_ts) >= F.col(parent_ts) - F.expr(f"interval {wait}"))
        & (F.col(child_ts) <= F.col(parent_ts) + F.expr(f"interval {wait}"))
    )
    same = F.col(key) == F.col("_parent_key")
    if spread > 1:
        part = F.pmod(F.xxhash64(*[F.col(x) for x in children.columns]), F.lit(spread)).cast("int")
        c = c.withColumn("_part", part)
        p = p.withColumn("_parent_part", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
        same = same & (F.col("_part") == F.col("_parent_part"))
    return c.join(p, same & near, "inner").drop("_parent_key", "_part", "_parent_part")


def commit_parent_and_child(
    parents: DataFrame, children: DataFrame, key: str, folders: tuple[str, str], batch_id: int,
    log: StateLog | None = None,
) -> None:
    """Write parents, then the children that go with them, under one batch id.

    Either is replaced as a whole when the batch is repeated, so both tables hold the
    batch once. With a ``log`` the batch is published after both are written, and
    ``read_committed`` shows both parts of it or neither. Meant for ``foreachBatch``,
    whose batch ids go up.
    """
    parents = parents.persist()
    try:
        overwrite_batch(parents, folders[0], batch_id)
        mine = children.join(parents.select(key), key, "left_semi").select(*children.columns)
        overwrite_batch(mine, folders[1], batch_id)
    finally:
        parents.unpersist()
    if log is not None:
        log.put("batch", str(batch_id))


def read_committed(
    spark: SparkSession, folders: tuple[str, str], schemas: tuple[str, str], log: StateLog
) -> tuple[DataFrame, DataFrame]:
    """Parents and children of the published batches."""
    last = int(log.get("batch", "-1"))
    parents, children = (
        read_batches(spark, folder, schema).where(F.col(BATCH_ID) <= last).drop(BATCH_ID)
        for folder, schema in zip(folders, schemas, strict=True)
    )
    return parents, children


def run_to_folder(
    stream: DataFrame, folder: str, checkpoint: str, on_disk: bool = False, eager: bool = True
) -> None:
    """Process all that is available and append it to a Parquet folder.

    State lies where the session has it, which with Spark's default is on the heap: some 300
    bytes a row of a join. With ``on_disk`` it lies on disk, whatever the session has, and only
    memory settings of the session's own count; a checkpoint keeps the kind of state that it began with.

    Spark follows the last batch by an empty one, which reads the whole state once more to drop
    what has expired. Not ``eager``, that is left to the next batch with rows, which may also
    take in rows that are too late. Only for streams that emit nothing in an empty batch, such as
    inner joins: outer joins and windows would keep back rows.
    """
    spark, given = stream.sparkSession, {}
    own = spark.conf.getAll
    if on_disk:
        given |= {k: v for k, v in STATE_ON_DISK.items() if k.endswith("providerClass") or k not in own}
    if not eager:
        given["spark.sql.streaming.noDataMicroBatches.enabled"] = "false"
    with held(spark, given):  # a stream keeps the settings that it was started with
        running = (
            stream.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(folder)
        )
    running.awaitTermination()
