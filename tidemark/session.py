"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings a cluster session should carry. The code does not depend on them for
# right results, only for speed: adaptive execution splits hot join partitions
# and picks broadcast joins from measured sizes.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Parquet files of other writers may hold nanosecond times.
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    # Texts may be long: batches for Python are bounded by bytes as well as rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

#: Settings of a stream whose state may outgrow the heap: it lies on the executors' disks, in stores
#: that share so many MB of memory an executor outside the heap. The stores don't count their rows,
#: which would read every row before it is written.
STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": CLUSTER_CONF["spark.sql.streaming.stateStore.providerClass"],
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "1000",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferCacheRatio": "0.8",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "128",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # room set aside in each of many stores
}


#: Codec of the tables that are written: digests take half the place that they take with
#: Spark's default, which has no entropy coding.
CODEC = "zstd"


def build_session(app: str = "tidemark", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**CLUSTER_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def held(spark: SparkSession, conf: dict[str, str]):
    """While it holds, the session has these settings; afterwards those it had."""
    before = spark.conf.getAll
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key in conf:
            spark.conf.set(key, before[key]) if key in before else spark.conf.unset(key)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the one all executors share.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    run without that setting; it gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/tidemark/{purpose}-{uuid.uuid4().hex[:12]}"
