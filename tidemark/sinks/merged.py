"""State that batches are merged into, so that history is not read again."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..operators.capture import BUCKET, bucket_of
from ..session import CODEC
from .state import StateLog

PLACES = f"{BUCKET} int, run bigint"


class MergedTable:
    """One row per key under ``folder``, kept up to date by ``combine``.

    ``combine`` takes rows of any number per key and gives one per key; it must not matter
    in which order or how often it is used on the way (sums, counts, greatest, latest).
    Rows lie in buckets by key. A batch is written first; then the buckets that it touches
    are combined with it and written anew, the others stay where they are. A batch counts
    once its id is saved, which goes up from batch to batch: one that counts already is
    passed over, and one that died is repeated and replaces what it left.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: StructType, keys: Sequence[str],
                 combine: Callable[[DataFrame], DataFrame], buckets: int = 64):
        self.spark, self.folder, self.schema, self.keys = spark, folder.rstrip("/"), schema, list(keys)
        self.combine, self.buckets = combine, buckets
        self.state = StateLog(spark, f"{self.folder}/merged")

    def _at(self, value: str | None) -> tuple[int, int]:
        """The run and the batch that count."""
        run, batch = (value or "0:-1").split(":")
        return int(run), int(batch)

    def _places(self, run: int) -> DataFrame:
        if not run:
            return self.spark.createDataFrame([], PLACES)
        return self.spark.read.schema(PLACES).parquet(f"{self.folder}/places/run={run}")

    def _read(self, run: int, buckets: Iterable[int] | None = None) -> DataFrame:
        wanted = None if buckets is None else set(buckets)
        folders = [f"{self.folder}/rows/run={r['run']}/{BUCKET}={r[BUCKET]}"
                   for r in self._places(run).collect() if wanted is None or r[BUCKET] in wanted]  # a row per bucket
        return self.spark.read.schema(self.schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)

    def read(self) -> DataFrame:
        return self._read(self._at(self.state.get("batch"))[0])

    def merge(self, batch_id: int, rows: DataFrame) -> list[int]:
        """Merge a batch; the buckets that were written anew."""
        before = self.state.last("batch")
        run, last = self._at(before.value)
        if batch_id <= last:
            return []
        new, names = run + 1, self.schema.names
        rows.select(*names, bucket_of(self.keys, self.buckets).alias(BUCKET)).write.mode("overwrite").option("compression", CODEC).parquet(f"{self.folder}/came/run={new}")
        came = self.spark.read.schema(StructType([*self.schema.fields, StructField(BUCKET, IntegerType())])).parquet(f"{self.folder}/came/run={new}")
        touched = sorted(r[BUCKET] for r in came.select(BUCKET).distinct().collect())
        together = self._read(run, touched).unionByName(came.select(*names))
        merged = self.combine(together).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        merged.withColumn(BUCKET, bucket_of(self.keys, self.buckets)).repartition(BUCKET).write.mode("overwrite").option("compression", CODEC).partitionBy(BUCKET).parquet(
            f"{self.folder}/rows/run={new}")
        kept = self._places(run).where(~F.col(BUCKET).isin(touched)) if touched else self._places(run)
        mine = self.spark.createDataFrame([(b, new) for b in touched], PLACES)
        kept.unionByName(mine).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/places/run={new}")
        self.state.put("batch", f"{new}:{batch_id}", after=before.seq)
        return touched
