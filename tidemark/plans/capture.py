"""Change capture: inserts, updates and deletes of a table that tells none of them.

The rows of a table are dealt into buckets by a hash of their key, and a digest is kept
for each bucket. A look at the table makes the digests anew in one aggregation; only
buckets whose digest differs are read again, there and in the copy kept from the last
look, and compared row by row. So rows that change behind a watermark come in.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..operators.capture import BUCKET, OP, bucket_of, differences, digests
from ..sinks.landing import BATCHES, place
from ..sinks.state import StateLog
from ..sources.files import is_complete

DIGEST = f"{BUCKET} int, n bigint, mixed bigint, total decimal(38,0), run bigint"
#: Deleted rows lie beside the batches.
DELETES = "postgres/deletes/table_name={table}"


@dataclass
class Look:
    """A look at the table: its number, and the buckets that were read again."""

    run: int
    differing: list[int]


class ChangeCapture:
    """Follows a table under ``folder``; ``keys`` are unique, and null is a key like any other.

    The folder holds, per look, the rows of the buckets that differed, the digests of all
    buckets with the look that wrote each, and the changes. A look counts once its number
    is saved; one that dies before is repeated and replaces what it left. ``buckets`` is
    to give each bucket some ten thousand rows: fewer make a look read more, and their
    digests come to the driver.
    """

    def __init__(self, spark: SparkSession, folder: str, name: str, keys: Sequence[str], schema: StructType, buckets: int = 1024):
        self.spark, self.folder, self.name = spark, f"{folder.rstrip('/')}/{name}", name
        self.keys, self.schema, self.buckets = list(keys), schema, buckets
        self.state = StateLog(spark, f"{folder.rstrip('/')}/looks")

    def _digests(self, run: int) -> DataFrame:
        if not run:
            return self.spark.createDataFrame([], DIGEST)
        return self.spark.read.schema(DIGEST).parquet(f"{self.folder}/digests/run={run}")

    def copy(self, buckets: Iterable[int] | None = None) -> DataFrame:
        """The table as it was at the last look, or those buckets of it; no other is read."""
        wanted = None if buckets is None else set(buckets)
        places = [
            f"{self.folder}/rows/run={r['run']}/{BUCKET}={r[BUCKET]}"
            for r in self._digests(int(self.state.get(self.name, "0"))).collect()  # a row per bucket
            if wanted is None or r[BUCKET] in wanted
        ]
        if not places:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*places)

    def look(self, table: DataFrame) -> Look:
        """Compare the table with the last look and keep it. ``table`` is read twice: all
        of it for the digests, and the rows of the buckets that differ."""
        before = self.state.last(self.name)
        last = int(before.value or 0)
        run = last + 1
        table = table.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        kept = {r[BUCKET]: r for r in self._digests(last).collect()}
        now = {r[BUCKET]: r for r in digests(table, self.keys, self.buckets).collect()}
        what = lambda r: r and (r["n"], r["mixed"], r["total"])
        differ = sorted(b for b in kept.keys() | now.keys() if what(kept.get(b)) != what(now.get(b)))
        if not differ:
            return Look(last, [])
        bucket = bucket_of(self.keys, self.buckets)
        rows, target = table.withColumn(BUCKET, bucket).where(F.col(BUCKET).isin(differ)), f"{self.folder}/rows/run={run}"
        rows.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(target)
        # From here on the rows just written count, should the table have moved on meanwhile.
        with_bucket = StructType([*self.schema.fields, StructField(BUCKET, IntegerType())])
        stored = self.spark.read.schema(with_bucket).parquet(target).drop(BUCKET)
        changes = differences(self.copy(differ), stored, self.keys)
        changes.write.mode("overwrite").parquet(self._changes(run))
        mine = digests(stored, self.keys, self.buckets).withColumn("run", F.lit(run).cast("bigint"))
        held = self._digests(last).where(~F.col(BUCKET).isin(differ))
        held.unionByName(mine).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/digests/run={run}")
        self.state.put(self.name, str(run), after=before.seq)
        return Look(run, differ)

    def _changes(self, run: int) -> str:
        return f"{self.folder}/changes/run={run}"

    def changes(self, run: int) -> DataFrame:
        """What a look found: ``_op``, the row, and as ``before`` the row that an update replaced."""
        return self.spark.read.parquet(self._changes(run))

    def land(self, lake: str, now: datetime | None = None) -> int:
        """Bring the changes of all looks not landed yet into the lake; the number of looks.

        Inserts and updates go to the table's batches as they are now, deleted rows beside
        them, in a folder per look that a repeated run replaces or finds complete.
        """
        now, last, landed = now or datetime.now(), int(self.state.get(self.name, "0")), self.state.last(f"{self.name}.landed")
        done = int(landed.value or 0)
        for run in range(done + 1, last + 1):
            changes = self.changes(run)
            for pattern, mine in ((BATCHES, F.col(OP) != "delete"), (DELETES, F.col(OP) == "delete")):
                folder = f"{place(lake, pattern, self.name)}/batch_date={now:%Y-%m-%d}/look={run}"
                if not is_complete(self.spark, folder):
                    changes.where(mine).select(*self.schema.names).hint("rebalance").write.mode("overwrite").parquet(folder)
            landed = landed._replace(seq=self.state.put(f"{self.name}.landed", str(run), after=landed.seq))
        return last - done
