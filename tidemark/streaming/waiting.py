"""Children that come before their parent wait in a table of their own.

A streaming join gives a child up after its time limit. Here nothing is given up: each
batch of children is joined to all parents there are, what finds none waits, and each
batch of parents is joined to what waits. So a child appears in the batch in which the
later of the two arrives, however much later that is, and no table is rebuilt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from ..sinks.state import StateLog
from .incremental import BATCH_ID, batch_folder, overwrite_batch, read_batches

#: Which part of a batch a child is in: with its parent, or waiting.
PLACED = "_placed"


class WaitingJoin:
    """Joins ``children`` to ``parents`` on ``key``, batch by batch, under ``folder``.

    Every batch has an id that goes up, as those of ``foreachBatch`` do, and may be
    repeated: it then replaces what it wrote, from the state of the batch before it, and
    counts once its id is saved. A batch may bring children, parents or both. Parents
    have unique keys; of one that comes again the first stays. A null key meets nothing
    and waits for ever.
    """

    def __init__(self, spark: SparkSession, folder: str, key: str, parents: StructType, children: StructType):
        clash = (set(parents.names) & set(children.names)) - {key}
        if clash:
            raise ValueError(f"columns of both sides: {', '.join(sorted(clash))}")
        self.spark, self.folder, self.key = spark, folder.rstrip("/"), key
        self.parents_schema, self.children_schema = parents, children
        self.out_schema = StructType([*children.fields, *[f for f in parents.fields if f.name != key]])
        self.done = StateLog(spark, f"{self.folder}/done")

    def _last(self) -> int:
        return int(self.done.get("batch", "-1"))

    def _upto(self, name: str, schema: StructType, batch_id: int) -> DataFrame:
        """Rows of the batches up to one, of those that count."""
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        return read_batches(self.spark, f"{self.folder}/{name}", ddl).where(F.col(BATCH_ID) <= batch_id).drop(BATCH_ID)

    def _met(self, children: DataFrame, parents: DataFrame) -> DataFrame:
        """Children with their parent's columns, or nulls, and whether it is there."""
        met = children.join(parents.withColumn(PLACED, F.lit(True)), self.key, "left")
        return met.select(*self.out_schema.names, F.coalesce(PLACED, F.lit(False)).alias(PLACED))

    def _waiting_after(self, batch_id: int) -> DataFrame:
        if batch_id < 0:
            return self.spark.createDataFrame([], self.children_schema)
        with_place = StructType([*self.children_schema.fields, StructField(PLACED, BooleanType())])
        rows = self.spark.read.schema(with_place).parquet(batch_folder(f"{self.folder}/met", batch_id))
        return rows.where(~F.col(PLACED)).drop(PLACED)

    def add(self, batch_id: int, parents: DataFrame | None = None, children: DataFrame | None = None) -> None:
        """Take in a batch, the next one or the last one once more.

        Joins carry no hint: a small batch is broadcast and shuffles no stored table, and
        a large one meets it in a join that adaptive execution can split. What waits is
        written anew with each batch; it is as large as what is late.
        """
        before = self.done.last("batch")
        last = -1 if before.value is None else int(before.value)
        if batch_id < last:
            raise ValueError(f"batch {batch_id} comes after batch {last}")
        previous = self._previous(batch_id)
        known = self._upto("parents", self.parents_schema, previous)
        new = parents if parents is not None else self.spark.createDataFrame([], self.parents_schema)
        came = children if children is not None else self.spark.createDataFrame([], self.children_schema)
        new = new.select(*self.parents_schema.names).dropDuplicates([self.key])
        overwrite_batch(new.join(known.select(self.key), self.key, "left_anti").select(*self.parents_schema.names), f"{self.folder}/parents", batch_id)
        overwrite_batch(came.select(*self.children_schema.names), f"{self.folder}/came", batch_id)
        # What was written, should the sources give other rows when they are read again.
        new, came = self._of("parents", self.parents_schema, batch_id), self._of("came", self.children_schema, batch_id)
        waiting = self._waiting_after(previous)
        both = known.unionByName(new)
        # One join per side tells who is placed and who waits, and parts them as they are written.
        overwrite_batch(self._met(came, both).unionByName(self._met(waiting, new)), f"{self.folder}/met", batch_id, PLACED)
        if batch_id > last:
            self.done.put("batch", str(batch_id), after=before.seq)

    def _previous(self, batch_id: int) -> int:
        """The batch that counted before this one."""
        ids = [int(r["value"]) for r in self.done.entries("batch").collect() if int(r["value"]) < batch_id]
        return max(ids, default=-1)

    def _of(self, name: str, schema: StructType, batch_id: int) -> DataFrame:
        return self.spark.read.schema(schema).parquet(batch_folder(f"{self.folder}/{name}", batch_id))

    def placed(self) -> DataFrame:
        """Children with their parents' columns, each once."""
        met = StructType([*self.out_schema.fields, StructField(PLACED, BooleanType())])
        return self._upto("met", met, self._last()).where(PLACED).drop(PLACED)

    def waiting(self) -> DataFrame:
        """Children whose parent has not come."""
        return self._waiting_after(self._last())

