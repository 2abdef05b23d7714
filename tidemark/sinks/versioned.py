"""A table whose whole content is replaced at once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.files import path_exists, remove
from ..session import CODEC
from .state import StateLog


class VersionedTable:
    """Each replacement is written to a folder of its own and then published.

    Readers see the old rows until the new ones are complete, a failed write
    changes nothing, and earlier versions stay readable. An empty replacement
    is not published: the old rows stay.

    Tables that are to be published together share a ``log``, in which each
    goes by its ``name``.
    """

    def __init__(self, spark: SparkSession, folder: str, log: StateLog | None = None, name: str = "version"):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.published = log or StateLog(spark, f"{self.folder}/published")
        self.name = name

    def stage(self, df: DataFrame) -> tuple[str, int]:
        """Write a version without publishing it; its name and row count."""
        version = uuid.uuid4().hex
        counted = Observation()
        df.observe(counted, F.count(F.lit(1)).alias("n")).write.option("compression", CODEC).parquet(self.path(version))
        return version, counted.get["n"]

    def publish(self, version: str) -> None:
        self.published.put(self.name, version)

    def replace(self, df: DataFrame) -> int:
        """Stage and publish; the number of rows, 0 when nothing was replaced."""
        version, rows = self.stage(df)
        if rows:
            self.publish(version)
        return rows

    def path(self, version: str) -> str:
        return f"{self.folder}/version={version}"

    def current(self) -> str | None:
        return self.published.get(self.name)

    def versions(self) -> DataFrame:
        """All published versions, first to last."""
        return self.published.entries(self.name).orderBy("seq").select(
            F.col("value").alias("version"), F.col("updated_at").alias("published_at")
        )

    def read(self, version: str | None = None, schema: StructType | None = None) -> DataFrame:
        """The current rows or those of ``version``; a known ``schema`` saves a look at the files."""
        version = version or self.current()
        if version is None:
            raise FileNotFoundError(f"nothing published under {self.folder}")
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(self.path(version))

    def expire(self, keep: int = 2) -> int:
        """Delete the rows of all but the last ``keep`` published versions; how many went.

        Readers of an older version fail from then on, so keep as many as may be read.
        """
        if keep < 1:
            raise ValueError("the current version must stay")
        published = [r["version"] for r in self.versions().collect()]  # one row per build
        old = [v for v in dict.fromkeys(published) if v not in published[-keep:] and path_exists(self.spark, self.path(v))]
        remove(self.spark, *[self.path(v) for v in old])
        return len(old)

    def write_once(self, df: DataFrame) -> int:
        """Replace only a table that has never been published."""
        return 0 if self.current() else self.replace(df)
