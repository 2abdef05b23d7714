"""Toxicity scores by a small recurrent network over all windows of a text."""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PART_CHARS, PART_ROWS, in_parts, load, sample_ids
from .gru import Network, train

#: The network learns from at most so many documents of each label, first by digest of
#: their id, and only from those of at most so many characters (longer ones blur where
#: the label comes from). Everything else, above all scoring, covers all documents.
TRAIN_TOXIC, TRAIN_CLEAN, TRAIN_CHARS = 1500, 2500, 4000
EPOCHS = 4
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2


def fold(doc_id, folds: int):
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def training_rows(docs: DataFrame, labels: DataFrame) -> list:
    """The bounded sample (text, toxic) that the network learns from.

    Held-out rows, rows without an id, a text or a label never come in. Ids with both
    labels are left out; of an id's texts the least is taken. The order is that of
    a hash of the id, so reruns agree. Texts are fetched for the chosen ids alone.
    """
    usable = docs.where(fold(F.col("doc_id"), FOLDS) != HELD_OUT).where(F.length("text").between(1, TRAIN_CHARS))
    known = labels.where("toxic IN (0, 1)").select("doc_id", "toxic")
    ids = sample_ids(known.join(usable.select("doc_id").distinct(), "doc_id"), "toxic", max(TRAIN_CLEAN, TRAIN_TOXIC), 2)
    texts = (
        usable.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # at most twice the larger parameter
        .groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).withColumn("key", F.xxhash64("doc_id"))
    )
    picked = sorted(texts.collect(), key=lambda r: (r["key"], r["doc_id"]))
    clean, toxic = ([r for r in picked if r["toxic"] == y] for y in (0, 1))
    return clean[:TRAIN_CLEAN] + toxic[:TRAIN_TOXIC]


def fit(docs: DataFrame, labels: DataFrame) -> bytes:
    """A trained network as bytes, of a size bounded by its vocabulary (about 8 MB)."""
    rows = training_rows(docs, labels)
    return pickle.dumps(train([r["text"] for r in rows], [r["toxic"] for r in rows], EPOCHS), protocol=5)


@lru_cache(maxsize=1)
def _network(crc: int, value) -> Network:
    return pickle.loads(value)


def with_score(docs: DataFrame, model: bytes) -> DataFrame:
    """Adds ``score``, in place of a column of that name: 0 to 1, of the worst window of
    the whole text.

    Null and empty texts get the score of an empty window. Rows equal in text get
    equal scores, up to single-precision rounding. Only ``text`` is read; other columns pass through.
    """
    shared, crc = docs.sparkSession.sparkContext.broadcast(model), zlib.crc32(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        net = _network(crc, shared.value)
        for batch in batches:
            out: list[float] = []
            for part in in_parts(batch, PART_CHARS, PART_ROWS):
                out.extend(net.score([t or "" for t in batch.iloc[part]]))
            yield pd.Series(out, dtype="float64")

    return docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != "score"], score("text").alias("score"))


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    """All documents, scored by a network that never saw the held-out ids."""
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    scored = with_score(docs, fit(docs, load(spark, sf_dir, "labels", "doc_id", "toxic")))
    return scored.select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score below the threshold, with their columns."""
    rows = docs.select("text", F.struct("*").alias("row"))
    return with_score(rows, fit(docs, labels)).where(F.col("score") < THRESHOLD).select("row.*")
