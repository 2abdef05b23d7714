"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import load, scratch, written
from tidemark.llm.lines import dedup_lines
from tidemark.llm.mixing import mix_documents
from tidemark.llm.packing import pack_documents
from tidemark.llm.simhash import RADIUS, SHINGLE, keep_one
from tidemark.llm.toxicity import keep_clean
from tidemark.sources.files import remove


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the labels of the input folder teach the score.

    Null and empty texts score as an empty window, and stay. A document without an id is
    scored like any other and teaches nothing. Repeated rows stay or go together. An empty
    table stays empty.
    """
    return keep_clean(docs, load(spark, sf_dir, "labels", "doc_id", "toxic"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stood earlier, to within a word, go. Every document stays, if need be
    with an empty text; n_chars follows the text left. A null text stays null, a null id
    counts as last, rows equal in id and text are one document and come out alike."""
    out = dedup_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group within three bits of 3-word SimHash stays, the least id.

    Null texts and those without words are one group. A null id is the last; of equal ids
    the one with the least text hash stays, of equal rows one. An empty table stays empty.
    """
    return keep_one(docs, SHINGLE, RADIUS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; documents appear as often as the mix takes them.

    A null source is a source of its own, a null id shuffles like any other, equal rows are
    separate documents. Null texts and those without words are not taken.
    """
    return mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as pieces of sequences of 1024 tokens, with their ids.

    A null or empty text is its end mark alone, a null id stays null, and equal rows are
    separate documents. Long texts are cut, never shortened.
    """
    return pack_documents(docs, with_ids=True)


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_duplicates),
    ("mix sources", mix),
    ("best-fit packing", pack),
]

#: Trained scores, fingerprint groups and tokenizers have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other. What a stage wrote on its way goes when it is done,
    and its result when the next one's is there; only the last one's is left."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for k, (_, stage) in enumerate(STAGES):
        with scratch(spark) as inner:
            docs = written(stage(spark, docs, sf_dir), f"stage-{k}")
            result = inner.pop()
        remove(spark, *before)
        before = [result]
    return docs
