"""Substring dedup: repeated runs of consecutive sentences.

At every sentence starts one run and ends one run: the shortest that has at least two
sentences and 20 words. What a run is depends on its own text only, so a passage gives
the same runs wherever it stands, and these cover every sentence of it. Runs are joined by a 128-bit hash over all documents; all
sentences of a run that stood earlier are removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PART_CHARS, PART_ROWS, in_parts, load, written

MIN_WORDS, MIN_SENTENCES = 20, 2
#: A sentence of so many words counts as several; a repeated one is enough.
LONG_SENTENCE = 30

#: Sentences end after full stops and the like, at line ends, and before a capital after
#: a small letter, which is what a passage set into other text looks like.
BREAK = regex.compile(r"(?<=[.!?…]['\")\]]?)\s+|\s*\n\s*|(?<=\p{Ll})\s+(?=\p{Lu})")

PLACE = "doc_id long, text_hash long, sentence int"


def sentences(text: str | None) -> list[tuple[int, int]]:
    """(start, end) of each sentence; ends reach to the next start, so they cover the text."""
    if not text:
        return []
    starts = [0, *(m.end() for m in BREAK.finditer(text) if 0 < m.end() < len(text))]
    return list(zip(starts, [*starts[1:], len(text)], strict=True))


def runs(text: str | None) -> list[tuple[int, int, bytes]]:
    """(first sentence, sentences, words as bytes): for each start the shortest run, and
    for each end the shortest run that is not yet among those.

    A repeated span is covered to its last sentence: its starts give runs up to the
    last start that has one within the span, and the run that ends with the span
    begins there.
    """
    parts = [text[a:b].lower().split() for a, b in sentences(text)]
    counts = [len(p) for p in parts]
    found, end, words = [], 0, 0
    for i in range(len(parts)):
        if end < i:
            end, words = i, 0
        while end < len(parts) and not _enough(counts, i, end, words):
            words += counts[end]
            end += 1
        if _enough(counts, i, end, words):
            found.append((i, end))
        words -= counts[i] if end > i else 0
    # The shortest run to an end starts where the last run within that end does.
    last = dict((end, i) for i, end in found)
    have, i = set(found), None
    for end in range(1, len(parts) + 1):
        i = last.get(end, i)
        if i is not None and (i, end) not in have:
            found.append((i, end))
    return [(i, end - i, " ".join(w for p in parts[i:end] for w in p).encode()) for i, end in found]


def _enough(counts: list[int], first: int, end: int, words: int) -> bool:
    if end - first == 1:
        return counts[first] >= LONG_SENTENCE
    return end - first >= MIN_SENTENCES and words >= MIN_WORDS


def run_table(docs: DataFrame) -> DataFrame:
    """A row per run: its hash (high, low), where it starts, and how many sentences it has."""

    def found_in(batch: pd.DataFrame) -> pd.DataFrame:
        from xxhash import xxh3_128_digest

        ids, hashes, firsts, sizes, digests = [], [], [], [], bytearray()
        for doc_id, text_hash, text in zip(batch["doc_id"], batch["text_hash"], batch["text"], strict=True):
            found = runs(text)
            ids += [doc_id] * len(found)
            hashes += [text_hash] * len(found)
            for first, size, words in found:
                firsts.append(first)
                sizes.append(size)
                digests += xxh3_128_digest(words)
        halves = np.frombuffer(bytes(digests), np.int64).reshape(-1, 2)
        return pd.DataFrame({
            "high": halves[:, 0], "low": halves[:, 1], "doc_id": pd.array(ids, dtype="Int64"),
            "text_hash": np.array(hashes, np.int64), "sentence": np.array(firsts, np.int32), "size": np.array(sizes, np.int32),
        })

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in in_parts(batch["text"], PART_CHARS, PART_ROWS):
                yield found_in(batch.iloc[part])

    return docs.mapInPandas(find, f"high long, low long, {PLACE}, size int")


def repeated_sentences(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, removed, repeats_of): for each document that repeats something
    the numbers of the sentences to remove and the ids where they stood first.

    ``docs`` has doc_id, text_hash and text. Earlier means a lower id (null last), then
    a lower text hash, then a lower sentence. Runs are found once and written. Hashes are
    counted with a sum per task first, so one that is everywhere is a row per task; the
    places of those that repeat are found by a join of plain shuffles, which adaptive
    execution can split, and are a small part of all.
    """
    table = written(run_table(docs), "runs")
    key = [F.col("high").alias("__high"), F.col("low").alias("__low")]
    meet = (F.col("high") == F.col("__high")) & (F.col("low") == F.col("__low"))
    repeated = written(table.groupBy("high", "low").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*key), "repeats")
    hits = written(table.join(repeated, meet).drop("__high", "__low"), "places")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash", "sentence")
    firsts = written(hits.groupBy("high", "low").agg(F.min(place).alias("first")).select(*key, "first"), "firsts")
    later = hits.join(firsts, meet).where(place != F.col("first"))
    # A document's own sentences, so each group is bounded by the document.
    return later.groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(
            F.sequence(F.col("sentence"), F.col("sentence") + F.col("size") - 1)
        )))).alias("removed"),
        F.array_sort(F.collect_set("first.doc_id")).alias("repeats_of"),
    )


def without(text: str | None, removed) -> str | None:
    """The text without those sentences."""
    if removed is None or not len(removed):
        return text
    gone = set(removed)
    return "".join(text[a:b] for k, (a, b) in enumerate(sentences(text)) if k not in gone)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the text left, and n_removed (sentences) and repeats_of (where they
    stood first) added.

    Words are compared in lower case, whatever white space parts them. A null text
    stays null, an empty one empty. Rows equal in id and text are one document and
    come out alike; other rows with an equal id are documents of their own. Null ids
    count as last. Long texts are read whole. Other columns pass through, also those
    named like an added one, which comes in their place.
    """
    added = ("n_removed", "repeats_of")
    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text", F.struct("*").alias("row"))
    found = repeated_sentences(rows.select("doc_id", "text_hash", "text")).select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "removed", "repeats_of"
    )

    @F.pandas_udf("string")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, removed in batches:
            yield pd.Series([without(t, r) for t, r in zip(texts, removed, strict=True)], dtype="object")

    meet = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash"))
    out = rows.join(found, meet, "left").withColumn("cut", cut("text", "removed"))
    kept = [F.col("cut").alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns if c not in added]
    return out.select(
        *kept, F.coalesce(F.size("removed"), F.lit(0)).alias("n_removed"),
        F.coalesce("repeats_of", F.array().cast("array<bigint>")).alias("repeats_of"),
    )


def op5_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents without the sentences that stood before."""
    return remove_repeats(load(spark, sf_dir, "documents", "doc_id", "text"))
