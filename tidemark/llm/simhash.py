"""SimHash near-duplicates by exact comparison of tiles of fingerprints.

A tile holds the fingerprints with equal population counts of their four 16-bit
parts. Two fingerprints whose counts differ by more than the radius in sum cannot
be within the radius, so only tiles with near counts meet; all pairs of such tiles
are compared with exclusive-or and bit counts. Full tiles are kept as several
blocks. A comparison reports links that connect what it found linked (a forest),
not every pair. Components are found by alternating star contractions.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import load, written

SHINGLE = 3
RADIUS = 3
SEED = 42
PARTS = 4
PART_BITS = 64 // PARTS
#: Fingerprints of a block. A row of the comparison holds two blocks, so 8 kB at most, and the
#: 10,000 rows of a batch for Python 80 MB.
BLOCK = 512
#: Rows of a comparison done at once: 512 x 512 words of 8 bytes are 2 MB.
STRIP = 512


# ---- fingerprints ---------------------------------------------------------------

def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits: each is set if more than half of the shingles' hashes have it set.

    Words are lower-cased in A-Z only and split at ASCII white space; shingles of
    ``shingle`` words count as often as they occur. Fewer words are one shingle; no
    word (or null) gives 0.
    """
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split() if text else []  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1:].tolist(), strict=True)
    hashes = np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in spans), np.uint64, len(words) - k + 1)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at:at + 65_536].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes))
    return int(bits.view(">u8")[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def with_fingerprint(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Adds ``bits``, the fingerprint as a signed long, in place of a column of that name."""

    @F.pandas_udf("long")
    def bits(texts: pd.Series) -> pd.Series:
        return pd.Series([_signed(fingerprint(t, shingle)) for t in texts], dtype="int64")

    return docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != "bits"], bits("text").alias("bits"))


# ---- links ----------------------------------------------------------------------

def forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the same nodes (0 to n-1): each node with the least it reaches."""
    least = np.arange(n)
    while True:
        low = np.minimum(least[a], least[b])
        new = least.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == least).all():
            break
        least = new
    nodes = np.flatnonzero(least != np.arange(n))
    return nodes, least[nodes]


def compare(left: np.ndarray, right: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, fingerprint) that connect all pairs within the radius."""
    n = len(left) + len(right)
    both = np.concatenate((left, right))
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for at in range(0, len(left), STRIP):
        strip = left[at:at + STRIP]
        i, j = np.nonzero(np.bitwise_count(strip[:, None] ^ right[None, :]) <= radius)
        i = i + at
        if same:
            i, j = i[i < j], j[i < j]
        else:
            j = j + len(left)
        a, b = np.concatenate((a, i)), np.concatenate((b, j))
        if len(a) > 4 * n:
            a, b = forest(a, b, n)
    if len(a) > n:
        a, b = forest(a, b, n)
    return both[a], both[b]


def _near_tiles(radius: int) -> list[tuple[int, ...]]:
    """Differences of part counts that sum to the radius at most, one of each pair of signs."""
    span = range(-radius, radius + 1)
    steps = [d for d in product(span, repeat=PARTS) if sum(map(abs, d)) <= radius]
    return [d for d in steps if d >= (0,) * PARTS]


def links(prints: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """(a, b): links between different fingerprints that connect all within ``radius`` bits.

    ``prints`` has one row per fingerprint (bits). The tile of a fingerprint is the
    population count of each of its parts.
    """
    base = 64  # a part count is at most 16, and differences stay clear of the next digit
    part = [F.bit_count(F.shiftrightunsigned("bits", PART_BITS * k).bitwiseAND((1 << PART_BITS) - 1)) for k in range(PARTS)]
    tile = sum((p.cast("int") + radius) * base**k for k, p in enumerate(part))
    tiled = prints.select("bits", tile.cast("int").alias("tile"))
    # At most 17^4 tiles, so this table has a bound.
    sizes = tiled.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("n"))
    blocks = (
        tiled.join(F.broadcast(sizes), "tile")
        .groupBy("tile", F.pmod(F.xxhash64("bits"), F.col("n")).alias("block"))
        .agg(F.sort_array(F.collect_list("bits")).alias("prints"))
    )
    blocks = written(blocks, "tiles")
    steps = F.array(*[F.lit(sum(x * base**k for k, x in enumerate(d))) for d in _near_tiles(radius)])
    left = blocks.select(
        F.col("tile").alias("own"), F.col("block").alias("own_block"), F.col("prints").alias("left"),
        F.explode(F.transform(steps, lambda s: F.col("tile") + s)).alias("tile"),
    )
    pairs = left.join(blocks, "tile").where("own != tile OR own_block <= block").select(
        "left", F.col("prints").alias("right"), (F.col("own").eqNullSafe(F.col("tile")) & (F.col("own_block") == F.col("block"))).alias("same")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [
                compare(np.asarray(a, np.int64).view(np.uint64), np.asarray(b, np.int64).view(np.uint64), radius, same)
                for a, b, same in zip(batch["left"], batch["right"], batch["same"], strict=True)
            ]
            yield pd.DataFrame({
                "a": np.concatenate([x for x, _ in found]).view(np.int64), "b": np.concatenate([y for _, y in found]).view(np.int64),
            })

    return pairs.mapInPandas(run, "a long, b long")


# ---- components -----------------------------------------------------------------

def components(edges: DataFrame) -> DataFrame:
    """(node, root): every linked node with the least node that it reaches.

    Alternates two contractions until nothing changes: each node hands its larger
    neighbours to its least one, then its smaller neighbours to the least of them.
    The rounds grow with the logarithm of the longest chain. Each is written, so no
    lineage builds up. A least neighbour is a minimum made before the shuffle; the
    join that hands it out may be split by adaptive execution.
    """
    def tidy(df: DataFrame) -> DataFrame:
        return df.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def state(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()

    now = written(tidy(edges), "links")
    mark = state(now)
    while mark[0]:
        both = now.union(now.select("b", "a")).toDF("node", "other")
        least = both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("least"))
        large = both.where("other > node").join(least, "node").select(F.col("other").alias("a"), F.col("least").alias("b"))
        large = written(tidy(large), "links")
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        given = large.join(least, "a")
        small = given.select(F.col("b").alias("a"), F.col("least").alias("b")).union(least.select("a", F.col("least").alias("b")))
        now = written(tidy(small), "links")
        if (new := state(now)) == mark:
            break
        mark = new
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b")).distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, text_hash, bits, root, component_id) per row of ``docs`` (doc_id, text).

    ``root`` is the least fingerprint of the component and names it; component_id is the least id among all documents that links reach, itself
    included. A null text has no words; texts without words share the fingerprint 0
    and are linked like any others. Equal rows stay separate rows with one component.
    Null ids never are a component's least id, unless it has no other: then it is
    null. Ids that repeat with other texts link nothing by themselves. An empty table
    gives no rows; other columns are not read.
    """
    own = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    own = written(with_fingerprint(own, shingle).select("doc_id", "text_hash", "bits"), "prints")
    prints = own.groupBy("bits").agg(F.min("doc_id").alias("least_id"))
    roots = components(links(prints.select("bits"), radius)).withColumnRenamed("node", "bits")
    linked = prints.join(roots, "bits", "left").withColumn("root", F.coalesce("root", "bits"))
    ids = linked.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = linked.join(ids, "root").select("bits", "root", "component_id")
    return own.join(named, "bits").select("doc_id", "text_hash", "bits", "root", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One document of each component, with the columns of ``docs``: the one with the
    least id (null last), of several with that id the one with the least text hash;
    of equal rows one."""
    found = near_duplicates(docs, shingle, radius)
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.col("text_hash"))
    kept = found.groupBy("root").agg(F.min(order).alias("kept")).select(
        F.col("kept.doc_id").alias("__doc_id"), F.col("kept.text_hash").alias("__text_hash")
    )
    rows = docs.select(
        F.col("doc_id").alias("__id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("__hash"), F.struct("*").alias("row")
    )
    meet = [F.col("__id").eqNullSafe(F.col("__doc_id")), F.col("__hash") == F.col("__text_hash")]
    chosen = rows.join(kept, meet, "left_semi")
    equal = Window.partitionBy("__id", "__hash").orderBy(F.xxhash64("row"))
    return chosen.withColumn("n", F.row_number().over(equal)).where("n = 1").select("row.*")


def op8_simhash(spark, sf_dir: str) -> DataFrame:
    """All documents: fingerprint, and the least id of those linked at 3 bits or less."""
    found = near_duplicates(load(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")
