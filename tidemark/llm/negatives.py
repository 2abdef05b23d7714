"""Hard negatives for anchors, by a vertical scan of the vectors.

Vectors lie in tiles, column by column. For an anchor the columns of a tile are read in
the order of the anchor's largest components, some at a time. What is not yet read can
add no more than the columns' least and greatest values allow, so every vector has a
lower and an upper bound; vectors that can no longer count leave the bitmap, and the next
columns are read for the rest only. First the positives are found this way, the best
vectors of the anchor's label. Each gives a window of scores; the best vectors of other
labels within the windows are the negatives. All arithmetic is on integers.

Anchors are a stated query set: they meet all rows in blocks of bounded size, each
broadcast to tasks that hand on no more than an anchor's best few.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import load, written

POSITIVES, NEGATIVES = 5, 3
#: A negative scores from 50 to 95 hundredths of the positive's score.
LEAST_SHARE, MOST_SHARE = 50, 95
EVERY = 50
#: Anchors that meet all rows at once.
BLOCK = 2_048
#: Values of a tile, and columns read before bounds are looked at again.
TILE_VALUES, STEP = 1 << 20, 16
#: Rows whose best scores are taken as floors for all tasks, if the table is much larger.
SEED_ROWS = 65_536

RESULT = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def prepared(rows: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, label and the integer components of the rows that take part.

    Rows with a null label, a null vector, or a null or non-finite component do not.
    """
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & whole).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("v"),
    )


# ---- one tile -----------------------------------------------------------------------

@dataclass
class Tile:
    """``columns`` has a row per component; ``low`` and ``high`` are its extremes."""

    columns: np.ndarray
    ids: np.ndarray
    no_id: np.ndarray
    labels: np.ndarray
    low: np.ndarray
    high: np.ndarray


def tile(columns: np.ndarray, ids: np.ndarray, no_id: np.ndarray, labels: np.ndarray) -> Tile:
    return Tile(columns, ids, no_id, labels, columns.min(axis=1), columns.max(axis=1))


def by_label(whole: Tile) -> Iterator[tuple[int, Tile]]:
    """The tile's labels, each with its rows as a tile of their own."""
    order = np.argsort(whole.labels, kind="stable")
    labels, starts = np.unique(whole.labels[order], return_index=True)
    for label, at in zip(labels.tolist(), np.split(order, starts[1:]), strict=True):
        yield label, tile(whole.columns[:, at], whole.ids[at], whole.no_id[at], whole.labels[at])


def scan(anchor: np.ndarray, t: Tile, least: int, most: int | None = None,
         allowed: np.ndarray | None = None, step: int = STEP) -> tuple[np.ndarray, np.ndarray, int]:
    """Rows of the tile that score from ``least`` to ``most``, their scores, and the values read."""
    order = np.argsort(-np.abs(anchor), kind="stable")
    order = order[: np.count_nonzero(anchor)]  # the rest adds nothing
    ends = np.stack((anchor * t.low, anchor * t.high))[:, order]
    add = np.concatenate((np.cumsum(ends.max(axis=0)[::-1])[::-1], [0]))
    take = np.concatenate((np.cumsum(ends.min(axis=0)[::-1])[::-1], [0]))
    alive = np.arange(len(t.ids)) if allowed is None else np.flatnonzero(allowed)
    score, read, whole = np.zeros(len(alive), t.columns.dtype), 0, allowed is None
    for at in range(0, max(len(order), 1), step):
        dims = order[at:at + step]
        part = t.columns[dims] if whole else t.columns[np.ix_(dims, alive)]
        score = score + anchor[dims] @ part
        read += part.size
        done = min(at + step, len(order))
        keep = score + add[done] >= least
        if most is not None:
            keep &= score + take[done] <= most
        if not keep.all():
            alive, score, whole = alive[keep], score[keep], False
        if not len(alive):
            break
    return alive, score, read


def merged(scores, ids, no_id, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first ``k`` by score, then id (null last)."""
    order = np.lexsort((ids, no_id, -scores))[:k]
    return scores[order], ids[order], no_id[order]


class Best:
    """The first few rows found so far, and the score that a further one must reach."""

    def __init__(self, k: int, floor: int):
        self.k, self.floor = k, floor
        self.rows = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        new = scores.astype(np.int64), ids, no_id
        self.rows = merged(*(np.concatenate(x) for x in zip(self.rows, new, strict=True)), self.k)
        if len(self.rows[0]) == self.k:
            self.floor = max(self.floor, int(self.rows[0][-1]))


# ---- tiles of a task ----------------------------------------------------------------

def number(dims: int, largest: int) -> type:
    """A type in which all inner products are exact: floats (they are fast) as far as they go."""
    top = dims * largest * largest
    return np.float32 if top < 1 << 24 else np.float64 if top < 1 << 53 else object


def matrix(values: pa.Array, dims: int, kind: type) -> np.ndarray:
    """Component by component, a column per row; shorter vectors end in zeros."""
    flat, ends = values.flatten().to_numpy(zero_copy_only=False), np.diff(values.offsets.to_numpy())
    if (ends == dims).all():
        return np.ascontiguousarray(flat.reshape(len(values), dims).T.astype(kind))
    out = np.zeros((dims, len(values)), kind)
    for i, (start, n) in enumerate(zip(np.cumsum(ends) - ends, ends, strict=True)):
        out[:n, i] = flat[start:start + n]
    return out


def tiles(batches: Iterator[pa.RecordBatch], dims: int, kind: type) -> Iterator[Tile]:
    most = max(1, TILE_VALUES // max(dims, 1))
    for batch in batches:
        for at in range(0, len(batch), most):
            part = batch.slice(at, most)
            ids, labels = part.column("vec_id"), part.column("label")
            yield tile(matrix(part.column("v"), dims, kind), ids.fill_null(0).to_numpy(zero_copy_only=False),
                       ids.is_null().to_numpy(zero_copy_only=False), labels.to_numpy())


@dataclass
class Anchors:
    """A block: row k is an anchor with its id, label, components and floor for positives;
    ``windows`` are its (positive score, floor) pairs."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    floors: list[int]
    windows: list[list[tuple[int, int]]]


def window(score: int) -> tuple[int, int]:
    """The least and the greatest score of a negative for a positive of this score."""
    return -(-LEAST_SHARE * score // 100), MOST_SHARE * score // 100


def positives_of(block: Anchors, found: Iterator[Tile], k: int = POSITIVES) -> dict[tuple[int, int], Best]:
    """The first ``k`` rows of each anchor's label, the anchor's id left out."""
    best = {(n, 0): Best(k, floor) for n, floor in enumerate(block.floors)}
    mine: dict[int, list[int]] = {}
    for n, label in enumerate(block.labels.tolist()):
        mine.setdefault(label, []).append(n)
    for whole in found:
        for label, t in by_label(whole):
            for n in mine.get(label, ()):
                b = best[n, 0]
                at, score, _ = scan(block.vectors[n], t, b.floor, allowed=(t.ids != block.ids[n]) | t.no_id)
                if len(at):
                    b.add(score, t.ids[at], t.no_id[at])
    return best


def negatives_of(block: Anchors, found: Iterator[Tile], k: int = NEGATIVES) -> dict[tuple[int, int], Best]:
    """The first ``k`` rows of other labels within each window of each anchor."""
    best = {(n, s): Best(k, max(floor, window(s)[0])) for n, w in enumerate(block.windows) for s, floor in w}
    for t in found:
        for n, windows in enumerate(block.windows):
            mine = [(window(s)[1], best[n, s]) for s, _ in windows if window(s)[0] <= window(s)[1]]
            if not mine:
                continue
            at, score, _ = scan(block.vectors[n], t, min(b.floor for _, b in mine), max(top for top, _ in mine),
                                t.labels != block.labels[n])
            for top, b in mine:
                inside = (score <= top) & (score >= b.floor)
                if inside.any():
                    b.add(score[inside], t.ids[at[inside]], t.no_id[at[inside]])
    return best


# ---- all rows -----------------------------------------------------------------------

def _found(table: DataFrame, block: Anchors, dims: int, kind: type, find: Callable) -> DataFrame:
    """anchor (number in the block), of (a window's score, else 0), score, id: a task's best."""
    shared = table.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = find(shared.value, tiles(batches, dims, kind))
        rows = [(n, s, x, None if no else i) for (n, s), b in best.items() for x, i, no in zip(*(r.tolist() for r in b.rows), strict=True)]
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["anchor", "of", "score", "id"])

    return table.mapInArrow(run, "anchor long, of long, score long, id long")


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of all tasks for each anchor and window, with their rank."""
    order = Window.partitionBy("anchor", "of").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _blocks(anchors: DataFrame, dims: int, kind: type, size: int) -> Iterator[Anchors]:
    """The anchors in blocks of at most ``size``; the driver holds one."""
    rows = anchors.toLocalIterator() if anchors.limit(size + 1).count() > size else iter(anchors.collect())
    while part := list(islice(rows, size)):
        vectors = np.zeros((len(part), dims), kind)
        for k, r in enumerate(part):
            vectors[k, :len(r["v"])] = r["v"]
        ids, labels = (np.array([r[c] for r in part], np.int64) for c in ("vec_id", "label"))
        yield Anchors(ids, labels, vectors, [-(1 << 62)] * len(part), [[] for _ in part])


def _mine(table: DataFrame, sample: DataFrame | None, block: Anchors, dims: int, kind: type) -> DataFrame:
    """The negatives of one block of anchors."""

    def best(find, k, floors):
        if sample is not None:  # any rows' k-th best score is one that all rows' reaches
            seeds = _first(_found(sample, block, dims, kind, find), k).where(F.col("rank") == k)
            floors({(r["anchor"], r["of"]): r["score"] for r in seeds.collect()})  # a row per anchor and window at most
        return written(_first(_found(table, block, dims, kind, find), k), "nearest")

    def positive_floors(seeds):
        block.floors = [seeds.get((n, 0), f) for n, f in enumerate(block.floors)]

    def negative_floors(seeds):
        block.windows = [[(s, seeds.get((n, s), f)) for s, f in w] for n, w in enumerate(block.windows)]

    positives = best(positives_of, POSITIVES, positive_floors)
    for r in positives.select("anchor", "score").distinct().collect():  # five to an anchor at most
        block.windows[r["anchor"]].append((r["score"], -(1 << 62)))
    negatives = best(negatives_of, NEGATIVES, negative_floors)
    names = table.sparkSession.createDataFrame([(n, int(i)) for n, i in enumerate(block.ids)], "anchor long, anchor_id long")
    pairs = positives.select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")).join(F.broadcast(names), "anchor")
    ranked = negatives.select("anchor", F.col("of").alias("positive_score"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return pairs.join(ranked, ["anchor", "positive_score"]).select(*RESULT)


def hard_negatives(rows: DataFrame, every: int = EVERY, block: int = BLOCK, seed_rows: int = SEED_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` has vec_id, label and embedding; other columns are not read. Anchors are
    the rows whose id is divisible by ``every``. Of equal scores the lower id comes
    first, a null id last; a null id is no anchor. Repeated rows count as often as they
    occur, each anchor among them for itself; rows with an anchor's id are none of its
    positives. Components that a shorter vector lacks are 0, so an empty vector scores 0.
    An empty table, or one without an anchor, gives no rows. Scores beyond 64 bits raise
    an error.
    """
    spark = rows.sparkSession
    table = written(prepared(rows), "vectors")
    largest = F.array_max(F.transform("v", lambda x: F.abs(x)))
    n, dims, top = table.agg(F.count(F.lit(1)), F.max(F.size("v")), F.max(largest)).first()
    dims, kind = dims or 0, number(dims or 0, top or 0)
    sample = None
    if n > 4 * seed_rows:  # much larger, or the floors are not worth their pass
        share = int(seed_rows / n * (1 << 32))
        sample = written(table.where(F.pmod(F.xxhash64("vec_id", "v"), F.lit(1 << 32)) < share), "sample")
    anchors = table.where(F.col("vec_id") % every == 0)
    parts = [written(_mine(table, sample, b, dims, kind), "negatives") for b in _blocks(anchors, dims, kind, block)]
    if not parts:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return reduce(DataFrame.unionByName, parts)


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector, after every seventh got the next label."""
    rows = load(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved))


ORACLE_OP13 = """
WITH parted AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    list_inner_product(a.v::DOUBLE[], b.v::DOUBLE[])::BIGINT AS score
  FROM parted a JOIN parted b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id,
  row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INT AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
