"""Ranked lexical search: the best documents for each item, by two trees at once.

Documents become vectors over the items' terms: a term's part of the score that depends
on the document alone. A task takes its documents in batches. The documents of a batch
are the leaves of a tree whose nodes hold, for each term, the greatest value below them;
the items are a tree alike, of weights. The inner product of two nodes is at least the
score of any document below the one for any item below the other. A pair of nodes whose
bound is under the weakest k-th best score of its items so far is dropped with all below
it; other pairs open up, and pairs of leaves are scored exactly. Nothing but what cannot
enter an item's best is dropped, so results are exact. All arithmetic is on integers.

Items are a stated query set: they meet all documents in blocks of bounded size, each
broadcast to tasks that hand on no more than an item's best few.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import load, written

BEST = 10
#: A block ends with the item that brings it to so many items, or different terms of items.
BLOCK_ITEMS, BLOCK_TERMS = 512, 50_000
#: Documents and items below a leaf, and nodes below a node.
LEAF_DOCS, LEAF_ITEMS, FANOUT = 4, 1, 4
#: Dimensions in which rows are put in order.
SKETCH = 64
#: Values that the leaves of a batch of documents hold.
BATCH_VALUES = 1 << 21
#: Documents whose k-th best scores are floors for all tasks, if there are many more.
SEED_DOCS = 20_000

RESULT = "item_id long, rank int, doc_id long, score long"

# --- fixed value: A-Z become small, other ASCII but letters and digits parts terms ----
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a text, in order."""
    return text.encode().translate(_FOLD).split() if text else []


# ---- vectors ------------------------------------------------------------------------

def vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (all terms), terms and tfs of the vocabulary; documents without a term are left out."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    @F.pandas_udf("n long, terms array<int>, tfs array<int>")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for batch in batches:
            n, ids, tfs = [], [], []
            for text in batch:
                found = terms(text)
                n.append(len(found))
                mine = [(known[t], c) for t, c in Counter(found).items() if t in known]
                mine.sort()
                ids.append(np.array([i for i, _ in mine], np.int32))
                tfs.append(np.array([c for _, c in mine], np.int32))
            yield pd.DataFrame({"n": n, "terms": ids, "tfs": tfs})

    return docs.select("doc_id", count("text").alias("found")).select("doc_id", "found.*").where("n > 0")


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


# ---- trees --------------------------------------------------------------------------

@dataclass
class Rows:
    """Sparse rows: row k has ``ids[ends[k]:ends[k + 1]]`` with those ``values``."""

    ends: np.ndarray
    ids: np.ndarray
    values: np.ndarray

    def __len__(self) -> int:
        return len(self.ends) - 1

    def take(self, order: np.ndarray) -> Rows:
        sizes = np.diff(self.ends)[order]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        at = np.repeat(self.ends[:-1][order] - ends[:-1], sizes) + np.arange(ends[-1])
        return Rows(ends, self.ids[at], self.values[at])

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.ends))


def alike(rows: Rows, weights: np.ndarray, leaf: int) -> np.ndarray:
    """An order in which rows that point the same way stand together, ``leaf`` by ``leaf``.

    Rows are thrown onto a few dimensions, and halved again and again between two rows
    that point in unlike directions. The order only decides how tight the bounds are.
    """
    rng = np.random.default_rng(1)
    bucket, sign = rng.integers(0, SKETCH, len(weights)), rng.choice([-1.0, 1.0], len(weights))
    cells = rows.owners() * SKETCH + bucket[rows.ids]
    sketch = np.bincount(cells, rows.values * weights[rows.ids] * sign[rows.ids], len(rows) * SKETCH).reshape(-1, SKETCH)
    sketch /= np.linalg.norm(sketch, axis=1, keepdims=True) + 1.0
    done, waiting = [], [np.arange(len(rows))]
    while waiting:
        part = waiting.pop()
        if len(part) <= leaf:
            done.append(part)
            continue
        own = sketch[part]
        one = own[np.argmin(own @ own[0])]
        order = part[np.argsort(own @ (one - own[np.argmin(own @ one)]), kind="stable")]
        half = -(-len(part) // (2 * leaf)) * leaf
        waiting += [order[half:], order[:half]]
    return np.concatenate(done)


def maxima(rows: Rows, leaf: int, width: int) -> list[np.ndarray]:
    """Levels of a tree over the rows in their order, leaves first: each node's greatest values."""
    nodes = -(-len(rows) // leaf)
    level = np.zeros((nodes, width), np.int64)
    np.maximum.at(level.reshape(-1), rows.owners() // leaf * width + rows.ids, rows.values)
    levels = [level]
    while len(level) > 1:
        level = np.maximum.reduceat(level, np.arange(0, len(level), FANOUT), axis=0)
        levels.append(level)
    return levels


class Best:
    """An item's best documents so far, and the score that a further one must reach."""

    def __init__(self, k: int, floor: int):
        self.k, self.floor = k, floor
        self.rows = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        rows = [np.concatenate(x) for x in zip(self.rows, (scores, ids, no_id), strict=True)]
        order = np.lexsort((rows[1], rows[2], -rows[0]))[: self.k]
        self.rows = tuple(r[order] for r in rows)
        if len(order) == self.k:
            self.floor = max(self.floor, int(self.rows[0][-1]))


@dataclass
class Items:
    """The items' tree. Rows are terms with how often an item has them, times their weight."""

    rows: Rows
    width: int
    levels: list = field(init=False)
    terms: list = field(init=False)

    def __post_init__(self):
        self.order = alike(self.rows, np.ones(self.width, np.int64), LEAF_ITEMS)
        self.rows = self.rows.take(self.order)
        full = maxima(self.rows, LEAF_ITEMS, self.width)
        # Nodes keep their own terms alone: few, next to all.
        self.terms = [[np.flatnonzero(node) for node in level] for level in full]
        self.levels = [[node[at] for node, at in zip(level, ids, strict=True)] for level, ids in zip(full, self.terms, strict=True)]


def search_batch(items: Items, best: list[Best], docs: Rows, ids: np.ndarray, no_id: np.ndarray, weights: np.ndarray) -> int:
    """Enter a batch of documents into the items' best; the number of scores taken.

    ``best`` is in the order of the tree's items.
    """
    order = alike(docs, weights, LEAF_DOCS)
    docs, ids, no_id = docs.take(order), ids[order], no_id[order]
    tree = maxima(docs, LEAF_DOCS, items.width)
    place, scored = np.full(items.width, -1, np.int64), 0

    def least(level: int, node: int) -> int:
        span = LEAF_ITEMS * FANOUT**level
        return min(b.floor for b in best[node * span:(node + 1) * span])

    def leaf(node: int, found: np.ndarray, bounds: np.ndarray) -> None:
        """Score the documents of the leaves ``found``, those of the highest bounds first."""
        nonlocal scored
        mine, first = items.terms[0][node], node * LEAF_ITEMS
        rows = items.rows.take(np.arange(first, min(first + LEAF_ITEMS, len(items.rows))))
        place[mine] = np.arange(len(mine))
        wanted = np.zeros((len(mine), len(rows)), np.int64)
        wanted[place[rows.ids], rows.owners()] = rows.values
        found = found[np.argsort(-bounds, kind="stable")]
        bounds = -np.sort(-bounds)
        at, some = 0, 4
        while at < len(found) and bounds[at] >= least(0, node):
            leaves = found[at:at + some]
            at, some = at + some, min(some * 2, 64)
            members = (leaves[:, None] * LEAF_DOCS + np.arange(LEAF_DOCS)).reshape(-1)
            members = members[members < len(docs)]
            part = docs.take(members)
            known = place[part.ids] >= 0
            dense = np.zeros((len(members), len(mine)), np.int64)
            dense[part.owners()[known], place[part.ids[known]]] = part.values[known]
            scores = dense @ wanted
            scored += scores.size
            for k in range(len(rows)):
                b = best[first + k]
                good = np.flatnonzero(scores[:, k] >= b.floor)
                if len(good):
                    b.add(scores[good, k], ids[members[good]], no_id[members[good]])
        place[mine] = -1

    def visit(level: int, node: int, depth: int, found: np.ndarray) -> None:
        """``found``: the document nodes of a depth that are worth looking at for the items' node."""
        mine, values = items.terms[level][node], items.levels[level][node]
        while True:
            bounds = tree[depth][found][:, mine] @ values
            keep = bounds >= least(level, node)
            found, bounds = found[keep], bounds[keep]
            if not len(found) or level or not depth:
                break
            depth, found = depth - 1, _below(found, len(tree[depth - 1]))
        if not len(found):
            return
        if not level:
            leaf(node, found, bounds)
            return
        if depth:
            depth, found = depth - 1, _below(found, len(tree[depth - 1]))
        for child in range(node * FANOUT, min((node + 1) * FANOUT, len(items.levels[level - 1]))):
            visit(level - 1, child, depth, found)

    if len(docs) and best:
        visit(len(items.levels) - 1, 0, len(tree) - 1, np.zeros(1, np.int64))
    return scored


def _below(nodes: np.ndarray, there: int) -> np.ndarray:
    children = (nodes[:, None] * FANOUT + np.arange(FANOUT)).reshape(-1)
    return children[children < there]


# ---- a block of items ---------------------------------------------------------------

@dataclass
class Block:
    """Items (number, id, terms with counts) and the different terms they have."""

    items: list = field(default_factory=list)
    vocabulary: dict = field(default_factory=dict)

    def add(self, item_id, counts: Counter) -> None:
        for t in counts:
            self.vocabulary.setdefault(t, len(self.vocabulary))
        self.items.append((item_id, counts))


def blocks(items: Iterable, most_items: int, most_terms: int) -> Iterator[Block]:
    """Items with terms in blocks of bounded size; one with more terms is a block of its own."""
    block = Block()
    for r in items:
        counts = Counter(terms(r["text"]))
        if not counts:
            continue
        if block.items and (len(block.items) >= most_items or len(block.vocabulary) + len(counts) > most_terms):
            yield block
            block = Block()
        block.add(r["item_id"], counts)
    if block.items:
        yield block


def _impacts(n: np.ndarray, sizes: np.ndarray, tfs: np.ndarray, docs: int, length: int) -> np.ndarray:
    m = np.array([100 - 75 + 75 * x * docs // length for x in n.tolist()], np.int64)
    return 1_000_000_000 * tfs // (1000 * tfs + 8 * np.repeat(m, sizes))


def _found(table: DataFrame, shared, docs: int, length: int, k: int, floors: list[int]) -> DataFrame:
    """item (number in the block), doc_id, score: the best of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, weights = shared.value
        items = Items(rows, len(weights))
        best = [Best(k, floors[i]) for i in items.order.tolist()]
        most = max(LEAF_DOCS, BATCH_VALUES // len(weights) * LEAF_DOCS)
        for batch in batches:
            for at in range(0, len(batch), most):
                part = batch.slice(at, most)
                ids, found = part.column("doc_id"), part.column("terms")
                ends = found.offsets.to_numpy().astype(np.int64)
                tfs = part.column("tfs").flatten().to_numpy().astype(np.int64)
                values = _impacts(part.column("n").to_numpy(), np.diff(ends), tfs, docs, length)
                search_batch(items, best, Rows(ends - ends[0], found.flatten().to_numpy().astype(np.int64), values),
                             ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False), weights)
        out = [(int(i), None if no else d, s) for i, b in zip(items.order, best, strict=True) for s, d, no in zip(*(r.tolist() for r in b.rows), strict=True)]
        columns = list(zip(*out, strict=True)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item", "doc_id", "score"])

    return table.mapInArrow(run, "item long, doc_id long, score long")


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(docs: DataFrame, block: Block, k: int, seed_docs: int) -> DataFrame:
    spark = docs.sparkSession
    table = written(vectors(docs, block.vocabulary), "vectors")
    n, length = table.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    dfs = table.select(F.explode("terms").alias("t")).groupBy("t").count().collect()  # a row per term of the block
    df = dict((r["t"], r["count"]) for r in dfs)
    weights = np.array([weight(n, df.get(i, 0)) for i in range(len(block.vocabulary))], np.int64)
    rows = [sorted((block.vocabulary[t], c) for t, c in counts.items()) for _, counts in block.items]
    ids = np.array([i for r in rows for i, _ in r], np.int64)
    tree = Rows(np.cumsum([0, *map(len, rows)]), ids, weights[ids] * np.array([c for r in rows for _, c in r], np.int64))
    shared = spark.sparkContext.broadcast((tree, weights))
    worth = table.where(F.size("terms") > 0)
    floors = [1] * len(rows)  # a score is above 0
    if n > 4 * seed_docs:  # many more, or the floors are not worth their pass
        share = int(seed_docs / n * (1 << 32))
        sample = worth.where(F.pmod(F.xxhash64("doc_id", "n", "terms"), F.lit(1 << 32)) < share)
        # Any documents' k-th best score is one that all documents' reaches.
        for r in _first(_found(sample, shared, n, length, k, floors), k).where(F.col("rank") == k).collect():
            floors[r["item"]] = r["score"]
    names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block.items)], "item long, item_id long")
    best = _first(_found(worth, shared, n, length, k, floors), k)
    return written(best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"), "found")


def search(docs: DataFrame, items: DataFrame, k: int = BEST, block_items: int = BLOCK_ITEMS,
           block_terms: int = BLOCK_TERMS, seed_docs: int = SEED_DOCS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each item, scores above 0.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are not
    read. Null and empty texts have no terms: such an item gives no rows, such a document
    counts nowhere. Of equal scores the lower id comes first, a null id last. Every row
    is an item or a document of its own, also one that repeats another; equal item rows
    give equal results. Empty tables give no rows. Texts are read whole.
    """
    few = items.select("item_id", "text")
    rows = few.toLocalIterator() if few.limit(block_items + 1).count() > block_items else iter(few.collect())
    parts = [_search_block(docs, block, k, seed_docs) for block in blocks(rows, block_items, block_terms)]
    return reduce(DataFrame.unionByName, parts) if parts else docs.sparkSession.createDataFrame([], RESULT)


def op11_ranked_search(spark, sf_dir: str) -> DataFrame:
    """The ten best of all documents for each benchmark item."""
    return search(load(spark, sf_dir, "documents", "doc_id", "text"), load(spark, sf_dir, "benchmark", "item_id", "text"))


ORACLE_OP11 = r"""
WITH found AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents
), sized AS (
  SELECT doc_id, t, len(t) AS n FROM found WHERE len(t) > 0
), total AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS length FROM sized
), tfs AS (
  SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(t) AS term FROM sized) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tfs, total GROUP BY term, docs
), asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), scored AS (
  SELECT item_id, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // length))))::BIGINT AS score
  FROM asked JOIN tfs USING (term) JOIN weights USING (term), total GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""
