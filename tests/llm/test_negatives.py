"""Hard negatives: against brute force over all pairs, and SQL."""

import math
import random

import duckdb
import numpy as np
import pytest
from conftest import SF

from tidemark.llm import negatives

SCHEMA = "vec_id long, label int, embedding array<float>"


def plain(rows, every=50):
    """All pairs of the rows that take part, one by one."""
    part = []
    for vec_id, label, e in rows:
        if label is not None and e is not None and all(x is not None and math.isfinite(x) for x in e):
            part.append((vec_id, label, [math.floor(256 * x) for x in e]))
    order = lambda p: (-p[1], p[0] is None, p[0] or 0)
    out = []
    for anchor, label, v in part:
        if anchor is None or anchor % every:
            continue
        scored = [(i, sum(a * b for a, b in zip(v, w, strict=False)), m) for i, m, w in part]
        for p, ps, _ in sorted([s for s in scored if s[2] == label and s[0] != anchor], key=order)[:5]:
            fit = [s for s in scored if s[2] != label and 50 * ps <= 100 * s[1] <= 95 * ps]
            out += [(anchor, p, k, i, ps, ns) for k, (i, ns, _) in enumerate(sorted(fit, key=order)[:3], 1)]
    return sorted(out, key=str)


def got(df):
    assert df.columns == negatives.RESULT
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def odd():
    rnd = random.Random(3)
    f = lambda: float(np.float32(rnd.gauss(0.1, 0.3)))
    rows = [(i, rnd.choice([1, 1, 1, 2, 3]), [f() for _ in range(24)]) for i in range(300)]
    rows += [(i, 1, rows[7][2]) for i in (1000, 1001, 1002)]  # ties, one of them an anchor
    rows += [rows[50], rows[50], rows[9], (None, 1, rows[50][2]), (None, 2, rows[50][2]), (None, None, [])]
    rows += [(2000, None, [0.5] * 24), (2001, 1, None), (2002, 1, [0.5, None]), (2003, 2, [float("nan")] * 24)]
    rows += [(2004, 2, [float("-inf")] * 24), (2050, 1, []), (2051, 2, [1.0, -1.0, 2.0]), (2100, 9, [0.0] * 24)]
    return rows


def test_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    cursor = con.execute(negatives.ORACLE_OP13)
    names = [d[0] for d in cursor.description]
    want = sorted((tuple(r[names.index(c)] for c in negatives.RESULT) for r in cursor.fetchall()), key=str)
    out = got(negatives.op13_hard_negatives(spark, SF))
    assert out == want and len(out) > 100


def test_odd_rows(rows, odd):
    want = plain(odd)
    assert len(want) > 60
    assert got(negatives.hard_negatives(rows(SCHEMA, *odd))) == want


def test_small_blocks_and_floors_from_a_sample(rows, odd, monkeypatch):
    monkeypatch.setattr(negatives, "TILE_VALUES", 24 * 16)
    assert got(negatives.hard_negatives(rows(SCHEMA, *odd).repartition(5), block=3, seed_rows=40)) == plain(odd)


def test_extra_columns_and_nothing(spark, rows):
    docs = rows(SCHEMA + ", anchor string, score string, v int, rank int", (50, 1, [0.5], "a", "b", 1, 2), (1, 1, [0.5], "", "", 0, 0), (2, 2, [0.4], "", "", 0, 0))
    assert got(negatives.hard_negatives(docs)) == [(50, 1, 1, 2, 128 * 128, 128 * 102)]
    assert got(negatives.hard_negatives(docs.where("vec_id <> 50"))) == []
    assert got(negatives.hard_negatives(docs.where("false"))) == []


def test_large_components_are_exact(rows):
    vectors = [(50, 1, [2.0**20, 3.0]), (1, 1, [2.0**20, 1.0]), (2, 2, [2.0**19 + 0.25, 1.0]), (3, 2, [2.0**19, -0.5])]
    assert negatives.number(2, 1 << 28) is object
    assert got(negatives.hard_negatives(rows(SCHEMA, *vectors))) == plain(vectors) != []


def test_scan_reads_part_of_the_columns():
    rng = np.random.default_rng(5)
    vectors = rng.integers(-60, 60, (4000, 64))
    anchor = (vectors[17] * rng.permutation(np.r_[np.full(16, 4), np.zeros(48, int)])).astype(np.float32)
    exact = vectors @ anchor.astype(int)
    t = negatives.tile(np.ascontiguousarray(vectors.T.astype(np.float32)), np.arange(4000), np.zeros(4000, bool), np.zeros(4000, int))
    least, most = int(np.sort(exact)[-30]), int(np.sort(exact)[-10])
    at, score, read = negatives.scan(anchor, t, least, most, step=4)
    assert sorted(at) == np.flatnonzero((exact >= least) & (exact <= most)).tolist() and (score == exact[at]).all()
    assert read < 4000 * 64 / 5  # zero components are never read, others for the rows still alive
