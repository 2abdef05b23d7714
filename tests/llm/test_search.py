"""Ranked search: against SQL, and against scores of every document for every item."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
from conftest import SF, values
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, k=10):
    """Every document scored for every item, as the contract has it."""
    counted = [(d, Counter(t), len(t)) for d, t in ((d, plain_terms(x)) for d, x in docs) if t]
    n_docs, length = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        asked, scored = plain_terms(text), []
        for d, c, n in counted:
            m = 100 - 75 + 75 * n * n_docs // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in asked)
            if s > 0:
                scored.append((-s, d is None, d))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return out


def key(t):
    return [(v is not None, str(v)) for v in t]


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_terms(text):
    assert [t.decode() for t in search.terms(text)] == plain_terms(text)


def test_terms_of_all_ascii_and_others():
    text = "".join(map(chr, range(1, 400))) + " ÄÖ é🎉ß A_b-9 "
    assert [t.decode() for t in search.terms(text)] == plain_terms(text) and search.terms(None) == search.terms("") == []


def made(seed, n, items):
    rnd = random.Random(seed)
    words = [f"w{int(rnd.paretovariate(0.6)) % 400}" for _ in range(3000)]
    docs = [(i, " ".join(rnd.choices(words, k=int(rnd.lognormvariate(3, 1)) + 1))) for i in range(n)]
    asked = [(j, " ".join(rnd.choices(docs[rnd.randrange(n)][1].split(), k=rnd.randint(1, 40)))) for j in range(items)]
    return docs, asked


def test_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    cursor = con.execute(search.ORACLE_OP11)
    names = [d[0] for d in cursor.description]
    columns = ["item_id", "rank", "doc_id", "score"]
    want = sorted((tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall()), key=key)
    out = search.op11_ranked_search(spark, SF)
    assert out.columns == columns and values(out) == want and len(want) == 400


def test_every_score(rows):
    docs, items = made(1, 900, 40)
    docs += docs[:60] + [(None, docs[5][1]), (None, docs[5][1]), (5000, None), (5001, ""), (5002, "... !!")]
    docs += [(6000 + k, docs[7][1]) for k in range(30)] + [(7000, "w1 " * 40_000)]
    items += [(100, docs[7][1]), (100, docs[7][1]), (101, None), (102, ""), (103, "unheard of"), (None, "w1 w2 w2"), (104, "W1, w1.W2?")]
    want = sorted(plain(docs, items), key=key)
    d, i = rows("doc_id long, text string", *docs), rows("item_id long, text string", *items)
    assert values(search.search(d, i)) == want
    # Several blocks, one item larger than a block, floors from a sample.
    assert values(search.search(d.repartition(4), i, block_items=9, block_terms=30, seed_docs=50)) == want


def test_extra_columns_and_nothing(spark, rows):
    docs = rows("doc_id long, text string, n int, terms string, score int, item_id int", (1, "a b", 1, "", 1, 1), (2, "b", 1, "", 1, 1))
    items = rows("item_id long, text string, doc_id int, rank int", (7, "B c", 1, 1))
    assert values(search.search(docs, items)) == sorted(plain([(1, "a b"), (2, "b")], [(7, "B c")]), key=key)
    for d, i in ((docs.where("false"), items), (docs, items.where("false")), (docs.where("false"), items.where("false"))):
        assert search.search(d, i).collect() == []


def test_most_scores_are_never_taken():
    """Items with a few rare terms: whole leaves of documents fall away, and nothing is lost."""
    rng = np.random.default_rng(2)
    width, n, k = 600, 4096, 10
    topics = rng.permutation(width).reshape(20, -1)
    some = lambda k: np.sort(rng.choice(topics[rng.integers(20)], k, replace=False))
    sparse = [some(rng.integers(5, 20)) for _ in range(n)]
    docs = search.Rows(np.cumsum([0, *map(len, sparse)]), np.concatenate(sparse), rng.integers(10, 1000, sum(map(len, sparse))))
    asked = [some(4) for _ in range(30)]
    weights = rng.integers(1, 9, width) ** 3
    items = search.Items(search.Rows(np.cumsum([0, *map(len, asked)]), np.concatenate(asked), weights[np.concatenate(asked)]), width)
    best = [search.Best(k, 1) for _ in range(30)]
    scored = 0
    for at in range(0, n, 1024):
        part = docs.take(np.arange(at, at + 1024))
        scored += search.search_batch(items, best, part, np.arange(at, at + 1024), np.zeros(1024, bool), weights)
    dense = np.zeros((n, width), np.int64)
    dense[docs.owners(), docs.ids] = docs.values
    for i, b in zip(items.order, best, strict=True):
        exact = dense[:, asked[i]] @ weights[asked[i]]
        order = np.lexsort((np.arange(n), -exact))[:k]
        assert b.rows[0].tolist() == exact[order].tolist() and b.rows[1].tolist() == order.tolist()
    assert scored < 0.1 * n * 30
