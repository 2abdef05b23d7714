"""SimHash: fingerprints, links and components against brute force."""

import random
import re

import numpy as np
import pytest
from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tidemark.llm import simhash


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    k = min(3, len(words))
    hashes = [xxh64_intdigest(" ".join(words[i:i + k]).encode(), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reach(prints, ids, radius=3):
    """component_id per document by comparing all pairs."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if bin(a ^ prints[j]).count("1") <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(least.get(find(i), d), d)
    return [least[find(i)] for i in range(len(ids))]


@given(st.text(max_size=60) | st.lists(st.sampled_from(["a", "B", "ß", "İ", "\x1c", "\x85", "x y", "\v", "\n"]), max_size=20).map(" ".join))
@settings(max_examples=300, deadline=None)
def test_fingerprint_matches_plain(text):
    assert simhash.fingerprint(text) == plain(text)


def test_documents_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    prints, ids = [plain(d["text"]) for d in docs], [d["doc_id"] for d in docs]
    want = {d: (f"{p:016x}", c) for d, p, c in zip(ids, prints, reach(prints, ids), strict=True)}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.op8_simhash(spark, SF).collect()}
    assert got == want and len({c for _, c in want.values()}) < len(want)


@pytest.mark.parametrize("block", [512, 7])
def test_links_connect_what_is_near(spark, block):
    """Chains, clusters and far prints; also with tiles cut into small blocks."""
    rnd = random.Random(3)
    prints = set()
    for _ in range(40):
        p = rnd.getrandbits(64)
        prints.add(p)
        for _ in range(rnd.randint(0, 12)):
            for b in rnd.sample(range(64), rnd.randint(1, 4)):
                p ^= 1 << b
            prints.add(p)
    prints |= {0, 1, 3, (1 << 64) - 1, 1 << 63} | {rnd.getrandbits(4) for _ in range(16)}
    prints = sorted(prints)
    df = spark.createDataFrame([(simhash._signed(p),) for p in prints], "bits long")
    found = simhash.components(simhash.links(df, 3, block)).collect()
    root = {r["node"]: r["root"] for r in found}
    ours = [root.get(simhash._signed(p), simhash._signed(p)) for p in prints]
    want = reach(prints, [simhash._signed(p) for p in prints])
    assert ours == want


def test_dense_groups_give_a_forest():
    rng = np.random.default_rng(1)
    prints = np.unique(rng.integers(0, 1 << 6, 3000, dtype=np.uint64))
    a, _ = simhash.compare(prints, prints, 64, True)
    assert len(a) <= len(prints)


def test_long_chain_is_one_component(spark):
    links = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    out = simhash.components(links).collect()
    assert len(out) == 301 and {r["root"] for r in out} == {0}


def test_nulls_repeats_empty(spark, rows):
    docs = rows(
        "doc_id long, text string, bits string, root int, component_id string, row int, text_hash int, n int",
        (7, None, "", 1, "", 1, 1, 1), (5, "", None, None, None, None, None, None), (None, " \n", "", 1, "", 1, 1, 1),
        (9, "One two three four", "", 1, "", 1, 1, 1), (9, "One two three four", "", 1, "", 1, 1, 1),
        (4, "one TWO three\tfour", "", 1, "", 1, 1, 1), (4, "something else here now", "", 1, "", 1, 1, 1),
    )
    out = simhash.near_duplicates(docs)
    assert sorted((r["doc_id"] or -1, r["component_id"]) for r in out.collect()) == [(-1, 5), (4, 4), (4, 4), (5, 5), (7, 5), (9, 4), (9, 4)]
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(4, "one TWO three\tfour"), (4, "something else here now"), (5, "")]
    assert simhash.keep_one(docs.where("false")).count() == 0 and simhash.near_duplicates(docs.where("false")).count() == 0
    only = simhash.near_duplicates(docs.where("doc_id IS NULL")).collect()
    assert [r["component_id"] for r in only] == [None]
    many = docs.where("doc_id = 9").crossJoin(spark.range(50).select("id")).drop("id")
    assert simhash.keep_one(many).count() == 1
