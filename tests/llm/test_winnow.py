"""Winnowing: against a plain version, and its match guarantee."""

import hashlib
import random
import re
import struct

import pytest
from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tidemark.llm import winnow


def h_text(s, seed=42):
    return xxh64_intdigest(s.encode(), seed)


def h_longs(*xs):
    seed = 42
    for x in xs:
        seed = xxh64_intdigest(struct.pack("<Q", x), seed)
    return seed


def plain(text):
    """Chosen (39-bit hash, place), least of each window, of equal ones the rightmost."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if not words:
        return []
    if len(words) < 4:
        seed = 42
        for w in words:
            seed = h_text(w, seed)
        grams = [seed]
    else:
        x = [h_text(w) for w in words]
        two = [h_longs(a, b) for a, b in zip(x, x[1:], strict=False)]
        grams = [h_longs(a, b) for a, b in zip(two, two[2:], strict=False)]
    grams = [g >> 25 for g in grams]
    out = []
    for i in range(max(len(grams) - 3, 1)):
        window = grams[i:i + 4]
        k = max(j for j, g in enumerate(window) if g == min(window))
        if (window[k], i + k) not in out:
            out.append((window[k], i + k))
    return out


def jaccard(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def marks_of(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [[tuple(m) for m in r["marks"]] for r in winnow.fingerprints(df).orderBy("i").collect()]


@given(st.lists(st.lists(st.sampled_from(["a", "b", "é", "cc"]), max_size=25).map(" ".join), min_size=1, max_size=8))
@settings(max_examples=25, deadline=None)
def test_marks_match_plain(spark, texts):
    assert marks_of(spark, [*texts, None, " \n"]) == [plain(t) for t in [*texts, None, " \n"]]


def test_shared_runs_of_seven_words_share_a_mark(spark):
    rnd = random.Random(3)
    word = lambda: f"w{rnd.randrange(10**6)}"
    run = [word() for _ in range(7)]
    texts = [" ".join([word() for _ in range(rnd.randrange(30))] + run + [word() for _ in range(rnd.randrange(30))]) for _ in range(40)]
    found = marks_of(spark, texts)
    for k, a in enumerate(found):
        for b in found[:k]:
            assert {h for h, _ in a} & {h for h, _ in b}


def follow(docs):
    ids = [d for d, _ in docs]
    return {d: docs[(i + 1) % len(ids)][1] or "" for i, d in enumerate(ids)}


def test_documents_match_plain(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    nexts = follow(docs)
    out = {r["doc_id"]: r for r in winnow.op9_winnowing(spark, SF).collect()}
    assert len(out) == len(docs)
    seen = {}
    for doc_id, text in docs:
        r, half = out[doc_id], len(text) // 2
        new = text[:len(text) - half] + nexts[doc_id][:half]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        assert r["near_edited"] == pytest.approx(jaccard(plain(text), plain(new)))
        assert r["near_next"] == pytest.approx(jaccard(plain(text), plain(nexts[doc_id])))
        for t, f in ((text, r["fingerprint"]), (new, r["edited_fingerprint"])):
            assert seen.setdefault(tuple(plain(t)), f) == f


def test_nulls_repeats_one_empty(spark, rows):
    schema = "doc_id long, text string, key string, n int, edited int"
    docs = rows(schema, (1, "abcdef", "", 0, 0), (None, "last one here", "", 0, 0), (2, None, "", 0, 0), (2, "ZZ", "", 0, 0), (2, "ZZ", "", 0, 0))
    got = sorted((r["doc_id"] or 9, r["n_chars"], r["edited_sha256"][:8]) for r in winnow.compare_edits(docs).collect())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()[:8]
    # By id, then by the hash of the text, then none.
    signed = lambda t: struct.unpack("<q", struct.pack("<Q", h_text(t)))[0]
    order = [(1, "abcdef"), *sorted([(2, ""), (2, "ZZ"), (2, "ZZ")], key=lambda r: signed(r[1])), (9, "last one here")]
    want = []
    for k, (d, t) in enumerate(order):
        half = len(t) // 2
        want.append((d, len(t), sha(t[:len(t) - half] + order[(k + 1) % 5][1][:half])))
    assert got == sorted(want)
    only = winnow.compare_edits(docs.where("doc_id = 1")).collect()
    assert len(only) == 1 and only[0]["near_next"] == 1.0
    assert winnow.compare_edits(docs.where("false")).count() == 0


def test_order_over_many_ranges(spark):
    docs = spark.range(0, 5000, 1, 16).select((F.col("id") * 7919 % 5003).alias("doc_id")).withColumn("text", F.col("doc_id").cast("string"))
    order = {r["doc_id"]: int(r["following"]) for r in winnow.with_following(docs).collect()}
    ranked = sorted(order)
    assert [order[d] for d in ranked] == [*ranked[1:], ranked[0]]


def test_plan_is_native(spark):
    plan = winnow.op9_winnowing(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
