"""Toxicity: the network's gradients, its parts, and held-out accuracy."""

import random
import zlib

import numpy as np
import pytest
from conftest import SF

from tidemark.llm import gru, toxicity


def texts(n, seed=0):
    """Invented prose; every third text has one of a family of bad words somewhere."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abdeghiklmnorstu") for _ in range(rnd.randint(2, 7)))
    out, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rnd.randint(3, 120))]
        if i % 3 == 0:
            words[rnd.randrange(len(words))] = "vequ" + word()
        out.append(" ".join(words))
        labels.append(int(i % 3 == 0))
    return out, labels


def test_words_and_runs():
    w = gru.Words(["The cat, the CAT!", "", "l'été  9 the"])
    assert w.counts.tolist() == [4, 0, 3]
    assert w.ids[0] == w.ids[2] == w.ids[6] and w.ids[1] == w.ids[3] and len(w.hashes) == 4
    alone = gru.Words(["the"])
    assert alone.hashes[0] == w.hashes[w.ids[0]]
    assert sorted(alone.runs) == sorted(w.runs[w.owners == w.ids[0]])
    # Three runs of 3 with the edges, and one of 5: the word with both edges.
    assert len(alone.runs) == 4


def test_windows_overlap_and_cover_all():
    counts = np.array([0, 1, 32, 33, 200, 5000])
    first, length, owner = gru.Network.layout(counts)
    start = np.cumsum(counts) - counts
    for t, n in enumerate(counts):
        met = np.zeros(n, int)
        for f, k in zip(first[owner == t], length[owner == t], strict=True):
            met[f - start[t]:f - start[t] + k] += 1
        assert (met >= 1).all() and (owner == t).sum() >= 1
        if n > 100:
            assert (met > 1).any()


def test_gradients_match_differences():
    data, labels = texts(6, 3)
    net = gru.Network(*gru.known_hashes(data, 1, 10_000), seed=1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    y = np.array(labels, np.float32)
    # One window each, so that the highest window is the only one.
    data = [" ".join(t.split()[:30]) for t in data]
    grads, _ = net.step(data, y)
    rng = np.random.default_rng(0)
    for name, value in net.p.items():
        flat = np.flatnonzero(np.abs(grads[name].ravel()) > 1e-4)
        for at in rng.choice(flat, min(4, len(flat)), replace=False):
            where = np.unravel_index(at, value.shape)
            old, h = value[where], 1e-3
            value[where] = old + h
            up = net.step(data, y)[1]
            value[where] = old - h
            down = net.step(data, y)[1]
            value[where] = old
            assert (up - down) / (2 * h) == pytest.approx(grads[name][where], rel=0.05, abs=2e-4), name


def test_learns_a_family_of_words():
    data, labels = texts(900, 5)
    net = gru.train(data, labels, 6)
    held, y = texts(300, 6)
    predicted = net.score(held) >= 0.3
    assert (predicted == np.array(y, bool)).mean() > 0.95
    # A single bad word in a very long text is found, wherever its window lies.
    clean = " ".join(t for t, k in zip(*texts(300, 7), strict=True) if not k)
    words = clean.split()
    assert net.score([" ".join([*words[:5000], "vequando", *words[5000:]])])[0] > net.score([clean])[0]


def test_scores_do_not_depend_on_the_batch():
    data, labels = texts(120, 8)
    net = gru.train(data, labels, 1)
    alone = np.concatenate([net.score([t]) for t in data])
    assert np.allclose(net.score(data), alone, atol=1e-5)
    assert 0 <= net.score([""])[0] <= 1


def test_held_out_rows_never_teach(spark, rows):
    docs = rows("doc_id long, text string", *[(i, f"text {i}") for i in range(200)])
    labels = rows("doc_id long, toxic int", *[(i, i % 2) for i in range(200)], (1, 0), (None, 1), (3, None))
    got = {r["text"] for r in toxicity.training_rows(docs, labels)}
    want = {f"text {i}" for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2} - {"text 1"}
    assert got == want


def test_documents_and_threshold(spark):
    out = toxicity.op6_toxicity(spark, SF)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    got = out.collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)


def test_held_out_accuracy(spark):
    """On the given table with enough labels to learn from (some 4,000)."""
    folder = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [r for r in toxicity.op6_toxicity(spark, folder).collect() if r["held_out"] and r["doc_id"] in labels]
    clean, toxic = ([r["predicted"] for r in held if labels[r["doc_id"]] == y] for y in (0, 1))
    assert len(toxic) > 100 and sum(toxic) >= 0.85 * len(toxic)
    assert len(clean) - sum(clean) >= 0.97 * len(clean)


def test_nulls_empty_columns_and_no_labels(rows):
    data, labels = texts(120, 2)
    docs = rows(
        "doc_id long, text string, score string, row int", *[(i, t, "x", 1) for i, t in enumerate(data)],
        (500, None, None, None), (501, "", "", 0), (None, data[0], "", 0), (0, data[0], "", 0),
    )
    taught = rows("doc_id long, toxic int, text string", *[(i, y, "q") for i, y in enumerate(labels)])
    kept = toxicity.keep_clean(docs, taught)
    assert kept.columns == docs.columns
    model = toxicity.fit(docs, taught)
    scores = {}
    for r in toxicity.with_score(docs.drop("score"), model).collect():
        scores.setdefault(r["text"] or "", set()).add(r["score"])
    assert all(len(s) == 1 for s in scores.values())
    untaught = toxicity.fit(docs, taught.where("false"))
    assert toxicity.with_score(docs.drop("score"), untaught).count() == docs.count()
    assert toxicity.keep_clean(docs.where("false"), taught).count() == 0
