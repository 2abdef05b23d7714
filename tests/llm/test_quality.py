"""Quality rules: measures, exact bounds, and cutoffs per stratum."""

import math
import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import quality

DOCS = "doc_id long, text string, lang string"


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    counts, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if counts[g] > 1:
            covered |= set(range(i, i + 5))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


@given(st.text(alphabet="ab#|é \n\t\x0b\x1c ", max_size=120) | st.none())
@settings(max_examples=400, deadline=None)
def test_measures_match_plain(text):
    assert quality.measures(text) == plain(text)


@given(st.integers(0, 60), st.integers(1, 60), st.floats(0.001, 0.9))
@settings(max_examples=300, deadline=None)
def test_binomial_is_exact(k, n, p):
    want = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(min(k, n) + 1))
    assert quality.at_most(k, n, p) == pytest.approx(want, abs=1e-12)


def test_bound_holds_on_repeated_holdouts():
    """Of samples whose true share is just above the limit, few are certified."""
    rnd = random.Random(2)
    wrong = sum(quality.certified(sum(rnd.random() < 0.06 for _ in range(300)), 300, 0.05, 0.1) for _ in range(400))
    assert wrong <= 0.1 * 400


def corpus(n, lang, at=0):
    """Good prose, and bad text with symbols; 3 % of the good have some symbols too."""
    docs, labels = [], []
    for i in range(n):
        words = " ".join(f"w{lang}{i}x{k}" for k in range(30))
        bad = i % 4 == 0
        text = words.replace(" ", " | ") if bad else words + (" &" if i % 97 == 1 else "")
        docs.append((at + i, text, lang))
        labels.append((at + i, 0 if bad else 1))
    return docs, labels


def judged(rows, docs, labels):
    out = quality.quality_rules(rows(DOCS, *docs), rows("doc_id long, quality int", *labels)).collect()
    return {r["doc_id"]: r for r in out}


def test_cutoffs_reject_bad_and_keep_good(rows):
    a, la = corpus(1600, "a")
    b, lb = corpus(40, "b", 10_000)  # too few to certify anything
    out = judged(rows, a + b + [(50_000, a[0][1], "a"), (50_001, a[1][1], "a")], la + lb)
    good, bad = [i for i, y in la if y], [i for i, y in la if not y]
    assert not any(out[i]["kept"] for i in bad) and all(out[i]["kept"] for i in good)
    assert all(out[i]["kept"] for i, _ in lb)
    assert not out[50_000]["kept"] and out[50_001]["kept"]


def test_stricter_limit_certifies_less(rows):
    docs, labels = corpus(1600, "a")
    measured = quality.with_measures(rows(DOCS, *docs))
    strict = quality.cutoffs(measured, rows("doc_id long, quality int", *labels), "lang", limit=0.001).first()
    assert all(strict[r[0]] is None for r in quality.RULES)


def test_nulls_empty_conflicts_and_no_labels(rows):
    text = " ".join(map(str, range(20)))
    docs = [(1, None, None), (2, "", "a"), (3, text, None), (3, text, None), (None, text, "a"), (4, "x " * 50, "a")]
    out = quality.quality_rules(rows(DOCS, *docs), rows("doc_id long, quality int", (3, 1), (3, 0), (None, 1), (4, None))).collect()
    assert sorted((r["doc_id"] or 0, r["kept"], r["base_failed"]) for r in out) == [
        (0, True, False), (1, False, True), (2, False, True), (3, True, False), (3, True, False), (4, False, True),
    ]
    assert quality.quality_rules(rows(DOCS), rows("doc_id long, quality int")).collect() == []


def test_clashing_columns_are_not_read(rows):
    docs = rows(DOCS + ", n_words string, kept string, symbols int", (1, "a b", "x", "q", "q", 1))
    out = quality.quality_rules(docs, rows("doc_id long, quality int, text string", (1, 1, "t")))
    assert out.columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert out.first()["n_words"] == 2


def test_the_path_is_nested():
    for name, _, _, way, values in quality.RULES:
        assert list(values) == sorted(values, reverse=way > 0), name
    assert len(quality.PATH) == sum(len(r[4]) for r in quality.RULES) == len(set(quality.PATH))
    assert quality.in_force(None) == [None] * 5 and quality.in_force(len(quality.PATH) - 1) == [r[4][-1] for r in quality.RULES]


def test_steps_are_tested_in_order_until_one_fails():
    never = len(quality.PATH)
    good, bad = [0] * (never + 1), [0] * (never + 1)
    good[never], bad[3], bad[9] = 200, 5, 5
    assert quality.best_step(good, bad, 0.05, 0.05) == 9
    good[6] = 30  # fails there, so the later one is never reached
    assert quality.best_step(good, bad, 0.05, 0.05) == 3
    assert quality.best_step([0] * never + [58], bad, 0.05, 0.05) is None and quality.best_step([0] * never + [59], bad, 0.05, 0.05) == 9
    assert quality.best_step([0] * (never + 1), bad, 0.05, 0.05) is None


def test_no_stratum_loses_more_than_the_limit():
    """Whole choices on repeated holdouts: the true loss of the chosen step is over the limit in few of them."""
    rnd, over = random.Random(5), 0
    steps = list(range(len(quality.PATH) + 1))
    share = [0.004] * len(quality.PATH) + [1 - 0.004 * len(quality.PATH)]  # true loss after step s: 0.004 * (s + 1)
    for _ in range(300):
        drawn = Counter(rnd.choices(steps, share, k=250))
        bad = [1] * len(steps)
        pick = quality.best_step([drawn[s] for s in steps], bad, 0.05, 0.05)
        over += pick is not None and 0.004 * (pick + 1) > 0.05
    assert over <= 0.05 * 300 + 8


def test_some_cutoff_is_certified_on_the_tables(spark):
    """The method rejects documents that the base lets pass, and next to no good ones."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    chosen = quality.cutoffs(quality.with_measures(docs), labels, "lang").collect()
    assert any(r[rule[0]] is not None for r in chosen for rule in quality.RULES)
    out = quality.op3_quality_rules(spark, sf).join(labels, "doc_id", "left")
    rejected = out.where("NOT kept AND NOT base_failed")
    assert rejected.count() >= 10 and rejected.where("quality = 1").count() <= 0.05 * out.where("quality = 1").count()
