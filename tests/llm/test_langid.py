"""Language identification: backoff, folds, and held-out accuracy."""

import math
import zlib
from collections import Counter

import pytest

from conftest import SF

from tidemark.llm import langid


def test_known_words_go_first_then_longest_runs():
    model = langid.Model([("der hund und der mann", "de"), ("the dog and the man", "en")] * 3)
    assert set(model.languages) == {"de", "en"} and "der" in model.words
    assert model.predict("der hund")[0] == "de" and model.predict("the dog")[0] == "en"
    # Unseen words by their runs: 'under' has 'und' of German, 'doggo' has 'dog'.
    assert model.predict("hundd")[0] == "de" and model.predict("doggo")[0] == "en"
    assert model.score_unseen("hundd") != model.words["hund"]
    # Known words are not read by runs.
    model.runs = [{} for _ in model.runs]
    assert model.predict("der")[0] == "de" and model.score("zzz") == [0.0, 0.0]


def test_backoff_uses_the_longest_known_run():
    model = langid.Model([("abcde", "x"), ("vwxyz", "y")] * 2)
    model.words = {}
    long = model.runs[4]["abcde"]
    assert model.score_unseen("abcde") != [0.0, 0.0]
    model.runs[4] = {" abcd": long}
    first = model.score_unseen("abcd")
    model.runs[4] = {}
    assert model.score_unseen("abcd") != first


def test_held_out_accuracy(spark):
    out = {r["doc_id"]: r for r in langid.op10_language_id(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text").collect()
    assert len(out) == len(docs)
    held = [d for d in docs if zlib.crc32(str(d["doc_id"]).encode()) % 3 == 1]
    assert {d["doc_id"] for d in held} == {i for i, r in out.items() if r["held_out"]}
    right = sum(out[d["doc_id"]]["lang_pred"] == d["lang"] for d in held)
    assert right / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in out.values())


def test_held_out_and_unlabelled_rows_never_teach(rows):
    docs = [(i, f"aa{i} bb", "x") for i in range(60)] + [(100, "zz", None), (None, "qq", "y"), (101, None, "w"), (200, "tt", "x"), (200, "tt", "y")]
    taught = langid.training_rows(rows("doc_id long, text string, lang string", *docs)).collect()
    assert {r["lang"] for r in taught} <= {"x", "w"}
    got = {r["text"] for r in taught if r["lang"] == "x"}
    assert got == {f"aa{i} bb" for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1}


def test_nulls_letters_repeats_columns(rows):
    docs = rows("doc_id long, text string, lang string, score string, lang_pred string", *[(i, "ja das ist gut", "de", "", "") for i in range(9)])
    model = langid.fit(docs)
    new = rows("doc_id long, text string, n int", (1, None, 1), (2, "", 1), (3, "12 .. ²", 1), (4, "das ist", 1), (4, "das ist", 1), (5, "das " * 50_000, 1))
    out = langid.with_language(new, model)
    assert out.columns == ["doc_id", "text", "n", "lang_pred", "score"]
    assert sorted((r["doc_id"], r["lang_pred"]) for r in out.collect()) == [(1, "und"), (2, "und"), (3, "und"), (4, "de"), (4, "de"), (5, "de")]
    none = langid.fit(docs.where("false"))
    assert {r["lang_pred"] for r in langid.with_language(new, none).collect()} == {"und"}
    assert langid.with_language(new.where("false"), model).count() == 0


def test_more_than_fifty_languages_are_learned(rows):
    letters = "abcdefghijklmnopqrstuvwxyz"
    names = [a + b for a in letters for b in letters][:130]
    docs = rows(
        "doc_id long, text string, lang string",
        *[(k * 10 + i, f"{name}qu{name} the {name * 3} one", name) for k, name in enumerate(names) for i in range(10)])
    model = langid.fit(docs)
    new = rows("doc_id long, text string", *[(k, f"{name}qu{name} {name * 3}") for k, name in enumerate(names)])
    out = {r["doc_id"]: r["lang_pred"] for r in langid.with_language(new, model).collect()}
    assert out == dict(enumerate(names))


def test_scores_are_smoothed_log_frequencies():
    import math

    model = langid.Model([("aa aa bb", "x"), ("aa cc", "y"), ("cc dd", "z")])
    # Known from two texts on: aa and cc.
    totals = {"x": 3 + 2 + 1, "y": 2 + 2 + 1, "z": 2 + 2 + 1}
    assert [round(v, 12) for v in model.score("aa")] == [
        round(math.log((n + 1) / totals[lang]), 12) for lang, n in (("x", 2), ("y", 1), ("z", 0))]


def test_samples_of_any_number_of_groups(spark):
    from pyspark.sql import functions as F

    from tidemark.llm import common

    rows = spark.range(9000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 3000, F.col("id") % 300).otherwise(-1).alias("g"))
    want = common.sample_ids(rows, "g", 20, 301)
    got = common.sample_ids(rows, "g", 20)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 300 * 10 + 20


def test_words_are_taken_from_all_over_a_text(rows):
    text = "boilerplate " * 3000 + "später " * 3000
    got = langid.words_from_all_over(text).split()
    assert len(got) == langid.TRAIN_WORDS and 150 < got.count("später") < 250 and got == sorted(got)
    assert langid.words_from_all_over("One, two.") == "One, two." and langid.words_from_all_over(None) is None
    assert langid.words_from_all_over("x" * 9000 + " end") == "end"
    docs = rows("doc_id long, text string, lang string", *[(i, text, "de") for i in range(9)])
    assert all("später" in r["text"] for r in langid.training_rows(docs).collect())


def one_by_one(model, text):
    """The formula, word by word."""
    counts = Counter(langid.words_of(text))
    if not counts:
        return langid.NONE, 0.0
    sums = [0.0] * len(model.languages)
    for word, n in counts.items():
        sums = [a + n * b for a, b in zip(sums, model.score(word), strict=True)]
    best = max(range(len(sums)), key=lambda k: (sums[k], -k))
    scale = min(counts.total(), 10) / counts.total()
    return model.languages[best], 1 / sum(math.exp((s - sums[best]) * scale) for s in sums)


def test_all_documents_match_the_formula(spark):
    """Every document of the table, against the plain formula."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model = langid.pickle.loads(langid.fit(docs))
    texts = [r["text"] for r in docs.collect()] + [None, "", "12 ²", "zzz"]
    for text in texts:
        lang, score = one_by_one(model, text)
        got = model.predict(text)
        assert got[0] == lang and got[1] == pytest.approx(score, abs=1e-9)
