"""Substring dedup: against a plain pass over all documents."""

import random

from conftest import SF

from tidemark.llm import spans


def every_run(docs):
    """doc_id -> removed sentences, from all runs of any length; ids must differ."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs):
        parts = [text[a:b].lower().split() for a, b in spans.sentences(text)]
        gone = set()
        for i in range(len(parts)):
            for j in range(i + 1, len(parts) + 1):
                words = sum(map(len, parts[i:j]))
                if (j - i == 1 and words >= 30) or (j - i >= 2 and words >= 20):
                    key = hash(tuple(w for p in parts[i:j] for w in p))
                    if key in seen:
                        gone |= set(range(i, j))
                    seen.add(key)
        out[doc_id] = gone
    return out


def sentence(rnd, n):
    return " ".join("".join(rnd.choice("abcdefghij") for _ in range(4)) for _ in range(n)).capitalize() + "."


def test_sentences_cover_the_text():
    for text in ("", "One. Two! Three", "a\n\nb", "he said so The end", "x.  \n y", " lead. tail "):
        parts = spans.sentences(text)
        assert "".join(text[a:b] for a, b in parts) == text
    assert len(spans.sentences("one. two. three\nfour Five")) == 5


def test_documents_match_plain(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = every_run(docs)
    out = spans.op5_substring_dedup(spark, SF).collect()
    texts = dict(docs)
    for r in out:
        gone = want.pop(r["doc_id"])
        assert (r["text"], r["n_removed"]) == (spans.without(texts[r["doc_id"]], sorted(gone)), len(gone))
        assert bool(r["repeats_of"]) == bool(gone)
    assert not want


def test_passages_set_into_other_text_go_once_found(rows):
    rnd = random.Random(9)
    passage = " ".join(sentence(rnd, rnd.randint(8, 16)) for _ in range(6))
    single = sentence(rnd, 55)
    docs = [(1, f"{sentence(rnd, 9)} and then {passage} so it went on. {sentence(rnd, 12)}")]
    docs += [(k, f"{sentence(rnd, 7)} or {passage} but {sentence(rnd, 9)}") for k in (2, 3)]
    docs += [(4, f"{sentence(rnd, 9)} {single} {sentence(rnd, 8)}"), (5, f"{sentence(rnd, 5)} {single} {sentence(rnd, 30)}")]
    docs += [(6, " ".join(sentence(rnd, 11) for _ in range(20)))]
    out = {r["doc_id"]: r for r in spans.remove_repeats(rows("doc_id long, text string", *docs)).collect()}
    for first in (1, 4, 6):
        assert out[first]["text"] == dict(docs)[first] and out[first]["repeats_of"] == []
    assert passage not in out[2]["text"] and single not in out[5]["text"]
    # The third also shares "or" and "but" beside the passage with the second.
    assert out[2]["repeats_of"] == [1] and 1 in out[3]["repeats_of"] and out[5]["repeats_of"] == [4]
    assert dict(docs)[2].split()[:7] == out[2]["text"].split()[:7]


def test_repeats_within_a_document_and_long_texts(rows):
    rnd = random.Random(1)
    block = " ".join(sentence(rnd, 12) for _ in range(4))
    other = " ".join(sentence(rnd, 12) for _ in range(5000))
    out = spans.remove_repeats(rows("doc_id long, text string", (1, f"{block} {other} {block}"))).first()
    assert out["n_removed"] == 4 and out["text"].strip() == f"{block} {other}"


def test_nulls_empty_repeats_columns(rows):
    text = "One two three four five six seven. Eight nine ten eleven twelve thirteen. A b c d e f g h i j k."
    docs = rows(
        "doc_id long, text string, removed string, n_removed string, row int, cut int",
        (1, text, "a", "b", 1, 1), (1, text, "a", "b", 1, 1), (None, text, "a", "b", 1, 1), (2, None, "a", "b", 1, 1), (3, "", "a", "b", 1, 1), (4, text.upper(), "", "", 0, 0),
    )
    out = spans.remove_repeats(docs)
    assert out.columns == ["doc_id", "text", "removed", "row", "cut", "n_removed", "repeats_of"]
    got = sorted(((r["doc_id"] or 9, r["text"], r["n_removed"]) for r in out.collect()), key=str)
    assert got == sorted([(1, text, 0), (1, text, 0), (2, None, 0), (3, "", 0), (4, "", 3), (9, "", 3)], key=str)
    assert spans.remove_repeats(docs.where("false")).count() == 0


def test_the_last_sentences_of_a_span_go_too(rows):
    rnd = random.Random(4)
    passage = " ".join(sentence(rnd, n) for n in (12, 10, 5))
    docs = [(k, f"{sentence(rnd, 9)} {passage} {sentence(rnd, 25)}") for k in (1, 2)]
    out = {r["doc_id"]: r for r in spans.remove_repeats(rows("doc_id long, text string", *docs)).collect()}
    assert out[1]["n_removed"] == 0 and out[2]["n_removed"] == 3 and passage[-10:] not in out[2]["text"]


def test_all_runs_of_any_length_are_covered(spark, rows):
    rnd = random.Random(11)
    pool = [sentence(rnd, n) for n in (1, 2, 3, 5, 5, 7, 8, 10, 12, 15, 19, 21, 29, 30, 40)]
    made = [(k, " ".join(rnd.choice(pool) if rnd.random() < 0.7 else sentence(rnd, rnd.randint(1, 35)) for _ in range(30))) for k in range(80)]
    given = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    for docs in (made, given):
        want = every_run(docs)
        out = spans.remove_repeats(rows("doc_id long, text string", *docs)).collect()
        assert {r["doc_id"]: r["n_removed"] for r in out} == {i: len(gone) for i, gone in want.items()}
        texts = dict(docs)
        assert all(r["text"] == spans.without(texts[r["doc_id"]], sorted(want[r["doc_id"]])) for r in out)
