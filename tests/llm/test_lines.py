"""Line dedup: against comparing all pairs of lines."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import lines


def edits(a, b):
    """Word edit distance."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def alike(a, b):
    return a == b or (min(len(a), len(b)) >= 5 and edits(a, b) <= 1)


def plain(docs):
    """doc_id -> (text left, lines, removed); ids must differ."""
    seen, out = [], {}
    for doc_id, text in sorted(docs):
        kept, n, gone = [], 0, 0
        for line in text.split("\n"):
            words = line.lower().split()
            if not words:
                kept.append(line)
                continue
            n += 1
            if any(alike(words, s) for s in seen):
                gone += 1
            else:
                kept.append(line)
            seen.append(words)
        out[doc_id] = (text if not gone else "" if gone == n else "\n".join(kept), n, gone)
    return out


def run(df):
    return {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in lines.dedup_lines(df).collect()}


def test_matches_all_pairs(rows):
    rnd = random.Random(4)
    pool = [[rnd.choice("abcdefgh") + rnd.choice("xy") for _ in range(rnd.randint(1, 14))] for _ in range(60)]
    docs = []
    for i in range(150):
        text = []
        for _ in range(rnd.randint(0, 6)):
            words = list(rnd.choice(pool))
            for _ in range(rnd.choice((0, 0, 1, 1, 2))):
                k, kind = rnd.randrange(len(words) + 1), rnd.randrange(3)
                words[k:k + (kind < 2)] = ["NEW"] * (kind > 0)
            text.append(rnd.choice((" ", "  ", "\t")).join(words) + rnd.choice(("", " ")))
        docs.append((i, "\n".join(text)))
    assert run(rows("doc_id long, text string", *docs)) == plain(docs)


@pytest.mark.parametrize("n", [5, 6, 63, 64, 65, 128, 131])
def test_one_edit_anywhere_in_a_line(rows, n):
    """At each place a word changed, added or left out; also over chunk borders."""
    base = [f"w{i}" for i in range(n)]
    docs = [(0, " ".join(base))]
    for k in sorted({0, 1, n // 2 - 1, n // 2, n // 2 + 1, n - 2, n - 1, min(62, n - 1), min(64, n - 1)}):
        docs += [(3 * k + 1, " ".join([*base[:k], f"c{k}", *base[k + 1:]])), (3 * k + 2, " ".join([*base[:k], f"a{k}", *base[k:]]))]
        docs += [(3 * k + 3, " ".join(base[:k] + base[k + 1:]))]
    assert run(rows("doc_id long, text string", *docs)) == plain(docs)


@given(st.lists(st.sampled_from("abc"), min_size=1, max_size=6), st.lists(st.sampled_from("abc"), min_size=1, max_size=6))
@settings(max_examples=60, deadline=None)
def test_distance_check(spark, a, b):
    df = spark.createDataFrame([(a, b)], "a array<string>, b array<string>")
    if a != b:
        assert df.select(lines.within_one_edit(F.col("a"), F.col("b"))).first()[0] == (edits(a, b) <= 1)


def test_many_lines_that_differ_in_one_word_make_no_pairs(spark):
    """A third of all lines in one neighbourhood: its join gives one row per line."""
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("request number "), "id", F.lit(" was handled without any trouble today")))
        .otherwise(F.concat_ws(" ", *[F.concat(F.lit(f"w{k}-"), "id") for k in range(8)])).alias("text"),
    )
    out = lines.dedup_lines(docs)
    assert out.where("n_removed > 0").count() == 999
    slim = docs.withColumn("text_hash", F.xxhash64("text"))
    table = lines.distinct_lines(lines.line_table(slim))
    assert lines.candidates(table).count() == 1000


def test_nulls_blanks_repeats_columns(rows):
    docs = rows(
        "doc_id long, text string, lines string, n_lines string, kept int, row int, words string",
        (2, None, "a", "b", 1, 2, "c"), (3, "", "a", "b", 1, 2, "c"), (4, " \n\n", "a", "b", 1, 2, "c"),
        (5, "Same line\n\nown line", "a", "b", 1, 2, "c"), (5, "Same line\n\nown line", "a", "b", 1, 2, "c"),
        (None, "same LINE", "a", "b", 1, 2, "c"), (6, "same  line\n", None, None, None, None, None), (7, "own line\nnew", "", "", 0, 0, ""),
    )
    out = lines.dedup_lines(docs)
    assert out.columns == ["doc_id", "text", "lines", "kept", "row", "words", "n_lines", "n_removed"]
    got = sorted((r["doc_id"] or 99, r["text"], r["n_lines"], r["n_removed"]) for r in out.collect() if r["text"] is not None)
    assert got == [
        (3, "", 0, 0), (4, " \n\n", 0, 0), (5, "Same line\n\nown line", 2, 0), (5, "Same line\n\nown line", 2, 0),
        (6, "", 1, 1), (7, "new", 2, 1), (99, "", 1, 1),
    ]
    assert out.where("text IS NULL").count() == 1
    assert lines.dedup_lines(docs.where("false")).count() == 0


def test_a_very_long_line(rows):
    words = [f"w{i}" for i in range(20_000)]
    docs = rows("doc_id long, text string", (1, " ".join(words)), (2, " ".join([*words[:15_000], "x", *words[15_001:]])), (3, " ".join(words[5:])))
    assert [v[2] for _, v in sorted(run(docs).items())] == [0, 1, 0]


def test_plan_is_native(spark):
    docs = spark.createDataFrame([(1, "a b c d e"), (2, "a b c d f")], "doc_id long, text string")
    plan = lines.dedup_lines(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
