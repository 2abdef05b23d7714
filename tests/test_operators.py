import random
from collections import Counter
from datetime import datetime
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from conftest import values
from tidemark.operators import keys
from tidemark.operators import (
    accepted, centroid_and_modes, check_contract, children_of, concat_frames, content_fingerprint,
    count_rows, delta_since, first_per_key, has_changed, max_or_default, max_version, not_null,
    number_pages, page_after, page_answer, page_by_key, relationship, run_checks, split_known,
    time_slice, top_k, unique, up_to, value_counts,
)
from tidemark.operators import profile
from tidemark.schemas import CONTRACTS


def test_first_per_key_is_deterministic(rows):
    data = [(k, random.randint(0, 3), random.randint(0, 9)) for k in range(20) for _ in range(10)]
    best = {k: min((o, v) for kk, o, v in data if kk == k) for k in range(20)}
    for _ in range(3):
        random.shuffle(data)
        df = rows("k int, o int, v int", *data).repartition(5)
        got = {r["k"]: (r["o"], r["v"]) for r in first_per_key(df, ["k"], [F.col("o").asc()]).collect()}
        assert got == best


def test_centroid_and_modes_against_counting(rows):
    random.seed(3)
    data = [(random.choice(["a", "b", None]), random.choice([1.0, 2.0, None]), random.choice(["x", "y", "z", None]),
             random.choice(["s", "t"])) for _ in range(400)]
    data += [("hot", 5.0, "q", "s")] * 300 + [("hot", None, None, "t")] * 20
    got = centroid_and_modes(rows("k string, m double, c string, s string", *data), "k", ["m"], ["c", "s"], "n")
    for r in got.collect():
        mine = [d for d in data if d[0] == r["k"]]
        means = [d[1] for d in mine if d[1] is not None]
        assert r["n"] == len(mine)
        assert r["m"] == pytest.approx(sum(means) / len(means))
        for i, name in ((2, "c"), (3, "s")):
            counts = Counter(d[i] for d in mine if d[i] is not None)
            assert r[name] == min(counts, key=lambda v: (-counts[v], v))
    assert got.count() == 4


def test_mode_ties_and_all_null(rows):
    df = rows("k int, m double, c string", (1, 1.0, "b"), (1, 1.0, "a"), (1, None, "a"), (1, None, "b"),
              (1, None, None), (2, None, None))
    assert values(centroid_and_modes(df, "k", ["m"], ["c"])) == [(1, 1.0, "a"), (2, None, None)]


def test_slices(rows):
    at = lambda d: datetime(2024, 1, d)
    df = rows("k int, ts timestamp_ntz", (1, at(1)), (2, at(2)), (3, at(3)), (4, None))
    assert values(time_slice(df, "ts", "2024-01-01", "2024-01-02"), "k") == [(2,)]
    assert values(up_to(df, "ts", "2024-01-02"), "k") == [(1,), (2,)]
    kids = rows("k int, c int", (1, 10), (1, 11), (9, 12), (None, 13))
    assert values(children_of(kids, df, "k")) == [(1, 10), (1, 11)]


def test_delta_is_strict_and_overlap_rereads(rows):
    at = lambda d: datetime(2024, 1, d)
    df = rows("k int, ts timestamp_ntz", (1, at(1)), (2, at(2)), (3, at(3)))
    assert values(delta_since(df, "ts", "2024-01-02 00:00:00"), "k") == [(3,)]
    assert values(delta_since(df, "ts", "2024-01-03", overlap="1 day"), "k") == [(3,)]
    assert values(delta_since(df, "ts"), "k") == [(1,), (2,), (3,)]
    kids = rows("k int, c int", (1, 10), (3, 30), (3, 31))
    got = delta_since(kids, "ts", "2024-01-01", parent=df, on="k")
    assert got.columns == ["k", "c", "tracking_ts"]
    assert values(got, "c") == [(30,), (31,)]


def test_change_detection(rows):
    df = rows("k int, v string", (1, "a"), (2, "b"), (2, "b"))
    mark = lambda d: content_fingerprint(d).first()[0]
    assert mark(df) == mark(df.repartition(4))
    assert mark(df) != mark(df.where("k = 1"))
    assert mark(df) != mark(df.distinct())
    assert max_version(df, "k").first()[0] == 2
    assert max_version(df.where("k > 5"), "k").first()[0] == 0
    assert has_changed(5, None) and has_changed(5, 0) and has_changed(6, 5)
    assert not has_changed(5, 5) and not has_changed(4, 5)
    assert has_changed(4, 5, monotone=False)


def test_sets(rows):
    both = concat_frames(rows("a int, b int", (1, 2)), rows("b int, c int", (3, 4)))
    assert values(both) == [(None, 3, 4), (1, 2, None)]
    assert split_known(["x", "y", "x", "z"], ["z", "x", "q"]) == (["x", "z"], ["y"])


def test_paging(spark, rows, tmp_path):
    df = rows("k int, v string", *[(i * 3, str(i)) for i in range(25)]).repartition(6)
    assert [r["k"] for r in page_by_key(df, "k", 3, 10).collect()] == [60, 63, 66, 69, 72]
    assert [r["k"] for r in page_after(df, "k", 60, 2).collect()] == [63, 66]
    for bad in ((0, 5), (1, 0)):
        with pytest.raises(ValueError):
            page_by_key(df, "k", *bad)
    full, last, beyond = (page_answer(page_by_key(df, "k", p, 5), p, 5).first() for p in (1, 5, 6))
    assert (full["has_next"], last["has_next"], beyond["has_next"], beyond["count"]) == (True, True, False, 0)
    numbered = number_pages(spark, df, "k", 10, str(tmp_path / "pages"))
    assert values(numbered, "k", "page") == sorted(((i * 3, i // 10 + 1) for i in range(25)), key=lambda t: str(t[0]))


def test_small_reports(rows):
    df = rows("k int, v string", (1, "a"), (2, None), (3, "a"))
    assert [tuple(r) for r in value_counts(df, "v").collect()] == [("a", 2), (None, 1)]
    assert values(count_rows({"x": df, "y": df.where("k > 2")})) == [("x", 3), ("y", 1)]
    assert max_or_default(df.where("k > 9"), "k", 0, "m").first()["m"] == 0
    assert [r["k"] for r in top_k(df, 2, F.col("k").desc()).collect()] == [3, 2]


def test_checks(rows):
    models = {
        "child": rows("id int, ref string, s string", (1, "a", "ok"), (1, "a", "it's"), (2, "zz", None),
                      (None, None, "{x}"), (3, "zz", "ok")),
        "parent": rows("ref string", ("a",), ("b",), (None,)),
    }
    report = run_checks(models, [
        not_null("child", "id"), not_null("child", "ref").warn(), not_null("parent", "ref"),
        unique("child", "id"), unique("child", "id", "s"), unique("parent", "ref"),
        relationship("child", "ref", "parent", "ref"),
        accepted("child", "s", ["ok", "it's", "{x}"]), accepted("child", "s", ["it's"]).warn(),
    ])
    got = {(r["model"], r["test"], r["column_name"], r["severity"]): (r["failures"], r["status"]) for r in report.collect()}
    assert got == {
        ("child", "not_null", "id", "error"): (1, "fail"),
        ("child", "not_null", "ref", "warn"): (1, "warn"),
        ("parent", "not_null", "ref", "error"): (1, "fail"),
        ("child", "unique", "id", "error"): (1, "fail"),
        ("child", "unique", "id,s", "error"): (0, "pass"),
        ("parent", "unique", "ref", "error"): (0, "pass"),
        ("child", "relationships", "ref", "error"): (2, "fail"),
        ("child", "accepted_values", "s", "error"): (0, "pass"),
        ("child", "accepted_values", "s", "warn"): (2, "warn"),
    }


def test_contract(rows):
    contract = CONTRACTS["silver_sellers"]
    good = rows(contract, ("a", None, "b", "c"))
    assert check_contract("silver_sellers", good, contract) is good
    with pytest.raises(TypeError, match="contract"):
        check_contract("silver_sellers", good.withColumn("seller_zip_code_prefix", F.lit(1)), contract)


def test_profiles(rows):
    df = rows("k string, v double, t string", ("aa", 1.0, "2024-01-01"), ("aa", 1.0, "2024-01-01"),
              (None, 2.5, "NaT"), (None, None, None))
    assert [tuple(r) for r in profile.null_counts(df).collect()] == [("k", 2), ("t", 1), ("v", 1)]
    assert values(profile.duplicate_rows(df, "k")) == [(4, 2)]
    assert values(profile.duplicate_rows(df)) == [(4, 1)]
    ranges = profile.timestamp_ranges(df, ["t"]).first()
    assert (ranges["earliest"], ranges["latest"], ranges["nulls"]) == (datetime(2024, 1, 1), datetime(2024, 1, 1), 2)
    assert values(profile.key_lengths(df, "k")) == [(None, 2), (2, 2)]
    assert values(profile.has_fractions(df, ["v"])) == [("v", True)]
    assert values(profile.has_fractions(df.where("v = 1"), ["v"])) == [("v", False)]
    assert values(profile.shape(df), "column_name", "non_null", "row_count", "data_type") == [
        ("k", 2, 4, "string"), ("t", 3, 4, "string"), ("v", 3, 4, "double")]


def test_duplicates_of_long_texts(rows):
    """One rule for all lengths: a text is no repeat of another one's digest."""
    import hashlib

    from tidemark.operators import profile

    long = "x" * 100
    row = profile.duplicate_rows(rows("t string", (long,), (hashlib.sha256(long.encode()).hexdigest(),)), "t").first()
    assert (row["row_count"], row["duplicates"]) == (2, 0)
    row = profile.duplicate_rows(rows("t string", (long,), (long,), (None,), (None,), ("",)), "t").first()
    assert (row["row_count"], row["duplicates"]) == (5, 2)


def test_keys_and_references_are_found_and_false_ones_rejected(rows):
    given = {
        "parent": rows("id int, other int, day date, name string", *[(k, k % 7, None, f"n{k}") for k in range(500)]),
        "child": rows("a bigint, b int, c int, d int, e string", *[(k % 40, k // 40, k % 500, 600 if k == 3 else k % 500, f"n{k % 3}") for k in range(1000)]),
        "almost": rows("id int, n int", *[(k, k) for k in range(3000)], (5, 3001)),
        "gone": rows("id int, x int", (None, 1), (1, 2)),
        "empty": rows("id int"),
    }
    found = {n: keys.sketches(n, df) for n, df in given.items()}
    mine = keys.find_keys(given, found)
    want = []
    for name, df in given.items():
        data, least = [r.asDict() for r in df.collect()], []
        for size in (1, 2):
            for some in combinations(df.columns, size):
                held = [tuple(r[c] for c in some) for r in data]
                if data and None not in [v for h in held for v in h] and len(set(held)) == len(held) and not any(set(k) <= set(some) for k in least):
                    least.append(some)
        want += [(name, k) for k in least]
    assert mine == want and {("parent", ("id",)), ("child", ("a", "b")), ("gone", ("x",))} <= set(mine)
    assert not any("id" in k for n, k in mine if n in ("almost", "gone"))
    refs = keys.find_references(given, found, mine)
    assert ("child", "c", "parent", "id") in refs and ("child", "d", "parent", "id") not in refs
    assert ("child", "e", "parent", "name") in refs and ("almost", "id", "parent", "id") not in refs
    tests = keys.as_checks(mine, refs)
    assert {r["status"] for r in run_checks(given, tests).collect()} == {"pass"} and len(tests) > len(mine) + len(refs)
    assert ("gone", "id", "parent", "id") in refs and not any(r[0] == "empty" or r[2] == "empty" for r in refs)


def test_sketches_bound_what_is_grouped(rows, monkeypatch):
    """A column with few values is never grouped, nor are two whose values cannot tell the rows apart."""
    asked = []
    monkeypatch.setattr(keys, "is_key", lambda df, columns: asked.append(tuple(columns)) or False)
    df = rows("id int, few int, some int", *[(k, k % 3, k % 20) for k in range(1000)])
    keys.find_keys({"t": df}, {"t": keys.sketches("t", df)})
    assert asked == [("id",), ("id", "few"), ("id", "some")]


def test_short_texts_are_grouped_as_they_are(rows):
    from tidemark.operators import profile
    long = "x" * 33
    df = rows("v string, m int", ("ab", 1), ("ab", 1), (None, 1), (None, 1), (long, 1), (long, 1), ("", 1), ("x" * 32, 1))
    short = df.select(profile._short(F.col("v"), "string").alias("s")).select("s.text", "s.length", F.length("s.digest"))
    assert values(short.distinct()) == values(rows("a string, b int, c int", ("ab", None, None), (None, None, None), (None, 33, 32), ("", None, None), ("x" * 32, None, None)))
    assert values(profile.duplicate_rows(df, "v")) == values(profile.duplicate_rows(df)) == [(8, 3)]
