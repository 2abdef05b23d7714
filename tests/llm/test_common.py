"""Helpers: joins of any size, prefix sums, samples, written tables."""

import os

import pandas as pd
from pyspark.sql import functions as F

from tidemark.llm import common, packing
from tidemark.llm.common import in_parts


def test_attach_both_ways_gives_the_same(spark, rows, monkeypatch):
    left = rows("k string, v int", *[("hot" if i % 3 else f"k{i % 7}", i) for i in range(200)], (None, 1))
    table = rows("k string, w int", ("hot", 1), ("k0", 2), (None, 3))
    want = sorted(map(str, common.attach(left, table, "k").collect()))
    monkeypatch.setattr(common, "SMALL_ROWS", 1)
    salted = common.attach(left, table, "k")
    assert sorted(map(str, salted.collect())) == want and salted.columns == ["k", "v", "w"] and len(want) == 201


def test_with_start_counts_earlier_rows(rows):
    data = [("a" if i % 4 else None, i // 10, i, i % 5) for i in range(120)]
    out = common.with_start(rows("g string, b int, i int, n int", *data), "g", "b", [F.col("i")], "n").collect()
    for r in out:
        assert r["start"] == sum(n for g, _, i, n in data if g == r["g"] and i < r["i"])


def test_sample_is_bounded_and_stable(spark):
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 100 == 0, "rare").otherwise("hot").alias("g"))
    twice = rows.union(rows)
    got = common.sample_ids(twice, "g", 300, 2).collect()
    again = common.sample_ids(rows.repartition(3), "g", 300, 2).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    assert sum(r["g"] == "hot" for r in got) == 300 and sum(r["g"] == "rare" for r in got) == 50


def test_written_survives_and_restores_the_setting(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    df = common.written(spark.range(100).repartition(5).withColumn("x", F.lit(1)), "test")
    assert df.count() == 100 and spark.conf.get(key) == before
    assert common.written(df.where("false"), "test").count() == 0


def test_parts_are_bounded_and_whole():
    texts = ["a" * 10, None, "b" * 95, "", "c" * 500, "d", float("nan"), "e"] + ["f"] * 25
    parts = list(in_parts(texts, 100, 10))
    assert [t for p in parts for t in texts[p]] == texts
    for p in parts:
        sizes = [len(t) if isinstance(t, str) else 0 for t in texts[p]]
        assert len(sizes) <= 10 and sum(sizes[:-1]) < 100
    assert list(in_parts([], 100, 10)) == []


def test_one_batch_of_long_texts_gives_several_outputs(spark):
    """A batch of 3,000 texts is handed on in parts of bounded tokens, ids included."""
    docs = spark.range(3000).selectExpr("id AS doc_id", "repeat('word thing ', 200) AS text").coalesce(1)
    pieces = packing.cut_documents(docs, with_ids=True)
    assert pieces.agg(F.sum("length"), F.sum(F.size("ids"))).first() == (3000 * 402, 3000 * 402)
    given = pd.DataFrame({"doc_id": range(3000), "text": ["word thing " * 200] * 3000})
    seen = []

    class Docs:
        def select(self, *_):
            return self

        def mapInPandas(self, run, _):
            seen.extend(len(out) for out in run(iter([given])))

    packing.cut_documents(Docs(), with_ids=True)
    assert sum(seen) == 3000 and max(seen) <= packing.PART_TOKENS // 400 + 1


def test_scratch_tables_go_but_for_those_taken_out(spark, rows):
    before = common.written(rows("a int", (0,)), "outer")
    with common.scratch(spark) as inner:
        one = common.written(rows("a int", (1,)), "one")
        two = common.written(one, "two")
        kept = inner.pop()
    assert two.collect()[0]["a"] == 1 and before.collect()[0]["a"] == 0 and kept in two.inputFiles()[0]
    assert not any(os.path.exists(f.removeprefix("file://")) for f in one.inputFiles())
