"""Source mixing: targets, schedule, and what the mix takes."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing

SCHEMA = "doc_id long, source string, size long"


def level(sizes, weights, total, most=3):
    """Targets by repeated resharing."""
    goal, stopped = {}, set()
    while True:
        left = total - sum(most * sizes[s] for s in stopped)
        weight = sum(weights[s] for s in sizes if s not in stopped)
        goal = {s: most * sizes[s] if s in stopped else weights[s] * left / weight for s in sizes}
        above = {s for s in sizes if s not in stopped and goal[s] > most * sizes[s]}
        if not above:
            return goal
        stopped |= above


def mixed(rows, *data, **options):
    return mixing.mix(rows(SCHEMA, *data), **options).collect()


def test_targets_reshare_what_is_over(rows):
    data = [(i, s, n) for i, (s, n) in enumerate([("a", 10), ("b", 500), ("c", 40), ("d", 700), (None, 90), ("é", 1)])]
    got = {r["source"]: r["target"] for r in mixing.targets(rows(SCHEMA, *data)).collect()}
    sizes = {s: n for _, s, n in data}
    order = ["a", "b", "c", "d", "é", None]
    want = level(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, sum(sizes.values()))
    assert got == pytest.approx(want)


def test_taken_words_meet_targets_and_repeats_stop(rows):
    data = [(i, "abc"[i % 3] if i % 50 else "rare", i % 37) for i in range(3000)]
    out = mixed(rows, *data, block=64)
    assert len(out) == len(data)
    words = Counter()
    for r in out:
        words[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    for r in out:
        assert abs(words[r["source"]] - r["target"]) <= 1


def test_block_size_changes_the_order_but_not_the_words(rows):
    data = [(i, "ab"[i % 2], i % 11 + 1) for i in range(400)]
    small = {r["doc_id"]: r["taken"] for r in mixed(rows, *data, block=7)}
    assert small == {r["doc_id"]: r["taken"] for r in mixed(rows, *data, block=1000)}


def test_schedule_is_evenly_spread(spark, rows):
    sources = spark.createDataFrame(
        [("a", 1, 1, 0, 0.0, 5000), ("b", 2, 1, 0, 0.0, 2000), ("c", 3, 1, 0, 0.0, 1000), ("d", 4, 1, 0, 0.0, 1)],
        "source string, sid int, n long, source_size long, target double, quota long",
    )
    slots = sorted((r["slot"], r["sid"], r["block"]) for r in mixing.schedule(sources, 1).collect())
    assert Counter(s for _, s, _ in slots) == {1: 5000, 2: 2000, 3: 1000, 4: 1}
    for sid in (1, 2, 3):
        assert [b for _, s, b in slots if s == sid] == list(range(Counter(s for _, s, _ in slots)[sid]))
    seen = Counter()
    for k, (_, sid, _) in enumerate(slots[:4000], 1):
        seen[sid] += 1
        assert abs(seen[1] - k * 5 / 8) < 6 and abs(seen[2] - k * 2 / 8) < 6


def test_hot_source_is_split_over_buckets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP_ROWS", 100)
    rows = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "hot").otherwise("rest").alias("source"), F.lit(5).cast("long").alias("size")
    )
    placed = mixing.streams(rows, mixing.targets(rows))
    assert placed.where("source = 'hot'").groupBy("__bucket_of").count().agg(F.max("count")).first()[0] < 100
    starts = sorted(r["start"] for r in placed.where("source = 'hot'").collect())
    assert starts == [5 * k for k in range(len(starts))]


def test_nulls_ties_repeats_and_empty(rows):
    data = [(None, None, 5), (None, None, 5), (1, "a", 0), (1, "a", 0), (2, "a", 7), (2, "a", 7)]
    out = mixed(rows, *data)
    assert sorted((r["doc_id"] or 0, r["size"]) for r in out) == sorted((d or 0, n) for d, _, n in data)
    assert all(r["taken"] == 0 for r in out if r["size"] == 0)
    assert sum(r["taken"] for r in out) == pytest.approx(24, abs=2)
    assert mixed(rows) == []
    assert all(r["taken"] == 0 and r["target"] == 0 for r in mixed(rows, (1, "a", 0), (2, None, 0)))


def test_reruns_agree(rows):
    data = [(i % 90, "ab"[i % 2], i % 9) for i in range(300)]
    assert sorted(mixed(rows, *data)) == sorted(mixed(rows, *reversed(data)))


def test_documents_keep_columns_and_repeat(rows):
    docs = rows(
        "doc_id long, text string, source string, size int, taken string, target string, row int, copy int",
        *[(i, "w " * 20, "big", 1, "x", "y", 2, 3) for i in range(60)],
        *[(100 + i, "w " * 20, "small", 1, None, None, None, None) for i in range(5)], (200, None, None, 0, None, None, 1, 1),
    )
    out = mixing.mix_documents(docs)
    assert out.columns == docs.columns
    counts = Counter(r["source"] for r in out.collect())
    # big weighs 5, small 2 of 1300 words; small stops at three times its 100 words.
    assert counts == {"big": 50, "small": 15}
    assert mixing.mix_documents(docs.where("false")).count() == 0


def test_the_mix_in_order_deals_sources_evenly_and_in_stream_order(rows):
    data = [(i, "abc"[i % 3], i % 7 + 1) for i in range(1500)]
    docs, sizes = rows(SCHEMA, *data), {i: n for i, _, n in data}
    out = mixing.mixed_order(docs, block=16).collect()
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(docs, block=16).collect()}
    sums, by_source, seen = Counter(), {}, Counter()
    for r in out:
        sums[r["doc_id"]] += r["words"]
        by_source.setdefault("abc"[r["doc_id"] % 3], []).append(r)
    assert sums == Counter({i: n for i, n in taken.items() if n})
    assert [r["slot"] for r in out] == sorted(r["slot"] for r in out)
    for source, parts in by_source.items():
        # One after the other, each document whole, before the next begins.
        stream = [(d, n) for _, d, n in sorted(
            (__import__("hashlib").md5(f"mix-1:{d}:{n}".encode()).hexdigest(), d, n) for d, s, n in data if s == source)]
        words = [(d, k) for _ in range(3) for d, n in stream for k in range(n)]
        got = [(r["doc_id"], r["first"] + k) for r in parts for k in range(r["words"])]
        assert got == words[:len(got)]
    total, at = sum(sums.values()), 0
    final = Counter("abc"[i % 3] for i in sums.elements())
    for r in out:
        at += r["words"]
        seen["abc"[r["doc_id"] % 3]] += r["words"]
        # Shares hold at every point while all sources are open.
        if at < 0.8 * total:
            assert all(abs(seen[s] - at * final[s] / total) < 6 * 16 for s in "abc")
    assert all(r["first"] + r["words"] <= sizes[r["doc_id"]] for r in out)


def first_hit(a, m, low, high):
    """The least k from 0 on for which k * a mod m lies from low to high; None if none does."""
    if low == 0:
        return 0
    if a == 0:
        return None
    if 2 * a > m:
        return first_hit(m - a, m, m - high, m - low)
    k = -(-low // a)
    if k * a <= high:
        return k
    wraps = first_hit(m % a, a, -high % a, -low % a)
    return None if wraps is None else -(-(low + m * wraps) // a)


def test_first_hit():
    rnd = random.Random(3)
    for _ in range(300):
        m = rnd.randint(5, 400)
        a, low = rnd.randint(1, m - 1), rnd.randint(1, m - 1)
        high = rnd.randint(low, m - 1)
        want = next((k for k in range(1, m + 1) if low <= k * a % m <= high), None)
        assert first_hit(a, m, low, high) == want


def test_no_source_of_one_block_is_lost_at_any_size():
    """Points alone: of 200 million blocks (8e11 words), and of 20 billion, each has a point in time."""
    rnd = random.Random(7)
    for n in (2_000_000, 200_000_000, 20_000_000_000):
        points = int(n * mixing.ENOUGH_POINTS) + 2
        for unit in [1, n - 2, *(rnd.randrange(1, n - 1) for _ in range(300))]:
            low, high = -(-unit * mixing.PERIOD // n), -(-(unit + 1) * mixing.PERIOD // n) - 1
            assert first_hit(mixing.GOLDEN, mixing.PERIOD, low, high) <= points


def test_missing_slots_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ENOUGH_POINTS", 0.5)
    sources = spark.createDataFrame(
        [("a", 1, 1, 0, 0.0, 5000), ("b", 2, 1, 0, 0.0, 1)], "source string, sid int, n long, source_size long, target double, quota long")
    with pytest.raises(RuntimeError, match="fewer slots"):
        mixing.schedule(sources, 1)


def test_clashing_columns(rows):
    docs = rows(SCHEMA + ", target string, Taken string, sid string, __key string, place string, start string, first_slot string, row string, slot string",
                *[(i, "ab"[i % 2], 5, *"tusdepfrl") for i in range(40)])
    out = mixing.mix(docs, block=8)
    assert out.columns == ["doc_id", "source", "size", "sid", "__key", "place", "start", "row", "slot", "source_size", "target", "taken", "first_slot"]
    want = {r["doc_id"]: (r["taken"], r["first_slot"]) for r in mixing.mix(docs.select("doc_id", "source", "size"), block=8).collect()}
    got = out.collect()
    assert {r["doc_id"]: (r["taken"], r["first_slot"]) for r in got} == want and all(r["start"] == "p" for r in got)


def test_first_slots_are_those_of_the_mix(rows):
    docs = rows(SCHEMA, *[(i, "abc"[i % 3], i % 7 + 1) for i in range(600)])
    firsts = {}
    for r in mixing.mixed_order(docs, block=16).collect():
        firsts.setdefault(r["doc_id"], r["slot"])
    assert {r["doc_id"]: r["first_slot"] for r in mixing.mix(docs, block=16).collect() if r["taken"]} == firsts
