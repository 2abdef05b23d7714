"""Change capture by digests of buckets."""

import random
from datetime import datetime

import pytest
from conftest import values

from tidemark.plans.capture import ChangeCapture
from tidemark.sinks import LostRace
from tidemark.sinks.landing import BATCHES, place

SCHEMA = "k int, day int, v string, w double"


@pytest.fixture
def follow(spark, rows, tmp_path):
    """follow(n) captures a table keyed by (k, day) in n buckets."""
    def make(buckets=16):
        return ChangeCapture(spark, str(tmp_path / "capture"), "t", ["k", "day"], rows(SCHEMA).schema, buckets)
    return make


def ops(df):
    return sorted((r["_op"], r["k"], r["day"], r["v"], r["before"] and r["before"]["v"]) for r in df.collect())


def test_inserts_updates_deletes(rows, follow):
    capture = follow()
    first = [(k, 1, f"v{k}", None if k % 3 else 1.0) for k in range(40)]
    look = capture.look(rows(SCHEMA, *first))
    assert look.run == 1 and len(capture.changes(1).collect()) == 40
    later = [r for r in first if r[0] not in (3, 4)] + [(99, 1, "new", 0.0)]
    later[0], later[1] = (0, 1, None, 1.0), (1, 1, "v1", 5.0)  # a value gone, a value come
    look = capture.look(rows(SCHEMA, *later))
    assert ops(capture.changes(2)) == [("delete", 3, 1, "v3", None), ("delete", 4, 1, "v4", None), ("insert", 99, 1, "new", None),
                                       ("update", 0, 1, None, "v0"), ("update", 1, 1, "v1", "v1")]
    assert values(capture.copy()) == values(rows(SCHEMA, *later))
    assert capture.look(rows(SCHEMA, *later)).differing == [] and follow().look(rows(SCHEMA, *later)).run == 2


def test_only_differing_buckets_are_read(rows, follow):
    capture = follow(64)
    table = [(k, k % 5, "a", 0.0) for k in range(2000)]
    assert len(capture.look(rows(SCHEMA, *table)).differing) == 64
    table[7] = (7, 2, "b", 0.0)
    look = capture.look(rows(SCHEMA, *table))
    assert len(look.differing) == 1 and ops(capture.changes(look.run)) == [("update", 7, 2, "b", "a")]
    assert len(capture.copy(look.differing).inputFiles()) == 1 and capture.copy(look.differing).count() < 100
    assert capture.copy().count() == 2000


def test_random_states(rows, follow):
    rnd, capture, kept = random.Random(4), follow(8), {}
    for _ in range(5):
        now = {(k, None if k % 4 else 0): rnd.choice("abc") for k in rnd.sample(range(60), rnd.choice([0, 20, 45]))}
        look = capture.look(rows(SCHEMA, *[(k, d, v, None) for (k, d), v in now.items()]))
        want = [("insert", *k, v, None) for k, v in now.items() if k not in kept]
        want += [("delete", *k, v, None) for k, v in kept.items() if k not in now]
        want += [("update", *k, v, kept[k]) for k, v in now.items() if k in kept and kept[k] != v]
        if want:
            got = [(r["_op"], r["k"], r["day"], r["v"], r["before"] and r["before"]["v"]) for r in capture.changes(look.run).collect()]
            assert sorted(got, key=str) == sorted(want, key=str)
        else:
            assert look.differing == []
        kept = now


def test_moved_value_and_a_look_that_died(spark, rows, follow, monkeypatch):
    capture = follow()
    capture.look(rows(SCHEMA, (1, 1, "x", None)))

    def died(*_, **__):
        raise OSError("died")

    with monkeypatch.context() as m:
        m.setattr(capture.state, "put", died)
        with pytest.raises(OSError):
            capture.look(rows(SCHEMA, (1, 1, None, None), (2, 1, "y", None)))
    assert values(capture.copy(), "v") == [("x",)]
    look = capture.look(rows(SCHEMA, (1, 1, "z", None)))
    assert ops(capture.changes(look.run)) == [("update", 1, 1, "z", "x")]


def test_landing_is_repeatable(spark, rows, follow, lake, monkeypatch):
    capture, day = follow(), datetime(2024, 1, 1)
    capture.look(rows(SCHEMA, (1, 1, "a", 0.0), (2, 1, "b", 0.0)))
    with monkeypatch.context() as m:
        m.setattr(capture.state, "put", lambda *_, **__: (_ for _ in ()).throw(OSError("died")))
        with pytest.raises(OSError):
            capture.land(lake, day)
    capture.look(rows(SCHEMA, (1, 1, "c", 0.0)))
    assert capture.land(lake, day) == 2 and capture.land(lake, day) == 0
    landed = spark.read.parquet(place(lake, BATCHES, "t"))
    assert values(landed, "look", "k", "v") == [(1, 1, "a"), (1, 2, "b"), (2, 1, "c")]
    gone = spark.read.parquet(f"{lake}/postgres/deletes/table_name=t")
    assert values(gone, "look", "k", "v") == [(2, 2, "b")]


def test_two_lookers(rows, follow):
    one, two = follow(), follow()
    seen = two.state.last("t")
    one.look(rows(SCHEMA, (1, 1, "a", 0.0)))
    with pytest.raises(LostRace):
        two.state.put("t", "1", after=seen.seq)
