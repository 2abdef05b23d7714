from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import values
from tidemark.sinks import StateLog
from tidemark.streaming import (
    commit_parent_and_child, dedup_stream, join_when_parent_arrives, land_record_batches, read_committed,
    run_to_folder,
)
from tidemark.streaming.waiting import WaitingJoin

AT = datetime(2024, 1, 1, 12)


def test_dedup_across_batches(spark, rows, tmp_path):
    schema = "id int, ts timestamp, v string"
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(schema).option("maxFileAge", "36500d").parquet(f"{tmp_path}/in")
    for n, data in enumerate([
        [(1, AT, "first"), (2, AT, "a")] + [(3, AT, "hot")] * 200,
        [(1, AT + timedelta(minutes=5), "again"), (3, AT, "hot"), (4, AT + timedelta(minutes=6), "b")],
    ]):
        rows(schema, *data).repartition(4).write.mode("append").parquet(f"{tmp_path}/in")
        run_to_folder(dedup_stream(stream, ["id"], "ts", "1 hour"), f"{tmp_path}/out", f"{tmp_path}/cp")
    assert values(spark.read.parquet(f"{tmp_path}/out"), "id", "v") == [(1, "first"), (2, "a"), (3, "hot"), (4, "b")]


def test_dedup_loses_no_old_events(spark, rows, tmp_path):
    """Several micro-batches, the oldest events last: each comes out once."""
    schema = "id int, ts timestamp"
    (tmp_path / "in").mkdir()
    for n in range(4):
        part = rows(schema, *[(10 * n + i, AT - timedelta(days=100 * n)) for i in range(10)], (0, AT))
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = (
        spark.readStream.schema(schema).option("maxFileAge", "36500d").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        .withColumn("arrived", F.col("_metadata.file_modification_time"))
    )
    run_to_folder(dedup_stream(stream, ["id"], "arrived", "1 hour"), f"{tmp_path}/out", f"{tmp_path}/cp")
    assert values(spark.read.parquet(f"{tmp_path}/out"), "id") == sorted(((i,) for i in range(40)), key=str)


def test_early_child_waits_for_its_parent(spark, rows, tmp_path):
    kids, parents = "k int, c int, ct timestamp", "k int, p string, pt timestamp"
    rows(kids, *[(1, i, AT) for i in range(50)], (2, 0, AT)).write.parquet(f"{tmp_path}/kids")
    rows(parents, (7, "none", AT)).write.parquet(f"{tmp_path}/parents")
    read = lambda s, n: spark.readStream.schema(s).option("maxFileAge", "36500d").parquet(f"{tmp_path}/{n}")
    joined = join_when_parent_arrives(read(kids, "kids"), read(parents, "parents"), "k", "ct", "pt", "1 hour")
    assert joined.columns == ["k", "c", "ct", "p", "pt"]
    go = lambda: run_to_folder(joined, f"{tmp_path}/out", f"{tmp_path}/cp")
    go()
    rows(parents, (1, "came", AT + timedelta(minutes=1))).write.mode("append").parquet(f"{tmp_path}/parents")
    go()
    got = spark.read.schema(joined.schema).parquet(f"{tmp_path}/out")
    assert got.count() == 50 and got.select("c").distinct().count() == 50 and values(got.select("p").distinct()) == [("came",)]


def test_record_batches(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "a.json").write_text('{"source_table":"order_payments","records":[{"id":"1","n":2},{"id":"2"}]}\n'
                                  '{"source_table":"order_payments","records":[]}\n'
                                  '{"source_table":"order_reviews","records":[{"id":"9"}]}\n'
                                  '{"source_table":"order_payments","records":[{"id":"3","n":"two"}]}\n'
                                  '{"source_table":"order_payments","records":[{"id":"4","n"\n')
    go = lambda: land_record_batches(
        spark, str(inbox), f"{tmp_path}/drop", "order_payments", "id string, n int", f"{tmp_path}/cp")
    folder = go()
    go()
    landed = spark.read.parquet(folder)
    assert values(landed, "id", "n") == [("1", 2), ("2", None)] and "batch_date" in landed.columns
    rejected = spark.read.parquet(f"{tmp_path}/drop/_rejected_order_payments")
    assert [v[:60] for (v,) in values(rejected, "value")] == [
        '{"source_table":"order_payments","records":[{"id":"3","n":"t', '{"source_table":"order_payments","records":[{"id":"4","n"']


def test_parent_and_child_commit_repeats_cleanly(spark, rows, tmp_path):
    folders = (f"{tmp_path}/orders", f"{tmp_path}/items")
    items = rows("k int, n int", (1, 1), (1, 2), (2, 1), (9, 1))
    for batch_id, ids in ((0, [1]), (1, [2]), (1, [2])):
        commit_parent_and_child(rows("k int", *[(i,) for i in ids]), items, "k", folders, batch_id)
    assert values(spark.read.parquet(folders[0]), "k") == [(1,), (2,)]
    assert values(spark.read.parquet(folders[1]), "k", "n") == [(1, 1), (1, 2), (2, 1)]


def test_readers_see_both_parts_of_a_batch_or_neither(spark, rows, tmp_path):
    folders, log = (f"{tmp_path}/orders", f"{tmp_path}/items"), StateLog(spark, f"{tmp_path}/log")
    items = rows("k int, n int", (1, 1), (2, 1))
    seen = lambda: [values(df, "k") for df in read_committed(spark, folders, ("k int", "k int, n int"), log)]
    assert seen() == [[], []]
    commit_parent_and_child(rows("k int", (1,)), items, "k", folders, 0, log)
    with pytest.raises(Exception, match="died"):  # the children's part fails after the parents are written
        bad = items.withColumn("n", F.raise_error(F.lit("died")).cast("int"))
        commit_parent_and_child(rows("k int", (2,)), bad, "k", folders, 1, log)
    assert seen() == [[(1,)], [(1,)]]
    commit_parent_and_child(rows("k int", (2,)), items, "k", folders, 1, log)
    assert seen() == [[(1,), (2,)], [(1,), (2,)]]


def test_children_wait_for_late_parents(spark, rows, tmp_path):
    parent, child = "k int, p string", "k int, c int"
    join = WaitingJoin(spark, str(tmp_path / "j"), "k", rows(parent).schema, rows(child).schema)
    join.add(0, children=rows(child, (1, 10), (1, 11), (2, 20), (None, 99)))
    assert values(join.placed()) == [] and len(values(join.waiting())) == 4
    join.add(3, parents=rows(parent, (2, "two"), (5, "five")), children=rows(child, (5, 50), (6, 60)))
    assert values(join.placed()) == [(2, 20, "two"), (5, 50, "five")]
    join.add(4, parents=rows(parent, (1, "one"), (2, "again")))
    for _ in range(2):
        join.add(5, children=rows(child, (2, 21), (1, 12)))
    assert values(join.placed()) == [(1, 10, "one"), (1, 11, "one"), (1, 12, "one"), (2, 20, "two"), (2, 21, "two"), (5, 50, "five")]
    assert values(join.waiting()) == [(None, 99), (6, 60)]
    with pytest.raises(ValueError, match="comes after"):
        join.add(4, parents=rows(parent, (6, "six")))
    with pytest.raises(ValueError, match="both sides"):
        WaitingJoin(spark, str(tmp_path / "x"), "k", rows("k int, c int").schema, rows(child).schema)


def test_a_batch_that_died_is_replaced(spark, rows, tmp_path, monkeypatch):
    parent, child = "k int, p string", "k int, c int"
    join = WaitingJoin(spark, str(tmp_path / "j"), "k", rows(parent).schema, rows(child).schema)
    join.add(0, children=rows(child, (1, 10), (2, 20)))

    def died(*_, **__):
        raise OSError("died")

    with monkeypatch.context() as m:
        m.setattr(join.done, "put", died)
        with pytest.raises(OSError):
            join.add(1, parents=rows(parent, (1, "x"), (2, "x")))
    assert values(join.placed()) == [] and len(values(join.waiting())) == 2
    join.add(1, parents=rows(parent, (1, "y")))
    assert values(join.placed()) == [(1, 10, "y")] and values(join.waiting()) == [(2, 20)]


def test_waiting_for_a_parent_keeps_each_row_once(spark, rows, tmp_path):
    kids, parents = "k int, c int, ct timestamp", "k int, p string, pt timestamp"
    rows(kids, *[(i % 5, i, AT) for i in range(50)], (9, 0, AT)).write.parquet(f"{tmp_path}/kids")
    rows(parents, *[(i, f"p{i}", AT) for i in range(5)]).write.parquet(f"{tmp_path}/parents")
    read = lambda s, n: spark.readStream.schema(s).option("maxFileAge", "36500d").parquet(f"{tmp_path}/{n}")
    found = []
    for name, more in (("plain", {}), ("spread", {"spread": 4})):
        joined = join_when_parent_arrives(read(kids, "kids"), read(parents, "parents"), "k", "ct", "pt", "1 hour", **more)
        running = (joined.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp-{name}")
                   .trigger(availableNow=True).start(f"{tmp_path}/out-{name}"))
        running.awaitTermination()
        kept = max(p["stateOperators"][0]["numRowsTotal"] for p in running.recentProgress if p["stateOperators"])
        assert kept == 51 + 5 * more.get("spread", 1)
        found.append(values(spark.read.schema(joined.schema).parquet(f"{tmp_path}/out-{name}"), "k", "c", "p"))
    assert found[0] == found[1] and len(found[0]) == 50


def test_waiting_join_writes_who_is_placed_and_who_waits_at_once(spark, rows, tmp_path, monkeypatch):
    from tidemark.streaming import waiting
    kid, parent = rows("k int, c int", (1, 1), (2, 2), (None, 3), (1, 1)), rows("k int, p string", (1, "a"))
    join, written = WaitingJoin(spark, f"{tmp_path}/joined", "k", parent.schema, kid.schema), []
    plain = waiting.overwrite_batch
    monkeypatch.setattr(waiting, "overwrite_batch", lambda df, folder, *a: (written.append(folder), plain(df, folder, *a)))
    join.add(0, parents=parent, children=kid)
    assert len(written) == 3
    assert values(join.placed()) == [(1, 1, "a"), (1, 1, "a")] and values(join.waiting()) == [(None, 3), (2, 2)]
    join.add(1, parents=rows("k int, p string", (2, "b")))
    assert values(join.placed()) == [(1, 1, "a"), (1, 1, "a"), (2, 2, "b")] and values(join.waiting()) == [(None, 3)]


def test_parent_child_state_outgrows_no_heap(spark, rows, tmp_path):
    """On a session whose state would lie on the heap; repeated and null keys as in any join."""
    from pathlib import Path

    from tidemark.queries.streams import stream_parent_child
    provider = "spark.sql.streaming.stateStore.providerClass"
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://")) / "tidemark"
    (rows("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz",
          *[(k, 100 + n, "F", AT) for n, k in enumerate((1, 2, 2, None))]).write.parquet(f"{tmp_path}/orders.parquet"))
    (rows("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_extendedprice double, l_tax double, l_shipdate timestamp_ntz",
          *[(k, 5, 6, n, 1.5, 0.0, AT) for n, k in enumerate((1, 1, 2, 3, None))]).write.parquet(f"{tmp_path}/lineitem.parquet"))
    before, conf = set(shared.glob("stream-*")), spark.conf.getAll
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        heap = spark.conf.getAll
        got = values(stream_parent_child(spark, str(tmp_path)), "order_id", "order_item_id", "customer_id")
        assert spark.conf.getAll == heap
    finally:
        spark.conf.set(provider, conf[provider])
    assert got == [("1", 0, "100"), ("1", 1, "100"), ("2", 2, "101"), ("2", 2, "102")]
    (root,) = set(shared.glob("stream-*")) - before
    assert [f.name for f in (root / "checkpoint" / "offsets").iterdir() if not f.name.startswith(".")] == ["0"]
    kinds = {f.suffix for f in (root / "checkpoint" / "state").rglob("*") if f.is_file() and not f.name.startswith(".")}
    assert ".zip" in kinds and ".delta" not in kinds


def test_an_empty_batch_follows_if_asked_for(spark, rows, tmp_path):
    """Without it rows of later runs still meet those before them."""
    kids, parents = "k int, c int, ct timestamp", "k int, p string, pt timestamp"
    read = lambda s, n: spark.readStream.schema(s).option("maxFileAge", "36500d").parquet(f"{tmp_path}/{n}")
    found, conf = [], spark.conf.getAll
    for name, eager in (("eager", True), ("lazy", False)):
        rows(kids, (1, 10, AT), (2, 20, AT)).write.parquet(f"{tmp_path}/kids-{name}")
        rows(parents, (1, "a", AT)).write.parquet(f"{tmp_path}/parents-{name}")
        joined = join_when_parent_arrives(read(kids, f"kids-{name}"), read(parents, f"parents-{name}"), "k", "ct", "pt", "1 hour")
        go = lambda: run_to_folder(joined, f"{tmp_path}/out-{name}", f"{tmp_path}/cp-{name}", on_disk=True, eager=eager)  # noqa: B023, E731
        go()
        batches = [f.name for f in (tmp_path / f"cp-{name}" / "offsets").iterdir() if not f.name.startswith(".")]
        assert sorted(batches) == (["0", "1"] if eager else ["0"])
        rows(parents, (2, "b", AT + timedelta(minutes=1))).write.mode("append").parquet(f"{tmp_path}/parents-{name}")
        go()
        found.append(values(spark.read.schema(joined.schema).parquet(f"{tmp_path}/out-{name}"), "k", "c", "p"))
    assert found == [[(1, 10, "a"), (2, 20, "b")]] * 2 and spark.conf.getAll == conf
