"""Sources, sinks and loading, on a lake of its own."""

import json
import os
import time
from datetime import datetime, timezone
from decimal import Decimal
from pathlib import Path

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import values
from tidemark.operators.changes import content_fingerprint
from tidemark.plans.bronze import SOURCES, BronzeLoader, Source, reset_tables
from tidemark.plans.extract import Extractor, manifest, refresh_endpoint, sync_drop
from tidemark.sinks import (
    StateLog, UnknownColumnsError, VersionedTable, conform, land_delta, land_snapshot, seed_if_empty,
    snapshot_if_changed,
)
from tidemark.sinks.landing import DROPS, ENDPOINTS, place
from tidemark.sinks.state import LostRace
from tidemark.sources import (
    describe_columns, last_modified, list_files, modified_since, newest_snapshot, query, read_csv_table,
    read_files, read_json_dump, read_json_pages, tables_present, tagged_latest, unprocessed_files,
)
from tidemark.sources.files import create_new
from tidemark.sources.tables import child_delta_sql, jdbc_options
from tidemark.streaming import IncrementalTable, load_incremental

T0 = 1_750_000_000


def put(df, path, at):
    """One Parquet file by a foreign writer at ``path``, modified ``at`` seconds."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    df.toPandas().to_parquet(path, index=False)
    os.utime(path, (T0 + at, T0 + at))


def test_newest_snapshot_by_time_and_by_partition(spark, rows, lake):
    base = f"{lake}/t"
    put(rows("a int", (1,)), f"{base}/snapshot_date=2026-08-22/snapshot_1.parquet", 10)
    put(rows("a int", (2,)), f"{base}/snapshot_date=2026-08-24/snapshot_2.parquet", 40)
    put(rows("a int", (3,)), f"{base}/snapshot_date=2026-08-25/snapshot_3.parquet", 30)
    assert "2026-08-24" in newest_snapshot(spark, base)
    assert "2026-08-25" in newest_snapshot(spark, base, by="partition")
    with pytest.raises(FileNotFoundError):
        newest_snapshot(spark, f"{lake}/none")
    with pytest.raises(ValueError):
        newest_snapshot(spark, base, by="name")
    listed = list_files(spark, base)
    assert listed.count() == 3 and listed.where("length > 0").count() == 3
    assert list_files(spark, f"{lake}/none").count() == 0


def test_newest_snapshot_takes_all_parts(spark, rows, lake):
    df = spark.range(100).repartition(4)
    land_snapshot(df, lake, "t", datetime(2026, 8, 24, 1, 2, 3))
    path = newest_snapshot(spark, f"{lake}/postgres/snapshots/table_name=t")
    assert path.endswith("snapshot_date=2026-08-24/snapshot_010203.parquet")
    assert read_files(spark, [path]).count() == 100


def test_tagged_latest(spark, rows, lake):
    with pytest.raises(FileNotFoundError):
        tagged_latest(spark, lake)
    put(rows("a int", (1,)), f"{lake}/geo_old_2026.parquet", 1)
    with pytest.raises(FileNotFoundError):
        tagged_latest(spark, lake)
    rows("a int", (2,)).write.parquet(f"{lake}/geo_latest.parquet")
    path = tagged_latest(spark, lake)
    assert path.endswith("geo_latest.parquet") and values(read_files(spark, [path]), "a") == [(2,)]
    put(rows("a int", (3,)), f"{lake}/a_latest.parquet", 1)
    assert tagged_latest(spark, lake).endswith("/a_latest.parquet")


def test_read_files_unites_columns_and_names_the_file(spark, rows, lake):
    put(rows("a int, b int", (1, 2)), f"{lake}/x.parquet", 1)
    put(rows("a int, c int", (3, 4)), f"{lake}/y.parquet", 1)
    df = read_files(spark, [f"{lake}/x.parquet", f"{lake}/y.parquet"])
    assert values(df, "a", "b", "c") == [(1, 2, None), (3, None, 4)]
    assert {os.path.basename(r["_source_file"]) for r in df.collect()} == {"x.parquet", "y.parquet"}
    assert read_files(spark, []).count() == 0


def test_modified_since_is_strict(spark, rows, lake):
    put(rows("a int", (1,)), f"{lake}/x.parquet", 0)
    put(rows("a int", (2,)), f"{lake}/y.parquet", 60)
    at = lambda s: int((T0 + s) * 1_000_000)
    assert last_modified(spark, lake) == at(60)
    assert values(modified_since(spark, lake, at(0), at(60)), "a") == [(2,)]
    assert values(modified_since(spark, lake, at(-1), at(60)), "a") == [(1,), (2,)]
    assert values(modified_since(spark, lake, at(-1), at(59)), "a") == [(1,)]
    assert modified_since(spark, lake, at(60), at(99)).count() == 0


@pytest.fixture(params=["UTC", "Asia/Tokyo", "America/New_York"])
def zone(request, spark, monkeypatch):
    """Driver and session in a time zone."""
    before = spark.conf.get("spark.sql.session.timeZone")
    monkeypatch.setenv("TZ", request.param)
    time.tzset()
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)
    monkeypatch.undo()
    time.tzset()


def test_sync_drop_in_any_zone(spark, rows, lake, tmp_path, zone):
    state, inbox = StateLog(spark, f"{lake}/state"), str(tmp_path / "inbox")
    for k in range(3):
        put(rows("a int", (k,)), f"{inbox}/t/batch_date=2024-01-0{k + 1}/f{k}.parquet", 2 * k)
        assert sync_drop(spark, inbox, lake, "t", state)
        assert not sync_drop(spark, inbox, lake, "t", state)
    landed = spark.read.parquet(place(lake, DROPS, "t"))
    assert sorted((r["a"], str(r["batch_date"])) for r in landed.collect()) == [(k, f"2024-01-0{k + 1}") for k in range(3)]


def test_sync_drop_repeated_after_a_crash(spark, rows, lake, tmp_path):
    """Dying before the progress is saved adds nothing, even if more has been dropped since."""
    class Dying(StateLog):
        def put(self, name, value, after=None):
            raise OSError("died")

    inbox, state = str(tmp_path / "inbox"), StateLog(spark, f"{lake}/state")
    put(rows("a int", (1,)), f"{inbox}/t/f.parquet", 0)
    with pytest.raises(OSError):
        sync_drop(spark, inbox, lake, "t", Dying(spark, f"{lake}/state"))
    folder = Path(place(lake, DROPS, "t"))
    first = sorted(p.name for p in folder.rglob("part-*"))
    put(rows("a int", (2,)), f"{inbox}/t/g.parquet", 5)
    assert sync_drop(spark, inbox, lake, "t", state) and sorted(p.name for p in folder.rglob("part-*")) == first
    assert sync_drop(spark, inbox, lake, "t", state) and not sync_drop(spark, inbox, lake, "t", state)
    assert values(spark.read.parquet(str(folder)), "a") == [(1,), (2,)]


def test_sync_drop_goes_by_the_manifest(spark, rows, lake, tmp_path):
    """Equal times, an older time, a file replaced in place, many files, and nothing new."""
    inbox, state = str(tmp_path / "inbox"), StateLog(spark, f"{lake}/state")
    got = lambda: [r["a"] for r in spark.read.parquet(place(lake, DROPS, "t")).orderBy("synced", "a").collect()]
    assert not sync_drop(spark, inbox, lake, "t", state)
    for a, name, at in ((1, "f", 50), (2, "g", 50), (3, "h", -9000), (4, "f", 51), (5, "f", 20)):
        put(rows("a int", (a,)), f"{inbox}/t/{name}.parquet", at)
        assert sync_drop(spark, inbox, lake, "t", state) and not sync_drop(spark, inbox, lake, "t", state)
    assert got() == [1, 2, 3, 4, 5]
    for a in range(6, 13):
        put(rows("a int", (a,)), f"{inbox}/t/batch_date=2024-01-01/m{a}.parquet", 50)
    assert sync_drop(spark, inbox, lake, "t", state, max_files=3)
    assert sorted(got()) == list(range(1, 13)) and manifest(spark, state, "t").count() == 12
    assert state.get("t") == "8"  # five, then three runs of at most three files


def test_sync_drop_of_two_at_once(spark, rows, lake, tmp_path):
    class Slow(StateLog):
        def put(self, name, value, after=None):
            StateLog.put(self, name, value, after)  # the other one was faster
            return super().put(name, value, after)

    inbox = str(tmp_path / "inbox")
    put(rows("a int", (1,)), f"{inbox}/t/f.parquet", 0)
    with pytest.raises(LostRace):
        sync_drop(spark, inbox, lake, "t", Slow(spark, f"{lake}/state"))
    assert not sync_drop(spark, inbox, lake, "t", StateLog(spark, f"{lake}/state"))
    assert values(spark.read.parquet(place(lake, DROPS, "t")), "a") == [(1,)]


def test_sync_drop_of_nanosecond_files(spark, lake, tmp_path):
    folder = tmp_path / "inbox/t"
    folder.mkdir(parents=True)
    pd.DataFrame({"at": pd.to_datetime(["2024-01-01 10:00:00.123456789"])}).to_parquet(folder / "f.parquet")
    assert sync_drop(spark, str(tmp_path / "inbox"), lake, "t", StateLog(spark, f"{lake}/state"))


def test_half_written_datasets_are_passed_over(spark, rows, lake):
    rows("a int", (1,), (2,)).write.parquet(f"{lake}/snapshot_date=2024-01-01/snapshot_1.parquet")
    rows("a int", (3,)).write.parquet(f"{lake}/snapshot_date=2024-01-02/snapshot_1.parquet")
    Path(f"{lake}/snapshot_date=2024-01-02/snapshot_1.parquet/_SUCCESS").unlink()
    for by in ("mtime", "partition"):
        assert "2024-01-01" in newest_snapshot(spark, lake, by)
    rows("a int", (4,)).write.parquet(f"{lake}/a_latest.parquet")
    rows("a int", (5,)).write.parquet(f"{lake}/b_latest.parquet")
    Path(f"{lake}/a_latest.parquet/_SUCCESS").unlink()
    assert tagged_latest(spark, lake).endswith("b_latest.parquet")


def test_failed_refresh_keeps_the_present_table(spark, rows, lake):
    """A source that fails in its last partition, first over nothing, then over a table."""
    bad = lambda: spark.range(0, 8, 1, 4).selectExpr("IF(id = 7, raise_error('gone'), id) AS a")
    good = lambda *x: (lambda: rows("a long", *[(v,) for v in x]))
    for _ in range(2):
        with pytest.raises(Exception, match="gone"):
            refresh_endpoint(spark, bad, lake, "t")
    assert refresh_endpoint(spark, good(1), lake, "t")
    latest = tagged_latest(spark, place(lake, ENDPOINTS, "t"))
    with pytest.raises(Exception, match="gone"):
        refresh_endpoint(spark, bad, lake, "t", force=True)
    assert values(spark.read.parquet(latest)) == [(1,)]
    assert not refresh_endpoint(spark, good(), lake, "t", force=True) and values(spark.read.parquet(latest)) == [(1,)]
    assert refresh_endpoint(spark, good(2), lake, "t", force=True) and values(spark.read.parquet(latest)) == [(2,)]


def test_state_is_compacted_and_versions_expire(spark, rows, lake):
    state = StateLog(spark, f"{lake}/state")
    for v in range(5):
        state.put("a", str(v))
    state.put("b", "x")
    state.compact("a")
    assert state.get("a") == "4" and state.get("b") == "x"
    assert len(list(Path(f"{lake}/state/of=a").glob("seq-*"))) == 1
    state.put("a", "5")
    assert state.get("a") == "5"
    table = VersionedTable(spark, f"{lake}/t")
    for v in range(4):
        table.replace(rows("a int", (v,)))
    assert table.expire(keep=2) == 2 and table.expire(keep=2) == 0
    assert values(table.read()) == [(3,)] and len(list(Path(f"{lake}/t").glob("version=*"))) == 2


def test_moved_value_is_a_change(rows):
    a = content_fingerprint(rows("x int, y int", (1, None))).first()["version"]
    assert a != content_fingerprint(rows("x int, y int", (None, 1))).first()["version"]


def test_jdbc_reads_are_split_or_asked_for(rows):
    assert jdbc_options("jdbc:u", "t", split_on="id", lower=1, upper=9, splits=4)["numPartitions"] == "4"
    assert "numPartitions" not in jdbc_options("jdbc:u", "t", one_task=True)
    for wrong in ({}, {"split_on": "id"}, {"split_on": "id", "lower": 1, "upper": 2, "one_task": True}):
        with pytest.raises(ValueError):
            jdbc_options("jdbc:u", "t", **wrong)
    sent = child_delta_sql("order_items", "orders", "order_id", "bought_at", "2024-01-01 00:00:00")
    assert "JOIN orders p ON c.order_id = p.order_id" in sent and "p.bought_at > TIMESTAMP '2024-01-01 00:00:00'" in sent
    with pytest.raises(ValueError):
        child_delta_sql("a; DROP TABLE b", "orders", "order_id", "t", "x")


def test_malformed_input_is_an_error(spark, tmp_path):
    (tmp_path / "cut.json").write_text('[{"a": "x", "b": 1}]\n[{"a": "y", "b": 2}, {"a')
    (tmp_path / "word.json").write_text('[{"a": "x", "b": "notint"}]\n')
    for name in ("cut", "word"):
        with pytest.raises(Exception, match="MALFORMED_RECORD"):
            read_json_dump(spark, f"{tmp_path}/{name}.json", "a string, b int").collect()
    (tmp_path / "a.csv").write_text("id,v\n1,2\nx,3\n")
    (tmp_path / "b.csv").write_text("id,v\n1,2,9\n")
    for name in ("a", "b"):
        with pytest.raises(Exception, match="MALFORMED"):
            read_csv_table(spark, f"{tmp_path}/{name}.csv", "id int, v int").collect()


def test_conform(rows):
    df = conform(rows("order_id string, payment_value string, _source_file string", ("a", "1.005", "f")),
                 "stream_order_payments")
    row = df.first()
    assert (row["payment_value"], row["payment_type"], row["_source_file"]) == (Decimal("1.01"), None, "f")
    assert row["_ingested_at"] is not None
    with pytest.raises(UnknownColumnsError, match="colour"):
        conform(rows("order_id string, colour string", ("a", "b")), "stream_order_payments")
    with pytest.raises(PySparkException, match="too long"):
        conform(rows("order_id string", ("x" * 65,)), "pg_orders").collect()
    with pytest.raises(PySparkException):
        conform(rows("payment_sequential string", ("one",)), "stream_order_payments").collect()
    times = conform(rows("order_id string, order_approved_at string", ("a", "NaT"), ("b", "2024-01-01 10:00:00")), "pg_orders")
    assert values(times, "order_id", "order_approved_at") == [("a", None), ("b", datetime(2024, 1, 1, 10))]


def test_state_log(spark, lake):
    state = StateLog(spark, f"{lake}/state")
    assert state.get("t") is None and state.get("t", "epoch") == "epoch"
    for v in ("5", "9", "7"):
        state.put("t", v)
    state.put("u", "1")
    assert state.get("t") == "7" and state.get("u") == "1"


def test_state_goes_by_number_not_by_clock(spark, lake):
    at = lambda h: lambda: datetime(2026, 1, 1, h, tzinfo=timezone.utc)
    one, two = StateLog(spark, f"{lake}/state", at(9)), StateLog(spark, f"{lake}/state", at(3))
    one.put("t", "old")
    two.put("t", "new")
    assert one.get("t") == two.get("t") == "new" and one.all() == {"t": "new"}
    assert [r["value"] for r in one.entries("t").orderBy("seq").collect()] == ["old", "new"]
    seen = one.last("t").seq
    two.put("t", "newer", after=seen)
    for late in (lambda: one.put("t", "lost", after=seen), lambda: one.put("u", "x", after=1)):
        with pytest.raises(LostRace):
            late()
    assert one.get("t") == "newer"


def test_state_of_two_that_take_the_same_number(spark, lake, monkeypatch):
    one, two = StateLog(spark, f"{lake}/state"), StateLog(spark, f"{lake}/state")
    one.put("t", "a")
    numbers = two._numbers("t")
    one.put("t", "b")
    monkeypatch.setattr(two, "_numbers", lambda name: numbers)  # it looked before
    with pytest.raises(LostRace):
        two.put("t", "c")
    assert one.get("t") == "b"


def test_state_that_was_cut_off(spark, lake):
    state = StateLog(spark, f"{lake}/state")
    state.put("t", "a")
    Path(f"{lake}/state/of=t/seq-000000000002.json").write_text('{"value": "b", "upd')
    Path(f"{lake}/state/of=t/seq-000000000003.json").write_text("")
    assert state.get("t") == "a" and state.last("t").seq == 1
    state.put("t", "c")
    assert state.get("t") == "c" and state.last("t").seq == 4


def test_values_come_into_force_together(spark, lake, monkeypatch):
    state = StateLog(spark, f"{lake}/state")
    state.put("a", "1")
    state.put_all({"a": "2", "b": "2"})
    assert state.all() == {"a": "2", "b": "2"}
    monkeypatch.setattr("tidemark.sinks.state.create_new", lambda spark, path, text: "/together/" not in path and create_new(spark, path, text))
    state.put_all({"a": "3", "b": "3"})  # dies before the group's file is there
    assert state.all() == {"a": "2", "b": "2"}
    monkeypatch.undo()
    state.put("b", "4")
    assert state.all() == {"a": "2", "b": "4"}
    state.put("a/b=c d", "x")
    assert state.get("a/b=c d") == "x" and "a/b=c d" in state.names()


def test_versioned_table(spark, rows, lake):
    table = VersionedTable(spark, f"{lake}/t")
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.write_once(rows("a int", (1,))) == 1
    assert table.write_once(rows("a int", (2,))) == 0
    first = table.current()
    assert table.replace(rows("a int", (3,), (4,))) == 2
    assert table.replace(rows("a int", (3,)).where("a > 9")) == 0
    assert values(table.read()) == [(3,), (4,)] and values(table.read(first)) == [(1,)]
    # a replacement may be computed from the table itself
    table.replace(table.read().withColumn("a", F.col("a") * 10))
    assert values(table.read()) == [(30,), (40,)]
    table.stage(rows("a int", (99,)))
    assert values(table.read()) == [(30,), (40,)]


def test_delta_lands_once_and_moves_the_watermark(spark, rows, lake):
    state = StateLog(spark, f"{lake}/metadata")
    at = lambda d: datetime(2024, 1, d)
    orders = rows("order_id string, ts timestamp_ntz", ("a", at(1)), ("b", at(2)))
    assert land_delta(orders, "ts", lake, "orders", state) == "2024-01-02 00:00:00"
    assert land_delta(orders, "ts", lake, "orders", state) is None
    more = orders.union(rows("order_id string, ts timestamp_ntz", ("late", at(1)), ("edge", at(2)), ("c", at(3))))
    land_delta(more, "ts", lake, "orders", state)
    landed = spark.read.parquet(f"{lake}/postgres/batches/table_name=orders")
    assert values(landed, "order_id") == [("a",), ("b",), ("c",)]
    items = rows("order_id string, n int", ("a", 1), ("c", 1), ("c", 2))
    assert land_delta(items, "ts", lake, "items", state, parent=more, on="order_id") == "2024-01-03 00:00:00"
    assert spark.read.parquet(f"{lake}/postgres/batches/table_name=items").columns == ["order_id", "n", "batch_date"]


def test_snapshot_if_changed(spark, rows, lake):
    state = StateLog(spark, f"{lake}/metadata")
    df = rows("id int, v string", (1, "a"), (2, "b"))
    take = lambda d, h, c=None, t="t": snapshot_if_changed(d, lake, t, state, c, datetime(2026, 1, 1, h))
    assert take(df, 1) and not take(df, 2) and take(df.where("id = 2"), 3)
    assert take(df, 1, "id", "u") and not take(df.where("id = 2"), 2, "id", "u")


def test_unprocessed(spark, rows):
    listing = rows("path string", ("a",), ("b",))
    ledger = rows("table_name string, file_key string", ("t", "a"), ("u", "b"))
    assert values(unprocessed_files(listing, ledger, "t")) == [("b",)]


def drop(df, lake, event, name, at=0):
    put(df, f"{lake}/external_s3/stream_event={event}/batch_date=2024-01-01/{name}.parquet", at)


PAY = "order_id string, payment_sequential bigint, payment_value double"


def test_incremental_load_is_exactly_once(spark, rows, lake, tmp_path):
    loader = BronzeLoader(spark, lake, str(tmp_path / "wh"), max_files=2)
    t = "stream_order_payments"
    for i in range(5):
        drop(rows(PAY, (f"o{i}", 1, 1.5), (f"o{i}", 2, 2.5)), lake, "order_payments", f"b{i}")
    drop(rows(PAY, ("x", 1, 1.0)).where("false"), lake, "order_payments", "empty")
    assert loader.load_table(t) == 10
    assert loader.load_table(t) == 0
    drop(rows(PAY, ("o9", 1, 9.0)), lake, "order_payments", "b9")
    assert loader.load_table(t) == 1
    assert loader.read(t).count() == 11 and loader.read(t).distinct().count() == 11
    assert values(loader.ledger(t).groupBy("table_name").agg(F.count("*"), F.sum("row_count"))) == [(t, 6, 11)]
    loader.reset([t])
    assert loader.read(t).count() == 0 and loader.ledger(t).count() == 0
    assert loader.load_table(t) == 11


def test_crash_between_data_and_ledger_is_repeated(spark, rows, lake, tmp_path, monkeypatch):
    target = IncrementalTable(spark, str(tmp_path / "wh"), "stream_order_payments")
    prefix = f"{lake}/external_s3/stream_event=order_payments"
    drop(rows(PAY, ("a", 1, 1.0)), lake, "order_payments", "b0")
    from tidemark.streaming import incremental
    real, calls = incremental.overwrite_batch, []

    def fail_on_ledger(df, folder, batch_id):
        calls.append(folder)
        if len(calls) == 2:
            raise RuntimeError("lost")
        real(df, folder, batch_id)

    monkeypatch.setattr(incremental, "overwrite_batch", fail_on_ledger)
    with pytest.raises(Exception, match="lost"):
        load_incremental(target, prefix)
    assert target.read().count() == 1 and target.ledger().count() == 0
    drop(rows(PAY, ("b", 1, 1.0)), lake, "order_payments", "b1")
    load_incremental(target, prefix)
    assert values(target.read(), "order_id") == [("a",), ("b",)]
    assert target.ledger().count() == 2


def test_unknown_column_sets_the_file_aside(spark, rows, lake, tmp_path):
    """Among good files: they load and are in the ledger, the other is reported once."""
    loader = BronzeLoader(spark, lake, str(tmp_path / "wh"))
    for k in range(3):
        drop(rows("order_id string", (f"o{k}",)), lake, "order_payments", f"b{k}")
    drop(rows("order_id string, colour string", ("a", "red")), lake, "order_payments", "bad")
    row = loader.run(["stream_order_payments"]).first()
    assert (row["status"], row["row_count"]) == ("loaded", 3) and "colour" in row["message"] and "bad" in row["message"]
    assert loader.ledger("stream_order_payments").count() == 3
    assert [r["message"] for r in loader.rejected("stream_order_payments").collect()] == ["stream_order_payments has no column colour"]
    assert loader.run(["stream_order_payments"]).first()["message"] is None and loader.read("stream_order_payments").count() == 3


def test_nothing_arrived_is_no_failure(spark, lake, tmp_path):
    loader = BronzeLoader(spark, lake, str(tmp_path / "wh"))
    row = loader.run(["stream_order_payments"]).first()
    assert (row["status"], row["row_count"]) == ("loaded", 0)


def test_a_load_reads_only_its_own_batches(spark, rows, lake, tmp_path):
    """However many batches came before, a load touches the folder of its own."""
    target = IncrementalTable(spark, str(tmp_path / "wh"), "stream_order_payments")
    for k in range(3):
        put(rows("order_id string", (f"o{k}",)), f"{lake}/f{k}.parquet", k)
        target.load_batch([f"{lake}/f{k}.parquet"], k)
    # Earlier batches turned unreadable do no harm to a later one.
    for part in Path(f"{target.data}/_batch_id=0").glob("part-*"):
        part.write_bytes(b"gone")
    put(rows("order_id string", ("o9",)), f"{lake}/f9.parquet", 9)
    target.load_batch([f"{lake}/f9.parquet"], 9)
    assert target.ledger().count() == 4


def test_load_at_an_interval(spark, rows, lake, tmp_path):
    """The running query picks up what arrives later, and stops."""
    target = IncrementalTable(spark, str(tmp_path / "wh"), "stream_order_payments")
    put(rows("order_id string", ("a",)), f"{lake}/f0.parquet", 0)
    running = load_incremental(target, lake, interval="1 second")
    try:
        running.processAllAvailable()
        assert target.read().count() == 1
        put(rows("order_id string", ("b",)), f"{lake}/f1.parquet", 5)
        running.processAllAvailable()
        assert values(target.read(), "order_id") == [("a",), ("b",)]
    finally:
        running.stop()
    assert not running.isActive


def test_text_times_of_pushed_files(spark, rows, lake, tmp_path):
    loader = BronzeLoader(spark, lake, str(tmp_path / "wh"))
    drop(rows("review_id string, review_creation_date string, review_score bigint",
              ("r", "2024-01-01 10:00:00", 5), ("s", "NaT", 4)), lake, "order_reviews", "b0")
    assert loader.load_table("stream_order_reviews") == 2
    assert values(loader.read("stream_order_reviews"), "review_id", "review_creation_date") == [
        ("r", datetime(2024, 1, 1, 10)), ("s", None)]


def test_files_of_another_writer(spark, lake, tmp_path):
    """Nanosecond times, columns without a value, whole numbers as floats."""
    import numpy as np
    import pandas as pd

    base = f"{lake}/postgres/batches/table_name=orders/batch_date=2024-01-01"
    os.makedirs(base)
    at = np.array(["2024-03-31T02:30:00.123456", "NaT"], dtype="datetime64[ns]")
    pd.DataFrame({"order_id": ["a", "b"], "order_purchase_timestamp": at,
                  "order_approved_at": pd.Series([None, None], dtype=object)}).to_parquet(f"{base}/batch_1.parquet")
    pd.DataFrame({"order_id": ["c"], "order_approved_at": ["2024-01-01 00:00:00"]}).to_parquet(f"{base}/batch_2.parquet")
    loader = BronzeLoader(spark, lake, str(tmp_path / "wh"))
    assert loader.load_table("pg_orders") == 3
    assert values(loader.read("pg_orders"), "order_id", "order_purchase_timestamp", "order_approved_at") == [
        ("a", datetime(2024, 3, 31, 2, 30, 0, 123456), None), ("b", None, None), ("c", None, datetime(2024, 1, 1))]


def test_run_isolates_failures_and_keeps_old_rows(spark, rows, lake, tmp_path):
    sources = {"pg_customers": SOURCES["pg_customers"], "pg_sellers": SOURCES["pg_sellers"],
               "pg_products": Source("by_magic", "x/")}
    loader = BronzeLoader(spark, lake, str(tmp_path / "wh"), sources)
    land_snapshot(rows("customer_id string", ("a",), ("b",)), lake, "customers", datetime(2026, 1, 1))
    outcome = {r["table_name"]: (r["status"], r["row_count"], (r["message"] or "")[:17]) for r in loader.run().collect()}
    assert outcome == {"pg_customers": ("loaded", 2, ""), "pg_sellers": ("failed", None, "FileNotFoundError"),
                       "pg_products": ("failed", None, "ValueError: unkno")}
    time.sleep(1.1)
    land_snapshot(rows("customer_id string", ("a",)).where("false"), lake, "customers", datetime(2026, 1, 2))
    assert loader.load_table("pg_customers") == 0
    assert values(loader.read("pg_customers"), "customer_id") == [("a",), ("b",)]
    with pytest.raises(KeyError):
        loader.load_table("pg_unheard_of")
    assert [r["table_name"] for r in loader.run(["pg_customers"]).collect()] == ["pg_customers"]


def page(n, limit, total):
    data = [{"zip": str(i), "lat": i + 0.5} for i in range((n - 1) * limit, min(n * limit, total))]
    more = f"?page={n + 1}" if len(data) == limit else None
    return {"page": n, "limit": limit, "count": len(data), "next_url": more, "data": data}


@pytest.mark.parametrize("total", [0, 3, 20, 21])
def test_paged_json(spark, tmp_path, total):
    n = 1
    while True:  # as a client following next_url would land them
        content = page(n, 5, total)
        (tmp_path / f"page-{n}.json").write_text(json.dumps(content, indent=1))
        n += 1
        if content["next_url"] is None:
            break
    landed = lambda: read_json_pages(spark, f"{tmp_path}/page-*.json", "zip string, lat double", one_document=True)
    assert values(landed()) == sorted((str(i), i + 0.5) for i in range(total))
    for missing in range(1, n):  # any page but a lone empty one
        if total:
            kept = (tmp_path / f"page-{missing}.json").rename(tmp_path / "away")
            if missing < n - 1 or total % 5 == 0 or n > 2:
                with pytest.raises(ValueError):
                    landed()
            kept.rename(tmp_path / f"page-{missing}.json")


def test_json_dump_of_one_document(spark, tmp_path):
    (tmp_path / "t.json").write_text(json.dumps([{"a": "x", "b": 1}, {"a": "y"}], indent=2))
    assert values(read_json_dump(spark, f"{tmp_path}/t.json", "a string, b int", one_document=True)) == [("x", 1), ("y", None)]


def test_csv(spark, tmp_path):
    (tmp_path / "o.csv").write_text("id,at\n1,2024-01-01 00:00:00\n2,soon\n")
    df = read_csv_table(spark, f"{tmp_path}/o.csv", "id int, at string", ["at"])
    assert values(df) == [(1, datetime(2024, 1, 1)), (2, None)]


def test_catalog_tables(spark, rows):
    spark.sql("CREATE DATABASE IF NOT EXISTS oltp")
    spark.sql("CREATE TABLE oltp.customers (id INT, name STRING) USING parquet")
    master = rows("id int, name string", (1, "a"), (2, "b"))
    assert seed_if_empty(spark, "oltp.customers", master)
    assert not seed_if_empty(spark, "oltp.customers", master)
    found, missing = tables_present(spark, "oltp", ["customers", "sellers"])
    assert found["customers"].count() == 2 and missing == ["sellers"]
    assert values(describe_columns(spark, "oltp"), "column_name", "data_type") == [("id", "int"), ("name", "string")]
    assert query(spark, "SELECT * FROM {t} WHERE id > :low", {"low": 1}, t=found["customers"]).count() == 1
    reset_tables(spark, "oltp", ["customers"])
    assert spark.table("oltp.customers").isEmpty()
    reset_tables(spark, "oltp", ["customers"], drop=True)
    assert not spark.catalog.tableExists("oltp.customers")
    spark.sql("DROP DATABASE oltp")


def test_extractor(spark, rows, tmp_path):
    at = lambda d: datetime(2024, 1, d)
    lake, inbox = str(tmp_path / "lake"), str(tmp_path / "inbox")
    tables = {
        "customers": rows("customer_id string", ("a",)),
        "orders": rows("order_id string, order_purchase_timestamp timestamp_ntz", ("o", at(1))),
        "order_items": rows("order_id string, order_item_id int", ("o", 1), ("early", 1)),
        "products": rows("product_id string", ("p",)),
    }
    asked = []

    def words():
        asked.append(1)
        return rows("product_category_name string", ("x",))

    def broken():
        raise OSError("no answer")

    rows("order_id string", ("o",)).write.parquet(f"{inbox}/order_payments")
    job = Extractor(spark, lake, tables.get, inbox, {"translations": words, "geolocation": broken})
    status = lambda df: {r["name"]: r["status"] for r in df.collect()}
    assert status(job.run()) == {
        "customers": "landed", "sellers": "missing", "products": "landed", "orders": "landed",
        "order_items": "landed", "order_payments": "landed", "order_reviews": "unchanged",
        "translations": "landed", "geolocation": "failed"}
    assert set(status(job.run(["snapshot", "delta", "drop"])).values()) <= {"unchanged", "missing"}
    assert status(job.run(["translations"])) == {"translations": "unchanged"} and len(asked) == 1
    assert status(job.run(["translations"], force=True)) == {"translations": "landed"} and len(asked) == 2
    names = {p.name[:17] for p in (tmp_path / "lake/api/api_endpoint=translations").iterdir() if p.is_dir()}
    assert names == {"translations_late", "translations_old_"}

    loader = BronzeLoader(spark, lake, str(tmp_path / "wh"))
    loaded = {r["table_name"]: r["row_count"] for r in loader.run().collect() if r["status"] == "loaded"}
    assert loaded == {"api_translations": 1, "pg_customers": 1, "pg_products": 1, "pg_orders": 1,
                      "pg_order_items": 1, "stream_order_payments": 1, "stream_order_reviews": 0}
