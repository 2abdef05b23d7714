"""Loaded files go to the archive; none is lost or loaded twice."""

import glob
import os

import pytest
from conftest import values

from tidemark.plans.bronze import BronzeLoader
from tidemark.streaming import incremental

TABLE = "stream_order_payments"
COLUMNS = "order_id string, payment_sequential int"


def drop(rows, lake, day, *keys):
    frame = rows(COLUMNS, *[(k, 1) for k in keys])
    frame.coalesce(1).write.mode("append").parquet(f"{lake}/external_s3/stream_event=order_payments/batch_date={day}")


def names(folder):
    return {os.path.basename(f) for f in glob.glob(f"{folder}/**/*.parquet", recursive=True) if os.path.isfile(f)}


@pytest.fixture
def loader(spark, lake, tmp_path):
    return BronzeLoader(spark, lake, str(tmp_path / "wh"), max_files=1, archive=str(tmp_path / "old files"))


def test_loaded_files_leave_the_prefix(rows, lake, tmp_path, loader):
    came = set()
    for day in range(1, 5):
        drop(rows, lake, f"2024-01-0{day}", f"a{day}", f"b{day}")
        came |= names(lake)
        assert loader.load_table(TABLE) == 2
        assert len(names(lake)) == 1 and names(lake) | names(tmp_path / "old files") == came  # the last batch stays
    assert loader.load_table(TABLE) == 0
    assert [k for k, in values(loader.read(TABLE), "order_id")] == sorted(f"{x}{d}" for x in "ab" for d in range(1, 5))


def test_a_reset_takes_the_archive_again(rows, lake, loader):
    for day in (1, 2, 3):
        drop(rows, lake, f"2024-01-0{day}", f"a{day}")
        loader.load_table(TABLE)
    before = values(loader.ledger(TABLE), "file_key", "row_count")
    loader.reset([TABLE])
    assert loader.read(TABLE).count() == 0 and loader.load_table(TABLE) == 3
    assert values(loader.ledger(TABLE), "file_key", "row_count") == before
    drop(rows, lake, "2024-01-04", "a4")
    assert loader.load_table(TABLE) == 1 and loader.read(TABLE).count() == 4


@pytest.mark.parametrize("dies_at", [0, 1, 2])
def test_a_crash_loses_nothing(rows, lake, loader, monkeypatch, dies_at):
    """The load dies once its batch has its rows but no ledger; also while the archive is taken."""
    for day in (1, 2):
        drop(rows, lake, f"2024-01-0{day}", f"a{day}")
        loader.load_table(TABLE)
    loader.reset([TABLE])
    drop(rows, lake, "2024-01-03", "a3")
    real, calls = incremental.overwrite_batch, []

    def dying(df, folder, batch_id, *partitions):
        if folder.endswith("ledger"):
            calls.append(batch_id)
            if len(calls) == dies_at + 1:
                raise OSError("died")
        return real(df, folder, batch_id, *partitions)

    with monkeypatch.context() as m:
        m.setattr(incremental, "overwrite_batch", dying)
        with pytest.raises(Exception, match="died"):
            loader.load_table(TABLE)
    loader.load_table(TABLE)
    assert values(loader.read(TABLE), "order_id") == [("a1",), ("a2",), ("a3",)]
    assert loader.ledger(TABLE).count() == 3
