"""Progress of extracts: one current value per table."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from datetime import datetime, timezone
from typing import NamedTuple
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession

from ..sources.files import create_new, list_names, read_text, remove


class LostRace(RuntimeError):
    """Another writer has given the name a value since this one looked."""


class Entry(NamedTuple):
    """``seq`` is 0 and ``value`` None before the first value."""

    seq: int
    value: str | None
    updated_at: datetime | None = None


class StateLog:
    """Values are appended, and of each name the one with the greatest number is in force.

    Numbers go up by one per name and are part of the file's name, which is created only
    if it is not there yet: of two writers that saw the same last value one fails with
    ``LostRace``. No clock takes part; the time of an entry is kept for people to read.
    A writer that dies half-way leaves an entry that cannot be read, and so the previous
    value in force. Every name has a folder of its own, and different names may be
    written at the same time.
    """

    SCHEMA = "name string, seq bigint, value string, updated_at timestamp"

    def __init__(self, spark: SparkSession, folder: str, clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc)):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.clock = clock

    def _of(self, name: str) -> str:
        return f"{self.folder}/of={quote(name, safe='')}"

    def _numbers(self, name: str) -> list[int]:
        return sorted(int(n[4:-5]) for n in list_names(self.spark, self._of(name)) if n.startswith("seq-"))

    def _together(self) -> set[str]:
        return set(list_names(self.spark, f"{self.folder}/together"))

    def _entry(self, name: str, seq: int, together: set[str]) -> Entry | None:
        """The entry of that number, None if it is cut off or its group did not come into force."""
        try:
            row = json.loads(read_text(self.spark, f"{self._of(name)}/seq-{seq:012d}.json"))
        except ValueError:
            return None
        if row.get("together") and row["together"] not in together:
            return None
        return Entry(seq, row["value"], datetime.fromisoformat(row["updated_at"]))

    def last(self, name: str, together: set[str] | None = None) -> Entry:
        """What is in force."""
        together = self._together() if together is None else together
        found = (self._entry(name, seq, together) for seq in reversed(self._numbers(name)))
        return next((e for e in found if e is not None), Entry(0, None))

    def names(self) -> list[str]:
        return sorted(unquote(n[3:]) for n in list_names(self.spark, self.folder) if n.startswith("of="))

    def entries(self, name: str | None = None) -> DataFrame:
        """All values that are or were in force, of ``name`` or of every name, first to last."""
        together = self._together()
        rows = [
            (n, e.seq, e.value, e.updated_at)
            for n in (self.names() if name is None else [name])
            for e in (self._entry(n, seq, together) for seq in self._numbers(n)) if e is not None
        ]
        return self.spark.createDataFrame(rows, self.SCHEMA)

    def all(self) -> dict[str, str]:
        """The current value of every name; there is one per table."""
        together = self._together()
        found = {n: self.last(n, together).value for n in self.names()}
        return {n: v for n, v in found.items() if v is not None}

    def get(self, name: str, default: str | None = None) -> str | None:
        value = self.last(name).value
        return default if value is None else value

    def put(self, name: str, value: str, after: int | None = None) -> int:
        """A new value and its number. With ``after``, the number that the writer has seen
        in force, it fails if there is another value since."""
        if after is not None and (now := self.last(name).seq) != after:
            raise LostRace(f"'{name}' is at {now}, not at {after}")
        return self._append(name, value)

    def put_all(self, values: Mapping[str, str]) -> None:
        """Several values, which come into force together.

        Their entries are written first and name a group; they count from the moment at
        which the group's own file is there.
        """
        group = f"{uuid.uuid4().hex}.json"
        mine = {name: self._append(name, value, group) for name, value in values.items()}
        for name, seq in mine.items():
            if self._numbers(name)[-1] != seq:
                raise LostRace(f"'{name}' has got another value meanwhile")
        create_new(self.spark, f"{self.folder}/together/{group}", json.dumps(mine))

    def compact(self, name: str) -> None:
        """Delete the entries before the one in force."""
        last = self.last(name).seq
        remove(self.spark, *[f"{self._of(name)}/seq-{seq:012d}.json" for seq in self._numbers(name) if seq < last])

    def _append(self, name: str, value: str, together: str | None = None) -> int:
        seq = (self._numbers(name) or [0])[-1] + 1
        row = {"value": str(value), "updated_at": self.clock().isoformat(), "together": together}
        if not create_new(self.spark, f"{self._of(name)}/seq-{seq:012d}.json", json.dumps(row)):
            raise LostRace(f"another writer has taken number {seq} of '{name}'")
        return seq
