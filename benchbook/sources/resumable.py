"""A resumable source of cases as a Spark data source: windows of days are its partitions, a ledger in a shared folder keeps
what was found and what is done.

An adapter tells what a site lists in a window, and takes one item at a time to an outcome. A window's list is kept when it
was found, so a run that goes on doesn't ask for it again; an outcome is kept before the run ends, so a run that was
killed repeats at most the items of its last unwritten buffer, and none that the ledger calls DONE.
"""

from __future__ import annotations

import importlib
from collections.abc import Iterator
from contextlib import AbstractContextManager, nullcontext
from dataclasses import dataclass
from datetime import date, timedelta
from typing import Any, Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from benchbook.sources.shared_files import FLUSH_ROWS, FLUSH_SECONDS, Buffer, names, put_rows, rows_of, ship

# States of items, and why a case has no judgment.
DONE, FAILED = "DONE", "FAILED"
NOT_PUBLISHED, DOWNLOAD_FAILED = "NOT_PUBLISHED", "DOWNLOAD_FAILED"

SCHEMA = "first_day date, item_key string, status string, reason string, record string"
_FOUND = pa.schema([("item_key", pa.string()), ("payload", pa.string()), ("done_reason", pa.string())])
_LEDGER = pa.schema([("item_key", pa.string()), ("status", pa.string()), ("reason", pa.string()), ("record", pa.string())])


@dataclass
class Item:
    """A listed case. done_reason: why there's nothing left to do for it."""

    key: str
    payload: str
    done_reason: str | None = None


@dataclass
class Outcome:
    """A record (JSON), with the reason if its judgment is missing; or no record, with the reason why it's passed over."""

    record: str | None = None
    reason: str | None = None


class SourceError(Exception):
    """The site itself fails: the window ends here and the other items stay for the next run. status: the batch's new one."""

    status = "SOURCE_BLOCKED"


class RateLimited(SourceError):
    status = "RATE_LIMITED"


class Unavailable(SourceError):
    status = "SOURCE_UNAVAILABLE"


class StructureChanged(SourceError):
    status = "STRUCTURE_CHANGED"


class Adapter(Protocol):
    """Made from the source's options in each task."""

    def discover(self, first: date, last: date) -> list[Item]: ...

    def session(self) -> AbstractContextManager[Any]: ...

    def process(self, session: Any, item: Item) -> Outcome: ...


@dataclass
class Window(InputPartition):
    first: date
    last: date


def windows(first: date, last: date, days: int) -> list[Window]:
    """Consecutive windows of at most so many days."""
    starts = range(0, (last - first).days + 1, days)
    return [Window(first + timedelta(n), min(first + timedelta(n + days - 1), last)) for n in starts]


class _Work:
    """What batch and stream readers share: a window's items to outcomes. A window's list is what a task holds."""

    def __init__(self, options: dict[str, str]):
        self.options = dict(options)
        self.ledger = options["ledger"]
        self.first, self.last = date.fromisoformat(options["from"]), date.fromisoformat(options["to"])
        self.days = int(options.get("days", "30"))
        self.rows, self.seconds = int(options.get("flushrows", FLUSH_ROWS)), float(options.get("flushseconds", FLUSH_SECONDS))

    def adapter(self) -> Adapter:
        module, _, name = self.options["adapter"].partition(":")
        return getattr(importlib.import_module(module), name)(self.options)

    def found(self, adapter: Adapter, w: Window) -> list[Item]:
        """The window's list as it was kept first, of repeated keys the least payload; else found now and kept."""
        folder = f"{self.ledger}/found/first_day={w.first}"
        if names(folder):
            kept = [Item(r["item_key"], r["payload"], r["done_reason"]) for r in rows_of(folder, _FOUND.names)]
        else:
            kept = adapter.discover(w.first, w.last)
            put_rows(folder, [(i.key, i.payload, i.done_reason) for i in kept], _FOUND)  # a file without rows: found empty
        unique: dict[str, Item] = {}
        for item in sorted(kept, key=lambda i: (i.key, i.payload)):
            unique.setdefault(item.key, item)
        return list(unique.values())

    def read(self, w: Window) -> Iterator[tuple]:
        adapter, folder = self.adapter(), f"{self.ledger}/outcomes/first_day={w.first}"
        done = {r["item_key"] for r in rows_of(folder, ["item_key", "status"]) if r["status"] == DONE}
        left = [i for i in self.found(adapter, w) if i.key not in done]
        if not left:
            return
        told = Buffer(lambda rows: put_rows(folder, rows, _LEDGER), self.rows, self.seconds)
        try:
            with adapter.session() as session:
                for item in left:
                    row, goes_on = self.one(adapter, session, item)
                    told.add(row)
                    yield (w.first, *row)
                    if not goes_on:
                        return
        finally:
            told.flush()

    @staticmethod
    def one(adapter: Adapter, session: Any, item: Item) -> tuple[tuple, bool]:
        if item.done_reason is not None:
            return (item.key, DONE, item.done_reason, None), True
        try:
            got = adapter.process(session, item)
        except SourceError as e:
            return (item.key, e.status, str(e), None), False
        except ValueError as e:  # a case that can't be read fails alone
            return (item.key, FAILED, str(e), None), True
        return (item.key, DONE, got.reason, got.record), True


class _BatchReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.work = _Work(options)

    def partitions(self) -> list[Window]:
        return windows(self.work.first, self.work.last, self.work.days)

    def read(self, partition: Window) -> Iterator[tuple]:
        return self.work.read(partition)


class _StreamReader(DataSourceStreamReader):
    """Offsets are first days: a query that starts again begins at the first window that it hasn't committed."""

    def __init__(self, options: dict[str, str]):
        self.work = _Work(options)

    def initialOffset(self) -> dict:
        return {"until": str(self.work.first)}

    def latestOffset(self) -> dict:
        return {"until": str(self.work.last + timedelta(1))}

    def partitions(self, start: dict, end: dict) -> list[Window]:
        low, high = start["until"], end["until"]
        return [w for w in windows(self.work.first, self.work.last, self.work.days) if low <= str(w.first) < high]

    def read(self, partition: Window) -> Iterator[tuple]:
        return self.work.read(partition)

    def commit(self, end: dict) -> None:
        """The ledger needs no clearing."""


class ResumableSource(DataSource):
    """Format `resumable_cases`. Options: adapter (module:Class), ledger, from, to, days, flushRows, flushSeconds, and the adapter's own.

    A task holds the list of one window, so `days` is to be chosen by how much a site lists in a day.
    A read gives the outcomes of this run only; ledger() gives those of all runs.
    """

    @classmethod
    def name(cls) -> str:
        return "resumable_cases"

    def schema(self) -> str:
        return SCHEMA

    def _options(self) -> dict[str, str]:
        return {k.lower(): v for k, v in self.options.items()}

    def reader(self, schema) -> DataSourceReader:
        return _BatchReader(self._options())

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(self._options())


def run(spark: SparkSession, **options: str) -> None:
    """Works through all windows; what the ledger calls DONE isn't touched."""
    ship(spark)
    spark.dataSource.register(ResumableSource)
    spark.read.format("resumable_cases").options(**options).load().write.format("noop").mode("overwrite").save()


def ledger(spark: SparkSession, folder: str) -> DataFrame:
    """One row per window and item of all runs: its DONE outcome, else one that failed. Columns as SCHEMA."""
    told = spark.read.schema(SCHEMA).option("basePath", f"{folder}/outcomes").parquet(f"{folder}/outcomes")
    rank = F.struct((F.col("status") == DONE).alias("done"), "status", "reason", "record")
    best = told.groupBy("first_day", "item_key").agg(F.max(rank).alias("x"))
    return best.select("first_day", "item_key", "x.status", "x.reason", "x.record")


class Listing:
    """An adapter for a site that is a landed table with a folder per window (land_site). A payload is JSON with part_id and status:
    FAILED cases have no judgment yet, PENDING ones are passed over."""

    def __init__(self, options: dict[str, str]):
        self.site = options["site"]

    def discover(self, first: date, last: date) -> list[Item]:
        rows = rows_of(f"{self.site}/first_day={first}", ["item_key", "payload", "done_reason"])
        return [Item(r["item_key"], r["payload"], r["done_reason"]) for r in rows]

    def session(self) -> AbstractContextManager[Any]:
        return nullcontext()

    def process(self, session: Any, item: Item) -> Outcome:
        if '"status":"PENDING"' in item.payload:
            return Outcome(reason="not listed yet")
        return Outcome(item.payload, NOT_PUBLISHED if '"status":"FAILED"' in item.payload else None)


def land_site(items: DataFrame, folder: str, first: date, days: int) -> None:
    """items (day, item_key, payload, done_reason) as folders of windows. Each window is written by tasks of its own keys."""
    n = F.floor(F.datediff("day", F.lit(first)) / days) * days
    cut = items.where(F.col("day") >= F.lit(first)).withColumn("first_day", F.date_add(F.lit(first), n.cast("int")))
    cut.select("first_day", "item_key", "payload", "done_reason").repartition("first_day").write.partitionBy("first_day").parquet(folder)
