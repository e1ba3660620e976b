"""A source that goes on after it was killed, and a sink whose repeated micro-batch counts once."""

import json
import uuid
from contextlib import contextmanager
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql.types import StructType

from benchbook.sources import landing, resumable
from benchbook.sources.resumable import Item, Outcome, RateLimited
from benchbook.streaming import log_sink, logs

LISTED = {"2024-01-01": ["a", "b", "c", "d"], "2024-01-11": ["e", "e", "f"], "2024-01-21": []}


class Site:
    """Lists LISTED, writes down each call, and fails as a folder's files tell."""

    def __init__(self, options):
        self.folder = Path(options["site"])

    def note(self, *words):
        (self.folder / f"call-{uuid.uuid4().hex}").write_text(" ".join(words))

    def discover(self, first, last):
        self.note("discover", str(first))
        return [Item(k, "{}", "known" if k == "b" else None) for k in LISTED[str(first)]]

    @contextmanager
    def session(self):
        yield "session"

    def process(self, session, item):
        assert session == "session"
        if (self.folder / f"kill-{item.key}").exists():
            raise SystemExit(1)
        if (self.folder / f"limit-{item.key}").exists():
            raise RateLimited("too many requests")
        if (self.folder / f"bad-{item.key}").exists():
            raise ValueError("unreadable")
        self.note("process", item.key)
        return Outcome(json.dumps({"key": item.key}))


@pytest.fixture
def site(tmp_path):
    folder = tmp_path / "site"
    folder.mkdir()
    options = {"adapter": "tests.test_resumable:Site", "site": str(folder), "ledger": str(tmp_path / "ledger"), "from": "2024-01-01", "to": "2024-01-25", "days": "10", "flushRows": "1"}
    calls = lambda: sorted(p.read_text() for p in folder.glob("call-*"))
    return folder, options, calls


def rows(df):
    return sorted((str(r["first_day"]), r["item_key"], r["status"], r["reason"]) for r in df.collect())


WHOLE = [("2024-01-01", "a", "DONE", None), ("2024-01-01", "b", "DONE", "known"), ("2024-01-01", "c", "DONE", None), ("2024-01-01", "d", "DONE", None), ("2024-01-11", "e", "DONE", None), ("2024-01-11", "f", "DONE", None)]


def test_a_killed_run_goes_on(spark, site):
    folder, options, calls = site
    (folder / "kill-d").touch()
    with pytest.raises(Exception, match="(?s).+"):
        resumable.run(spark, **options)
    assert "process a" in calls() and "process c" in calls() and "process d" not in calls()
    (folder / "kill-d").unlink()
    resumable.run(spark, **options)
    assert rows(resumable.ledger(spark, options["ledger"])) == WHOLE
    assert [c for c in calls() if c.startswith("process")] == [f"process {k}" for k in "acdef"]
    assert calls().count("discover 2024-01-01") == 1 and calls().count("discover 2024-01-11") == 1 and calls().count("discover 2024-01-21") == 1
    before = calls()
    resumable.run(spark, **options)
    assert calls() == before


def test_a_limited_site_ends_its_window_only(spark, site):
    folder, options, calls = site
    (folder / "limit-c").touch()
    (folder / "bad-e").touch()
    resumable.run(spark, **options)
    got = rows(resumable.ledger(spark, options["ledger"]))
    assert got == [*WHOLE[:2], ("2024-01-01", "c", "RATE_LIMITED", "too many requests"), ("2024-01-11", "e", "FAILED", "unreadable"), WHOLE[5]]
    (folder / "limit-c").unlink()
    (folder / "bad-e").unlink()
    resumable.run(spark, **options)
    assert rows(resumable.ledger(spark, options["ledger"])) == WHOLE and calls().count("process a") == 1


def test_the_stream_reads_the_same_windows(spark, site, tmp_path):
    _, options, calls = site
    spark.dataSource.register(resumable.ResumableSource)
    stream = lambda: logs.run_available(spark.readStream.format("resumable_cases").options(**options).load(), folder=str(tmp_path / "run"))
    assert rows(stream()) == WHOLE and rows(stream()) == WHOLE and calls().count("process a") == 1


def test_windows():
    assert [(str(w.first), str(w.last)) for w in resumable.windows(date(2024, 1, 1), date(2024, 1, 25), 10)] == [("2024-01-01", "2024-01-10"), ("2024-01-11", "2024-01-20"), ("2024-01-21", "2024-01-25")]
    assert resumable.windows(date(2024, 1, 2), date(2024, 1, 1), 10) == []


LINE = "log_id long, message string"


def lines(spark, folder, *ids):
    landing.land(spark.createDataFrame([(i, f"line {i}" if i % 2 else None) for i in ids], LINE), folder)


def test_sink_counts_a_repeated_micro_batch_once(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "sink")
    lines(spark, source, *range(1000))
    stream = lambda: landing.landed_stream(spark, source, LINE)
    log_sink.write(stream(), sink, str(tmp_path / "c")).awaitTermination()
    ids = lambda: sorted(r["log_id"] for r in log_sink.committed(spark, sink, LINE).collect())
    assert ids() == list(range(1000))
    # As after a crash between the sink's commit and the checkpoint's: micro-batch 0 is run again.
    log_sink.write(stream(), sink, str(tmp_path / "other")).awaitTermination()
    assert ids() == list(range(1000)) and log_sink.commits(spark, sink).count() == 1
    lines(spark, source, 1000, 1001)
    log_sink.write(stream(), sink, str(tmp_path / "other")).awaitTermination()
    assert ids() == list(range(1002)) and log_sink.commits(spark, sink).count() == 2


def test_lost_lines_are_told_and_fail_nothing(spark, tmp_path):
    source, sink = str(tmp_path / "in"), tmp_path / "sink"
    lines(spark, source, 1, 2, 3)
    sink.mkdir()
    (sink / "rows").write_text("a file where the folder should be")
    log_sink.write(landing.landed_stream(spark, source, LINE), str(sink), str(tmp_path / "c")).awaitTermination()
    assert [(r["files"], r["lost"]) for r in log_sink.commits(spark, str(sink)).collect()] == [([], 3)]


def test_aborted_files_go(spark, tmp_path):
    writer = log_sink._Writer({"path": str(tmp_path), "flushrows": "2"}, StructType.fromDDL("n long"))
    told = writer.write(iter([(1,), (2,), (3,)]))
    assert len(told.files) == 1 and list((tmp_path / "rows").glob("*.parquet"))
    writer.abort([told, None], 0)
    assert not list((tmp_path / "rows").glob("*.parquet"))
