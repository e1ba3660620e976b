"""Small files that tasks and driver write to a shared folder themselves, where Spark's own writers commit too late."""

from __future__ import annotations

import json
import shutil
import tempfile
import threading
import time
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import SparkSession

#: A buffer is written at so many rows or after so many seconds.
FLUSH_ROWS, FLUSH_SECONDS = 200, 1.0


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The Arrow file system and path of a folder; Hadoop's names for a store are the library's with another ending."""
    scheme, _, rest = folder.partition(":")
    if not rest or scheme == "file":
        return fs.LocalFileSystem(), "/" + (rest or folder).lstrip("/")
    found, path = fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}:{rest}")
    return found, path


def names(folder: str) -> list[str]:
    """Paths of a folder's files in order; none if the folder isn't there. Files that are still written begin with a dot."""
    files, path = opened(folder)
    found = files.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(f.path for f in found if f.is_file and not f.base_name.startswith((".", "_")))


def put(folder: str, name: str, body: bytes) -> None:
    """Writes a file under a name of its own and moves it, so that it appears whole or not at all; one of that name is replaced."""
    files, path = opened(folder)
    files.create_dir(path, recursive=True)
    hidden = f"{path}/.{uuid.uuid4().hex}"
    with files.open_output_stream(hidden) as out:
        out.write(body)
    files.move(hidden, f"{path}/{name}")


def put_rows(folder: str, rows: list[tuple], schema: pa.Schema) -> str:
    """Writes rows as one Parquet file; its name."""
    table = pa.Table.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)
    out, name = pa.BufferOutputStream(), f"{uuid.uuid4().hex}.parquet"
    pq.write_table(table, out)
    put(folder, name, out.getvalue().to_pybytes())
    return name


def rows_of(folder: str, columns: list[str]) -> Iterator[dict]:
    files, _ = opened(folder)
    for path in names(folder):
        with files.open_input_file(path) as f:
            yield from pq.read_table(f, columns=columns).to_pylist()


def put_json(folder: str, name: str, value: dict) -> None:
    put(folder, name, json.dumps(value).encode())


_shipped: set[str] = set()
_shipping = threading.Lock()


def ship(spark: SparkSession) -> None:
    """Sends this package to the workers, once per application: they load data sources by name. To be called before one is registered."""
    context = spark.sparkContext
    with _shipping:
        if context.applicationId not in _shipped:
            package = Path(__file__).resolve().parents[1]
            context.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name))
            _shipped.add(context.applicationId)


class Buffer:
    """Rows that go to use() together: at so many of them, or when the oldest has waited for so long and another comes."""

    def __init__(self, use, rows: int = FLUSH_ROWS, seconds: float = FLUSH_SECONDS):
        self.use, self.most, self.seconds = use, rows, seconds
        self.rows: list[tuple] = []
        self.since = time.monotonic()

    def add(self, row: tuple) -> None:
        if not self.rows:
            self.since = time.monotonic()
        self.rows.append(row)
        if len(self.rows) >= self.most or time.monotonic() - self.since >= self.seconds:
            self.flush()

    def flush(self) -> None:
        rows, self.rows = self.rows, []
        if rows:
            self.use(rows)
