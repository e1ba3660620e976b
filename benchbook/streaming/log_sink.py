"""A sink for log lines as a Spark data source: lines are buffered and written by tasks, and count once their micro-batch is
committed. Lines that can't be written are told, and never fail the batch that they belong to."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from benchbook.sources.shared_files import FLUSH_ROWS, FLUSH_SECONDS, Buffer, opened, put_json, ship

logger = logging.getLogger(__name__)


@dataclass
class Written(WriterCommitMessage):
    """What a task wrote: names of files, and how many lines were lost."""

    files: list[str] = field(default_factory=list)
    lost: int = 0


class _Lines:
    """A task's file of the sink; a buffer is one row group. After a failure the next buffer begins another file."""

    def __init__(self, folder: str, schema: pa.Schema):
        self.folder, self.schema, self.told = folder, schema, Written()
        self.out: pq.ParquetWriter | None = None
        self.now, self.lines = "", 0

    def append(self, rows: list[tuple]) -> None:
        try:
            if self.out is None:
                files, path = opened(f"{self.folder}/rows")
                files.create_dir(path, recursive=True)
                self.now, self.lines = f"{uuid.uuid4().hex}.parquet", 0
                self.out = pq.ParquetWriter(f"{path}/{self.now}", self.schema, filesystem=files)
            self.out.write_table(pa.Table.from_pylist([dict(zip(self.schema.names, r, strict=True)) for r in rows], self.schema))
            self.lines += len(rows)
        except (OSError, pa.ArrowException) as e:
            logger.warning("%d log lines were lost: %s", len(rows) + self.lines, e)
            # The file has no end, so the lines that it held before go with it.
            self.told.lost += len(rows) + self.lines
            self.out = None

    def close(self) -> Written:
        try:
            if self.out is not None:
                self.out.close()
                self.told.files.append(self.now)
        except (OSError, pa.ArrowException) as e:
            logger.warning("%d log lines were lost: %s", self.lines, e)
            self.told.lost += self.lines
        return self.told


class _Writer(DataSourceStreamWriter):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.folder, self.schema = options["path"], schema
        self.rows, self.seconds = int(options.get("flushrows", FLUSH_ROWS)), float(options.get("flushseconds", FLUSH_SECONDS))

    def write(self, iterator: Iterator) -> Written:
        lines = _Lines(self.folder, to_arrow_schema(self.schema))
        buffer = Buffer(lines.append, self.rows, self.seconds)
        for row in iterator:
            buffer.add(tuple(row))
        buffer.flush()
        return lines.close()

    def commit(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        """The batch's list of files; a batch that is run again replaces its own, so its lines count once."""
        told = [m for m in messages if isinstance(m, Written)]
        try:
            put_json(f"{self.folder}/commits", f"{batchId:012d}.json", {"batch": batchId, "files": [f for m in told for f in m.files], "lost": sum(m.lost for m in told)})
        except OSError as e:
            logger.warning("log lines of micro-batch %d were lost: %s", batchId, e)

    def abort(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        """Files of tasks that ended go; those of lost tasks are in no list and are never read."""
        files, path = opened(f"{self.folder}/rows")
        for m in messages:
            for name in m.files if isinstance(m, Written) else []:
                try:
                    files.delete_file(f"{path}/{name}")
                except OSError as e:
                    logger.warning("%s stays: %s", name, e)


class LogSink(DataSource):
    """Format `batch_log`, for writeStream. Options: path, flushRows, flushSeconds."""

    @classmethod
    def name(cls) -> str:
        return "batch_log"

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamWriter:
        return _Writer({k.lower(): v for k, v in self.options.items()}, schema)


def write(lines: DataFrame, folder: str, checkpoint: str, **options: str):
    """Starts a stream of lines into the sink over what is there now; the running query."""
    ship(lines.sparkSession)
    lines.sparkSession.dataSource.register(LogSink)
    return lines.writeStream.format("batch_log").options(path=folder, **options).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def commits(spark: SparkSession, folder: str) -> DataFrame:
    """batch, files, lost per committed micro-batch."""
    return spark.read.schema("batch long, files array<string>, lost long").json(f"{folder}/commits")


def committed(spark: SparkSession, folder: str, schema: StructType | str) -> DataFrame:
    """Lines of committed micro-batches. Lists of files stay in Spark: a semi-join by the file's name."""
    files = commits(spark, folder).select(F.explode("files").alias("file"))
    rows = spark.read.schema(schema).parquet(f"{folder}/rows").withColumn("file", F.col("_metadata.file_name"))
    return rows.join(files, "file", "left_semi").drop("file")
