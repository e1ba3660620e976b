"""Landing zone: records and log lines arrive as Parquet files that batch jobs and streams read alike."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir; in local mode, where that is unset, a temporary one."""
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="benchbook-"))
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/landing-{uuid.uuid4().hex}"


def written(rows: DataFrame) -> DataFrame:
    """rows, written once to the shared folder and read back: later steps see the same rows, whatever executor is lost."""
    spark = rows.sparkSession
    folder = shared_folder(spark)
    rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def land(records: DataFrame, folder: str) -> None:
    """Appends discovered records; files appear whole or not at all."""
    records.write.mode("append").parquet(folder)


def landed(spark: SparkSession, folder: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(folder)


def landed_stream(spark: SparkSession, folder: str, schema, files_per_batch: int = 64) -> DataFrame:
    """New files of the landing zone as they come."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
