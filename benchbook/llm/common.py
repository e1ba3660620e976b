"""Helpers that the corpus operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch, so that a batch of very long texts still fits a Python worker.
BATCH_ROWS = 512
#: A-Z to small letters, other bytes as they are.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def arrow_rows(spark: SparkSession, n: int) -> Iterator[None]:
    """Arrow batches of n rows for what runs inside; for narrow rows, of which 512 are a small batch."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(n))
    try:
        yield
    finally:
        spark.conf.set(name, before)


#: Stands for a null id on the way through Python, where a column with nulls would turn into floats.
NO_ID = -(2**63)


def ids_and_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id (long, nulls as NO_ID) and text (string) of docs, whatever other columns there are."""
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def with_null_ids(df: DataFrame) -> DataFrame:
    """df with NO_ID in doc_id turned back into null."""
    return df.withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))


def shared_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share.

    Where the setting is absent (tests, local mode) a temporary folder takes its place; on a cluster
    its absence is an error, because executors wouldn't see each other's files.
    """
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="benchbook-"))
        base = context.getCheckpointDir()
    if not base.split("/")[0].endswith(":"):
        base = f"file://{base}" if context.master.startswith("local") else base
    return f"{base.rstrip('/')}/benchbook-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Writes df once to the shared folder and reads it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Ids that without() and within() broadcast at most; 8 bytes each.
BROADCAST_IDS = 1_000_000


def _picked(rows: DataFrame, ids: DataFrame, id_col: str, how: str, broadcast_ids: int) -> DataFrame:
    """rows joined to ids (one column, id; longs). ids are written first and counted: up to broadcast_ids they are
    broadcast and rows stay where they are; beyond that both sides are shuffled."""
    ids = materialize(ids.select(F.col("id").cast("long").alias("__id")).where("__id is not null").distinct())
    few = ids.limit(broadcast_ids + 1).count() <= broadcast_ids
    ids = F.broadcast(ids) if few else ids.hint("merge")
    return rows.join(ids, F.col(id_col).cast("long") == F.col("__id"), how)


def without(rows: DataFrame, ids: DataFrame, id_col: str, broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """rows whose id isn't in ids. Rows with a null id stay."""
    return _picked(rows, ids, id_col, "left_anti", broadcast_ids)


def within(rows: DataFrame, ids: DataFrame, id_col: str, broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """rows whose id is in ids."""
    return _picked(rows, ids, id_col, "left_semi", broadcast_ids)
