"""Exact dedup: group by a 128-bit content hash, compare the bytes inside groups, keep one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchbook.llm.common import BROADCAST_IDS, materialize, without

#: What doesn't count when texts are compared.
BLANK = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """The text without blanks; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANK, "")


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", broadcast_hashes: int = BROADCAST_IDS
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Rows are grouped by the 128-bit hash of their normalised text. A hash of one row is a class of its
    own, so its text never travels. Where a hash repeats, the bytes are compared: the texts behind
    such hashes are grouped by hash and text, so rows that merely share a hash land in different
    classes. That aggregation combines on the map side, where all copies in a partition become one
    row; no task gathers a group. Up to broadcast_hashes repeated hashes pick their rows in place;
    beyond that they are joined with the rows by the hash. The classes return to the rows by hash
    and digest, a join whose larger side Spark can split.

    Of equal texts the longest original (in code points) stays, then the smallest id.
    Null text: equal to the empty text. Null id: sorts last. Rows that repeat an id are one document
    with one decision and all count in group_size. Empty table: no rows.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).select(
        "doc_id", F.coalesce(F.char_length("text"), F.lit(0)).alias("n"), normalised(F.col("text")).alias("norm")
    )
    hashed = texts.withColumn("hash", F.unhex(F.md5("norm")))
    # Digests once, in a table of some sixty bytes a row; all that follows reads it.
    rows = materialize(hashed.select("doc_id", "n", "hash", F.unhex(F.sha2("norm", 256)).alias("digest")))
    # One number orders the rows of a group, so that a hash aggregate can hold it: ids span less than 2 * 10**19.
    order = -F.col("n").cast("decimal(10,0)") * F.lit("1" + "0" * 20).cast("decimal(21,0)") + F.coalesce("doc_id", F.lit(2**63 - 1)).cast("decimal(20,0)")
    best = [F.min_by("doc_id", order).alias("keep_id"), F.count(F.lit(1)).alias("group_size")]
    sizes = materialize(rows.groupBy("hash").agg(*best, F.first("digest").alias("digest")))
    repeated = sizes.where("group_size > 1").select("hash")
    few = repeated.limit(broadcast_hashes + 1).count() <= broadcast_hashes
    compared = hashed.join(F.broadcast(repeated) if few else repeated, "hash", "left_semi").groupBy("hash", "norm").agg(*best)
    classes = sizes.where("group_size = 1").select("hash", "digest", "keep_id", "group_size").unionByName(
        compared.select("hash", F.unhex(F.sha2("norm", 256)).alias("digest"), "keep_id", "group_size")
    )
    return rows.join(classes, ["hash", "digest"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that exact_dedup keeps, with all their columns. Rows without an id stay, and so does an id one of whose rows is kept."""
    gone = exact_dedup(docs, id_col, text_col).groupBy("doc_id").agg(F.bool_or("kept").alias("kept")).where("not kept")
    return without(docs, gone.select(F.col("doc_id").alias("id")), id_col)


ORACLE_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
), g AS (
  SELECT doc_id, norm,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""
