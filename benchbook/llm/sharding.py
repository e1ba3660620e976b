"""Sharding by sampled splitters: size-weighted sample, quantile boundaries, ranges, subdivision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from benchbook.llm.common import materialize

#: Expected rows of the size-weighted sample, whatever the input's size.
SAMPLE_ROWS = 16_384
#: Ranges per shard; a range is the grain in which bytes are dealt.
RANGES_PER_SHARD = 128
#: A range over this multiple of the mean, of bytes or of rows, is cut into parts.
OVERFULL = 2.0
#: Rows of a part at most, about: what one task sorts to number them.
PART_ROWS = 1_000_000


def range_of(key: Column, bounds: list[int]) -> Column:
    """Index of the range that holds key: a search over coarse bounds, then over one fine block."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    blocks = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    heads = F.array(*[F.lit(b[0]) for b in blocks])
    fine = F.array(*[F.array(*[F.lit(x) for x in b]) for b in blocks])
    block = F.size(F.filter(heads, lambda b: b <= key))
    inside = F.size(F.filter(F.element_at(fine, F.greatest(block, F.lit(1))), lambda b: b <= key))
    return F.when(block == 0, F.lit(0)).otherwise((block - 1) * step + inside)


def shard_by_bytes(
    docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
    sample_rows: int = SAMPLE_ROWS, ranges_per_shard: int = RANGES_PER_SHARD, part_rows: int = PART_ROWS,
) -> DataFrame:
    """Deals all rows to shards of nearly equal bytes: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The key is the text's hash, so equal texts share a range and, as a rule, a shard. A sample of
    about sample_rows rows, drawn with a chance in proportion to their size, gives the boundaries of
    shards * ranges_per_shard ranges at quantiles of its weight. A range that turns out overfull, in bytes or in
    rows (a third of all texts may be empty), is cut into parts by the hash of the key, and a key that
    alone is overfull (a large group of copies) by the id. No part has many more than part_rows rows, so
    parts grow with the table and the tasks that number rows don't. Totals of the parts are laid end
    to end and each goes to the shard where its middle falls; that makes shards differ by about a
    range (1/ranges_per_shard of a shard) or by one text that is larger. Slots number a shard's rows from 0: rows of earlier ranges, then the place in the range.

    size is the UTF-8 length plus 1. Null text: size 1, crc32 0. Rows that repeat are rows of their
    own. Null id: kept. Empty table: no rows.
    """
    ranges = shards * ranges_per_shard
    keyed = materialize(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).select(
            "doc_id", (F.octet_length("text") + 1).cast("long").alias("size"), F.crc32("text").alias("text_crc32"), F.xxhash64("text").alias("key")
        )
    )
    total, n_rows = keyed.agg(F.sum("size"), F.count(F.lit(1))).first()
    total = total or 0
    # The chance is size / (total / sample_rows); u is a fixed number in [0, 1) for the row.
    share = F.col("size") * F.lit(float(sample_rows) / max(total, 1))
    u = F.pmod(F.xxhash64("doc_id", "key", F.lit("draw")), F.lit(2**31)) / F.lit(float(2**31))
    drawn = keyed.where(u < share).select("key", F.greatest(F.ceil(share), F.lit(1)).cast("long").alias("weight"))
    marks = [i / ranges for i in range(1, ranges)]
    cuts = drawn.groupBy("key").agg(F.sum("weight").alias("weight")).agg(F.percentile("key", F.lit(marks), F.col("weight"))).first()[0] or []
    bounds = sorted({int(x) for x in cuts})
    ranged = keyed.withColumn("range", range_of(F.col("key"), bounds))

    # At most one row per range is broadcast: ranges is a parameter, not a data size.
    most_bytes, most_rows = OVERFULL * max(1.0, total / ranges), min(OVERFULL * max(1.0, n_rows / ranges), part_rows)
    sized = [F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")]
    share = F.greatest(F.ceil(F.col("bytes") / F.lit(most_bytes)), F.ceil(F.col("rows") / F.lit(float(most_rows))))
    parts = ranged.groupBy("range").agg(*sized).select("range", share.cast("long").alias("parts"))
    # Parts follow the key, so that equal texts stay together; only keys that alone overfill a part are cut by the id.
    hot = keyed.groupBy("key").agg(*sized).where((F.col("bytes") > F.lit(most_bytes)) | (F.col("rows") > F.lit(most_rows))).select("key", F.lit(True).alias("hot"))
    grain = F.when(F.col("hot"), F.xxhash64("doc_id", "key")).otherwise(F.xxhash64("key", F.lit("part")))
    cut = ranged.join(F.broadcast(parts), "range").join(F.broadcast(hot), "key", "left").withColumn("part", F.when(F.col("parts") > 1, F.pmod(grain, F.col("parts"))).otherwise(F.lit(0)))
    sums = cut.groupBy("range", "part").agg(*sized)
    line = Window.orderBy("range", "part")
    before = F.sum("bytes").over(line.rowsBetween(Window.unboundedPreceding, -1))
    middle = F.coalesce(before, F.lit(0)) + F.col("bytes") / 2
    dealt = sums.withColumn("shard", F.least(F.floor(middle * shards / F.lit(float(max(total, 1)))), F.lit(shards - 1)).cast("int"))
    own = Window.partitionBy("shard").orderBy("range", "part").rowsBetween(Window.unboundedPreceding, -1)
    dealt = dealt.withColumn("base", F.coalesce(F.sum("rows").over(own), F.lit(0))).select("range", "part", "shard", "base")
    place = F.row_number().over(Window.partitionBy("range", "part").orderBy("key", "doc_id", "text_crc32"))
    return cut.join(F.broadcast(dealt), ["range", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("base") + place - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
