"""Places and running values in an order, without a window over a whole group: rows are cut into sorted ranges that are
written once, each range is counted per group, and what came before a range is added to what is counted inside it.

A group may lie over many ranges, and a range may hold many groups: there are as many pieces (group, range) as groups and
ranges together, and only pieces pass through windows over a whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from benchbook.sources.landing import written

RANGE, AT = "__range", "__at"
EARLIER = (Window.unboundedPreceding, -1)
SO_FAR = (Window.unboundedPreceding, Window.currentRow)


def ranged(rows: DataFrame, by: list[str | Column]) -> DataFrame:
    """rows with the number of their range and their place in it, from 0.

    The numbers are given once, as the sorted rows are written, and read back from there: a plan that numbered them anew in
    each of its branches could cut the ranges elsewhere in each.
    """
    kept = written(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(AT, F.monotonically_increasing_id()))
    return kept.withColumn(RANGE, F.shiftrightunsigned(AT, 33)).withColumn(AT, F.col(AT).bitwiseAND(F.lit((1 << 33) - 1)))


def with_pieces(rows: DataFrame, pieces: DataFrame, within: list[str]) -> DataFrame:
    """rows with the columns of their piece. pieces: within, range, others. Nulls in a group are equal."""
    keys = [*within, RANGE]
    renamed = pieces.select(*[F.col(c).alias(f"__k_{c}") for c in keys], *[c for c in pieces.columns if c not in keys])
    cond = F.lit(True)
    for c in keys:
        cond &= F.col(c).eqNullSafe(F.col(f"__k_{c}"))
    return rows.join(renamed, cond).drop(*[f"__k_{c}" for c in keys])


def places(rows: DataFrame, within: list[str], order: list[str | Column], name: str = "place") -> DataFrame:
    """rows with their place, from 1 and gapless, in the given order inside their group (no columns: all rows).

    Ties are broken in one way, which is written down. Nulls come first and are one group. Empty input: no rows.
    """
    kept = ranged(rows, [*within, *order])
    pieces = kept.groupBy(*within, RANGE).agg(F.count(F.lit(1)).alias("__n"), F.min(AT).alias("__first"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(*within).orderBy(RANGE).rowsBetween(*EARLIER)), F.lit(0))
    pieces = pieces.withColumn("__before", before).drop("__n")
    return with_pieces(kept, pieces, within).withColumn(name, F.col("__before") + F.col(AT) - F.col("__first") + 1).drop(RANGE, AT, "__before", "__first")


def runs(rows: DataFrame, within: list[str], order: list[str], marked: Column, name: str = "nth") -> DataFrame:
    """The marked rows, with how many marked ones in a row there are up to them.

    A piece tells its size, how many marked rows it ends with, and whether all are marked. The run with which a piece
    begins goes on from the pieces before it: from the last one that isn't marked throughout.
    """
    kept = ranged(rows.withColumn("__marked", F.coalesce(marked, F.lit(False))), [*within, *order])
    inside = Window.partitionBy(*within, RANGE).orderBy(AT)
    last_other = F.last(F.when(~F.col("__marked"), F.col(AT)), ignorenulls=True).over(inside.rowsBetween(*SO_FAR))
    local = kept.withColumn("__other", last_other)
    pieces = local.groupBy(*within, RANGE).agg(F.count(F.lit(1)).alias("__n"), F.min(AT).alias("__first"), F.max(AT).alias("__end"), F.max("__other").alias("__other_end"))
    line = Window.partitionBy(*within).orderBy(RANGE)
    total = F.sum("__n").over(line.rowsBetween(*SO_FAR))
    pieces = pieces.withColumn("__total", total).withColumn("__upto", F.when(F.col("__other_end").isNotNull(), F.col("__total") - (F.col("__end") - F.col("__other_end"))))
    carried = F.col("__total") - F.col("__n") - F.coalesce(F.last("__upto", ignorenulls=True).over(line.rowsBetween(*EARLIER)), F.lit(0))
    pieces = pieces.select(*within, RANGE, "__first", carried.alias("__carried"))
    nth = F.when(F.col("__other").isNull(), F.col("__carried") + F.col(AT) - F.col("__first") + 1).otherwise(F.col(AT) - F.col("__other"))
    return with_pieces(local.where("__marked"), pieces, within).withColumn(name, nth).drop(RANGE, AT, "__marked", "__other", "__first", "__carried")


def _second(best: Column, before: Column) -> Column:
    """The lesser of a value and the best before it: what falls back when a new best comes."""
    return F.when(best.isNotNull() & before.isNotNull(), F.least(best, before))


def two_best(rows: DataFrame, within: list[str], order: list[str], value: Column) -> DataFrame:
    """rows with best and second: the two greatest values (null: none) of the rows of their group up to them."""
    kept = ranged(rows.withColumn("__v", value), [*within, *order])
    inside = Window.partitionBy(*within, RANGE).orderBy(AT)
    local = kept.withColumn("__best", F.max("__v").over(inside.rowsBetween(*SO_FAR))).withColumn("__fell", _second(F.col("__v"), F.max("__v").over(inside.rowsBetween(*EARLIER))))
    local = local.withColumn("__second", F.max("__fell").over(inside.rowsBetween(*SO_FAR)))
    line = Window.partitionBy(*within).orderBy(RANGE)
    pieces = local.groupBy(*within, RANGE).agg(F.max("__best").alias("__b"), F.max("__second").alias("__s"))
    pieces = pieces.withColumn("__c1", F.max("__b").over(line.rowsBetween(*EARLIER)))
    pieces = pieces.withColumn("__f", F.greatest("__s", _second(F.col("__b"), F.col("__c1")))).withColumn("__c2", F.max("__f").over(line.rowsBetween(*EARLIER)))
    out = with_pieces(local, pieces.select(*within, RANGE, "__c1", "__c2"), within)
    second = F.greatest("__second", "__c2", _second(F.col("__best"), F.col("__c1")))
    return out.withColumn("second", second).withColumn("best", F.greatest("__best", "__c1")).drop(RANGE, AT, "__v", "__best", "__fell", "__second", "__c1", "__c2")
