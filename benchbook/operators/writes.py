"""Writes without MERGE: a new snapshot is the join of the target and what comes in, with the outcome of each row.

Single writer; applying the same input twice changes nothing the second time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from benchbook.operators.ordered import places


def numbered(new: DataFrame, order: list[str], start: DataFrame, id_name: str) -> DataFrame:
    """new with ids that go on from the one value of start (column top), gapless and in the given order."""
    top = F.broadcast(start.select(F.coalesce("top", F.lit(0)).alias("__top")))  # one row
    return places(new, [], order, "__place").join(top, F.lit(True)).withColumn(id_name, F.col("__top") + F.col("__place")).drop("__top", "__place")


def ranked(rows: DataFrame, grain: Column, order: list[Column], name: str = "rank") -> DataFrame:
    """rows with their place, from 1, in the order of grain (nulls last), then of order.

    A row's place is its place among the rows of its grain plus the sizes of the grains before it. Only the
    grains' sizes, a row each, pass through one task; so grain takes a bounded number of values, such as days.
    """
    marked = rows.withColumn("__grain", grain)
    before = F.sum("__n").over(Window.orderBy(F.col("__grain").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1))
    sizes = marked.groupBy("__grain").agg(F.count(F.lit(1)).alias("__n")).select(F.col("__grain").alias("__g"), F.coalesce(before, F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy("__grain").orderBy(*order))
    return marked.withColumn("__place", place).join(sizes, F.col("__grain").eqNullSafe(F.col("__g"))).withColumn(name, (F.col("__before") + F.col("__place")).cast("int")).drop("__grain", "__g", "__n", "__before", "__place")


def same_key(a: DataFrame, b: DataFrame, key: list[str]) -> Column:
    """Equality on every key column, nulls equal."""
    cond = F.lit(True)
    for k in key:
        cond &= a[k].eqNullSafe(b[k])
    return cond


def get_or_create(dim: DataFrame, incoming: DataFrame, key: list[str], id_name: str, first_by: str) -> DataFrame:
    """dim with a row for each new key of incoming; the first row by first_by gives its other columns. Known rows stay as they are.

    dim: id_name, key columns, others; incoming: key columns, others, first_by. Nulls in a key are equal.
    """
    others = [c for c in dim.columns if c not in key and c != id_name]
    firsts = incoming.groupBy(*key).agg(*[F.min_by(c, first_by).alias(c) for c in others]) if others else incoming.select(*key).distinct()
    new = firsts.join(dim, same_key(firsts, dim, key), "left_anti")
    added = numbered(new, key, dim.agg(F.max(id_name).alias("top")), id_name)
    return dim.unionByName(added.select(dim.columns))


def guarded_upsert(target: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """The target after an upsert, with an outcome per row.

    incoming: as target, with `missing` (no judgment came along). New key: inserted. Target has no
    judgment and one came: filled (all columns but the id and the external id, which stay). Target
    has none and none came: refreshed (status, reason, url if new). Target has a judgment: kept.
    Rows without incoming: untouched.
    """
    values = [c for c in target.columns if c not in (*key, "case_id", "external_id")]
    t = target.select(*key, F.struct(*[c for c in target.columns if c not in key]).alias("t"))
    n = incoming.select(*key, F.struct(*[c for c in incoming.columns if c not in key]).alias("n"))
    both = t.join(n, key, "full_outer")
    old, new = F.col("t"), F.col("n")
    outcome = (
        F.when(old.isNull(), "inserted").when(new.isNull(), "untouched").when(F.col("t.judgment_status") == "AVAILABLE", "kept").when(F.col("n.missing"), "refreshed").otherwise("filled")
    )
    refreshed = ("judgment_status", "reason")

    def value(c: str) -> Column:
        o, i = F.col(f"t.{c}"), F.col(f"n.{c}")
        if c == "source_url":
            fresh = F.coalesce(i, o)
        else:
            fresh = i if c in refreshed else o
        return F.when(F.col("outcome").isin("inserted", "filled"), i).when(F.col("outcome") == "refreshed", fresh).otherwise(o).alias(c)

    out = both.withColumn("outcome", outcome)
    return out.select(*key, F.coalesce("t.case_id", "n.case_id").alias("case_id"), F.col("t.external_id").alias("external_id"), *[value(c) for c in values], "outcome")


def assign_sequences(cases: DataFrame, counters: DataFrame, prefix: str = "CASE") -> DataFrame:
    """cases with external_id `prefix/court/0001/year` where it is missing and date and court code are known.

    counters: court_code, year, last. Numbers go on per court and year in the order of the case id; rows
    that get none use none up.
    """
    due = cases.where("external_id is null and judgment_date is not null and court_code is not null").select("case_id", "court_code", F.year("judgment_date").alias("year"))
    given = places(due, ["court_code", "year"], ["case_id"], "nth").join(counters, ["court_code", "year"], "left")
    number = F.coalesce("last", F.lit(0)) + F.col("nth")
    named = given.select("case_id", F.concat_ws("/", F.lit(prefix), "court_code", F.format_string("%04d", number), F.col("year").cast("string")).alias("given_id"))
    return cases.join(named, "case_id", "left").withColumn("external_id", F.coalesce("external_id", "given_id")).drop("given_id")


def survivors(rows: DataFrame, id_name: str, key: list[str]) -> DataFrame:
    """duplicate, survivor: rows whose key (nulls equal) has a smaller id."""
    least = rows.groupBy(*key).agg(F.min(id_name).alias("survivor"))
    return rows.join(least, same_key(rows, least, key)).select(rows[id_name].alias("duplicate"), "survivor").where("duplicate <> survivor")


def remap(rows: DataFrame, column: str, plan: DataFrame) -> DataFrame:
    """rows with duplicate ids of a column replaced by their survivors; the plan is a table of duplicates only."""
    return rows.join(plan.withColumnRenamed("duplicate", column), column, "left").withColumn(column, F.coalesce("survivor", column)).drop("survivor")


def remap_array(rows: DataFrame, id_name: str, column: str, plan: DataFrame) -> DataFrame:
    """id_name, column: arrays with duplicate ids replaced and made distinct; empty arrays stay empty."""
    flat = remap(rows.select(id_name, F.explode(column).alias("x")).withColumnRenamed("x", column), column, plan)
    lists = flat.groupBy(id_name).agg(F.array_sort(F.collect_set(column)).alias(column))
    return rows.select(id_name).join(lists, id_name, "left").withColumn(column, F.coalesce(column, F.array().cast(lists.schema[column].dataType)))


def ingest(known: DataFrame, incoming: DataFrame) -> DataFrame:
    """checksum, outcome, status: new files, unfinished ones taken up again, and duplicates of finished ones.

    known: checksum, status; incoming: checksum. A checksum that comes twice is one file.
    """
    done = F.col("status").isin("PROMOTED", "NEEDS_REVIEW")
    out = incoming.select("checksum").distinct().join(known, "checksum", "left")
    outcome = F.when(F.col("status").isNull(), "new").when(done, "duplicate").otherwise("reused")
    return out.select("checksum", outcome.alias("outcome"), F.when(F.coalesce(done, F.lit(False)), F.col("status")).otherwise("DOWNLOADED").alias("status"))


def overwrite_by_key(target: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """Rows of incoming, and those of target whose key it doesn't hold."""
    return target.join(incoming.select(*key).distinct(), key, "left_anti").unionByName(incoming)


def seed(target: DataFrame, rows: DataFrame, key: list[str], retired: list) -> DataFrame:
    """target without retired keys, and the seed rows whose key it lacks."""
    kept = target.where(~F.col(key[0]).isin(*retired)) if retired else target
    return kept.unionByName(rows.join(kept.select(*key).distinct(), key, "left_anti"))


def pending_migrations(files: DataFrame, applied: DataFrame) -> DataFrame:
    """Files that weren't applied yet, with their turn in the order of their names."""
    return files.join(applied, "filename", "left_anti").withColumn("turn", F.row_number().over(Window.orderBy("filename")))


def save_items(known: DataFrame, found: DataFrame) -> DataFrame:
    """Items after a discovery: known ones stay, new keys are added once, by their least place, done if a reason says so."""
    new = found.groupBy("batch_id", "item_key").agg(F.min(F.struct("place", "done_reason")).alias("x")).select("batch_id", "item_key", "x.*")
    new = new.join(known.select("batch_id", "item_key"), ["batch_id", "item_key"], "left_anti")
    return known.unionByName(new.select("batch_id", "item_key", "place", F.when(F.col("done_reason").isNotNull(), "DONE").otherwise("PENDING").alias("status"), "done_reason"))


def enrich_merge(cases: DataFrame, answers: DataFrame) -> DataFrame:
    """cases with an answer's columns merged: note and party: new wins; subject and disposition: old wins;
    industries replaced; ministries united; acts only if there were none; attempts go up."""
    joined = cases.join(answers.select("case_id", F.struct(*[c for c in answers.columns if c != "case_id"]).alias("n")), "case_id", "left")
    came = F.col("n").isNotNull()
    return joined.select(
        "case_id",
        F.coalesce("n.case_note", "case_note").alias("case_note"), F.coalesce("n.favouring_party", "favouring_party").alias("favouring_party"),
        F.coalesce("disposition", "n.disposition").alias("disposition"),
        F.coalesce("n.industries", "industries").alias("industries"),
        F.array_distinct(F.concat("ministries", F.coalesce("n.ministries", F.array().cast("array<bigint>")))).alias("ministries"),
        F.when(F.size("acts") == 0, F.coalesce("n.acts", "acts")).otherwise(F.col("acts")).alias("acts"),
        (F.col("attempts") + F.when(came, 1).otherwise(0)).alias("attempts"),
    )
