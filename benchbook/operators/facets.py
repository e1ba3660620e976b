"""Facets, pickers and statistics over matched cases."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from benchbook.functions.text import classify_category
from benchbook.functions.vocabulary import CATEGORIES
from benchbook.operators.search import Search, SearchRequest, members
from benchbook.sources.domain import Domain

#: Options that a facet of names lists.
TOP = 30
NAMED = ("judge", "industry", "ministry")
ORDER = ("court", "judge", "year", "disposition", "favouring_party", "industry", "ministry", "judgment")


#: Facets whose options come from a case's lines, and the column there.
OF_LINES = {"judge": "judge_id", "ministry": "ministry_id"}
THERE = "available", "Judgment available"
MISSING = "missing", "Judgment missing"


def _names(d: Domain, keys: tuple[str, ...]) -> DataFrame:
    """facet, id, value, label of options that a dimension names. Only courts show their id; equal names are one option."""
    dims = {"court": (d.courts(), "court_id", "court_name"), "judge": (d.judges(), "judge_id", "full_name"), "industry": (d.industries(), "industry_id", "name"), "ministry": (d.ministries(), "ministry_id", "name")}
    made = [
        dim.select(F.lit(k).alias("facet"), F.col(i).cast("string").alias("id"), F.col(i if k == "court" else name).cast("string").alias("value"), F.col(name).alias("label"))
        for k, (dim, i, name) in dims.items() if k in keys
    ]
    return reduce(DataFrame.union, made)


def _options(d: Domain, cases: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """facet, value, label, n of the facets keys over flagged cases (Search.judged): each case counts for a facet if it meets
    all other facets' clauses. The cases are exploded once into facet and option; all facets are counted by one aggregation."""
    meets = {k: reduce(lambda a, b: a & b, [F.col(f"meets_{o}") for o in ORDER if o != k]) for k in keys}
    there = F.col("judgment_status") == "AVAILABLE"
    own = {
        "court": F.col("court_id"), "year": F.year("judgment_date"), "disposition": F.col("disposition"), "favouring_party": F.col("favouring_party"), "industry": F.get("industries", F.lit(0)),
        "judgment": F.when(there, THERE[0]).otherwise(MISSING[0]),
    }
    tag = lambda k, x: F.when(meets[k] & x.isNotNull(), F.struct(F.lit(k).alias("facet"), x.cast("string").alias("id")))
    parts = []
    if flat := [k for k in keys if k in own]:
        parts.append(cases.select("case_id", F.explode(F.array_compact(F.array(*[tag(k, own[k]) for k in flat]))).alias("x")).select("case_id", "x.*"))
    if lined := [k for k in keys if k in OF_LINES]:
        wanted = cases.select("case_id", *[meets[k].alias(f"counts_{k}") for k in lined]).where(reduce(lambda a, b: a | b, [F.col(f"counts_{k}") for k in lined]))
        lines = d.lines().select("case_id", *[OF_LINES[k] for k in lined]).join(wanted, "case_id")
        each = F.array_compact(F.array(*[F.when(F.col(f"counts_{k}"), F.struct(F.lit(k).alias("facet"), F.col(OF_LINES[k]).cast("string").alias("id"))) for k in lined]))
        parts.append(lines.select("case_id", F.explode(each).alias("x")).select("case_id", "x.*"))
    tagged, label = reduce(DataFrame.union, parts), F.when(F.col("facet") == "judgment", F.when(F.col("id") == THERE[0], THERE[1]).otherwise(MISSING[1])).otherwise(F.col("id"))
    named = tuple(k for k in keys if k in ("court", "industry", *OF_LINES))
    if named:
        # Equal names are one option: the least of their ids stands for it, and names are put to what has been counted.
        names = _names(d, named)
        least = names.groupBy("facet", "value", "label").agg(F.min("id").alias("option"))
        first = names.join(least, ["facet", "value", "label"]).select("facet", "id", "option").distinct()
        tagged = tagged.join(first, ["facet", "id"], "left").where(F.col("option").isNotNull() | ~F.col("facet").isin(*named)).select("case_id", "facet", F.coalesce("option", "id").alias("id"))
    # What repeats in a case goes by ids alone, so that tasks hold no names for it.
    counted = tagged.select("case_id", "facet", "id").distinct().groupBy("facet", "id").agg(F.count("case_id").alias("n"))
    if not named:
        return counted.select("facet", F.col("id").alias("value"), label.alias("label"), "n")
    told = counted.join(least.withColumnRenamed("option", "id").withColumnRenamed("label", "name"), ["facet", "id"], "left")
    return told.select("facet", F.coalesce("value", "id").alias("value"), F.coalesce("name", label).alias("label"), "n")


def facet(d: Domain, request: SearchRequest, key: str) -> DataFrame:
    """Options of one facet over what the request matches without the facet's own selections: value, label, n, most first."""
    out = _options(d, Search(d).judged(request, ORDER), (key,)).select("value", "label", "n")
    return out.orderBy(F.desc("n"), "label").limit(TOP) if key in NAMED else out


def panel(d: Domain, request: SearchRequest) -> DataFrame:
    """All facets: facet, value, label, n. Facets without options have no rows.

    Cases are matched once, with a flag for each facet's own selection. A facet of names lists its TOP options:
    a rank within the facet, over options and not over cases.
    """
    options = _options(d, Search(d).judged(request, ORDER), ORDER)
    place = F.row_number().over(Window.partitionBy("facet").orderBy(F.desc("n"), "label"))
    return options.withColumn("place", place).where((F.col("place") <= TOP) | ~F.col("facet").isin(*NAMED)).drop("place")


def defined(d: Domain, request: SearchRequest, definitions: DataFrame, static: DataFrame, inactive: bool = False) -> DataFrame:
    """The panel as it's configured: key, title, display_order, value, label, n, a row per option.

    definitions: filter_id, key, title, data_source, is_active, display_order; static: filter_id, value, label, is_active.
    A facet of data source `database` has the panel's options and goes without any; others show their configured options,
    uncounted and whatever the search, or one row of nulls if they have none. inactive: with definitions and options that are off.
    """
    shown = definitions if inactive else definitions.where("is_active")
    offered = (static if inactive else static.where("is_active")).select("filter_id", "value", "label")
    told = ("key", "title", "display_order", "value", "label", "n")
    counted = shown.where("data_source = 'database'").join(panel(d, request).withColumnRenamed("facet", "key"), "key").select(*told)
    fixed = shown.where("data_source <> 'database'").join(offered, "filter_id", "left").withColumn("n", F.lit(None).cast("long")).select(*told)
    return counted.union(fixed)


def corpus_stats(d: Domain) -> DataFrame:
    """One row: cases, courts, judges, acts, industries, from cases and lines; distinct counts combine map-side."""
    pair = lambda k, c: F.struct(F.lit(k).alias("kind"), F.col(c).cast("long").alias("id"))
    cases = d.flat().select("case_id", "court_id", F.element_at("industries", 1).alias("industry_id")).select(F.explode(F.array(pair("cases", "case_id"), pair("courts", "court_id"), pair("industries", "industry_id"))).alias("x"))
    lines = d.named_lines().join(d.flat().select("case_id"), "case_id", "left_semi").select(F.explode(F.array(pair("judges", "judge_id"), pair("acts", "named_act"))).alias("x"))
    tagged = cases.union(lines).select("x.*").where("id is not null")
    kinds = ("cases", "courts", "judges", "acts", "industries")
    return tagged.distinct().agg(*[F.count(F.when(F.col("kind") == k, 1)).alias(k) for k in kinds])


def act_picker(d: Domain, term: str, limit: int) -> DataFrame:
    """Acts whose name or short code contains the term, by how often cases name them; year variants of a name add up."""
    like = f"%{term}%"
    acts = d.acts().where(F.col("act_name").ilike(like) | F.col("short_code").ilike(like))
    cited = d.named_lines().where("named_act is not null").join(d.flat().select("case_id"), "case_id", "left_semi")
    per_act = cited.select("case_id", F.col("named_act").alias("act_id")).distinct().groupBy("act_id").agg(F.count(F.lit(1)).alias("n"))
    named = per_act.join(acts, "act_id").groupBy("act_name").agg(F.max("short_code").alias("short_code"), F.sum("n").alias("n"))
    return named.orderBy(F.desc("n"), "act_name").limit(limit).select("act_name", "short_code", "n")


def natural(number: Column) -> list[Column]:
    """Sort keys of section numbers: leading digits as a number, then the text; without digits last."""
    return [F.expr(f"try_cast(nullif(regexp_extract({number}, '^[0-9]+', 0), '') as int)").asc_nulls_last(), F.col(number)]


def section_picker(d: Domain, act: str, prefix: str) -> DataFrame:
    """Sections of an act that start with the prefix, with case counts and their rank in natural order."""
    acts = d.acts().where(F.col("act_name") == act).select("act_id")
    wanted = d.sections().join(acts, "act_id", "left_semi").where(F.col("section_number").ilike(f"{prefix}%")).select("section_id", "section_number")
    counts = members(d.cases(), "sections", wanted, "section_id").groupBy("section_number").agg(F.countDistinct("case_id").alias("n"))
    # One row per section of one act: the ranking's single partition is that small.
    return counts.withColumn("rank", F.row_number().over(Window.orderBy(*natural("section_number"))))


def provisions_json(d: Domain, cases: DataFrame) -> DataFrame:
    """case_id, provisions: cited sections with their acts as a JSON array, sorted."""
    pairs = members(cases, "sections", d.sections(), "section_id").join(d.acts(), "act_id")
    return pairs.groupBy("case_id").agg(F.to_json(F.array_sort(F.collect_set(F.struct("act_name", F.col("section_number").alias("section"))))).alias("provisions"))


def category_names(cases: DataFrame) -> DataFrame:
    """case_id, category_names: categories found in case numbers, numbered as a dimension, and joined back by id."""
    found = cases.select("case_id", classify_category(F.col("case_number")).alias("c")).select("case_id", "c.category_code", "c.category_name")
    codes = F.array(*[F.lit(code) for _, code, _ in CATEGORIES])
    held = found.select("case_id", F.when(F.col("category_code").isNotNull(), F.array(F.array_position(codes, F.col("category_code")))).otherwise(F.array().cast("array<bigint>")).alias("categories"))
    dim = found.where("category_code is not null").select(F.array_position(codes, F.col("category_code")).alias("category_id"), F.col("category_name").alias("name")).distinct()
    names = members(held, "categories", F.broadcast(dim), "category_id").groupBy("case_id").agg(F.array_join(F.array_sort(F.collect_set("name")), ";").alias("category_names"))
    return cases.select("case_id").join(names, "case_id", "left").select("case_id", F.coalesce("category_names", F.lit("")).alias("category_names"))


def blob_url(base: Column, container: Column, name: Column) -> Column:
    """base/container/name; null if a part is null or empty."""
    whole = (base != "") & (container != "") & (name != "")
    return F.when(whole, F.concat(base, F.lit("/"), container, F.lit("/"), name))


def listed(cases: DataFrame) -> DataFrame:
    """The list projection: parties with a name only, bench ids joined; null arrays count as empty."""
    party = lambda name, role: F.struct(F.col(name).alias("name"), F.lit(role).alias("role"))
    parties = F.filter(F.array(party("petitioner", "petitioner"), party("respondent", "respondent")), lambda p: F.coalesce(p["name"], F.lit("")) != "")
    return cases.select(
        "case_id", F.array_join(F.transform(parties, lambda p: F.concat_ws("/", p["name"], p["role"])), ";").alias("parties"),
        F.array_join(F.transform(F.coalesce("bench", F.array().cast("array<bigint>")), lambda x: x.cast("string")), ";").alias("bench"),
    )
