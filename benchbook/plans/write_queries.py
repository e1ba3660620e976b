"""Queries of array operations, dimension and case writes, deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchbook.operators import writes as w
from benchbook.plans.registry import query
from benchbook.sources.domain import Domain

joined = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ";")
IDS = "string_agg(CAST({0} AS VARCHAR), ';' ORDER BY {0})"

# --- arrays ---
query("array_overlap", "SELECT DISTINCT case_id FROM case_bench WHERE judge_id IN (1, 7)")(lambda d: d.cases().where(F.arrays_overlap("bench", F.array(F.lit(1).cast("long"), F.lit(7).cast("long")))).select("case_id"))
query("array_any_member", "SELECT case_id FROM case_acts WHERE act_id = 3")(lambda d: d.cases().where(F.array_contains("acts", F.lit(3).cast("long"))).select("case_id"))
query("unnest", "SELECT case_id, judge_id FROM case_bench")(lambda d: d.cases().select("case_id", F.explode("bench").alias("judge_id")))


@query("ordered_dedupe", "SELECT case_id, string_agg(CAST(judge_id AS VARCHAR), ';' ORDER BY f, judge_id) judges FROM (SELECT case_id, judge_id % 7 judge_id, min(section_id) f FROM lines GROUP BY case_id, judge_id % 7) x GROUP BY case_id")
def ordered_dedupe(d: Domain) -> DataFrame:
    listed = d.lines().groupBy("case_id").agg(F.array_sort(F.collect_list(F.struct("section_id", (F.col("judge_id") % 7).alias("j")))).alias("x"))
    # An array keeps first mentions; of one section's judges the smaller comes first, as does the SQL's tie by value.
    firsts = F.array_distinct(F.transform("x", lambda e: e["j"]))
    return listed.select("case_id", joined(firsts).alias("judges"))


@query("list_append_unique", "SELECT case_id, string_agg(CAST(m AS VARCHAR), ';' ORDER BY o, m) merged FROM (SELECT case_id, m, min(o) o FROM (SELECT case_id, ministry_id m, 0 o FROM case_ministries UNION ALL SELECT case_id, 2, 1 FROM cases UNION ALL SELECT case_id, 9, 2 FROM cases) u GROUP BY case_id, m) x GROUP BY case_id")
def list_append_unique(d: Domain) -> DataFrame:
    return d.cases().select("case_id", joined(F.array_distinct(F.concat("ministries", F.array(F.lit(2).cast("long"), F.lit(9).cast("long"))))).alias("merged"))


# --- survivors and merging of duplicates ---
COPIES = "SELECT * FROM acts UNION ALL SELECT act_id + 1000, act_name, act_year, short_code FROM acts WHERE act_id % 3 = 0"
POINTED = "SELECT section_id, CASE WHEN act_id % 3 = 0 AND section_id % 2 = 0 THEN act_id + 1000 ELSE act_id END act_id, section_number FROM sections"
PLAN = f"SELECT act_id duplicate, survivor FROM (SELECT act_id, min(act_id) OVER (PARTITION BY act_name, act_year) survivor FROM ({COPIES}) c) x WHERE act_id <> survivor"


def act_copies(d: Domain) -> DataFrame:
    acts = d.acts()
    return acts.union(acts.where("act_id % 3 = 0").withColumn("act_id", F.col("act_id") + 1000))


def pointed_sections(d: Domain) -> DataFrame:
    moved = (F.col("act_id") % 3 == 0) & (F.col("section_id") % 2 == 0)
    return d.sections().select("section_id", F.when(moved, F.col("act_id") + 1000).otherwise(F.col("act_id")).alias("act_id"), "section_number")


def act_plan(d: Domain) -> DataFrame:
    return w.survivors(act_copies(d), "act_id", ["act_name", "act_year"])


query("survivor_window", PLAN)(act_plan)
query("update_from", f"SELECT section_id, coalesce(survivor, act_id) act_id FROM ({POINTED}) s LEFT JOIN ({PLAN}) p ON duplicate = act_id")(lambda d: w.remap(pointed_sections(d), "act_id", act_plan(d)).select("section_id", "act_id"))
SECTION_PLAN = "SELECT section_id duplicate, survivor FROM (SELECT section_id, min(section_id) OVER (PARTITION BY act_id, section_number) survivor FROM sections) x WHERE section_id <> survivor"


def section_plan(d: Domain) -> DataFrame:
    """After acts are merged, sections with one act and number are one section."""
    merged = w.remap(pointed_sections(d), "act_id", act_plan(d))
    return w.survivors(merged, "section_id", ["act_id", "section_number"])


REMAPPED = f"SELECT case_id, coalesce(ids, '') sections FROM cases LEFT JOIN (SELECT case_id, {IDS.format('s')} ids FROM (SELECT DISTINCT case_id, coalesce(survivor, section_id) s FROM case_sections LEFT JOIN ({SECTION_PLAN}) p ON duplicate = section_id) x GROUP BY case_id) y USING (case_id)"
query("array_remap_distinct", REMAPPED)(lambda d: w.remap_array(d.cases(), "case_id", "sections", section_plan(d)).select("case_id", joined("sections").alias("sections")))
query("dedupe_merge", f"SELECT section_id, act_id, section_number FROM sections WHERE section_id NOT IN (SELECT duplicate FROM ({SECTION_PLAN}) p)")(
    lambda d: w.remap(pointed_sections(d), "act_id", act_plan(d)).join(section_plan(d).select(F.col("duplicate").alias("section_id")), "section_id", "left_anti")
)

# --- get or create ---


@query("get_or_create", "SELECT act_id, act_name, act_year, short_code FROM acts WHERE act_id % 2 = 0 UNION ALL SELECT (SELECT max(act_id) FROM acts WHERE act_id % 2 = 0) + row_number() OVER (ORDER BY act_name, act_year), act_name, act_year, short_code FROM acts WHERE act_id % 2 = 1")
def get_or_create(d: Domain) -> DataFrame:
    known = d.acts().where("act_id % 2 = 0")
    named = d.lines().select("act_id", "section_id").join(F.broadcast(d.acts()), "act_id").select("act_name", "act_year", "short_code", "section_id")
    return w.get_or_create(known, named, ["act_name", "act_year"], "act_id", "section_id")


@query("resolve_act_entries", f"SELECT case_id, {IDS.format('act_id')} act_ids, (SELECT 1) one FROM (SELECT DISTINCT case_id, act_id FROM lines) x GROUP BY case_id")
def resolve_act_entries(d: Domain) -> DataFrame:
    entries = d.lines().select("case_id", "act_id").distinct().join(d.acts(), "act_id").select("case_id", "act_name", "act_year")
    dim = d.acts().select("act_name", F.col("act_year").alias("y"), F.col("act_id").alias("found"))
    back = entries.join(dim, (entries["act_name"] == dim["act_name"]) & entries["act_year"].eqNullSafe(dim["y"]))
    return back.groupBy("case_id").agg(joined(F.array_sort(F.collect_set("found"))).alias("act_ids")).withColumn("one", F.lit(1))


@query("resolve_provisions", f"SELECT case_id, {IDS.format('DISTINCT act_id').replace('ORDER BY DISTINCT', 'ORDER BY').replace('CAST(DISTINCT act_id', 'DISTINCT CAST(act_id').replace('ORDER BY act_id', 'ORDER BY CAST(act_id AS VARCHAR)')} act_ids, {IDS.format('section_id')} section_ids FROM lines GROUP BY case_id")
def resolve_provisions(d: Domain) -> DataFrame:
    """Acts without repeats, sections with them, as they are cited."""
    return d.lines().groupBy("case_id").agg(joined(F.array_sort(F.collect_set(F.col("act_id").cast("string")))).alias("act_ids"), joined(F.array_sort(F.collect_list("section_id"))).alias("section_ids"))


# --- cases ---
TARGET = "SELECT case_id, court_id, case_number, judgment_status, CASE WHEN judgment_status <> 'AVAILABLE' THEN 'late' END reason, 'old-' || case_id source_url, judgment_date, CASE WHEN case_id % 6 = 0 THEN 'CASE/X/' || case_id END external_id FROM cases WHERE case_id % 2 = 0"
INCOMING = "SELECT case_id, court_id, case_number, CASE WHEN case_id % 20 = 10 THEN 'NOT_PUBLISHED' ELSE 'AVAILABLE' END judgment_status, CASE WHEN case_id % 20 = 10 THEN 'still none' END reason, CASE WHEN case_id % 3 = 0 THEN NULL ELSE 'new-' || case_id END source_url, judgment_date, case_id % 20 = 10 missing FROM cases WHERE case_id % 3 <> 1"
POST = f"""WITH t AS ({TARGET}), n AS ({INCOMING}), j AS (SELECT coalesce(t.court_id, n.court_id) court_id, coalesce(t.case_number, n.case_number) case_number, coalesce(t.case_id, n.case_id) case_id, t.external_id,
CASE WHEN t.case_id IS NULL THEN 'inserted' WHEN n.case_id IS NULL THEN 'untouched' WHEN t.judgment_status = 'AVAILABLE' THEN 'kept' WHEN n.missing THEN 'refreshed' ELSE 'filled' END outcome,
t.judgment_status ts, n.judgment_status ns, t.reason tr, n.reason nr, t.source_url tu, n.source_url nu, t.judgment_date td, n.judgment_date nd FROM t FULL OUTER JOIN n ON t.court_id = n.court_id AND t.case_number = n.case_number)
SELECT court_id, case_number, case_id, external_id, CASE WHEN outcome IN ('inserted', 'filled', 'refreshed') THEN ns ELSE ts END judgment_status, CASE WHEN outcome IN ('inserted', 'filled', 'refreshed') THEN nr ELSE tr END reason,
CASE WHEN outcome IN ('inserted', 'filled') THEN nu WHEN outcome = 'refreshed' THEN coalesce(nu, tu) ELSE tu END source_url, CASE WHEN outcome IN ('inserted', 'filled') THEN nd ELSE td END judgment_date, outcome FROM j"""


def target(d: Domain) -> DataFrame:
    k = F.col("case_id")
    return d.cases().where("case_id % 2 = 0").select(
        "case_id", "court_id", "case_number", "judgment_status", F.when(F.col("judgment_status") != "AVAILABLE", "late").alias("reason"), F.concat(F.lit("old-"), k.cast("string")).alias("source_url"), "judgment_date", F.when(k % 6 == 0, F.concat(F.lit("CASE/X/"), k.cast("string"))).alias("external_id")
    )


def incoming(d: Domain) -> DataFrame:
    k = F.col("case_id")
    missing = k % 20 == 10
    return d.cases().where("case_id % 3 <> 1").select(
        "case_id", "court_id", "case_number", F.when(missing, "NOT_PUBLISHED").otherwise("AVAILABLE").alias("judgment_status"), F.when(missing, "still none").alias("reason"), F.when(k % 3 != 0, F.concat(F.lit("new-"), k.cast("string"))).alias("source_url"), "judgment_date", missing.alias("missing")
    )


def upserted(d: Domain) -> DataFrame:
    return w.guarded_upsert(target(d), incoming(d), ["court_id", "case_number"])


query("case_upsert_guarded", POST)(upserted)
query("still_missing_refresh", f"SELECT case_id, judgment_status, reason, source_url FROM ({POST}) p WHERE outcome = 'refreshed'")(lambda d: upserted(d).where("outcome = 'refreshed'").select("case_id", "judgment_status", "reason", "source_url"))
DUE = f"SELECT p.case_id, p.external_id, court_code, judgment_date FROM ({POST}) p JOIN courts USING (court_id)"
COUNTERS = "SELECT court_code, 1997 AS \"year\", 40 AS last FROM courts WHERE court_id % 2 = 1 AND court_code IS NOT NULL"
SEQUENCED = f"""SELECT case_id, coalesce(external_id, given) external_id FROM ({DUE}) x LEFT JOIN (SELECT case_id, 'CASE/' || court_code || '/' || lpad(CAST(coalesce(last, 0) + row_number() OVER (PARTITION BY court_code, year(judgment_date) ORDER BY case_id) AS VARCHAR), 4, '0') || '/' || year(judgment_date) given
FROM ({DUE}) y LEFT JOIN ({COUNTERS}) c USING (court_code) WHERE external_id IS NULL AND judgment_date IS NOT NULL AND court_code IS NOT NULL) z USING (case_id)"""
SEQUENCED = SEQUENCED.replace("LEFT JOIN (" + COUNTERS + ") c USING (court_code)", "LEFT JOIN (" + COUNTERS.replace("court_code, 1997", "court_code cc, 1997") + ") c ON cc = court_code AND c.\"year\" = year(judgment_date)")


def counters(d: Domain) -> DataFrame:
    return d.courts().where("court_id % 2 = 1 and court_code is not null").select("court_code", F.lit(1997).alias("year"), F.lit(40).alias("last"))


def sequenced(d: Domain) -> DataFrame:
    due = upserted(d).join(F.broadcast(d.courts()), "court_id").select("case_id", "external_id", "court_code", "judgment_date")
    return w.assign_sequences(due, counters(d))


query("sequence_assign", SEQUENCED)(lambda d: sequenced(d).select("case_id", "external_id"))


@query("late_sequence_assign", "SELECT case_id, 'CASE/' || court_code || '/' || lpad(CAST(row_number() OVER (PARTITION BY court_code, year(created_at) ORDER BY case_id) AS VARCHAR), 4, '0') || '/' || year(created_at) external_id FROM cases JOIN courts USING (court_id) WHERE judgment_date IS NULL AND court_code IS NOT NULL")
def late_sequence_assign(d: Domain) -> DataFrame:
    """A review gives cases without a date their day of entry; only those get a number, and doing it again changes none."""
    dated = d.cases().where("judgment_date is null").join(F.broadcast(d.courts()), "court_id").select("case_id", F.lit(None).cast("string").alias("external_id"), "court_code", F.to_date("created_at").alias("judgment_date"))
    none = counters(d).where("false")
    again = w.assign_sequences(w.assign_sequences(dated, none), none)
    return again.where("external_id is not null").select("case_id", "external_id")


KNOWN_FILES = "SELECT sha256(text) checksum, min(CASE doc_id % 3 WHEN 0 THEN 'PROMOTED' WHEN 1 THEN 'NEEDS_REVIEW' ELSE 'OCR_FAILED' END) status FROM documents WHERE doc_id % 2 = 0 GROUP BY 1"


@query("ingest_dedupe", f"SELECT checksum, CASE WHEN status IS NULL THEN 'new' WHEN status IN ('PROMOTED', 'NEEDS_REVIEW') THEN 'duplicate' ELSE 'reused' END outcome, CASE WHEN status IN ('PROMOTED', 'NEEDS_REVIEW') THEN status ELSE 'DOWNLOADED' END status FROM (SELECT DISTINCT sha256(text) checksum FROM documents) i LEFT JOIN ({KNOWN_FILES}) k USING (checksum)")
def ingest_dedupe(d: Domain) -> DataFrame:
    files = d.raw("documents").select("doc_id", F.sha2("text", 256).alias("checksum"))
    state = F.when(F.col("doc_id") % 3 == 0, "PROMOTED").when(F.col("doc_id") % 3 == 1, "NEEDS_REVIEW").otherwise("OCR_FAILED")
    known = files.where("doc_id % 2 = 0").groupBy("checksum").agg(F.min(state).alias("status"))
    return w.ingest(known, files)


@query("enrich_merge", f"""WITH a AS (SELECT case_id, {IDS.format('ministry_id')} m FROM case_ministries GROUP BY case_id), s AS (SELECT case_id, {IDS.format('act_id')} acts FROM case_acts GROUP BY case_id)
SELECT case_id, CASE WHEN came THEN 'note ' || case_id END case_note, coalesce(CASE WHEN came AND case_id % 4 = 1 THEN 'Neither' END, favouring_party) favouring_party, coalesce(disposition, CASE WHEN came THEN 'Other' END) disposition,
CASE WHEN came THEN '3' ELSE CAST(industry_id AS VARCHAR) END industries, coalesce(m, '') || CASE WHEN came THEN CASE WHEN m IS NULL THEN '77' ELSE ';77' END ELSE '' END ministries, coalesce(acts, CASE WHEN came THEN '5' ELSE '' END) acts, CAST(case_id % 3 + CASE WHEN came THEN 1 ELSE 0 END AS INTEGER) attempts
FROM (SELECT *, case_id % 2 = 1 came FROM cases) c LEFT JOIN a USING (case_id) LEFT JOIN s USING (case_id)""")
def enrich_merge(d: Domain) -> DataFrame:
    k = F.col("case_id")
    cases = d.cases().select("case_id", F.lit(None).cast("string").alias("case_note"), "favouring_party", "disposition", "industries", "ministries", "acts", (k % 3).cast("int").alias("attempts"))
    longs = lambda *x: F.array(*[F.lit(i).cast("long") for i in x])
    answers = d.cases().where("case_id % 2 = 1").select("case_id", F.concat(F.lit("note "), k.cast("string")).alias("case_note"), F.when(k % 4 == 1, "Neither").alias("favouring_party"), F.lit("Other").alias("disposition"), longs(3).alias("industries"), longs(77).alias("ministries"), longs(5).alias("acts"))
    out = w.enrich_merge(cases, answers)
    return out.select("case_id", "case_note", "favouring_party", "disposition", joined("industries").alias("industries"), joined("ministries").alias("ministries"), joined("acts").alias("acts"), "attempts")


@query("status_write", "SELECT log_id, kind status, substr(repeat(details || ' ', 60), 1, 500) error, n + 1 attempts FROM log_events WHERE kind = 'FAILED'")
def status_write(d: Domain) -> DataFrame:
    # A message of many lines, as a traceback is: at most 500 characters of it are kept.
    message = F.repeat(F.concat("details", F.lit(" ")), F.lit(60))
    return d.events().where("kind = 'FAILED'").select("log_id", F.col("kind").alias("status"), F.substring(message, 1, 500).alias("error"), (F.col("n") + 1).alias("attempts"))


@query("config_upsert", "SELECT court_id, 'old' config FROM courts WHERE court_id % 2 = 0 AND court_id % 3 <> 0 UNION ALL SELECT court_id, 'new' FROM courts WHERE court_id % 3 = 0")
def config_upsert(d: Domain) -> DataFrame:
    old = d.courts().where("court_id % 2 = 0").select("court_id", F.lit("old").alias("config"))
    return w.overwrite_by_key(old, d.courts().where("court_id % 3 = 0").select("court_id", F.lit("new").alias("config")), ["court_id"])


KNOWN_ITEMS = "SELECT DISTINCT batch_id, item_key FROM items WHERE part_id % 4 = 0"


@query("items_save", f"SELECT batch_id, item_key, CAST(-1 AS INTEGER) place, 'DONE' status, CAST(NULL AS VARCHAR) done_reason FROM ({KNOWN_ITEMS}) k UNION ALL SELECT batch_id, item_key, CAST(min(part_id) AS INTEGER), CASE WHEN min(CASE WHEN part_id % 10 < 3 THEN part_id END) = min(part_id) THEN 'DONE' ELSE 'PENDING' END, CASE WHEN min(CASE WHEN part_id % 10 < 3 THEN part_id END) = min(part_id) THEN 'already in database' END FROM items WHERE (batch_id, item_key) NOT IN (SELECT batch_id, item_key FROM ({KNOWN_ITEMS}) k2) GROUP BY batch_id, item_key")
def items_save(d: Domain) -> DataFrame:
    known = d.items().where("part_id % 4 = 0").select("batch_id", "item_key").distinct().select("batch_id", "item_key", F.lit(-1).alias("place"), F.lit("DONE").alias("status"), F.lit(None).cast("string").alias("done_reason"))
    found = d.items().select("batch_id", "item_key", F.col("part_id").cast("int").alias("place"), F.when(F.col("part_id") % 10 < 3, "already in database").alias("done_reason"))
    return w.save_items(known, found)


@query("item_mark", "SELECT item_key, batch_id, part_id, CASE WHEN flag = 'F' THEN 'DONE' ELSE status END status, CASE WHEN flag = 'F' AND part_id % 2 = 0 THEN part_id ELSE case_id END case_id, CAST(\"position\" + CASE WHEN flag = 'F' THEN 1 ELSE 0 END AS INTEGER) attempts FROM items")
def item_mark(d: Domain) -> DataFrame:
    marked = F.col("flag") == "F"
    new_id = F.when(marked & (F.col("part_id") % 2 == 0), F.col("part_id"))
    return d.items().select("item_key", "batch_id", "part_id", F.when(marked, "DONE").otherwise(F.col("status")).alias("status"), F.coalesce(new_id, "case_id").alias("case_id"), (F.col("position") + F.when(marked, 1).otherwise(0)).cast("int").alias("attempts"))


@query("ddl_migrate", "SELECT n_name || '.sql' filename, CAST(row_number() OVER (ORDER BY n_name || '.sql') AS INTEGER) turn FROM nation WHERE n_nationkey % 3 <> 0")
def ddl_migrate(d: Domain) -> DataFrame:
    files = d.raw("nation").select(F.concat("n_name", F.lit(".sql")).alias("filename"), "n_nationkey")
    return w.pending_migrations(files.select("filename"), files.where("n_nationkey % 3 = 0").select("filename"))


@query("seed_upsert", "SELECT court_id, 'kept' label FROM courts WHERE court_id % 2 = 0 AND court_id <> 4 UNION ALL SELECT court_id, 'seeded' FROM courts WHERE court_id < 10 AND (court_id % 2 = 1 OR court_id = 4)")
def seed_upsert(d: Domain) -> DataFrame:
    there = d.courts().where("court_id % 2 = 0").select("court_id", F.lit("kept").alias("label"))
    return w.seed(there, d.courts().where("court_id < 10").select("court_id", F.lit("seeded").alias("label")), ["court_id"], [4])
