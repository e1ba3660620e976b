"""Queries of batch administration, logs and search history."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from benchbook.operators import batches as b
from benchbook.operators import history as h
from benchbook.operators.ordered import places
from benchbook.operators.writes import ranked
from benchbook.plans.registry import query
from benchbook.sources.domain import Domain

NOW = "2024-01-31 00:00:00"
TS = f"TIMESTAMP '{NOW}'"
ADAPTERS = "court_id % 2 = 0"

# --- history ---
LATEST = "SELECT entry_id, user_id, query, created_at FROM (SELECT *, row_number() OVER (PARTITION BY user_id, lower(query) ORDER BY created_at DESC, entry_id DESC) r FROM history) x WHERE r = 1"
query("history_record", LATEST)(lambda d: h.latest(d.history()))
FOUND = f"SELECT * FROM ({LATEST}) l WHERE user_id = 8 AND query ILIKE '%click%' AND CAST(created_at AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-28'"
query("history_filter", FOUND)(lambda d: h.find(h.latest(d.history()), 8, "click", "2024-01-03", "2024-01-28"))


@query("history_sort", f"SELECT entry_id, query, CAST(row_number() OVER (ORDER BY lower(query), entry_id) AS INTEGER) AS \"rank\" FROM ({LATEST}) l WHERE user_id = 8")
def history_sort(d: Domain) -> DataFrame:
    return h.find(h.latest(d.history()), 8).select("entry_id", "query", F.row_number().over(Window.orderBy(*h.order("query_asc"))).alias("rank"))


@query("history_sort_unknown", f"SELECT entry_id, query, CAST(row_number() OVER (ORDER BY created_at DESC, entry_id) AS INTEGER) AS \"rank\" FROM ({LATEST}) l WHERE user_id = 8")
def history_sort_unknown(d: Domain) -> DataFrame:
    return h.find(h.latest(d.history()), 8).select("entry_id", "query", F.row_number().over(Window.orderBy(*h.order("by_colour"))).alias("rank"))


# --- batch lists ---
def listed(name: str, where: str, **kw) -> None:
    sql = f"SELECT batch_id, court_id, status FROM batches LEFT JOIN courts USING (court_id) WHERE {where}"
    query(name, sql)(lambda d: b.batch_filter(d.batches(), d.courts(), NOW, **kw).select("batch_id", "court_id", "status"))


listed("batch_filter", f"court_id IN (1, 2, 3) AND requested_at >= {TS} - INTERVAL 240 HOUR", court_ids=(1, 2, 3), hours=240)
listed("batch_filter_id", "CAST(batch_id AS VARCHAR) LIKE '12%'", q=" #12")
listed("batch_filter_name", "court_name ILIKE '%nation_1%' OR court_code ILIKE 'nation_1'", q="nation_1")
listed("batch_filter_nobody", "started_by IS NULL", started_by="none")


@query("status_group_filter", "SELECT batch_id, status FROM batches WHERE status IN ('FAILED', 'RATE_LIMITED', 'SOURCE_BLOCKED', 'SOURCE_UNAVAILABLE', 'STRUCTURE_CHANGED')")
def status_group_filter(d: Domain) -> DataFrame:
    return d.batches().where(F.col("status").isin(*b.GROUPS["stopped"])).select("batch_id", "status")


@query("is_distinct_from", "SELECT case_id FROM cases WHERE disposition IS DISTINCT FROM 'Allowed'")
def is_distinct_from(d: Domain) -> DataFrame:
    return d.cases().where(~F.col("disposition").eqNullSafe("Allowed")).select("case_id")


MISSING = "judgment_status <> 'AVAILABLE' AND court_id IN (1, 2, 3) AND (case_number ILIKE '%12%' OR petitioner ILIKE '%12%' OR respondent ILIKE '%12%' OR coalesce(neutral_citation, '') ILIKE '%12%')"


def missing(d: Domain) -> DataFrame:
    like = [F.coalesce(F.col(c).ilike("%12%"), F.lit(False)) for c in ("case_number", "petitioner", "respondent", "neutral_citation")]
    return d.cases().where((F.col("judgment_status") != "AVAILABLE") & F.col("court_id").isin(1, 2, 3) & (like[0] | like[1] | like[2] | like[3]))


query("missing_judgment_filter", f"SELECT case_id, judgment_status FROM cases WHERE {MISSING}")(lambda d: missing(d).select("case_id", "judgment_status"))


@query("missing_sort", f"SELECT case_id, CAST(row_number() OVER (ORDER BY judgment_date DESC NULLS LAST, case_id DESC) AS INTEGER) AS \"rank\" FROM cases WHERE {MISSING}")
def missing_sort(d: Domain) -> DataFrame:
    latest_first = -F.datediff("judgment_date", F.lit("1970-01-01").cast("date"))
    return ranked(missing(d), latest_first, [F.desc("case_id")]).select("case_id", "rank")


@query("missing_summary", "SELECT court_name, judgment_status, count(*) n FROM cases JOIN courts USING (court_id) WHERE judgment_status <> 'AVAILABLE' GROUP BY ALL")
def missing_summary(d: Domain) -> DataFrame:
    rows = d.cases().where("judgment_status <> 'AVAILABLE'").join(F.broadcast(d.courts()), "court_id")
    return rows.groupBy("court_name", "judgment_status").agg(F.count(F.lit(1)).alias("n"))


OVERLAP = "SELECT DISTINCT m.batch_id FROM batches m JOIN batches o ON m.court_id = o.court_id AND o.batch_id <> m.batch_id AND o.status IN ('QUEUED', 'RUNNING') AND o.from_date <= m.to_date AND o.to_date >= m.from_date"
query("interval_join", OVERLAP)(lambda d: b.overlapping_active(d.batches()))


@query("interval_overlap", "SELECT batch_id FROM batches WHERE status IN ('QUEUED', 'RUNNING') AND court_id = 3 AND from_date <= DATE '1997-06-30' AND to_date >= DATE '1997-01-01'")
def interval_overlap(d: Domain) -> DataFrame:
    return d.batches().where(F.col("status").isin(*b.ACTIVE) & (F.col("court_id") == 3)).where("from_date <= date '1997-06-30' and to_date >= date '1997-01-01'").select("batch_id")


RESUMABLE = f"SELECT *, status NOT IN ('QUEUED', 'RUNNING') AND {ADAPTERS} AND ((NOT discovered AND status <> 'COMPLETED') OR batch_id IN (SELECT batch_id FROM items WHERE status IN ('PENDING', 'FAILED'))) resumable FROM batches"


def flagged(d: Domain) -> DataFrame:
    return b.resumable(d.batches(), d.items(), F.expr(ADAPTERS))


query("resumable_predicate", f"SELECT batch_id, resumable FROM ({RESUMABLE}) x")(lambda d: flagged(d).select("batch_id", "resumable"))
SUMMARY = f"SELECT status, count(*) n, CAST(sum(promoted) AS BIGINT) promoted, count(*) FILTER (WHERE resumable) resumable FROM ({RESUMABLE}) x GROUP BY status"
query("batch_summary", SUMMARY)(lambda d: b.summary(flagged(d)))
query("batch_group_totals", f"SELECT CASE WHEN status IN ('QUEUED', 'RUNNING') THEN 'running' WHEN status = 'COMPLETED' THEN 'completed' WHEN status = 'CANCELLED' THEN 'cancelled' ELSE 'stopped' END group_name, CAST(sum(n) AS BIGINT) n, CAST(sum(promoted) AS BIGINT) promoted, CAST(sum(resumable) AS BIGINT) resumable FROM ({SUMMARY}) y GROUP BY 1")(
    lambda d: b.group_totals(b.summary(flagged(d)))
)


@query("enrichment_backlog", "SELECT case_id FROM cases JOIN documents d ON d.doc_id = case_id WHERE case_id % 5 IN (0, 1, 2) AND case_id % 4 < 3 AND d.text IS NOT NULL ORDER BY case_id LIMIT 50")
def enrichment_backlog(d: Domain) -> DataFrame:
    state = F.element_at(F.array(*[F.lit(s) for s in ("PENDING", "FAILED", "TRUNCATED", "DONE", "SKIPPED")]), (F.col("case_id") % 5 + 1).cast("int"))
    return d.cases(text=True).where(state.isin("PENDING", "FAILED", "TRUNCATED") & (F.col("case_id") % 4 < 3) & F.col("text").isNotNull()).orderBy("case_id").limit(50).select("case_id")


@query("coalesce_json_path", "SELECT log_id, coalesce(CASE WHEN n % 3 = 0 THEN NULL ELSE CAST(n AS VARCHAR) END, 'batch ' || batch_id) \"value\" FROM log_events")
def coalesce_json_path(d: Domain) -> DataFrame:
    payload = F.when(F.col("n") % 3 == 0, F.lit("{}")).otherwise(F.col("details"))
    return d.events().select("log_id", F.coalesce(F.get_json_object(payload, "$.k"), F.concat(F.lit("batch "), F.col("batch_id").cast("string"))).alias("value"))


SWEEP = f"SELECT batch_id, status, CASE WHEN cancel_requested THEN 'CANCELLED' ELSE 'FAILED' END new_status, 'INTERRUPTED' \"event\" FROM batches WHERE (status = 'QUEUED' AND requested_at < {TS} - INTERVAL 15 MINUTE) OR (status = 'RUNNING' AND coalesce(heartbeat_at, requested_at) < {TS} - INTERVAL 5 MINUTE)"


@query("stale_sweep", SWEEP)
def stale_sweep(d: Domain) -> DataFrame:
    return b.stale_sweep(d.batches(), NOW)


@query("heartbeat", "SELECT batch_id, max(\"at\") last_seen FROM log_events WHERE kind = 'HEARTBEAT' GROUP BY batch_id")
def heartbeat(d: Domain) -> DataFrame:
    return d.events().where("kind = 'HEARTBEAT'").groupBy("batch_id").agg(F.max("at").alias("last_seen"))


DAILY = "SELECT CAST(day AS DATE) \"day\", coalesce(n, 0) n FROM (SELECT unnest(generate_series(DATE '2024-01-18', DATE '2024-01-31', INTERVAL 1 DAY)) AS day) s LEFT JOIN (SELECT CAST(\"at\" + INTERVAL 330 MINUTE AS DATE) AS d, count(*) n FROM {} GROUP BY 1) c ON c.d = CAST(s.day AS DATE)"
query("cases_daily", DAILY.format("log_events WHERE kind = 'COMPLETED'"))(lambda d: b.daily_counts(d.events().where("kind = 'COMPLETED'"), "at", "2024-01-31", 14))
query("calendar_left_join", DAILY.format("log_events WHERE batch_id = 8"))(lambda d: b.daily_counts(d.events().where("batch_id = 8"), "at", "2024-01-31", 14))


@query("generate_series", "SELECT CAST(unnest(generate_series(min(judgment_date), max(judgment_date), INTERVAL 1 DAY)) AS DATE) \"day\" FROM cases")
def generate_series(d: Domain) -> DataFrame:
    ends = d.cases().agg(F.min("judgment_date").alias("a"), F.max("judgment_date").alias("z"))
    return ends.select(F.explode(F.sequence("a", "z")).alias("day"))


@query("event_timeline", """WITH own AS (SELECT batch_id, kind "event", "at", log_id FROM log_events WHERE kind <> 'LOG'),
bare AS (SELECT * FROM batches WHERE batch_id NOT IN (SELECT batch_id FROM own)),
alls AS (SELECT * FROM own UNION ALL SELECT batch_id, 'STARTED', requested_at, 0 FROM bare UNION ALL SELECT batch_id, status, finished_at, 1 FROM bare WHERE finished_at IS NOT NULL)
SELECT batch_id, "event", "at", CAST(row_number() OVER (PARTITION BY batch_id ORDER BY "at", log_id) AS INTEGER) place FROM alls""")
def event_timeline(d: Domain) -> DataFrame:
    return b.timeline(d.batches(), d.events())


# The same fold in SQL: one event of every batch per round. The cases are those of b.TRANSITIONS that the events reach.
MACHINE = """WITH RECURSIVE e AS (SELECT batch_id, kind, row_number() OVER (PARTITION BY batch_id ORDER BY "at", log_id) place FROM log_events WHERE kind <> 'LOG'),
r AS (SELECT batch_id, 0 place, 'NEW' state, 0 applied FROM e GROUP BY batch_id
UNION ALL SELECT batch_id, place, coalesce(moved, state), applied + CASE WHEN moved IS NULL THEN 0 ELSE 1 END FROM (SELECT r.batch_id, CAST(e.place AS INTEGER) place, state, applied,
CASE WHEN kind = 'STARTED' AND state IN ('QUEUED', 'NEW') THEN 'RUNNING' WHEN kind = 'COMPLETED' AND state = 'RUNNING' THEN 'COMPLETED' WHEN kind = 'FAILED' AND state IN ('QUEUED', 'RUNNING') THEN 'FAILED' WHEN kind = 'HEARTBEAT' AND state = 'RUNNING' THEN 'RUNNING' END moved
FROM r JOIN e ON e.batch_id IS NOT DISTINCT FROM r.batch_id AND e.place = r.place + 1) x)
SELECT batch_id, arg_max(state, place) state, max(applied) applied, max(place) - max(applied) ignored FROM r GROUP BY batch_id"""
query("state_machine", MACHINE)(lambda d: b.fold_states(d.events()))
PLACED = "SELECT batch_id, item_key, status, row_number() OVER (PARTITION BY batch_id ORDER BY case_id, \"position\", part_id, status) place FROM items"


def placed(d: Domain) -> DataFrame:
    """Items with their place in their batch; a batch may hold a third of all items."""
    return places(d.items().select("batch_id", "item_key", "status", "flag", "case_id", "position", "part_id"), ["batch_id"], ["case_id", "position", "part_id", "status"]).withColumn("place", F.col("place").cast("int"))


@query("failure_run_stop", f"""WITH p AS ({PLACED}), i AS (SELECT *, sum(CASE WHEN status = 'FAILED' THEN 0 ELSE 1 END) OVER (PARTITION BY batch_id ORDER BY place) island FROM p),
n AS (SELECT *, row_number() OVER (PARTITION BY batch_id, island ORDER BY place) nth FROM i WHERE status = 'FAILED') SELECT batch_id, CAST(min(place) AS INTEGER) stopped_at FROM n WHERE nth = 5 GROUP BY batch_id""")
def failure_run_stop(d: Domain) -> DataFrame:
    return b.failure_stop(placed(d))


@query("resume_ledger", f"SELECT batch_id, place, CASE WHEN status = 'DONE' AND flag = 'F' THEN 'PENDING' ELSE status END new_status FROM (SELECT p.*, flag FROM ({PLACED.replace('SELECT batch_id', 'SELECT flag, batch_id')}) p) x WHERE status IN ('PENDING', 'FAILED') OR (status = 'DONE' AND flag = 'F')")
def resume_ledger(d: Domain) -> DataFrame:
    again = (F.col("status") == "DONE") & (F.col("flag") == "F")  # stands for items skipped before, which a retry takes up
    rows = placed(d).where(F.col("status").isin("PENDING", "FAILED") | again)
    return rows.select("batch_id", "place", F.when(again, "PENDING").otherwise(F.col("status")).alias("new_status"))


ROUTED = """SELECT case_id, CASE WHEN judgment_status <> 'AVAILABLE' THEN CASE WHEN court_id % 2 = 1 THEN 'SKIPPED' WHEN case_id % 11 = 0 THEN 'FAILED' WHEN case_id % 3 = 0 THEN 'DONE' ELSE 'NO_JUDGMENT' END
WHEN case_id % 11 = 0 THEN 'FAILED' WHEN case_id % 13 = 0 THEN 'DONE' WHEN case_id % 17 = 0 THEN 'FAILED' WHEN case_id % 3 <> 0 THEN 'DONE' WHEN judgment_date IS NULL THEN 'DONE' ELSE 'FAILED' END status,
CASE WHEN judgment_status <> 'AVAILABLE' THEN CASE WHEN court_id % 2 = 1 THEN judgment_status WHEN case_id % 11 = 0 THEN 'couldn''t save case details' WHEN case_id % 3 = 0 THEN 'already in database' ELSE judgment_status END
WHEN case_id % 11 = 0 THEN 'couldn''t save the judgment PDF' WHEN case_id % 13 = 0 THEN 'duplicate PDF' WHEN case_id % 17 = 0 THEN 'unhandled pipeline error' WHEN case_id % 3 <> 0 THEN NULL WHEN judgment_date IS NULL THEN 'needs review' ELSE 'ocr_failed' END reason FROM cases"""


def routed(d: Domain) -> DataFrame:
    k = F.col("case_id")
    made = b.route(
        F.when(F.col("judgment_status") != "AVAILABLE", F.col("judgment_status")), F.col("court_id") % 2 == 0, k % 11 == 0, k % 13 == 0, k % 17 == 0, F.when(k % 3 != 0, k),
        F.when(F.col("judgment_date").isNull(), "NEEDS_REVIEW").otherwise("OCR_FAILED"),
    )
    return d.cases().select("case_id", made.alias("r")).select("case_id", "r.*")


query("outcome_router", ROUTED)(routed)
query("tallies", f"SELECT status, reason, count(*) n FROM ({ROUTED}) x GROUP BY ALL")(lambda d: routed(d).groupBy("status", "reason").agg(F.count(F.lit(1)).alias("n")))


@query("run_counters", f"SELECT count(*) processed, count(*) FILTER (WHERE reason = 'duplicate PDF') duplicates, count(*) FILTER (WHERE status = 'NO_JUDGMENT') no_judgment, count(*) FILTER (WHERE reason = 'needs review') needs_review, count(*) FILTER (WHERE status = 'FAILED') errored, count(*) FILTER (WHERE status = 'DONE' AND reason IS NULL) promoted FROM ({ROUTED}) x")
def run_counters(d: Domain) -> DataFrame:
    n = lambda cond, name: F.count(F.when(F.expr(cond), 1)).alias(name)
    return routed(d).agg(
        F.count(F.lit(1)).alias("processed"), n("reason = 'duplicate PDF'", "duplicates"), n("status = 'NO_JUDGMENT'", "no_judgment"), n("reason = 'needs review'", "needs_review"), n("status = 'FAILED'", "errored"), n("status = 'DONE' and reason is null", "promoted")
    )


# --- joins and counts ---
LAST = "row_number() OVER (PARTITION BY case_id ORDER BY \"position\" DESC, part_id DESC, batch_id DESC, status DESC)"


@query("lateral_latest", f"SELECT c.case_id, l.item_key, l.status, b.status batch_status FROM cases c LEFT JOIN (SELECT *, {LAST} r FROM items) l ON l.case_id = c.case_id AND l.r = 1 LEFT JOIN batches b ON b.batch_id = l.batch_id WHERE c.judgment_status <> 'AVAILABLE'")
def lateral_latest(d: Domain) -> DataFrame:
    latest = d.items().groupBy("case_id").agg(F.max(F.struct("position", "part_id", "batch_id", "status", "item_key")).alias("l")).select("case_id", "l.item_key", "l.status", "l.batch_id")
    cases = d.cases().where("judgment_status <> 'AVAILABLE'").select("case_id")
    return cases.join(latest, "case_id", "left").join(d.batches().select("batch_id", F.col("status").alias("batch_status")), "batch_id", "left").select("case_id", "item_key", "status", "batch_status")


OVERVIEW = f"SELECT court_id, court_name, coalesce(n, 0) n, CAST(coalesce(promoted, 0) AS BIGINT) promoted, coalesce(recent, 0) recent, last_requested_at FROM courts LEFT JOIN (SELECT court_id, count(*) n, sum(promoted) promoted, count(*) FILTER (WHERE requested_at >= {TS} - INTERVAL 24 HOUR) recent, max(requested_at) last_requested_at FROM batches GROUP BY court_id) x USING (court_id)"
query("left_agg_join", OVERVIEW)(lambda d: b.court_overview(d.courts(), d.batches(), NOW))
query("recent_count", f"SELECT court_id, count(*) FILTER (WHERE requested_at >= {TS} - INTERVAL 24 HOUR) recent FROM batches GROUP BY court_id")(
    lambda d: d.batches().groupBy("court_id").agg(F.count(F.when(F.col("requested_at") >= b.at(NOW) - F.make_dt_interval(F.lit(1)), 1)).alias("recent"))
)
query("max_by_group", "SELECT court_id, max(requested_at) last_requested_at FROM batches GROUP BY court_id")(lambda d: d.batches().groupBy("court_id").agg(F.max("requested_at").alias("last_requested_at")))


@query("multi_left", "SELECT batch_id, court_name, adapter FROM batches LEFT JOIN courts USING (court_id) LEFT JOIN (SELECT court_id, 'adapter-' || court_id adapter FROM courts WHERE court_id % 2 = 0) c USING (court_id)")
def multi_left(d: Domain) -> DataFrame:
    config = d.courts().where("court_id % 2 = 0").select("court_id", F.concat(F.lit("adapter-"), F.col("court_id").cast("string")).alias("adapter"))
    return d.batches().join(F.broadcast(d.courts()), "court_id", "left").join(F.broadcast(config), "court_id", "left").select("batch_id", "court_name", "adapter")


@query("item_case_left", "SELECT item_key, i.batch_id, i.part_id, case_number FROM items i LEFT JOIN cases c ON c.case_id = i.case_id AND i.flag = 'F'")
def item_case_left(d: Domain) -> DataFrame:
    items, cases = d.items(), d.cases().select("case_id", "case_number")
    return items.join(cases, (items["case_id"] == cases["case_id"]) & (items["flag"] == "F"), "left").select("item_key", "batch_id", "part_id", "case_number")


@query("ingestion_case_left", "SELECT doc_id, sha256(text) checksum, case_number, judgment_status FROM documents LEFT JOIN cases ON case_id = doc_id AND case_id % 2 = 0")
def ingestion_case_left(d: Domain) -> DataFrame:
    cases = d.cases().where("case_id % 2 = 0").select(F.col("case_id").alias("doc_id"), "case_number", "judgment_status")
    return d.raw("documents").select("doc_id", F.sha2("text", 256).alias("checksum")).join(cases, "doc_id", "left")


@query("anti_new", "SELECT DISTINCT case_id, CASE WHEN c.judgment_status = 'AVAILABLE' THEN 'already in database' END done_reason FROM items LEFT JOIN cases c USING (case_id)")
def anti_new(d: Domain) -> DataFrame:
    there = d.cases().where("judgment_status = 'AVAILABLE'").select("case_id", F.lit("already in database").alias("done_reason"))
    return d.items().select("case_id").distinct().join(there, "case_id", "left")


@query("pivot_status_counts", "SELECT court_id, string_agg(status || '=' || n, ';' ORDER BY status) counts FROM (SELECT court_id, status, count(*) n FROM batches GROUP BY ALL) x GROUP BY court_id")
def pivot_status_counts(d: Domain) -> DataFrame:
    per = d.batches().groupBy("court_id", "status").agg(F.count(F.lit(1)).alias("n"))
    as_map = per.groupBy("court_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "n")))).alias("m"))
    return as_map.select("court_id", F.array_join(F.transform(F.map_entries("m"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ";").alias("counts"))


@query("count_nonnull", "SELECT court_id, count(*) n, count(finished_at) finished, count(started_by) started FROM batches GROUP BY court_id")
def count_nonnull(d: Domain) -> DataFrame:
    return d.batches().groupBy("court_id").agg(F.count(F.lit(1)).alias("n"), F.count("finished_at").alias("finished"), F.count("started_by").alias("started"))


@query("group_status", "SELECT 'item' kind, status, count(*) n FROM items GROUP BY status UNION ALL SELECT 'case', judgment_status, count(*) FROM cases JOIN documents ON doc_id = case_id GROUP BY judgment_status")
def group_status(d: Domain) -> DataFrame:
    items = d.items().groupBy("status").agg(F.count(F.lit(1)).alias("n")).select(F.lit("item").alias("kind"), "status", "n")
    texts = d.raw("documents").select(F.col("doc_id").alias("case_id"))
    cases = d.cases().join(texts, "case_id", "left_semi").groupBy("judgment_status").agg(F.count(F.lit(1)).alias("n"))
    return items.union(cases.select(F.lit("case").alias("kind"), F.col("judgment_status").alias("status"), "n"))


@query("derived_totals", "SELECT batch_id, CASE WHEN n > 0 THEN done ELSE promoted END total FROM batches LEFT JOIN (SELECT batch_id, count(*) n, count(*) FILTER (WHERE status = 'DONE') done FROM items GROUP BY batch_id) x USING (batch_id)")
def derived_totals(d: Domain) -> DataFrame:
    live = d.items().groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("status") == "DONE", 1)).alias("done"))
    return d.batches().join(live, "batch_id", "left").select("batch_id", F.when(F.col("n") > 0, F.col("done")).otherwise(F.col("promoted").cast("long")).alias("total"))


@query("mean_confidence", "SELECT batch_id, round(avg(page), 2) confidence FROM (SELECT batch_id, kind, sum(n) * 1.0 / count(*) page FROM log_events WHERE n % 7 <> 0 GROUP BY batch_id, kind) x GROUP BY batch_id")
def mean_confidence(d: Domain) -> DataFrame:
    pages = d.events().where("n % 7 <> 0").groupBy("batch_id", "kind").agg((F.sum("n") / F.count(F.lit(1))).alias("page"))
    return pages.groupBy("batch_id").agg(F.round(F.avg("page"), 2).alias("confidence"))


@query("batch_sort", f"SELECT batch_id, CAST(row_number() OVER (ORDER BY coalesce(finished_at, {TS}) - requested_at DESC, batch_id) AS INTEGER) AS \"rank\" FROM batches WHERE court_id = 3")
def batch_sort(d: Domain) -> DataFrame:
    took = F.coalesce(F.col("finished_at"), b.at(NOW)) - F.col("requested_at")
    rows = d.batches().where("court_id = 3").select("batch_id", took.alias("took"))
    hours = F.expr("extract(day from took) * 24 + extract(hour from took)")
    return ranked(rows, -hours, [F.desc("took"), F.col("batch_id")]).select("batch_id", "rank")


@query("cursor_page", "SELECT log_id, kind FROM log_events WHERE kind = 'LOG' AND log_id > 1000 ORDER BY log_id LIMIT 500")
def cursor_page(d: Domain) -> DataFrame:
    return d.events().where("kind = 'LOG' and log_id > 1000").orderBy("log_id").limit(500).select("log_id", "kind")


@query("retention_prune", f"SELECT log_id FROM log_events WHERE \"at\" >= {TS} - INTERVAL 7 DAY")
def retention_prune(d: Domain) -> DataFrame:
    return d.events().where(F.col("at") >= b.at(NOW) - F.make_dt_interval(F.lit(b.LOG_DAYS))).select("log_id")
