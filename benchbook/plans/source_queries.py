"""Queries of sources and streams: pages to rows, landing zone, log streams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchbook.operators.batches import fold_states
from benchbook.plans.batch_queries import NOW, SWEEP
from benchbook.plans.registry import query
from benchbook.sources import html, landing, resumable
from benchbook.sources.domain import Domain
from benchbook.streaming import log_sink as sink
from benchbook.streaming import logs, sweep

S = "cast(case_id as string)"


def made_pages(d: Domain, template: str) -> DataFrame:
    """A page per case: the template with its columns, as a site would show them. Cases are few bytes and pages much work, so
    cases are dealt over as many tasks as a shuffle has, and pages are made there."""
    cases = d.flat().select("case_id", "petitioner", "respondent", "party_raw")
    return cases.repartition(int(d.spark.conf.get("spark.sql.shuffle.partitions"))).select("case_id", F.expr(template).alias("html"))


MP = f"""concat('<table class="table case-details-table"><tr><td>Case No. :</td><td>CRIMINAL APPEAL (CRA) ', {S}, '/2024 Registered On 30-05-2024 CNR: MP', {S}, '</td></tr><tr><td>Status</td><td>Pending</td></tr>',
'<tr><td>Category</td><td>CRIMINAL LAW &amp; PROCEDURE-12100<br/>Code-12102</td></tr><tr><td>Last Listed On</td><td>10-11-2025 [ HON''BLE SHRI JUSTICE ', petitioner, ' ]</td></tr>',
'<tr><td>Act</td><td>231 - Code of Criminal Procedure (Section - 374(2))<br>231 - Code of Criminal Procedure (Section - 374(2))<br>9 - Other Act (Section - 1/2)</td></tr>',
'<tr><td>Petitioner(s)</td><td><div class="d-flex align-items-start"><div class="small"><div>', petitioner, '</div><div>S/o X</div><div>Street 1</div></div></div></td></tr>',
'<tr><td>Petitioner Advocate(s)</td><td><span class="fw-semibold">', respondent, '[P-1] [3258/1996]</span></td></tr></table>')"""
ILR = f"""concat('<div class="card-header"><p>Jabalpur/WP/', {S}, '/2018</p><span class="info-box-text text-left">Mr. Justice AMr. Justice B</span>( Division Bench )<br>Neutral Citation - 2018:MPHC:', {S}, '<br>Decision date- 05 March 2019</div>',
'<div class="card-body"><span class="info-box-text">', petitioner, '</span><span class="info-box-text">... Petitioner</span><span class="info-box-text">', respondent, '</span><span class="info-box-text">... Respondent</span><p class="info-box-text">Head note</p></div>')"""
TS = f"""concat('<div id="resultCard"><h3 class="section-title">Primary Details</h3><table><tr><th>Main Number</th><td>WP ', {S}, '/2019</td><th>SR Number</th><td>7</td></tr><tr><th>Petitioner</th><td>', petitioner, '</td><th>Case Status</th><td>Pending</td></tr></table>',
'<h3>PETITIONER(S)</h3><table><tr><td>1</td><td>', petitioner, '<br>Village A<br>Town B</td></tr></table><h3>Orders</h3><table><tr><th>On</th><th>Judge</th><th>Date</th><th>Type</th><th>File</th></tr><tr><td>IA</td><td>J A</td><td>01-01-2020</td><td>Interim</td><td><a href="/o/', {S}, '">x</a></td></tr></table></div>')"""
REPORT = f"""concat('<table id="reportTable"><tr><th>S.No</th><th>Case Number</th><th>Parties</th></tr><tr><td>1</td><td>wp ', {S}, '/2019</td><td><a href="/a">', party_raw, '</a></td></tr><tr><td>2</td><td>WP ', {S}, '/2019</td><td>again</td></tr><tr><td>3</td><td></td><td>none</td></tr></table>')"""

query("html_table_parse_mp")(lambda d: html.case_details(made_pages(d, MP), "case_id"))
query("html_detail_parse_ilr")(lambda d: html.detail_pane(made_pages(d, ILR), "case_id"))
query("html_table_parse_ts")(lambda d: html.status_page(made_pages(d, TS), "case_id"))
query("report_rows_parse")(lambda d: html.report_rows(made_pages(d, REPORT), "case_id"))


@query("results_row_read", "SELECT case_id, case_number number, CASE WHEN case_id % 2 = 0 THEN 'second' ELSE party_raw END party FROM cases")
def results_row_read(d: Domain) -> DataFrame:
    heads = F.array(F.lit("Case Number"), F.lit("Party"), F.when(F.col("case_id") % 2 == 0, "Party").otherwise("Bench"))
    row = d.cases().select("case_id", html.read_row(heads, F.array("case_number", "party_raw", F.lit("second"))).alias("m"))
    return row.select("case_id", F.col("m")["Case Number"].alias("number"), F.col("m")["Party"].alias("party"))


@query("json_case_read", "SELECT log_id, CASE WHEN n % 10 <> 0 THEN CAST(n AS VARCHAR) END cnr, CASE WHEN n % 10 <> 0 THEN 1 END orders FROM log_events")
def json_case_read(d: Domain) -> DataFrame:
    body = F.when(F.col("n") % 10 == 0, "[]").otherwise(F.concat(F.lit('{"primary": {"cnrno": "'), F.col("n").cast("string"), F.lit('"}, "orderdetails": [{"judge": "A"}]}')))
    return d.events().select("log_id", html.json_case(body).alias("r")).select("log_id", "r.cnr", F.when(F.col("r").isNotNull(), F.size("r.orders")).alias("orders"))


@query("page_titles", "SELECT page_id, trim(regexp_replace(regexp_extract(html, '<title>([^<&]*)</title>', 1), '\\s+', ' ', 'g')) title FROM pages WHERE regexp_matches(html, '<title>[^<&]*</title>')")
def page_titles(d: Domain) -> DataFrame:
    pages = d.raw("pages").where(F.col("html").rlike("<title>[^<&]*</title>"))
    return pages.select("page_id", html.title(F.col("html")).alias("title"))


ITEMS = "SELECT batch_id, item_key, part_id, status FROM items"


@query("scraped_source", ITEMS)
def scraped_source(d: Domain) -> DataFrame:
    """Discovered items land as files and are read back as the source of a batch."""
    folder = landing.shared_folder(d.spark)
    found = d.items().select("batch_id", "item_key", "part_id", "status")
    landing.land(found, folder)
    return landing.landed(d.spark, folder, found.schema)


@query("scraped_source_stream", ITEMS)
def scraped_source_stream(d: Domain) -> DataFrame:
    folder = landing.shared_folder(d.spark)
    found = d.items().select("batch_id", "item_key", "part_id", "status")
    landing.land(found, folder)
    return logs.run_available(landing.landed_stream(d.spark, folder, found.schema)).drop("batch")


WINDOW_DAYS = 30
OUTCOMES = f"""WITH d AS (SELECT min(CAST("at" AS DATE)) f FROM items), x AS (SELECT CAST(f + CAST(datediff('day', f, CAST("at" AS DATE)) // {WINDOW_DAYS} * {WINDOW_DAYS} AS INTEGER) AS DATE) first_day,
item_key, status s, '{{"part_id":' || part_id || ',"status":"' || status || '"}}' payload, CASE WHEN "position" = 7 THEN 'known' END known FROM items, d)
SELECT first_day, item_key, 'DONE' status, coalesce(known, CASE s WHEN 'PENDING' THEN 'not listed yet' WHEN 'FAILED' THEN 'NOT_PUBLISHED' END) reason, CASE WHEN known IS NULL AND s <> 'PENDING' THEN payload END record
FROM x QUALIFY row_number() OVER (PARTITION BY first_day, item_key ORDER BY payload) = 1"""


@query("resumable_source", OUTCOMES)
def resumable_source(d: Domain) -> DataFrame:
    """All items as a site lists them by days, worked through by the resumable source; what its ledger holds then."""
    folder = landing.shared_folder(d.spark)
    payload = F.to_json(F.struct("part_id", "status"))
    listed = d.items().select(F.to_date("at").alias("day"), "item_key", payload.alias("payload"), F.when(F.col("position") == 7, "known").alias("done_reason"))
    first, last = listed.agg(F.min("day"), F.max("day")).first()
    if first is None:
        return d.spark.createDataFrame([], resumable.SCHEMA)
    resumable.land_site(listed, f"{folder}/site", first, WINDOW_DAYS)
    options = {"adapter": "benchbook.sources.resumable:Listing", "site": f"{folder}/site", "ledger": f"{folder}/ledger", "days": str(WINDOW_DAYS), "flushRows": "20000", "flushSeconds": "60"}
    resumable.run(d.spark, **options, **{"from": str(first), "to": str(last)})
    return resumable.ledger(d.spark, f"{folder}/ledger")


@query("log_tail", "SELECT log_id, batch_id, kind FROM log_events WHERE log_id > 1000 AND kind = 'LOG'")
def log_tail(d: Domain) -> DataFrame:
    """Followed to its end: the events' batches are finished, so the second look brings nothing."""
    lines = lambda: logs.tail(logs.events_stream(d.spark, d.sf_dir), 1000).where("event_type = 'click'").select("log_id", "batch_id", F.lit("LOG").alias("kind"))
    none = d.spark.createDataFrame([], "log_id long, batch_id long, kind string")
    return reduce(DataFrame.union, logs.follow(lines, lambda: True, landing.shared_folder(d.spark)), none)


@query("stale_sweep_stream", SWEEP)
def stale_sweep_stream(d: Domain) -> DataFrame:
    """The sweep's timers over all batches, with a clock that stands where the batch twin's does."""
    folder = landing.shared_folder(d.spark)
    batches = d.batches().select("batch_id", "status", "requested_at", "heartbeat_at", "cancel_requested")
    landing.land(batches, folder)
    now = d.spark.range(1).select(F.unix_millis(F.lit(NOW).cast("timestamp")), F.unix_millis(F.current_timestamp())).first()
    with sweep.stateful(d.spark):
        return logs.run_available(sweep.sweep(landing.landed_stream(d.spark, folder, batches.schema), now[1] - now[0]), once=True).drop("batch")


@query("log_sink", "SELECT batch_id, count(*) n FROM log_events GROUP BY batch_id")
def log_sink(d: Domain) -> DataFrame:
    folder = landing.shared_folder(d.spark)
    lines = logs.events_stream(d.spark, d.sf_dir).select("batch_id", "log_id")
    sink.write(lines, f"{folder}/sink", f"{folder}/checkpoint", flushRows="20000").awaitTermination()
    return sink.committed(d.spark, f"{folder}/sink", lines.schema).groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))


@query("cases_daily_stream", "SELECT CAST(\"at\" + INTERVAL 330 MINUTE AS DATE) \"day\", count(*) n FROM log_events GROUP BY 1")
def cases_daily_stream(d: Domain) -> DataFrame:
    return logs.final(logs.run_available(logs.daily(logs.events_stream(d.spark, d.sf_dir)), "update"), ["day"])


@query("state_machine_stream")
def state_machine_stream(d: Domain) -> DataFrame:
    kind = F.element_at(F.create_map(*[F.lit(x) for x in ("signup", "STARTED", "view", "HEARTBEAT", "error", "FAILED", "purchase", "COMPLETED")]), F.col("event_type"))
    events = logs.log_lines(d.raw("events")).withColumn("kind", kind).where("kind is not null").select("batch_id", "log_id", "kind", "at")
    return logs.final(logs.replay(events, logs.batch_states), ["batch_id"])


def folded(d: Domain) -> DataFrame:
    return fold_states(d.events())
