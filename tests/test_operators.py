"""Properties of search, facets, writes, batches, sources and streams; the layout of the package."""

import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from benchbook.operators import batches, facets, writes
from benchbook.operators.search import Search, SearchRequest
from benchbook.plans import QUERIES
from benchbook.plans.source_queries import folded
from benchbook.sources import html
from benchbook.sources.domain import Domain
from tests.conftest import DATA

ROOT = Path(__file__).resolve().parents[1]


@pytest.fixture(scope="module")
def domain(spark):
    return Domain(spark, DATA)


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def test_a_facet_of_names_counts_cases_without_names(domain):
    plan = facets.facet(domain, SearchRequest(), "judge")._jdf.queryExecution().executedPlan().toString()
    keys = [line.split("keys=[")[1].split("]")[0] for line in plan.splitlines() if "Aggregate(keys=[" in line]
    held = [k for k in keys if "case_id" in k]
    assert held and not any("label" in k or "value" in k for k in held)


def test_a_facet_ignores_its_own_selection(domain):
    chosen = SearchRequest.of({"filters": {"court_id": [1], "disposition": ["Allowed"]}})
    free = SearchRequest.of({"filters": {"disposition": ["Allowed"]}})
    assert rows(facets.facet(domain, chosen, "court"), "value", "n") == rows(facets.facet(domain, free, "court"), "value", "n")
    assert rows(facets.facet(domain, chosen, "disposition"), "value", "n") != rows(facets.facet(domain, free, "disposition"), "value", "n")


def test_pages_add_up(domain):
    search, request = Search(domain), SearchRequest.of({"filters": {"court": [1, 2]}})
    total = search.total(request, 50).first()
    seen = [r["case_id"] for p in range(1, total["pages"] + 1) for r in search.page(request, p, 50).collect()]
    assert len(seen) == len(set(seen)) == total["total"]
    for page, limit in ((0, 10), (1, 0), (1, 101)):
        with pytest.raises(ValueError, match="page"):
            search.page(request, page, limit)


def test_blank_parts_add_no_clause(domain):
    request = SearchRequest.of({"text": " ", "all": ["", " "], "filters": {"court": [], "judge": [""], "x": ["y"]}, "provisions": [{"act": ""}]})
    assert Search(domain).clauses(request) == []
    assert SearchRequest.of("  words ") == SearchRequest(text="words")


def test_filters_reach_the_scan(domain):
    plan = Search(domain).matched(SearchRequest.of({"filters": {"year": [1997]}})).select("case_id")._jdf.queryExecution().executedPlan().toString()
    orders = next(x for x in plan.split("Scan parquet") if "o_orderkey" in x and "ReadSchema" in x)
    assert "o_totalprice" not in orders and "text" not in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def target(spark):
    return spark.createDataFrame(
        [(1, 1, "A", "AVAILABLE", None, "u1", "2020-01-01", "X/1"), (2, 1, "B", "NOT_PUBLISHED", "late", "u2", None, None), (3, 1, "C", "DOWNLOAD_FAILED", "late", "u3", None, "X/3")],
        "case_id long, court_id long, case_number string, judgment_status string, reason string, source_url string, judgment_date string, external_id string",
    )


def incoming(spark):
    return spark.createDataFrame(
        [(11, 1, "A", "AVAILABLE", None, "n1", "2021-01-01", False), (12, 1, "B", "NOT_PUBLISHED", "still", None, None, True), (13, 1, "C", "AVAILABLE", None, "n3", "2021-01-01", False), (14, 1, "D", "AVAILABLE", None, "n4", "2021-01-01", False)],
        "case_id long, court_id long, case_number string, judgment_status string, reason string, source_url string, judgment_date string, missing boolean",
    )


def test_guarded_upsert(spark):
    once = writes.guarded_upsert(target(spark), incoming(spark), ["court_id", "case_number"])
    got = {r["case_number"]: (r["outcome"], r["case_id"], r["source_url"], r["judgment_status"], r["external_id"]) for r in once.collect()}
    assert got == {
        "A": ("kept", 1, "u1", "AVAILABLE", "X/1"), "B": ("refreshed", 2, "u2", "NOT_PUBLISHED", None), "C": ("filled", 3, "n3", "AVAILABLE", "X/3"), "D": ("inserted", 14, "n4", "AVAILABLE", None),
    }
    twice = writes.guarded_upsert(once.drop("outcome"), incoming(spark), ["court_id", "case_number"])
    columns = [c for c in once.columns if c != "outcome"]
    assert rows(once, *columns) == rows(twice, *columns)


def test_sequences(spark):
    cases = spark.createDataFrame([(5, None, "N1", "2020-05-01"), (3, None, "N1", "2020-01-01"), (4, "old", "N1", "2020-01-01"), (6, None, None, "2020-01-01"), (7, None, "N1", None)], "case_id long, external_id string, court_code string, judgment_date string").withColumn("judgment_date", F.col("judgment_date").cast("date"))
    counters = spark.createDataFrame([("N1", 2020, 9999)], "court_code string, year int, last int")
    once = writes.assign_sequences(cases, counters)
    assert rows(once, "case_id", "external_id") == [(3, "CASE/N1/10000/2020"), (4, "old"), (5, "CASE/N1/10001/2020"), (6, None), (7, None)]
    assert rows(writes.assign_sequences(once, counters), "case_id", "external_id") == rows(once, "case_id", "external_id")


@pytest.mark.parametrize("parts", [1, 7])
def test_get_or_create_is_gapless_and_stable(spark, parts):
    dim = spark.createDataFrame([(4, "a", None, "first")], "id long, name string, year int, extra string")
    came = spark.createDataFrame([("a", None, "later", 1), ("c", 2000, "x", 3), ("c", 2000, "y", 2), ("b", None, "z", 4), ("b", 1, "w", 5)], "name string, year int, extra string, n int").repartition(parts)
    got = writes.get_or_create(dim, came, ["name", "year"], "id", "n")
    assert rows(got, "name", "year", "extra") == rows(spark.createDataFrame([("a", None, "first"), ("b", None, "z"), ("b", 1, "w"), ("c", 2000, "y")], "name string, year int, extra string"), "name", "year", "extra")
    assert sorted(r["id"] for r in got.collect()) == [4, 5, 6, 7]
    again = writes.get_or_create(got, came, ["name", "year"], "id", "n")
    assert rows(again, *dim.columns) == rows(got, *dim.columns)


def test_remap_keeps_empty_arrays(spark):
    cases = spark.createDataFrame([(1, [3, 2, 3]), (2, [])], "case_id long, acts array<long>")
    plan = spark.createDataFrame([(3, 2)], "duplicate long, survivor long")
    assert {r["case_id"]: r["acts"] for r in writes.remap_array(cases, "case_id", "acts", plan).collect()} == {1: [2], 2: []}


def test_overlap_and_failures(spark):
    data = [(1, 1, "RUNNING", "2020-01-20", "2020-02-05"), (2, 1, "FAILED", "2020-02-05", "2020-02-06"), (3, 1, "FAILED", "2020-03-01", "2020-03-02"), (4, 2, "FAILED", "2020-01-21", "2020-01-22")]
    frame = spark.createDataFrame(data, "batch_id long, court_id long, status string, a string, b string").select("batch_id", "court_id", "status", F.col("a").cast("date").alias("from_date"), F.col("b").cast("date").alias("to_date"))
    assert rows(batches.overlapping_active(frame), "batch_id") == [(2,)]
    items = spark.createDataFrame([(1, i, s) for i, s in enumerate("FAILED FAILED DONE FAILED FAILED FAILED".split())] + [(2, 0, "FAILED")], "batch_id long, place int, status string")
    assert rows(batches.failure_stop(items, 3), "batch_id", "stopped_at") == [(1, 5)]


def test_stream_equals_batch(spark, domain):
    batch = {r["batch_id"]: r["state"] for r in folded(domain).collect()}
    stream = {r["batch_id"]: r["state"] for r in QUERIES["state_machine_stream"](spark, DATA).collect()}
    assert set(stream) == set(batch)
    assert all(stream[k] in (batch[k], "STALE") for k in batch)


def test_html_of_the_second_court(spark):
    page = """<table class="x case-details-table"><tr><td>Case No.:</td><td>WRIT PETITION (WP) 5/2018 Registered On 01-02-2018 CNR: ABC</td></tr><tr><td>Act</td><td>1 - An Act (Section - 2/3)<br>1 - An Act (Section - 2/3)</td></tr>
    <tr><td>Petitioner(s)</td><td><div class="d-flex align-items-start"><div class="small"><div>P Q</div><div>S/o R</div><div>Road</div></div></div><div class="d-flex align-items-start"><div class="small"><div>Second</div></div></div></td></tr>
    <tr><td>Petitioner Advocate(s)</td><td><span class="fw-semibold">A B[P-1] [12/1999]</span><span class="fw-semibold">no number</span></td></tr></table>"""
    pages = spark.createDataFrame([(1, page), (2, "<p>nothing</p>"), (3, None)], "id long, html string")
    r = html.case_details(pages, "id").collect()
    assert [x["id"] for x in r] == [1]
    r = r[0]
    assert (r["case_type_code"], r["cnr"], len(r["acts"]), r["acts"][0]["sections"]) == ("WP", "ABC", 1, ["2", "3"])
    assert [tuple(p) for p in r["petitioners"]] == [("P Q", "S/o R", "Road"), ("Second", None, None)]
    assert [tuple(a) for a in r["petitioner_advocates"]] == [("A B", "P-1", "12", 1999)]


def test_html_of_reports(spark):
    page = "<table><tr><th>Case Number</th><th>Parties</th></tr><tr><td>wp 1</td><td><a href='/x'>A</a></td></tr><tr><td>WP 1</td><td>B</td></tr><tr><td></td><td>C</td></tr><tr><td>WP 2</td></tr></table>"
    got = html.report_rows(spark.createDataFrame([(1, page)], "id long, html string"), "id").collect()
    assert sorted((r["fields"]["Case Number"], r["fields"].get("Parties"), r["href"]) for r in got) == [("WP 2", None, None), ("wp 1", "A", "/x")]


def test_nothing_outside_needs_the_corpus_subpackage():
    for p in [*(ROOT / "benchbook").rglob("*.py"), *(ROOT / "tests").glob("*.py")]:
        if "llm" not in p.parts[-2:-1]:
            assert not re.search(r"^\s*(?:from|import) .*\b(?:benchbook\.llm|corpus_pipeline)", p.read_text(), re.M), p


def test_driver_contract(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and set(QUERIES) <= set(e.queries())
    assert e.entry(spark).count() > 0


def test_plain_pages_are_read_as_the_library_reads_them():
    """Pages of plain tags take a short way; whatever else a page has, the library's parser reads it."""
    rng = random.Random(3)
    bits = ["<table>", "<TABLE id=\"a&amp;b\" class='x'>", '<table class="case-details-table big" hidden>', "</table>", "<tr>", "</tr>", "<td>", "</td>", "<th >", "</th>", "a &amp; b", "&lt;", "&am", "x < y", "<br/>", "<br>", "<div class=\"d-flex\">", "</div>", "<span class=\"fw-semibold\">", "</span>", "<a href=\"/o?a=1&amp;b\">", "</a>", "<!-- c -->", "<script>if (a<b)</script>", "<title>T<b></title>", "<h3>", "</h3>", "\n  ", "é", "<p/>", "</p x>", "<p", "&#39;"]
    for n in range(3000):
        page = "".join(rng.choice(bits[:4] + bits) for _ in range(rng.randrange(12)))
        for parser in (html.Cells, html.Marks):
            want = parser()
            want.feed(page)
            want.close()
            assert html._parsed(parser, page) == want.found(), page


def test_pages_are_made_in_many_tasks(spark, sf_dir):
    from benchbook.plans import source_queries
    from benchbook.sources.domain import Domain

    made = source_queries.made_pages(Domain(spark, sf_dir), source_queries.MP)
    assert made.rdd.getNumPartitions() == 4 and made.rdd.glom().filter(len).count() == 4
