"""Queries read whole texts and tables: what stands late in a text, comes late in a stream, or sits in a large group counts."""

import random

import pytest
from pyspark.sql import functions as F

from benchbook.functions import spans, text
from benchbook.functions import vocabulary as v
from benchbook.operators import batches, entities, writes
from benchbook.plans import QUERIES, text_queries
from benchbook.plans.source_queries import folded
from benchbook.sources import html
from benchbook.sources.domain import Domain
from benchbook.streaming import logs
from tests.conftest import DATA


class OneCase:
    """A domain of a single case with a given text."""

    def __init__(self, spark, body):
        self.frame = spark.createDataFrame([(1, body)], "case_id long, text string")

    def cases(self, text=False):
        return self.frame


def test_judgments_hold_what_stands_late_in_a_text(spark):
    body = "Filler words only. " * 4000 + "Late cites (2011) 7 SCC 77 under Section 420 of the Indian Penal Code."
    made = text_queries.judgments(OneCase(spark, body)).cache()
    assert body in made.first()["text"]
    own = made.select(text.extract_provisions(F.col("text")).alias("p"), F.size(text.split_sentences(F.col("text"))).alias("n"), text.build_excerpt(F.col("text"))["mode"].alias("mode")).first()
    assert "420" in [p["section_number"] for p in own["p"]] and own["n"] > 4000 and own["mode"] == "long"
    marked = made.withColumn("s", spans.match_spans(F.col("text"), *spans.CITATIONS)).select(spans.citation_candidates(F.col("text"), F.col("s"))).first()[0]
    assert "(2011) 7 SCC 77" in [c["raw_citation"] for c in marked]


def by_hand(kinds):
    state, applied, ignored = "NEW", 0, 0
    for k in kinds:
        come, to = batches.TRANSITIONS.get(k, ((), None)) if k != "HEARTBEAT" else (("RUNNING",), "RUNNING")
        state, applied, ignored = (to, applied + 1, ignored) if state in come else (state, applied, ignored + 1)
    return state, applied, ignored


def test_a_large_batch_of_events_is_folded_in_pieces(spark):
    rng = random.Random(3)
    kinds = [*batches.TRANSITIONS, "HEARTBEAT", "UNKNOWN"]
    made = [(7 if rng.random() < 0.5 else rng.randrange(300), i, rng.choice(kinds), rng.randrange(2000)) for i in range(6000)]
    events = spark.createDataFrame(made, "batch_id long, log_id long, kind string, s long").withColumn("at", F.col("s").cast("timestamp")).repartition(3)
    want = {}
    for b, _, k, _ in sorted(made, key=lambda r: (r[3], r[1])):
        want.setdefault(b, []).append(k)
    folded = batches.fold_states(events)
    assert {r["batch_id"]: (r["state"], r["applied"], r["ignored"]) for r in folded.collect()} == {b: by_hand(k) for b, k in want.items()}
    # Only maps of runs are collected, never a batch's events.
    plan = folded._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("collect_list(struct(place") < plan.index("MapInArrow") and plan.count("collect_list") == 1
    placed = spark.createDataFrame([(1, "STARTED", 0), (1, "FAILED", 1), (2, "RESUMED", 2)], "batch_id long, kind string, place long").coalesce(1)
    maps = placed.mapInArrow(batches._transition_maps, "batch_id long, place long, ends array<int>, applied array<long>, n long").collect()
    assert [(r["batch_id"], r["place"], batches.STATES[r["ends"][0]], r["applied"][0], r["n"]) for r in maps] == [(1, 0, "FAILED", 2, 2), (2, 2, "NEW", 0, 1)]


def test_streams_over_many_files_of_shuffled_times(spark, tmp_path, monkeypatch):
    given = spark.read.parquet(f"{DATA}/events.parquet")
    given.repartition(11, F.xxhash64("event_id")).write.parquet(str(tmp_path / "events.parquet"))
    days = {r["day"]: r["n"] for r in QUERIES["cases_daily_stream"](spark, str(tmp_path)).collect()}
    shifted = given.select((F.col("ts") + F.expr("interval 330 minutes")).cast("date").alias("day"))
    assert days == {r["day"]: r["count"] for r in shifted.groupBy("day").count().collect()}
    monkeypatch.setattr(logs.replay, "__defaults__", ("update", 400))
    batch = {r["batch_id"]: r["state"] for r in folded(Domain(spark, str(tmp_path))).collect()}
    stream = {r["batch_id"]: r["state"] for r in QUERIES["state_machine_stream"](spark, str(tmp_path)).collect()}
    assert set(stream) == set(batch) and all(stream[k] == batch[k] or (stream[k], batch[k]) == ("STALE", "RUNNING") for k in batch)


def test_statutes_of_one_name_meet(spark):
    sentences = [
        (1, 0, "Section 5 of the Wakf Boards Act applies."), (1, 1, "Section 6 of the Bakf Boards Act too."), (2, 0, "Section 302 of the IPC applies."), (2, 1, "Section 34 of the Indian Penal Code too."),
        (3, 0, "Section 7 of the Arms Act holds."), (3, 1, "The Constitution is supreme."), (3, 2, "Section 9 fails."), (3, 3, "The Arms Act is old."), (3, 4, "But article 21 holds."),
    ]
    frame = spark.createDataFrame(sentences, "case_id int, sentence int, text string")
    got = sorted((r["case_id"], r["provision"], r["statute"]) for r in entities.paired_provisions(entities.entity_spans(frame)).collect())
    assert got == [
        (1, "Section 5", "Wakf Boards Act"), (1, "Section 6", "Wakf Boards Act"), (2, "Section 302", "Indian Penal Code"), (2, "Section 34", "Indian Penal Code"),
        (3, "Section 7", "Arms Act"), (3, "Section 9", "Arms Act"), (3, "article 21", "Constitution"),
    ]
    spelt = spark.createDataFrame([(1, 0, 0, "STATUTE", "The Police Act"), (1, 1, 0, "STATUTE", "Police Act"), (1, 2, 0, "STATUTE", "Forest Act")], "case_id int, sentence int, start int, label string, text string")
    assert {r["text"]: r["statute"] for r in entities.canonical_statutes(spelt).collect()} == {"The Police Act": "The Police Act", "Police Act": "The Police Act", "Forest Act": "Forest Act"}


def test_the_last_of_repeated_labels_counts_for_every_field(spark):
    row = lambda label, cell: f"<tr><td>{label}</td><td>{cell}</td></tr>"
    cells = row("Case No.", "WRIT PETITION (WP) 1/2018") + row("Status", "PENDING") + row("Act", "1 - First Act (Section - 1)") + row("Status", "DISPOSED") + row("Act", "2 - Second Act (Section - 2)")
    page = spark.createDataFrame([(1, f"<table id='case-details-table'>{cells}</table>")], "page_id long, html string")
    found = html.case_details(page, "page_id").first()
    assert found["status_line"] == "DISPOSED" and [a["act_name"] for a in found["acts"]] == ["Second Act"]


def test_ranks_by_grain_equal_a_global_order(spark):
    rng = random.Random(6)
    rows = [(i, rng.choice([None, *range(9)]), rng.randrange(40)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, day int, x int").repartition(5)
    found = {r["id"]: r["rank"] for r in writes.ranked(df, -F.col("day"), [F.desc("x"), F.col("id")]).collect()}
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), -r[2], r[0]))
    assert found == {r[0]: n + 1 for n, r in enumerate(want)}
