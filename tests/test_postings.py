"""The inverted table against a look at every text; changed cases change only their own rows."""

import random

import pytest
from pyspark.sql import functions as F

from benchbook.functions.lexers import PORTABLE, English, match_all, match_phrase
from benchbook.operators import postings
from benchbook.operators.postings import Postings, vectors
from benchbook.operators.search import Search, SearchRequest
from benchbook.sources.domain import Domain
from tests.conftest import DATA

WORDS = "the court of appeal dismissed appeals and dismisses an appeal in court no 12".split()


@pytest.fixture(scope="module")
def cases(spark):
    rng = random.Random(3)
    rows = [(i, f"No. {i}", rng.choice(["The State", None, "A. B."]), " ".join(rng.choice(WORDS) for _ in range(rng.randrange(0, 30))) if i % 7 else None) for i in range(120)]
    return spark.createDataFrame(rows, "case_id long, case_number string, petitioner string, text string").repartition(3)


def ids(df):
    return sorted(r["case_id"] for r in df.collect())


@pytest.mark.parametrize("lexer", [PORTABLE, English()], ids=["portable", "english"])
def test_terms_and_phrases_equal_a_look_at_the_texts(cases, lexer):
    table = Postings.build(cases, lexer)
    tokens = cases.withColumn("w", lexer.column(F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in ("case_number", "petitioner", "text")])))
    for query in ("court", "court of appeal", "Appeals dismissed", "the of", "", "12 nowhere", "appeal appeal"):
        assert ids(table.all_of(lexer.lexemes(query))) == ids(tokens.where(match_all(F.col("w"), lexer.lexemes(query)))), query
    for query in ("court of appeal", "the court", "appeal appeal", "dismissed the court", "of the", "state court", "", "no 12"):
        words = lexer.words(query)
        assert ids(table.phrase(words)) == ids(tokens.where(match_phrase(F.col("w"), words))), query


def test_places_and_classes(spark):
    one = spark.createDataFrame([(5, "No. 7", "court", "A court, the court")], "case_id long, case_number string, petitioner string, text string")
    got = {r["term"]: (r["places"], r["classes"]) for r in Postings.build(one).rows(["no", "7", "court", "the", "x"]).collect()}
    assert got == {"no": ([0], "B"), "7": ([1], "B"), "court": ([2, 4, 6], "BD"), "the": ([5], "D")}


def test_an_upsert_changes_only_its_own_rows(spark, cases):
    table = Postings.build(cases)
    before = {(r["term"], r["case_id"]): r["places"] for r in table.rows(sorted(set(WORDS))).collect()}
    files = set(spark.read.parquet(f"{table.folder}/rows").inputFiles())
    changed = spark.createDataFrame([(3, "No. 3", "court court"), (4, "No. 4", None), (500, "No. 500", "appeal of the court")], "case_id long, case_number string, text string")
    table.upsert(changed)
    table.upsert(changed.where("case_id = 3"))
    table.remove(spark.createDataFrame([(5,)], "case_id long"))
    after = {(r["term"], r["case_id"]): r["places"] for r in table.rows(sorted(set(WORDS))).collect()}
    mine = {3, 4, 5, 500}
    assert {k: v for k, v in after.items() if k[1] not in mine} == {k: v for k, v in before.items() if k[1] not in mine}
    assert {k: v for k, v in after.items() if k[1] in mine} == {("no", 3): [0], ("court", 3): [2, 3], ("no", 4): [0], ("no", 500): [0], ("appeal", 500): [2], ("of", 500): [3], ("the", 500): [4], ("court", 500): [5]}
    assert files < set(spark.read.parquet(f"{table.folder}/rows").inputFiles())  # nothing old was rewritten
    whole = Postings.build(cases.where(~F.col("case_id").isin(3, 4, 5)).unionByName(changed.withColumn("petitioner", F.lit(None).cast("string"))))
    assert {(r["term"], r["case_id"]): r["places"] for r in whole.rows(sorted(set(WORDS))).collect()} == after


def test_a_request_reads_only_the_buckets_of_its_terms_and_no_text(spark):
    search = Search(Domain(spark, DATA))
    found = search.found(SearchRequest.of({"all": ["that", "the"], "none": ["misc"]}))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan and "documents" not in plan
    assert "PartitionFilters: [isnotnull(bucket" in plan or "bucket#" in plan and " IN (" in plan


def test_building_shuffles_no_words(spark, cases):
    """Words outnumber texts by far; only the texts may be dealt out, and a table of few blocks has few rows per term."""
    plan = vectors(cases, PORTABLE)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == cases._jdf.queryExecution().executedPlan().toString().count("Exchange")
    table = Postings.build(cases)
    kept = spark.read.parquet(f"{table.folder}/rows").where("term = 'court'")
    assert kept.count() <= 3 and table.rows(["court"]).count() > 50


def test_blocks_of_few_words_give_the_same_rows(spark, cases, monkeypatch):
    whole = Postings.build(cases, English())
    monkeypatch.setattr(postings, "BLOCK", 7)
    rows = lambda t: sorted((r["term"], r["case_id"], r["places"], r["classes"]) for r in t.rows(["court", "appeal", "dismiss", "12", "the"]).collect())
    assert rows(Postings.build(cases, English())) == rows(whole)


def test_odd_texts(spark):
    one = spark.createDataFrame([(1, None), (2, ""), (3, "\u0130stanbul \u212a9 x\u0000y \U0001f600z"), (4, "..."), (5, "a a")], "case_id long, text string")
    table = Postings.build(one)
    tokens = {r["case_id"]: r["w"] for r in one.select("case_id", PORTABLE.column(F.col("text")).alias("w")).collect()}
    want = sorted((w, i, [k for k, v in enumerate(ws) if v == w], "D") for i, ws in tokens.items() for w in set(ws))
    assert sorted(map(tuple, table.rows(sorted({w for w, *_ in want})).collect())) == want
    assert ids(table.phrase(["a", "a"])) == [5] and ids(table.phrase(["a", None, "a"])) == []
    assert ids(Postings.build(one.where("case_id < 0")).phrase(["a"])) == []
