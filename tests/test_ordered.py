"""Places, runs and sweeps over sorted pieces, held against plain loops; hot groups lie over many tasks."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from benchbook.operators import batches, ordered, writes


@pytest.fixture(params=[True, False], ids=["adaptive", "fixed"])
def planned(spark, request):
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", request.param)
    spark.conf.set("spark.sql.shuffle.partitions", 9)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("keys", [5_000, 50_000, 400_000])
def test_new_ids_of_many_wide_keys_are_gapless(planned, keys):
    dim = planned.createDataFrame([(1_000_000, "known", "first", "x")], "act_id long, name string, extra string, more string")
    came = planned.range(2 * keys).select(F.concat(F.lit("key "), (F.col("id") % keys).cast("string")).alias("name"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 2).alias("extra"), F.col("id").cast("string").alias("more"), F.col("id").alias("n")).repartition(11)
    got = writes.get_or_create(dim, came, ["name"], "act_id", "n")
    out = got.agg(F.count("*").alias("n"), F.countDistinct("act_id").alias("ids"), F.countDistinct("name").alias("names"), F.min("act_id").alias("least"), F.max("act_id").alias("most")).first()
    assert tuple(out) == (keys + 1, keys + 1, keys + 1, 1_000_000, 1_000_000 + keys)
    first = got.where("act_id > 1000000").select(F.expr("cast(substring(name, 5) as long)").alias("k"), F.col("more").cast("long").alias("m"))
    assert first.where("k <> m").isEmpty()  # the first row by n gave the other columns
    by_id = [r["name"] for r in got.where("act_id > 1000000").orderBy("act_id").limit(3).collect()]
    assert by_id == ["key 0", "key 1", "key 10"]


def test_sequences_of_a_hot_court(planned):
    n = 30_000
    cases = planned.range(n).select(
        ((F.col("id") * 7919) % n).alias("case_id"), F.when(F.col("id") % 50 == 0, "old").alias("external_id"), F.when(F.col("id") % 3 == 0, F.concat(F.lit("C"), (F.col("id") % 40).cast("string"))).otherwise("HOT").alias("court_code"),
        F.expr("make_date(2000 + cast(id % 2 as int), 1, 1)").alias("judgment_date"),
    )
    counters = planned.createDataFrame([("HOT", 2001, 77)], "court_code string, year int, last int")
    found = writes.assign_sequences(cases, counters).join(cases.select("case_id", F.col("external_id").alias("before")), "case_id").collect()
    assert len(found) == n
    groups = {}
    for r in found:
        if r["before"]:
            assert r["external_id"] == "old"
        else:
            groups.setdefault((r["court_code"], r["judgment_date"].year), []).append((r["case_id"], r["external_id"]))
    for (court, year), rows in groups.items():
        start = 77 if (court, year) == ("HOT", 2001) else 0
        assert [e for _, e in sorted(rows)] == [f"CASE/{court}/{start + k + 1:04d}/{year}" for k in range(len(rows))]
    ranges = ordered.ranged(cases, ["court_code", "case_id"]).where("court_code = 'HOT'").select("__range").distinct().count()
    assert ranges > 1 or planned.conf.get("spark.sql.adaptive.enabled") == "true"


def test_places_with_nulls_and_ties(planned):
    data = [(g, v) for g in ("a", None, "b") for v in (3, 1, None, 2, 2)] + [("hot", i) for i in range(500)]
    got = ordered.places(planned.createDataFrame(data, "g string, v int").repartition(5), ["g"], ["v"]).collect()
    for g in ("a", None, "b", "hot"):
        mine = sorted((r["place"], r["v"]) for r in got if r["g"] == g)
        want = sorted((v for h, v in data if h == g), key=lambda v: (v is not None, v))
        assert mine == [(k + 1, v) for k, v in enumerate(want)]
    assert ordered.places(planned.createDataFrame([], "g string, v int"), ["g"], ["v"]).count() == 0


def test_failure_runs_against_a_loop(planned):
    rng = random.Random(2)
    data = [(b, i, "FAILED" if rng.random() < share else rng.choice(["DONE", "PENDING", None])) for b, n, share in ((1, 4000, 0.5), (2, 60, 0.9), (3, 3, 1.0), (4, 900, 1.0), (5, 30, 0.0)) for i in range(n)]
    items = planned.createDataFrame(data, "batch_id long, place int, status string").repartition(6)
    for run in (1, 5, 40):
        want = {}
        for b, rows in itertools.groupby(sorted(data, key=lambda r: r[:2]), key=lambda r: r[0]):
            k = 0
            for _, place, status in rows:
                k = k + 1 if status == "FAILED" else 0
                if k == run:
                    want.setdefault(b, place)
        assert {r["batch_id"]: r["stopped_at"] for r in batches.failure_stop(items, run).collect()} == want


def test_overlap_sweep_against_all_pairs(planned):
    rng = random.Random(4)
    day = lambda k: f"2020-{1 + k // 28:02d}-{1 + k % 28:02d}"
    data = []
    for i in range(900):
        a = rng.randrange(300)
        data.append((i, rng.choice([1, 1, 1, 2, None]) if i % 9 else 3 + i, rng.choice(["QUEUED", "RUNNING", "FAILED", "DONE", None] + ["FAILED"] * 40), day(a), None if i % 50 == 7 else day(max(0, a + rng.randrange(-1, 3)))))
    frame = planned.createDataFrame(data, "batch_id long, court_id long, status string, a string, b string").select("batch_id", "court_id", "status", F.col("a").cast("date").alias("from_date"), F.col("b").cast("date").alias("to_date")).repartition(7)
    want = set()
    for i, c, _, a, b in data:
        for j, c2, s2, a2, b2 in data:
            if i != j and c is not None and c == c2 and s2 in batches.ACTIVE and None not in (a, b, a2, b2) and a2 <= b and b2 >= a:
                want.add(i)
    got = [r["batch_id"] for r in batches.overlapping_active(frame).collect()]
    assert sorted(got) == sorted(want) and 20 < len(want) < 800
