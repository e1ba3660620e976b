"""A refreshed view equals a rebuilt one, and buckets without changed ids stay as they were."""

import pytest
from pyspark.sql import functions as F

from benchbook.operators import read_model
from benchbook.sources import landing

VIEW = "case_id long, label string, names array<string>"


def view(spark, rows):
    return spark.createDataFrame([(i, x, [x] if x else None) for i, x in rows.items()], VIEW)


def rows(df):
    return {r["case_id"]: r["label"] for r in df.collect()}


@pytest.fixture
def kept(spark):
    folder = landing.shared_folder(spark)
    old = {i: f"v{i}" for i in range(40)}
    read_model.build(view(spark, old), folder, buckets=8)
    return folder, old


def test_refreshed_equals_rebuilt(spark, kept):
    folder, old = kept
    assert rows(read_model.read(spark, folder)) == old
    gone = spark.createDataFrame([(7,), (999,)], "case_id long")
    for _ in range(2):
        read_model.refresh(view(spark, {3: "new", 5: None, 100: "more"}), folder, gone)
        want = {**old, 3: "new", 5: None, 100: "more"}
        del want[7]
        assert rows(read_model.read(spark, folder)) == want and read_model.read(spark, folder).count() == len(want)
    assert rows(read_model.lookup(spark, folder, [3, 7, 100])) == {3: "new", 100: "more"}


def test_only_buckets_of_changed_ids_are_written(spark, kept):
    folder, _ = kept
    before = read_model.manifest(folder)["of"]
    assert read_model.refresh(view(spark, {3: "new"}), folder) == 1
    after = read_model.manifest(folder)["of"]
    assert sorted(v for b, v in after.items() if before[b] != v) == [2] and len(after) == len(before)
    assert read_model.refresh(view(spark, {}), folder) == 0 and read_model.manifest(folder)["version"] == 2


def test_a_killed_refresh_leaves_the_view(spark, kept, monkeypatch):
    folder, old = kept
    with monkeypatch.context() as m:
        m.setattr(read_model, "_publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            read_model.refresh(view(spark, {3: "new"}), folder)
    assert rows(read_model.read(spark, folder)) == old
    read_model.refresh(view(spark, {4: "other"}), folder)
    assert rows(read_model.read(spark, folder)) == {**old, 4: "other"}


def test_no_rows_null_ids_and_emptied_buckets(spark):
    folder = landing.shared_folder(spark)
    read_model.build(view(spark, {}), folder, buckets=2)
    assert rows(read_model.read(spark, folder)) == {} and rows(read_model.lookup(spark, folder, [1])) == {}
    read_model.refresh(view(spark, {1: "a", None: "none"}), folder)
    read_model.refresh(view(spark, {None: "other"}), folder)
    assert rows(read_model.read(spark, folder)) == {1: "a", None: "other"}
    read_model.refresh(view(spark, {}), folder, spark.createDataFrame([(1,), (None,)], "case_id long"))
    assert read_model.read(spark, folder).count() == 0


def test_a_lookup_opens_its_buckets_only(spark, kept):
    folder, _ = kept
    found = read_model.lookup(spark, folder, [3])
    assert found.select(F.input_file_name()).distinct().count() == 1 and len(found.inputFiles()) < len(read_model.read(spark, folder).inputFiles())


def test_view_of_all_cases_needs_no_arrays(spark, sf_dir):
    """The whole view equals the view by arrays, and neither explodes nor joins by kinds; a single name reads no other."""
    from benchbook.operators.search import view, whole_view
    from benchbook.plans import QUERIES
    from benchbook.sources.domain import Domain

    d = Domain(spark, sf_dir)
    names = ["bench_names", "act_names", "ministry_names", "industry_names", "provisions"]
    js = lambda x: sorted(tuple(r) for r in x.select("case_id", "court_name", *names).collect())
    assert js(whole_view(d)) == js(view(d, d.cases()))
    plan = lambda name: QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert not any("Generate explode(concat" in plan(n) for n in names[:4])
    assert "l_orderkey" not in plan("industry_names") and "s_name" not in plan("act_names")
