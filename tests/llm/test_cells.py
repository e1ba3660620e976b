import random

import numpy as np
import pandas as pd
import pytest

from benchbook.llm import cells, components
from benchbook.llm.jaccard_join import _cells
from benchbook.llm.simhash import _wide_cells
from pyspark.sql import functions as F
from tests.llm.test_jaccard_join import brute_join


def crowd(size, length=90, seed=4):
    """Copies of a text with up to 15 of its words changed for others of few: many are near it, of the others few are near each other."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(length)]
    for i in range(size):
        words = list(base)
        for _ in range(rng.randrange(16)):
            words[rng.randrange(length)] = f"v{rng.randrange(20)}"
        yield i, " ".join(words)
        if i % 25 == 0:  # one that may only be near its own kind
            yield size + i, " ".join([*words[:-1], "z"])


def test_crowded_cell_is_settled_whole_with_few_comparisons(spark, monkeypatch):
    docs = list(crowd(400))
    compared = []
    measure = cells.measured

    def counted(edges, *args, **how):
        compared.append(edges.count())
        return measure(edges, *args, **how)

    monkeypatch.setattr(cells, "measured", counted)
    texts = spark.createDataFrame(docs, "id long, text string")
    table = texts.select(F.lit(0).alias("kind"), F.lit(1).cast("long").alias("key"), F.col("id").alias("node"), F.col("id").alias("label"), F.lit(None).cast("double").alias("dist"))
    found = {r["node"]: r["component"] for r in cells.settled(table, spark.createDataFrame([], "a long, b long"), texts).collect()}
    assert [(i, found.get(i, i)) for i, _ in sorted(docs)] == [(i, c) for i, _, c in brute_join(docs)]
    assert sum(compared) < 10 * len(docs)


@pytest.mark.parametrize("rare", [2, 5, 64])
def test_crowded_cells_with_ids_that_repeat(spark, monkeypatch, rare):
    monkeypatch.setattr(cells, "RARE", rare)
    monkeypatch.setattr(cells, "CROWDED", 8)
    docs = list(crowd(70, 40, 7))
    texts = spark.createDataFrame([*docs, (3, docs[20][1]), (5, "alone")], "id long, text string")
    table = texts.select("id").distinct().select(F.lit(0).alias("kind"), F.lit(1).cast("long").alias("key"), F.col("id").alias("node"), F.col("id").alias("label"), F.lit(None).cast("double").alias("dist"))
    found = {r["node"]: r["component"] for r in cells.settled(table, spark.createDataFrame([], "a long, b long"), texts).collect()}
    want = {i: c for i, _, c in brute_join([*docs, (3, docs[20][1]), (5, "alone")])}
    assert {i: found.get(i, i) for i in want} == want


@pytest.mark.parametrize("step", [1, 7, 100])
def test_a_long_key_has_one_leader_over_batches(step):
    key = np.repeat([1, 2, 3, 4], [3, 40, 30, 2])
    data = pd.DataFrame({"key": key, "node": np.arange(len(key)), "part": np.arange(len(key)), "n": 10, "pos": 0, "f0": 0})
    for made in (_cells(3), _wide_cells(1, 0, 3)):
        out = pd.concat(made(iter([data.iloc[i : i + step].reset_index(drop=True) for i in range(0, len(data), step)])))
        rows = out[out["leader"].notna()]
        assert sorted(zip(rows["a"], rows["leader"], strict=True)) == [(i, 3 if i < 43 else 43) for i in range(3, 73)]


def test_components_need_no_round_where_a_task_holds_them(spark, monkeypatch):
    def star(*_):
        raise AssertionError("a round of stars")

    monkeypatch.setattr(components, "_star", star)
    path = spark.createDataFrame([*[(i, i + 1) for i in range(50)], (100, 90), (None, 3), (7, 7)], "a long, b long").coalesce(1)
    assert sorted(map(tuple, components.connected_components(path).collect())) == [*[(i, 0) for i in range(51)], (90, 90), (100, 90)]


@pytest.mark.parametrize("held", [1, 1000])
def test_components_over_many_tasks(spark, monkeypatch, held):
    monkeypatch.setattr(components, "HELD", held)
    rng = random.Random(3)
    edges = [*[(i, i + 1) for i in range(1000, 1040)], *[(rng.randrange(300), rng.randrange(300)) for _ in range(170)]]
    root = {i: i for e in edges for i in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    made = spark.createDataFrame(rng.sample(edges, len(edges)), "a long, b long").repartition(7)
    assert {r["node"]: r["component"] for r in components.connected_components(made).collect()} == {i: root[i] for a, b in edges if a != b for i in (a, b)}


def test_edges_of_a_group_in_many_tasks_need_no_round(spark, monkeypatch):
    def star(*_):
        raise AssertionError("a round of stars")

    monkeypatch.setattr(components, "_star", star)
    made = spark.createDataFrame([(i, j) for i in range(1, 60) for j in (i - 1, 0, 59)], "a long, b long").repartition(16)
    assert sorted(map(tuple, components.connected_components(made).collect())) == [(i, 0) for i in range(60)]


def test_only_rare_shingles_of_several_parts_are_told():
    key = np.repeat([1, 2, 3, 4], [500, 3, 3, 1])
    low = np.r_[np.arange(500), [7, 7, 7], [7, 7, 8], [9]]
    data = pd.DataFrame({"key": key, "node": np.r_[np.arange(500), 0, 1, 2, 0, 1, 2, 0], "low": low, "high": low})
    out = pd.concat(cells._told(iter([data])))
    assert [tuple(r) for r in out[out["h"].notna()].to_numpy()] == [(0, 3, 3), (1, 3, 3), (2, 3, 3)]
    assert {int(n): int(k) for n, k in out[out["h"].isna()].groupby("node")["k"].sum().items()} == {0: 2, 1: 1, 2: 1}


def test_half_of_the_shingles_give_a_bound(spark):
    texts = spark.createDataFrame([*crowd(60, 60, 2), (0, "another text of that id")], "id long, text string")
    whole = {r["node"]: (r["n"], r["c"]) for r in cells.shared_sizes(texts).collect()}
    half = {r["node"]: (r["n"], r["c"]) for r in cells.shared_sizes(texts, half=True).collect()}
    assert whole.keys() == half.keys() == {r["id"] for r in texts.collect()} - {0}
    assert all(whole[i][0] == half[i][0] >= half[i][1] >= whole[i][1] for i in whole)
