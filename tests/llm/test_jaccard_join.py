import random

import numpy as np
import pandas as pd
import pytest

from benchbook.llm import jaccard_join as jj
from tests.llm.fixtures import TEXTS, documents, empty, rows
from tests.llm.test_dedup_operators import brute_shingles

COLUMNS = ("doc_id", "n_shingles", "component_id")


def brute_join(docs):
    """docs: (id, text). Rows without id link nothing."""
    sets = [(i, frozenset(brute_shingles(t))) for i, t in docs]
    different = sorted({x for x in sets if x[0] is not None and x[1]}, key=lambda x: x[0])
    root = {i: i for i, _ in sets if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    by_size = sorted(different, key=lambda x: len(x[1]))
    for k, (i, s) in enumerate(by_size):
        for j, t in by_size[k + 1 :]:
            if 5 * len(s) < 4 * len(t):
                break
            both = len(s & t)
            if 100 * both >= 80 * (len(s) + len(t) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    of_set = {}
    for i, s in different:
        of_set[s] = min(find(i), of_set.get(s, find(i)))
    out = [(i, len(s), i if not s else of_set.get(s)) for i, s in sets]
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r))


def group(rng, size, length, edits, name):
    """A text and copies of it with up to so many words changed."""
    base = [f"{name}{rng.randrange(5000)}" for _ in range(length)]
    for c in range(size):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(length)] = f"y{rng.randrange(10**6)}"
        yield " ".join(words)


def corpus(seed=11):
    rng = random.Random(seed)
    texts = [t for k in range(5) for t in group(rng, 30, 120, 4, f"w{k}_")] + [t for t in group(rng, 60, 60, 2, "hot")]
    passage = " ".join(f"p{i}" for i in range(40))
    texts += [f"{passage} " + " ".join(f"r{rng.randrange(10**6)}" for _ in range(rng.choice([3, 6, 30, 60]))) for _ in range(60)]  # a passage that many share
    texts += [" ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 80))) for _ in range(60)]
    texts += [texts[0], texts[0].upper(), "one two three", "ONE  two\tthree", "one two three four"]
    rng.shuffle(texts)
    docs = [(k * 3 + 1, t) for k, t in enumerate(texts)] + [(10_000 + i, t) for i, t in TEXTS]
    return docs + [(None, texts[5]), (None, "alone without id"), (None, None), docs[4], docs[4]]


@pytest.mark.parametrize(("pivots", "small", "batch"), [(0, 2, 50), (6, 3, 1000)])
def test_join_against_brute_force(spark, monkeypatch, pivots, small, batch):
    docs = corpus()
    monkeypatch.setattr(jj, "LEAST_FREQUENT", 20 if pivots else 10**9)
    real = jj.arrow_rows
    monkeypatch.setattr(jj, "arrow_rows", lambda s, n: real(s, batch))
    given = spark.createDataFrame([(i, t, 7, "x") for i, t in docs], "doc_id long, text string, n long, home string").repartition(4)
    found = rows(jj.jaccard_join(given, pivots=pivots, small=small), *COLUMNS)
    want = brute_join(docs)
    assert found == want
    assert len({c for _, _, c in want}) < len(want) - 110


def test_join_of_real_documents(spark):
    real = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = [(r["doc_id"], r["text"]) for r in real.collect()]
    assert rows(jj.jaccard_join(real), *COLUMNS) == brute_join(docs)


def test_join_edges(spark):
    assert jj.jaccard_join(empty(spark)).count() == 0
    found = {r["doc_id"]: r["component_id"] for r in jj.jaccard_join(documents(spark, repeat=(7, 12))).collect()}
    assert found[1] == found[2] == found[3] == 1 and found[4] == 4 and found[5] == 5 and found[6] == 6 and found[7] == 7
    # An id with two texts is one document: it joins what either links.
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    two = spark.createDataFrame([(5, a), (5, b), (7, a + " x"), (3, b + " y")], "doc_id long, text string")
    for pivots in (0, 512):
        assert {r["component_id"] for r in jj.jaccard_join(two, pivots=pivots).collect()} == {3}


def test_prefix_is_long_enough_and_not_longer():
    for n in range(1, 400):
        k = jj.prefix_length(n)
        assert 5 * (n - k) < 4 * n <= 5 * (n - k + 1)


def test_cells_over_batches():
    key = np.array([1, 1, 2, 3, 3, 3, 4] + [5] * 40 + [6, 6])
    data = pd.DataFrame({"key": key, "node": np.arange(len(key)), "part": np.arange(len(key)), "n": 10, "pos": 0})
    for step in (1, 3, 7, 100):
        out = pd.concat(jj._cells(3)(iter([data.iloc[i : i + step].reset_index(drop=True) for i in range(0, len(data), step)])))
        pairs = sorted((int(a), int(b)) for a, b in zip(out["a"], out["b"], strict=True) if b is not pd.NA)
        assert pairs == [(0, 1), (3, 4), (3, 5), (4, 5), (47, 48)]
        assert sorted(int(a) for a, b in zip(out["a"], out["b"], strict=True) if b is pd.NA) == list(range(7, 47))


def test_distances_to_pivots_against_sets():
    rng = np.random.default_rng(2)
    sets = [(i, np.unique(rng.integers(0, 300, 60)).astype(np.uint64) << np.uint64(40)) for i in range(20)]
    sets.append((99, sets[3][1]))
    pivots = jj.Pivots.of(sets)
    assert pivots.ids.tolist() == list(range(20))
    for _ in range(20):
        s = np.unique(rng.integers(0, 400, 50)).astype(np.uint64) << np.uint64(40)
        both, whole = pivots.overlaps(s)
        assert both.tolist() == [len(np.intersect1d(s, t)) for _, t in sets[:20]]
        assert whole.tolist() == [len(np.union1d(s, t)) for _, t in sets[:20]]
