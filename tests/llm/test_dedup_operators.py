import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from benchbook.llm import components, exact_dedup, simhash
from tests.llm.fixtures import TEXTS, documents, empty, rows


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


def test_exact_dedup_against_brute_force(spark):
    found = {r["doc_id"]: r for r in exact_dedup.exact_dedup(documents(spark).repartition(3)).collect()}
    for i, t in TEXTS:
        group = [(j, u) for j, u in TEXTS if norm(u) == norm(t)]
        keep = min(group, key=lambda g: (-len(g[1] or ""), g[0]))[0]
        assert (found[i]["keep_id"], found[i]["group_size"], found[i]["kept"]) == (keep, len(group), keep == i)
        assert found[i]["text_sha256"] == hashlib.sha256(norm(t).encode()).hexdigest()


def test_exact_dedup_repeats_ties_and_empty(spark):
    assert exact_dedup.exact_dedup(empty(spark)).count() == 0
    found = exact_dedup.exact_dedup(documents(spark, repeat=(12,)))
    assert rows(found.where("doc_id = 12"), "keep_id", "group_size", "kept") == [(12, 2, True)] * 2
    kept = exact_dedup.keep_first(documents(spark))
    assert kept.columns == documents(spark).columns
    assert [r[0] for r in rows(kept, "doc_id")] == [2, 6, 7, 8, 9, 10, 11, 12, 13, 14]


def test_exact_dedup_orders_ids_at_both_ends_of_long(spark):
    far = 9 * 10**18
    texts = [(far, "a b c"), (-far, "abc "), (2**63 - 1, "x y"), (-(2**63), "xy "), (None, "q"), (None, "q "), (-5, "q"), (None, "only")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    for broadcast in (1_000_000, 0):
        found = sorted(tuple(r)[:4] for r in exact_dedup.exact_dedup(docs, broadcast_hashes=broadcast).collect() if r["doc_id"] is not None)
        assert found == [(-(2**63), -(2**63), 2, True), (-far, far, 2, False), (-5, None, 3, False), (far, far, 2, True), (2**63 - 1, -(2**63), 2, False)]
        nulls = sorted(tuple(r)[1:4] for r in exact_dedup.exact_dedup(docs, broadcast_hashes=broadcast).collect() if r["doc_id"] is None)
        assert nulls == [(None, 1, True), (None, 3, True), (None, 3, True)]


def test_exact_dedup_tells_texts_of_one_hash_apart(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b "), (4, "c")], "doc_id long, text string")
    monkeypatch.setattr(exact_dedup.F, "md5", lambda c: exact_dedup.F.lit("00" * 16))
    assert rows(exact_dedup.exact_dedup(docs), "doc_id", "keep_id", "group_size", "kept") == [(1, 1, 1, True), (2, 3, 2, False), (3, 3, 2, True), (4, 4, 1, True)]


def brute_fingerprint(text, n=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + n]).encode(), 42) for i in range(len(w) - n + 1)] or [xxhash.xxh64_intdigest(" ".join(w).encode(), 42)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    ids = sorted(prints)
    root = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for i in ids:
            for j in ids:
                if bin(prints[i] ^ prints[j]).count("1") <= 2 and root[i] != root[j]:
                    root[i] = root[j] = min(root[i], root[j])
                    changed = True
    return root


def test_simhash_against_brute_force(spark):
    prints = {i: brute_fingerprint(t) for i, t in TEXTS}
    roots = brute_components(prints)
    found = rows(simhash.near_dedup(documents(spark, repeat=(3,))), "doc_id", "fingerprint", "component_id")
    want = sorted([(i, f"{prints[i]:016x}", roots[i]) for i in [*prints, 3]])
    assert found == want
    assert simhash.near_dedup(empty(spark)).count() == 0


def test_two_bit_links_against_all_pairs_of_real_fingerprints(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    prints = np.unique(np.array([r["fp"] for r in simhash.fingerprints(docs).collect()], np.int64))
    far = np.bitwise_count(prints[:, None].view(np.uint64) ^ prints[None].view(np.uint64))
    want = {(int(i), int(j)) for i, j in zip(*np.nonzero(far <= 2), strict=True) if i < j}
    nodes = spark.createDataFrame([(n, int(p)) for n, p in enumerate(prints)], "node long, fp long")
    assert {(min(r), max(r)) for r in simhash.near_links(nodes).collect()} == want


@pytest.mark.parametrize("pairwise", [2, 48])
def test_links_are_whole_with_and_without_long_runs(spark, monkeypatch, pairwise):
    rng = random.Random(5)
    points = {rng.getrandbits(64)}
    while len(points) < 150:
        p = rng.choice(sorted(points))
        points.add(p ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) if rng.random() < 0.7 else rng.getrandbits(64))
    prints = dict(enumerate(sorted(points)))
    signed = [(i, int(np.array([p], dtype=np.uint64).view(np.int64)[0])) for i, p in prints.items()]
    monkeypatch.setattr(simhash, "PAIRWISE", pairwise)
    links = list(simhash._links(2)(iter([_index(signed)])))
    hot = {int(n) for f in links for n, b in zip(f["a"], f["b"], strict=True) if b is not np.nan and str(b) == "<NA>"}
    near = {(min(int(a), int(b)), max(int(a), int(b))) for f in links for a, b in zip(f["a"], f["b"], strict=True) if str(b) != "<NA>"}
    want = {(i, j) for i in prints for j in prints if i < j and bin(prints[i] ^ prints[j]).count("1") <= 2}
    assert want == near | {p for p in want if set(p) <= hot}
    nodes = spark.createDataFrame(signed, "node long, fp long")
    parts = {r["node"]: r["component"] for r in components.connected_components(simhash.near_links(nodes)).collect()}
    assert {i: parts.get(i, i) for i in prints} == brute_components(prints)


def _index(signed):
    import pandas as pd

    out = []
    for node, fp in signed:
        u = fp & (2**64 - 1)
        for slot in range(64):
            part = u >> 32 if slot < 32 else u & 0xFFFFFFFF
            out.append((slot, part & ~(1 << slot % 32), node, fp))
    return pd.DataFrame(out, columns=["slot", "key", "node", "fp"]).sort_values(["slot", "key"], kind="stable").reset_index(drop=True)


def test_runs_over_batches():
    import pandas as pd

    data = pd.DataFrame({"slot": [0] * 10 + [1] * 120, "key": [1, 1, 2, 3, 3, 3, 4, 5, 5, 6] + [7] * 120, "node": range(130), "fp": range(130)})
    for step in (1, 3, 50, 200):
        runs = list(simhash._runs(data[i : i + step].reset_index(drop=True) for i in range(0, 130, step)))
        assert [list(r[3]) for r in runs if not r[4]] == [[0, 1], [3, 4, 5], [7, 8]]
        assert sorted(x for r in runs if r[4] for x in r[3]) == list(range(10, 130))


def brute_shingles(text, n=5):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute_similar(texts, least=0.8):
    """Smallest id of each id's group of texts connected by a Jaccard similarity of five-word shingles of at least `least`."""
    sets = {i: brute_shingles(t) for i, t in texts.items()}
    root = {i: i for i in texts}
    links = [(i, j) for i in sets for j in sets if i < j and (len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]))]
    changed = True
    while changed:
        changed = False
        for i, j in links:
            if root[i] != root[j]:
                root[i] = root[j] = min(root[i], root[j])
                changed = True
    return root


def near_copies(groups=12, copies=9, length=300, seed=3):
    """Texts in groups of copies with some words changed, so that similarities lie on both sides of 0.8."""
    rng, texts = random.Random(seed), {}
    for g in range(groups):
        base = [f"w{rng.randrange(4000)}" for _ in range(length)]
        for c in range(copies):
            words = list(base)
            for _ in range(c):
                words[rng.randrange(length)] = f"x{rng.randrange(10**6)}"
            texts[1000 * c + g] = " ".join(words)
    return texts


def test_keep_one_against_brute_force(spark):
    texts = near_copies() | {90_000 + i: t for i, t in TEXTS} | {95_000: "word word", 95_001: "WORD  word"}
    roots = brute_similar(texts)
    docs = spark.createDataFrame([*texts.items(), (None, texts[0]), (95_000, "word word")], "doc_id long, text string").repartition(3)
    kept = [r["doc_id"] for r in simhash.keep_one(docs).collect()]
    want = {i for i in texts if roots[i] == i}
    assert len(texts) - len(want) > 60 and kept.count(None) == 1 and kept.count(95_000) == 2
    # No clean document goes; of the others fingerprints may miss a few.
    assert want <= set(kept) and len(set(kept) - {None} - want) <= 0.05 * (len(texts) - len(want))
    assert simhash.keep_one(documents(spark, repeat=(3,))).columns == documents(spark).columns
    assert simhash.keep_one(empty(spark)).count() == 0


def _rows_of_key(prints, key=7):
    import pandas as pd

    return pd.DataFrame({"key": key, "node": range(len(prints)), "f0": np.array(prints, np.int64), "f1": 0})


def _met(rows, small, most=2, step=50):
    import pandas as pd

    out = pd.concat(simhash._wide_cells(2, most, small)(iter([rows.iloc[i : i + step].reset_index(drop=True) for i in range(0, len(rows), step)])))
    pairs = {(int(a), int(b)) for a, b in zip(out["a"], out["b"], strict=True) if b is not pd.NA}
    return pairs, sorted(int(a) for a, b in zip(out["a"], out["b"], strict=True) if b is pd.NA)


@pytest.mark.parametrize("more", [0, 3, 4, 40, 5000])
def test_no_pair_of_a_key_is_lost_by_its_size(more):
    # A-C and B-C differ in 1 bit, A-B in 2: all three pairs count, however many other rows the key has.
    pairs, rows = _met(_rows_of_key([0b01, 0b10, 0b00, *[1 << 40 | n << 8 for n in range(more)]]), small=6, step=512)
    assert rows == list(range(3 + more)) if 3 + more > 6 else {(0, 1), (0, 2), (1, 2)} <= pairs and not rows


def test_rows_of_a_long_key_come_as_they_are_read():
    batches = (_rows_of_key([3] * 10_000) for _ in range(60))
    n = read = 0
    for out in simhash._wide_cells(2, 2, 6)(batches):
        n += len(out)
        read += 1
        assert len(out) <= 3 * 10_000 + 3
    assert read == 60 and n >= 600_000


def test_similar_documents_meet_in_keys_of_any_size(spark):
    # One template with many slots: all share segments, only some are similar.
    rng = random.Random(8)
    base = [f"t{i}" for i in range(150)]
    texts = {}
    for i in range(60):
        words = list(base)
        for k in range(0, 150, 25):
            if rng.random() < 0.3 + (i % 3) / 4:
                words[k] = f"v{rng.randrange(3)}"
        texts[i] = " ".join(words)
    docs = spark.createDataFrame([*texts.items()], "doc_id long, text string").repartition(3)
    roots = brute_similar(texts)
    found = {r["node"]: r["component"] for r in simhash.similar_components(docs, width=21, segments=6).collect()}
    assert all(roots[i] == roots[found.get(i, i)] for i in texts)  # nothing is linked that isn't
    want = {i for i in texts if roots[i] != i}
    assert len(want) > 20 and len(want - {i for i, c in found.items() if i != c}) <= 0.1 * len(want)


def test_wide_fingerprint_against_brute_force():
    for _, text in TEXTS:
        found = simhash.wide_fingerprint(text, 6, 21)
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
        hashes = [int.from_bytes(xxhash.xxh3_128_digest(" ".join(words[i : i + 2]).encode(), 42), "big") for i in range(max(1, len(words) - 1))] if words else []
        bits = [2 * sum(h >> (127 - b) & 1 for h in hashes) > len(hashes) for b in range(126)]
        assert list(found) == [sum(bits[21 * s + i] << i for i in range(21)) for s in range(6)]


def test_components_of_chain_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    found = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
