import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from benchbook.llm import divergence, vector_codes
from tests.llm.fixtures import TEXTS, documents, empty, rows

SF = "/root/testdata/sf0.001"


def brute_audit(docs, least=3, top=200):
    docs = [(t or "", lang or "", s or "") for t, lang, s in docs]
    split = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t))
    out = []
    for lang in {d[1] for d in docs}:
        df, total, by = Counter(), Counter(), defaultdict(Counter)
        for t, ln, s in docs:
            if ln == lang:
                by[s].update(split(t))
                total.update(split(t))
                df.update(set(split(t)))
        kept = [t for t in df if df[t] >= least]
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c[u] for u in kept) + len(kept)) for t in kept}
        ps, q = {s: share(c) for s, c in by.items()}, share(total)
        f = lambda p, r: (p - r) * (p - r) // r
        for s in by:
            pairs = [(-sum(f(ps[s][t], ps[o][t]) for t in kept), o.encode(), o) for o in by if o != s]
            terms = [(-f(ps[s][t], q[t]), t.encode(), t) for t in kept if by[s][t] and ps[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                out += [(lang, s, part, x[2], -x[0], k + 1) for k, x in enumerate(sorted(found)[:most])]
    return sorted(out)


AUDIT = ("lang", "source", "part", "item", "value", "rank")


@pytest.mark.parametrize("held", [5, 400_000])
def test_audit_against_brute_force(spark, monkeypatch, held):
    monkeypatch.setattr(divergence, "HELD", held)
    texts = ["Alpha beta beta Gamma", "alpha BETA delta", "alpha beta gamma-gamma_x 1a2", "Über über ÜBER straße", "über ende", "Über", None, "", "alpha " * 50, "日本 alpha"]
    docs = [(t, lang, s) for k, t in enumerate(texts) for lang in ("en", None) for s in ("a", "b", None)[: 1 + k % 3]] + [("alpha beta delta", "xx", "only"), (None, "yy", "p"), ("one", "yy", "q")]
    docs += [("alpha beta delta", "en", "c")] * 40
    given = spark.createDataFrame([(k, t, lang, s, 1) for k, (t, lang, s) in enumerate(docs)], "doc_id long, text string, lang string, source string, n long").repartition(5)
    for broadcast in (1_000_000, 0):
        monkeypatch.setattr(divergence, "BROADCAST_IDS", broadcast)
        assert rows(divergence.audit(given), *AUDIT) == brute_audit(docs)
    assert divergence.audit(empty(spark)).count() == 0


def test_audit_of_real_documents_and_odd_texts(spark):
    real = spark.read.parquet(f"{SF}/documents.parquet")
    found = rows(divergence.audit(real), *AUDIT)
    assert found == brute_audit([(r["text"], r["lang"], r["source"]) for r in real.collect()])
    odd = documents(spark, repeat=(7, 8))
    assert rows(divergence.audit(odd, least_docs=1), *AUDIT) == brute_audit([(r["text"], r["lang"], r["source"]) for r in odd.collect()], least=1)


def brute_codes(vectors, parts=4, entries=256, rounds=4):
    """vectors: (id, list, label). Exact, every distance."""
    whole = [(i, [int(np.floor(1024 * float(x))) for x in v], lab) for i, v, lab in vectors if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = len(whole[0][1]) // parts
    pts = np.array([v for _, v, _ in whole], np.int64).reshape(len(whole), parts, width)
    order = sorted(range(len(whole)), key=lambda k: (whole[k][0] is None, whole[k][0] or 0, whole[k][1]))[:entries]
    books = pts[order].transpose(1, 0, 2).copy()
    near = lambda p: ((pts[:, p, None] - books[p][None]) ** 2).sum(axis=2).argmin(axis=1)
    for _ in range(rounds):
        for p in range(parts):
            own = near(p)
            for e in range(books.shape[1]):
                if (own == e).any():
                    books[p, e] = np.floor_divide(pts[own == e, p].sum(axis=0), (own == e).sum())
    own = np.stack([near(p) for p in range(parts)], axis=1)
    errors = [int(sum(((pts[k, p] - books[p, own[k, p]]) ** 2).sum() for p in range(parts))) for k in range(len(whole))]
    by = Counter()
    for (_, _, lab), e in zip(whole, errors, strict=True):
        by[lab] += e
    sha = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    out = [(i, "".join(f"{x:02x}" for x in own[k]), errors[k], by[lab], sha) for k, (i, _, lab) in enumerate(whole)]
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r))


CODED = ("vec_id", "code", "error", "label_error", "codebooks_sha256")
VECTORS = "vec_id long, embedding array<float>, label int, code string, v int"


@pytest.mark.parametrize("block", [60, 8192])
def test_codes_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(vector_codes, "BLOCK", block)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(9, 16))
    given = [(i, [float(np.float32(x)) for x in (centres[i % 9] + rng.normal(size=16) * (0.01 if i % 2 else 0.3))], None if i % 7 == 0 else i % 5) for i in range(500)]
    given += [(700 + i, given[3][1], 3) for i in range(200)] + [(3, given[3][1], 3), (3, given[4][1], 1), (None, given[5][1], 2), (None, given[5][1], 2)]
    given += [(800, None, 1), (801, [*given[0][1][:-1], None], 1), (802, [*given[0][1][:-1], float("nan")], 1), (803, [*given[0][1][:-1], float("-inf")], None), (-5, [0.0] * 16, 9)]
    df = spark.createDataFrame([(*g, "x", 1) for g in given], VECTORS).repartition(3)
    for entries in (256, 7):
        assert rows(vector_codes.code_vectors(df, entries=entries), *CODED) == brute_codes(given, entries=entries)
    assert vector_codes.code_vectors(df.where("false")).count() == 0
    few = [g for g in given if g[0] in (3, 5, 800)]
    assert rows(vector_codes.code_vectors(df.where("vec_id in (3, 5, 800)")), *CODED) == brute_codes(few)
    with pytest.raises(ValueError):
        vector_codes.code_vectors(df, parts=3)


def test_codes_of_real_vectors(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    assert rows(vector_codes.code_vectors(df), *CODED) == brute_codes([(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()])


def test_balls_hold_their_points_and_shrink_lists():
    rng = np.random.default_rng(4)
    points = np.concatenate([rng.integers(-50, 50, (400, 4)) + c for c in ([0, 0, 0, 0], [5000, 0, 0, 0], [0, 9000, 0, 0])] + [np.full((300, 4), 7)]).astype(np.int64)
    tree = vector_codes.Tree(points)
    tree = vector_codes.Tree.loads(tree.dumps())
    assert sorted(tree.order.tolist()) == list(range(len(points)))
    for n in range(len(tree.begin)):
        mine = points[tree.order[tree.begin[n] : tree.end[n]]]
        assert len(mine) and (tree.total[n] == mine.sum(axis=0)).all()
        assert np.sqrt(((mine - tree.centre[n]) ** 2).sum(axis=1)).max() <= tree.radius[n] + 1e-6
    book = np.array([[0, 0, 0, 0], [5000, 0, 0, 0], [0, 9000, 0, 0], [0, 9000, 0, 0], [7, 7, 7, 7]], np.int64)
    owner, sums, counts = tree.assign(points, book)
    want = vector_codes.squared(points, book).argmin(axis=1)
    assert (owner == want).all() and (counts == np.bincount(want, minlength=5)).all() and counts[3] == 0
    assert all((sums[e] == points[want == e].sum(axis=0)).all() for e in range(5))
