import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from benchbook.llm import byte_bpe, packing, token_counts
from benchbook.llm import tokenizers_ as tok
from tests.llm.fixtures import TEXTS, documents, empty, rows


def library_ids(text):
    return tok.library(tok.BYTE_BPE_JSON).encode(text or "", add_special_tokens=False).ids


def check_pieces(found, ids):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in found:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    assert set(by_doc) == set(ids)
    for doc, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            part = np.array(ids[doc][r["start"] : r["start"] + r["length"]], dtype="<u4")
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids[doc]), zlib.crc32(part.tobytes()))
            at += r["length"]
        assert at == len(ids[doc])
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= 1024 and (at == 1024 or at & (at - 1) == 0)


def test_packing_holds_each_id_once(spark):
    check_pieces(packing.pack(documents(spark).repartition(2)).collect(), {i: [*library_ids(t), 0] for i, t in TEXTS})
    assert packing.pack(empty(spark)).count() == 0


@given(st.lists(st.integers(1, 3000), max_size=80))
@settings(deadline=None, max_examples=40)
def test_packing_of_any_lengths(lengths):
    ids = {i: np.arange(n, dtype="<u4") for i, n in enumerate(lengths)}
    names = [c.split()[0] for c in packing.SCHEMA.split(", ")]
    check_pieces([dict(zip(names, r, strict=True)) for r in packing.pack_partition(iter(ids.items()), 1024, 3)], ids)


def test_sum_of_squares_takes_the_least_change():
    packer = packing.SumOfSquares(16, grain=1)
    rng = np.random.default_rng(1)
    for size in rng.integers(1, 16, 400):
        before = packer.counts.copy()

        def after(level, before=before, size=int(size)):
            n = before.copy()
            n[level] -= level > 0
            n[level + size] += 1
            return int((n[1:16].astype(int) ** 2).sum())

        allowed = [after(h) for h in range(0, 17 - size) if h == 0 or before[h]]
        packer.place(int(size), "p")
        assert int((packer.counts[1:16] ** 2).sum()) == min(allowed)


@given(st.lists(st.integers(1, 3000), max_size=80), st.sampled_from([1, 16, 64, 1024]))
@settings(deadline=None, max_examples=60)
def test_packing_at_any_grain(lengths, grain):
    ids = {i: np.arange(n, dtype="<u4") for i, n in enumerate(lengths)}
    names = [c.split()[0] for c in packing.SCHEMA.split(", ")]
    found = [dict(zip(names, r, strict=True)) for r in packing.pack_partition(iter(ids.items()), 1024, 3, grain)]
    check_pieces(found, ids)
    fills = [sum(r["length"] for r in found if r["sequence_id"] == s) for s in {r["sequence_id"] for r in found}]
    assert sum(f < 1024 for f in fills) == bin(sum(lengths) % 1024).count("1")


def test_most_remainders_stay_where_the_method_put_them(monkeypatch):
    rng, opened = np.random.default_rng(2), []
    real = packing.topped_up
    monkeypatch.setattr(packing, "topped_up", lambda windows, capacity: real(opened.append(sum(len(w[1]) for w in windows)) or windows, capacity))
    docs = [(i, np.zeros(int(n), dtype="<u4")) for i, n in enumerate(rng.lognormal(6, 1, 4000).astype(int) + 1)]
    assert len(list(packing.pack_partition(iter(docs), 1024, 0))) > 4000
    assert opened[0] < 0.08 * len(docs)


def test_topping_up_leaves_the_fullest_alone():
    piece = lambda doc, n: (doc, 0, np.zeros(n, dtype="<u4"), n)
    windows = [(900, [piece(1, 900)]), (600, [piece(2, 400), piece(3, 200)]), (100, [piece(4, 100)]), (60, [piece(5, 60)])]
    found = [[(p[0], len(p[2])) for p in w] for w in packing.topped_up(windows, 1024)]
    # 1660 ids: one full window, then 512, 64, 32, 16, 8 and 4 of those that are left.
    assert found[0] == [(1, 900), (5, 60), (4, 64)]
    assert [sum(n for _, n in w) for w in found] == [1024, 512, 64, 32, 16, 8, 4]
    assert {d: sum(n for w in found for e, n in w if e == d) for d in range(1, 6)} == {1: 900, 2: 400, 3: 200, 4: 100, 5: 60}


def test_packing_of_repeated_rows(spark):
    docs = documents(spark, repeat=(1, 12)).coalesce(1)
    found = packing.pack(docs).where("doc_id in (1, 12)").groupBy("doc_id").sum("length").collect()
    assert {r[0]: r[1] for r in found} == {i: 2 * (len(library_ids(dict(TEXTS)[i])) + 1) for i in (1, 12)}


def test_byte_bpe_against_the_library(spark):
    encoding = tok.ranked(tok.BYTE_BPE_RANKS)
    found = {r["doc_id"]: r for r in byte_bpe.encode_decode_digests(documents(spark), leaf=100).collect()}
    whole = {r["doc_id"]: r for r in byte_bpe.encode_decode(documents(spark), leaf=100).collect()}
    for i, t in TEXTS:
        ids = encoding.encode_ordinary(t or "")
        assert found[i]["n_tokens"] == len(ids) and whole[i]["ids"] == ids and bytes(whole[i]["decoded"]) == (t or "").encode()
        assert found[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert found[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
    assert byte_bpe.encode_decode_digests(empty(spark)).count() == 0
    assert len(set(rows(byte_bpe.encode_decode_digests(documents(spark, repeat=(1,))).where("doc_id = 1"), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256"))) == 1


@given(st.text(alphabet=st.sampled_from(list("ab 'sreltdvmTß日́\n\t \x1c\x85 12!?😀")), max_size=120), st.integers(1, 9))
@settings(deadline=None, max_examples=400)
def test_tree_equals_whole(text, leaf):
    encoding = tok.ranked(tok.BYTE_BPE_RANKS)
    assert byte_bpe.encode_tree(text, encoding, leaf) == encoding.encode_ordinary(text)
    assert byte_bpe.decode_tree(encoding.encode_ordinary(text), encoding, leaf) == text.encode()


@given(st.text(max_size=60))
@settings(deadline=None, max_examples=200)
def test_tree_equals_whole_on_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    encoding = tok.ranked(tok.BYTE_BPE_RANKS)
    assert byte_bpe.encode_tree(text, encoding, 4) == encoding.encode_ordinary(text)


def test_token_counts_against_the_library(spark):
    library = tok.library(tok.WORD_BPE_JSON)
    want = sorted((i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 2048) for i, t in [*TEXTS, TEXTS[0]])
    assert rows(token_counts.token_counts(documents(spark, repeat=(1,))), "doc_id", "n_bytes", "n_tokens", "over_limit") == want
    assert token_counts.token_counts(empty(spark)).count() == 0


@given(st.text(alphabet=st.characters(max_codepoint=0x17F), max_size=60))
@settings(deadline=None, max_examples=300)
def test_counts_of_any_latin_text(text):
    assert token_counts.Lengths(tok.WORD_BPE_JSON).count(text) == len(tok.library(tok.WORD_BPE_JSON).encode(text, add_special_tokens=False).ids)


@given(st.lists(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(["<|endoftext|>", "<|startoftext|>", "'s", "é", "İ", "Σ", "\u00a0", "日"])), max_size=40).map("".join))
@settings(deadline=None, max_examples=300)
def test_counts_of_any_text(text):
    assert token_counts.Lengths(tok.WORD_BPE_JSON).count(text) == len(tok.library(tok.WORD_BPE_JSON).encode(text, add_special_tokens=False).ids)


def test_the_table_holds_the_most_frequent_words_of_all_rows(spark):
    docs = spark.createDataFrame([(i, "the cat sat on the mat " * 3 + f"word{i} Σίσυφος" if i < 90 else "zebra") for i in range(100)], "doc_id long, text string").repartition(5)
    found = token_counts.frequent(docs, tok.WORD_BPE_JSON, "text", entries=8)
    assert list(found)[:1] == ["the"] and {"cat", "sat", "on", "mat"} <= set(found) and "σίσυφος" in found
    assert all(n == len(tok.library(tok.WORD_BPE_JSON).encode(w, add_special_tokens=False).ids) for w, n in found.items())


@given(st.text(alphabet=st.characters(max_codepoint=0x17F), max_size=60))
@settings(deadline=None, max_examples=300)
def test_fast_ids_of_any_latin_text(text):
    assert list(next(packing.encode([text], tok.BYTE_BPE_JSON, tok.BYTE_BPE_RANKS))) == library_ids(text)


def test_special_strings_are_handled_as_by_default():
    text = "a<|endoftext|>b"
    assert list(next(packing.encode([text], tok.BYTE_BPE_JSON, tok.BYTE_BPE_RANKS))) == library_ids(text)
    assert 50256 in library_ids(text)


@pytest.mark.parametrize("text", ["İstanbul", "Σίσυφος", "é", "½ ² ª"])
def test_unusual_texts_go_to_the_library(text):
    assert not tok.PLAIN.fullmatch(text)


def test_null_ids_leave_large_ids_whole(spark):
    from benchbook.llm import fingerprints, language, simhash

    big = 2**60 + 1
    docs = spark.createDataFrame([(big, "one text here"), (None, "another text"), (big + 1, None)], "doc_id long, text string").coalesce(1)
    for df in (
        packing.pack(docs), byte_bpe.encode_decode_digests(docs), token_counts.token_counts(docs), simhash.fingerprints(docs), fingerprints.edited_fingerprints(docs),
        language.predict(docs, language.fit(docs.withColumn("lang", packing.F.lit("en")))),
    ):
        assert {r["doc_id"] for r in df.collect()} == {big, None, big + 1}
