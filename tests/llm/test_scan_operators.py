import base64
import hashlib
import re
import struct
import zlib

import pytest

from benchbook.llm import fingerprints, language, licenses, sharding, warc
from tests.llm.fixtures import TEXTS, documents, empty, rows


def test_sharding_law(spark):
    docs = spark.createDataFrame([(i, "same copy " * 30 if i % 3 == 0 else f"text {i} " * (i % 50), i) for i in range(3000)] + [(None, None, 0)], "doc_id long, text string, shard int")
    found = sharding.shard_by_bytes(docs).collect()
    sizes = [sum(r["size"] for r in found if r["shard"] == s) for s in range(8)]
    assert len(found) == 3001 and {r["law"] for r in found} == {"bytes"} and {r["grown_shard"] for r in found} == {None}
    assert max(sizes) - min(sizes) < 0.03 * max(sizes)
    for s in range(8):
        assert sorted(r["slot"] for r in found if r["shard"] == s) == list(range(sum(r["shard"] == s for r in found)))
    text = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert all(r["size"] == len(text[r["doc_id"]].encode()) + 1 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode()) for r in found)


def test_sharding_cuts_a_hot_key_by_rows(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "if(id % 3 = 0, null, concat('text ', repeat('w', cast(id % 90 as int)), id)) as text")
    found = sharding.shard_by_bytes(docs, part_rows=100).collect()
    assert sum(r["size"] == 1 for r in found) == 1334
    for s in range(8):
        assert sorted(r["slot"] for r in found if r["shard"] == s) == list(range(sum(r["shard"] == s for r in found)))
    sizes = [sum(r["size"] for r in found if r["shard"] == s) for s in range(8)]
    assert max(sizes) - min(sizes) < 0.05 * max(sizes)


def test_sharding_against_a_second_way(spark):
    """Ranges, parts and shards computed again from the rows, without Spark: whole texts in one range, ranges in order, slots by range, key and id."""
    docs = spark.createDataFrame([(i, f"text {i % 700} " * (i % 40)) for i in range(2000)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in sharding.shard_by_bytes(docs, shards=4, ranges_per_shard=8, sample_rows=500).collect()}
    keys = {r["doc_id"]: r["k"] for r in docs.selectExpr("doc_id", "xxhash64(text) as k").collect()}
    # Shards follow the order of the keys, but for keys that alone overfill a part, and slots follow it within a shard.
    by_key = {}
    for i, k in keys.items():
        by_key.setdefault(k, set()).add(found[i]["shard"])
    whole = [(k, s) for k, s in sorted(by_key.items()) if len(s) == 1]
    shards = [min(s) for _, s in whole]
    assert sum(a > b for a, b in zip(shards, shards[1:], strict=False)) <= 8 and len(whole) > 0.98 * len(by_key)
    total = sum(r["size"] for r in found.values())
    for s in range(4):
        assert abs(sum(r["size"] for r in found.values() if r["shard"] == s) - total / 4) < total / 16


def test_sharding_edges(spark):
    assert sharding.shard_by_bytes(empty(spark)).count() == 0
    found = sharding.shard_by_bytes(documents(spark, repeat=(5, 12))).collect()
    assert len(found) == len(TEXTS) + 2 and all(0 <= r["shard"] < 8 for r in found)


def words(t):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def test_license_base_against_brute_force(spark):
    found = {r["doc_id"]: r for r in licenses.scan_documents(documents(spark)).collect()}
    for i, t in TEXTS:
        w = words(t)
        at = [(p, label) for phrase, label in licenses.BASE.items() for p in range(len(w)) if w[p : p + len(phrase.split())] == phrase.split()]
        r = found[i]
        assert (r["n_words"], r["n_base"]) == (len(w), len(at)), i
        assert (r["first_word"], r["last_word"]) == ((min(at)[0], max(at)[0]) if at else (None, None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in at}))
        assert set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) | {""} and 0 <= r["score"] <= 1
    assert found[10]["labels"] == "apache,gpl,mit"
    assert found[14]["base_labels"] == "" and found[14]["labels"] == "apache"  # a word put in: neighbouring diagonals
    assert licenses.scan_documents(empty(spark)).count() == 0
    twice = licenses.scan_documents(documents(spark, repeat=(10,)))
    assert len({tuple(r) for r in twice.where("doc_id = 10").collect()}) == 1 and twice.count() == len(TEXTS) + 1


def brute_scan(text):
    """Labels and score by the same rule, over lists: votes per diagonal, neighbours merged, coverage of the template's words."""
    w, labels, score = words(text), set(), 0.0
    for _, label, is_base, k, near, t in licenses.templates(licenses.NOTICES, licenses.TEXTS, licenses.BASE):
        votes = {}
        for p in range(len(w) - k + 1):
            for q in range(len(t) - k + 1):
                if w[p : p + k] == t[q : q + k]:
                    votes.setdefault(p - q, set()).add(q)
        if is_base:
            if any(len(v) == len(t) - k + 1 for v in votes.values()):
                labels.add(label)
                score = 1.0
            continue
        islands, before = [], None
        for d in sorted(votes):
            first, last = d + min(votes[d]), d + max(votes[d]) + k - 1
            if before and d - before[0] <= near and first - before[1] <= len(t):
                islands[-1] |= votes[d]
            else:
                islands.append(set(votes[d]))
            before = (d, last)
        for found in islands:
            share = len({q + i for q in found for i in range(k)}) / len(t)
            if share >= licenses.COVERED:
                labels.add(label)
                score = max(score, share)
    return ",".join(sorted(labels)), score


def license_cases():
    mit, bsd3, gpl = (next(t for label, t in licenses.TEXTS if label == x) for x in ("mit", "bsd-3", "gpl"))
    some = bsd3.split()
    return [
        (101, "x = 1 /* " + mit + " */ y = 2"), (102, mit.replace("Software", "Program")), (103, " ".join(some[:60] + ["Acme", "Corp", "and", "others"] + some[60:])), (104, " ".join(some[: len(some) // 2])),
        (105, gpl + " middle " + gpl), (106, "LICENSED UNDER CC BY-NC 4.0. Released under the \u212a MIT License; \u0130 mit licens\u00e9"), (107, " ".join(mit.split()[::-1])), (None, "the apache license " + mit), (108, "MIT license " * 9),
    ]


def test_license_labels_and_score_against_brute_force(spark):
    texts = [*TEXTS, *license_cases()]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: r for r in licenses.scan_documents(docs).collect()}
    assert len(found) == len(texts)
    for i, t in texts:
        labels, score = brute_scan(t)
        assert (found[i]["labels"], found[i]["n_words"]) == (labels, len(words(t))) and abs(found[i]["score"] - score) < 1e-9, i
    assert found[101]["labels"] == "mit" and found[103]["labels"] == "bsd,bsd-3" and found[105]["labels"] == "gpl,lgpl" and found[107]["labels"] == ""
    assert found[106]["base_labels"] == "mit" and found[106]["labels"] == "cc-by-nc,mit"


def pages(spark, data):
    return spark.createDataFrame(data, "page_id long, url string, html string, key string, refers_to long")


def test_warc_round_trip(spark):
    data = [(1, "http://a/1", "<p>hé</p>", "x", 9), (2, None, "<p>hé</p>", "x", 9), (3, "u\r\nX: y", None, "x", 9), (4, "http://a/4", "", "x", 9), (5, "http://a/5", "r\r\n\r\n" * 40_000, "x", 9)]
    data += [(i, f"http://b/{i}", f"<html><body>page {i % 40} " + "lorem ipsum " * (i % 40), "x", 9) for i in range(10, 300)]
    found = {r["page_id"]: r for r in warc.round_trip(pages(spark, data).repartition(3)).collect()}
    first = {}
    for i, _, html, *_ in data:
        first.setdefault(html or "", i)
    assert len(found) == len(data)
    for i, _, html, *_ in data:
        b, r = (html or "").encode(), found[i]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(b), base64.b32encode(hashlib.sha1(b).digest()).decode())
        assert (r["record_type"], r["refers_to"]) == (("response", None) if first[html or ""] == i else ("revisit", first[html or ""]))


def test_warc_small_payloads_and_empty(spark):
    small = warc.round_trip(pages(spark, [(1, "a", "x", "", 0), (2, "b", "x", "", 0), (3, "c", "xyz", "", 0), (4, "d", "xyz", "", 0)]), least_bytes=2)
    assert rows(small, "page_id", "record_type", "refers_to") == [(1, "response", None), (2, "response", None), (3, "response", None), (4, "revisit", 3)]
    assert warc.round_trip(pages(spark, [])).count() == 0


def test_warc_reader_rejects_damage():
    good = warc.record(1, "http://a", b"payload", 7, warc.digest(b"payload"), None)
    assert warc.parse(good)["payload"] == b"payload"
    for bad in (good[:-1], good.replace(b"payload\r\n", b"payloaD\r\n"), good.replace(b"WARC/1.1", b"WORC/1.1"), good.replace(b"WARC-Date", b"WARC-Dote"), good.replace(b"Content-Length: 7", b"Content-Length: 8")):
        with pytest.raises(warc.BadArchive):
            warc.parse(bad)
    shared = warc.dictionary([b"some sample %d" % i for i in range(3)])
    data = warc.archive([good, good], shared)
    assert list(warc.read(data)) == [good, good]
    assert struct.unpack_from("<I", data)[0] == 0x184D2A5D
    for bad in (data[:-3], data[:10], data + b"junk", data[: len(data) - 20] + b"\0" * 20):
        with pytest.raises(warc.BadArchive):
            list(warc.read(bad))


def foreign(kind, block, *fields, name="urn:uuid:6d1d2c3e-0000-4000-8000-000000000000"):
    head = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", "WARC-Date: 2020-01-01T00:00:00Z", *fields, f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_warc_reads_records_of_other_writers():
    http = "Content-Type: application/http; msgtype=response"
    found = warc.parse(foreign("response", b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\nbody", http, "WARC-Target-URI: <http://x/>"))
    assert (found["page_id"], found["payload"], found["payload_bytes"], found["payload_digest"], found["url"]) == (None, b"body", 4, warc.digest(b"body"), "http://x/")
    assert warc.parse(foreign("warcinfo", b"software: x\r\n", "Content-Type: application/warc-fields"))["record_type"] == "warcinfo"
    assert warc.parse(foreign("request", b"GET / HTTP/1.1\r\nHost: x\r\n\r\n", "Content-Type: application/http; msgtype=request"))["payload"] == b""
    assert warc.parse(foreign("response", b"HTTP/1.1 200 OK\r\nContent-Length: many\r\n\r\nbody", http))["payload_bytes"] == 4
    assert warc.parse(foreign("response", b"HTTP/1.1 200 OK\r\nContent-Length: 9\r\n\r\nbody", http, "WARC-Truncated: length"))["payload"] == b"body"
    assert warc.parse(foreign("response", b"HTTP/1.1 200 OK\r\n\r\nbody", http, "WARC-Payload-Digest: md5:abc"))["payload_digest"] == "md5:abc"
    revisit = warc.parse(foreign("revisit", b"", http, "WARC-Payload-Digest: sha1:ABC", "WARC-Refers-To: <urn:uuid:1>"))
    assert (revisit["payload"], revisit["payload_digest"], revisit["refers_to"]) == (None, "ABC", None)
    with pytest.raises(warc.BadArchive):
        warc.parse(foreign("revisit", b"", http))


def test_warc_frames_between_records_and_compressed_dictionaries():
    import io

    import zstandard

    good = warc.record(1, "http://a", b"payload" * 50, 350, warc.digest(b"payload" * 50), None)
    shared = b"payload" * 100
    small = zstandard.ZstdCompressor().compress(shared)
    packer = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(shared))
    skip = struct.pack("<II", 0x184D2A53, 5) + b"hello"
    data = struct.pack("<II", warc.DICT_MAGIC, len(small)) + small + packer.compress(good) + skip + packer.compress(good) + skip
    assert list(warc.read(data)) == [good, good] == list(warc.read(io.BytesIO(data)))
    assert list(warc.read(zstandard.ZstdCompressor().compress(good))) == [good] and list(warc.read(b"")) == []


def test_warc_damage_becomes_rows(spark, tmp_path):
    good = warc.record(1, "http://a", b"payload", 7, warc.digest(b"payload"), None)
    shared = warc.dictionary([b"x" * 99])
    for name, data in (("a", warc.archive([good, good[:-1], good], shared)), ("b", warc.archive([good, good], shared)[:-4]), ("c", warc.archive([good], shared))):
        (tmp_path / f"{name}.warc.zst").write_bytes(data)
    found = warc.read_archives(warc.archives_in(spark, str(tmp_path))).collect()
    told = sorted((r["archive"][-10], r["record_type"], r["error"]) for r in found)
    assert told == [("a", "damaged", "the block's length is wrong"), ("a", "response", None), ("a", "response", None), ("b", "damaged", "a frame is cut off"), ("b", "response", None), ("c", "response", None)]


def test_warc_reads_what_the_manifest_names_only(spark, tmp_path):
    """A task that runs twice, each time with other rows in other archives, leaves files of both; one attempt's are committed."""
    data = warc.revisits(pages(spark, [(i, "u", f"<p>{i}</p>" * 50, "", 0) for i in range(40)]))
    folder = f"file://{tmp_path}/warc"
    first = warc.write_archives(data.orderBy("page_id").coalesce(1), folder).collect()
    second = warc.write_archives(data.orderBy(warc.F.desc("page_id")).coalesce(1), folder)
    second.write.parquet(f"{tmp_path}/manifest")
    manifest = spark.read.parquet(f"{tmp_path}/manifest")
    assert not {r["archive"] for r in first} & {r["archive"] for r in manifest.collect()}
    assert warc.archives_in(spark, folder).count() >= 2
    assert sorted(r["page_id"] for r in warc.read_archives(manifest).collect()) == list(range(40))


def test_warc_null_repeated_and_large_ids(spark):
    big = 2**60 + 1
    found = warc.round_trip(pages(spark, [(None, "a", "x", "", 0), (None, None, None, "", 0), (big, "c", "x", "", 0), (big + 1, "c", "x", "", 0), (5, "d", "y", "", 0), (5, "d", "y", "", 0), (5, "d", "x", "", 0)]))
    key = lambda r: (r["page_id"] is None, r["page_id"] or 0, r["record_type"], r["payload_bytes"])
    assert [(r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in sorted(found.collect(), key=key)] == [
        (5, "response", None, 1), (5, "response", None, 1), (5, "response", None, 1), (big, "revisit", 5, 1), (big + 1, "revisit", 5, 1), (None, "response", None, 0), (None, "revisit", 5, 1),
    ]


def brute_anchors(text, k=16, s=8):
    if not text:
        return []
    if len(text) < k:
        return [0]
    small = list(fingerprints._rolling(__import__("numpy").frombuffer(text.encode("utf-32-le"), dtype="<u4").astype("u8") + __import__("numpy").uint64(1), s))
    return [i for i in range(len(text) - k + 1) if min(small[i : i + k - s + 1]) in (small[i], small[i + k - s])]


def test_syncmers_against_brute_force():
    import numpy as np

    with np.errstate(over="ignore"):
        for _, t in TEXTS:
            t = (t or "")[:3000]
            assert list(fingerprints.anchors(t)[0]) == brute_anchors(t)


def whole_hash(text):
    """Hash of a stretch of 2**n code points by halves, on whole numbers; what the rolling arrays must equal."""
    mask = 2**64 - 1

    def scrambled(x):
        x = (x ^ x >> 31) * 0xBF58476D1CE4E5B9 & mask
        return (x ^ x >> 29) * 0x9E3779B97F4A7C15 & mask

    def raw(codes, steps):
        if len(codes) == 1:
            return codes[0]
        half = len(codes) // 2
        return (raw(codes[:half], steps) * steps[half] + raw(codes[half:], steps)) & mask

    steps, step = {}, 0x100000001B3
    for n in (1, 2, 4, 8):
        steps[n], step = step, step * step * 0x9E3779B97F4A7C15 & mask
    return scrambled(raw([ord(c) + 1 for c in text], steps))


def brute_sketch(text, k=16, s=8, kept=64):
    """The least anchor hashes, with every k-mer and its inner s-mers looked at one by one."""
    if not text:
        return []
    if len(text) < k:
        return None
    found = set()
    for i in range(len(text) - k + 1):
        small = [whole_hash(text[i + j : i + j + s]) for j in range(k - s + 1)]
        if min(small) in (small[0], small[-1]):
            found.add(whole_hash(text[i : i + k]) >> 32)
    return sorted(found)[:kept]


def test_fingerprints_and_likeness_against_brute_force(spark):
    texts = [(i, (t or "")[:1500]) for i, t in TEXTS] + [(50, TEXTS[6][1][:1400] + "changed at the end"), (51, TEXTS[6][1][:700] + "q" * 700)]
    found = {r["doc_id"]: r for r in fingerprints.edited_fingerprints(documents(spark, texts).repartition(2)).collect()}
    order = sorted(texts, reverse=True)
    for n, (i, t) in enumerate(order):
        after = order[(n + 1) % len(order)][1]
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        own, changed, following = map(brute_sketch, (t, edited, after))
        told = "".join(f"{h:08x}" for h in own) if own is not None else None
        assert told is None or found[i]["fingerprint"] == told
        for name, other in (("near_edited", changed), ("near_next", following)):
            if own is not None and other is not None:
                both = sorted(set(own) | set(other))[:64]
                assert found[i][name] == (sum(h in own and h in other for h in both) / len(both) if both else 1.0)


def test_syncmers_depend_on_themselves_only():
    body = TEXTS[6][1][:2000]
    at, hashes = fingerprints.anchors(body)
    moved, same = fingerprints.anchors("prefix " + body)
    inside = {(p - 7, h) for p, h in zip(moved, same, strict=True) if p >= 7}
    assert inside == set(zip(at, hashes, strict=True))


def test_edited_fingerprints(spark):
    docs = documents(spark).repartition(3)
    found = {r["doc_id"]: r for r in fingerprints.edited_fingerprints(docs).collect()}
    order = sorted(TEXTS, reverse=True, key=lambda x: x[0])
    assert len(found) == len(order)
    for n, (i, t) in enumerate(order):
        t, after = t or "", order[(n + 1) % len(order)][1] or ""
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        assert (found[i]["n_chars"], found[i]["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert found[i]["fingerprint"] == fingerprints.said(fingerprints.sketch(t)) and found[i]["edited_fingerprint"] == fingerprints.said(fingerprints.sketch(edited))
        assert 0 <= found[i]["near_edited"] <= 1 and 0 <= found[i]["near_next"] <= 1
    assert found[1]["fingerprint"] == found[3]["fingerprint"] and found[4]["fingerprint"] == found[5]["fingerprint"] == ""
    assert fingerprints.edited_fingerprints(empty(spark)).count() == 0
    one = fingerprints.edited_fingerprints(documents(spark, TEXTS[:1])).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert fingerprints.edited_fingerprints(documents(spark, repeat=(12, 12))).count() == len(TEXTS) + 2


def test_positional_matches(spark):
    docs = spark.createDataFrame([(1, TEXTS[6][1][:3000]), (2, "q" * 50 + TEXTS[6][1][:1500])], "doc_id long, text string")
    found = fingerprints.syncmer_anchors(docs)
    best = fingerprints.positional_matches(found.where("doc_id = 1"), found.where("doc_id = 2")).where("left_id <> right_id").orderBy("n", ascending=False).first()
    assert (best["left_id"], best["right_id"], best["shift"]) == (1, 2, 50)
    plan = fingerprints.positional_matches(found.where("doc_id = 1"), found)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 2


def test_language_edges(spark):
    found = {r["doc_id"]: r for r in language.identify(documents(spark, repeat=(1,))).collect()}
    for i in (4, 5, 6, 13):
        assert (found[i]["lang_pred"], found[i]["score"]) == ("und", 0.0)
    assert found[1]["lang_pred"] == "en"
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for i, r in found.items())
    assert language.identify(empty(spark)).count() == 0


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    wrong = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang <> lang_pred").count()
    assert wrong <= 2


def test_language_does_not_learn_from_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    lied = docs.selectExpr("doc_id", "text", "if(crc32(cast(doc_id as string)) % 4 = 2, 'xx', lang) lang")
    assert rows(language.identify(docs), "doc_id", "lang_pred", "score") == rows(language.identify(lied), "doc_id", "lang_pred", "score")
