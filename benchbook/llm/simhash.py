"""SimHash near-dedup: fingerprints that differ in few bits, found through segments with one wildcard bit."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchbook.llm.cells import leaders, linked, measured, runs, settled
from benchbook.llm.common import LOWER, arrow_rows, ids_and_texts, materialize, with_null_ids, within, without
from benchbook.llm.components import connected_components

SHINGLE = 3
SEED = 42
#: Fingerprints under one key that are compared pairwise; larger groups are linked through midpoints.
PAIRWISE = 48
#: Shingles and similarity (percent) by which the corpus stage judges, and the fingerprints that find its candidates:
#: words of their shingles (fewer words, so that an edit changes fewer of them), segments, least bits of each, and the
#: share of all bits in which candidates may differ.
SIMILAR_WORDS = 5
SIMILARITY = 80
PRINT_WORDS = 2
SEGMENTS = 6
LEAST_WIDTH = 21
MOST_SHARE = 0.18
MASK32 = np.uint64(0xFFFFFFFF)
ONE = np.uint64(1)


def fingerprint(text: str | None, words: int = SHINGLE) -> int:
    """64 bits, each the majority over the hashes of all word shingles, repeats included; without words 0."""
    import xxhash

    parts = (text or "").encode().translate(LOWER).split()
    if not parts:
        return 0
    joined, ends, at = b" ".join(parts), [], -1
    for p in parts:
        at += len(p) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[i:j], SEED) for i, j in zip(starts, ends[words - 1 :], strict=False)] or [digest(joined, SEED)]
    bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    over = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(over, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE) -> DataFrame:
    """doc_id and its fingerprint as a signed long. Null or wordless text: 0. Rows that repeat: a row each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = np.array([fingerprint(t, words) for t in batch["text"]], dtype=np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "fp": found})

    return with_null_ids(ids_and_texts(docs, id_col, text_col).mapInPandas(run, "doc_id long, fp long"))


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, bool]]:
    """Runs of two or more rows with one key, of batches sorted by key: segment, wildcard, fingerprints, nodes, and
    whether the run is longer than PAIRWISE. A longer run comes in pieces, so memory stays bounded."""
    held: pd.DataFrame | None = None
    long_key = None
    for batch in batches:
        data = batch if held is None else pd.concat([held, batch], ignore_index=True)
        keys = data[["slot", "key"]].to_numpy()
        starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)]) if len(keys) else np.zeros(0, int)
        ends = np.r_[starts[1:], len(keys)]
        fps, nodes = data["fp"].to_numpy().view(np.uint64), data["node"].to_numpy()
        held = None
        for n, (i, j) in enumerate(zip(starts, ends, strict=True)):
            last, key = n == len(starts) - 1, tuple(keys[i])
            if last and j - i <= PAIRWISE and long_key != key:
                held = data.iloc[i:j]  # may go on in the next batch
            elif long_key == key or j - i > PAIRWISE:
                long_key = key
                yield int(key[0]), int(key[0]) % 32, fps[i:j], nodes[i:j], True
            elif j - i > 1:
                yield int(key[0]), int(key[0]) % 32, fps[i:j], nodes[i:j], False
    if held is not None and len(held) > 1:
        slot = int(held["slot"].iloc[0])
        yield slot, slot % 32, held["fp"].to_numpy().view(np.uint64), held["node"].to_numpy(), False


def _links(most: int):
    """Rows (a, b, fp): verified pairs of nodes; for a node of a long run (node, null, fingerprint)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs: list[tuple] = []
        for _, _, fps, nodes, long in _runs(batches):
            if long:
                pairs += [(int(n), None, int(f)) for n, f in zip(nodes, fps.view(np.int64), strict=True)]
            else:
                i, j = np.triu_indices(len(fps), 1)
                near = _popcount(fps[i] ^ fps[j]) <= most
                pairs += [(int(a), int(b), None) for a, b in zip(nodes[i[near]], nodes[j[near]], strict=True)]
            if len(pairs) > 50_000:
                yield _frame(pairs)
                pairs = []
        yield _frame(pairs)

    return run


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame({c: pd.array([r[k] for r in rows], dtype="Int64") for k, c in enumerate("abf")}).rename(columns={"f": "fp"}).drop_duplicates()


def near_links(distinct: DataFrame, most: int = 2) -> DataFrame:
    """Links a, b between nodes whose fingerprints differ in at most 2 bits. distinct: node, fp; one row per fingerprint.

    Two segments of 32 bits: of two bits at most one falls into one of them. So each segment is
    indexed with each of its bits as a wildcard (64 keys a fingerprint), rows with an equal key meet,
    and whole fingerprints are compared. No key is capped: where more than PAIRWISE fingerprints meet
    under one key, their pairs aren't enumerated; each of them is expanded into itself and its 64
    one-bit variants instead, and those with a variant in common are linked to the least of them.
    Two fingerprints share such a midpoint exactly if they differ in at most two bits.
    """
    if most != 2:
        raise ValueError("two segments with one wildcard stand for 2 bits")
    segment = F.when(F.col("slot") < 32, F.shiftrightunsigned("fp", 32)).otherwise(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)))
    index = (
        distinct.select("node", "fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("slot"))
        .withColumn("key", segment.bitwiseAND(F.expr("~shiftleft(1L, slot % 32)")))
        .select("slot", "key", "node", "fp")
    )
    met = materialize(index.repartition("slot", "key").sortWithinPartitions("slot", "key").mapInPandas(_links(most), "a long, b long, fp long").distinct())
    pairs = met.where("b is not null").select("a", "b")
    flips = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)))
    variants = met.where("b is null").select(F.col("a").alias("node"), F.explode(F.concat(F.array("fp"), flips)).alias("variant"))
    hubs = variants.groupBy("variant").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1").select("variant", "hub")
    stars = variants.join(hubs, "variant").where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    return pairs.union(stars).distinct()


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the smallest id reachable over links of at most 2 bits.

    Fingerprints are computed once and written to the shared folder. Documents with one fingerprint
    become a single node (their smallest id), so a large group of copies never meets itself; links
    exist between distinct fingerprints only. Null or wordless text: fingerprint 0, linked like any
    other. Null id: a row of its own fingerprint; its component is that of the fingerprint's
    documents, null if there is no other. Rows that repeat: a row each. Empty table: no rows.
    """
    prints = materialize(fingerprints(docs, id_col, text_col, words))
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("node")))
    parts = connected_components(near_links(nodes.where("node is not null")))
    labels = nodes.join(parts, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return prints.join(labels, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# --- documents by similarity: wide fingerprints find candidates, shingles decide ----------------


def wide_fingerprint(text: str | None, segments: int, width: int, words: int = PRINT_WORDS) -> np.ndarray:
    """segments numbers of width bits, each bit the majority over the hashes of all word shingles."""
    import xxhash

    bits, total, n = segments * width, 0, 0
    for part in _shingles(text, words):
        digests = [xxhash.xxh3_128_digest(p, SEED + k) for p in part for k in range(-(-bits // 128))]
        total = total + np.unpackbits(np.frombuffer(b"".join(digests), np.uint8).reshape(len(part), -1), axis=1)[:, :bits].sum(axis=0, dtype=np.int64)
        n += len(part)
    over = np.broadcast_to(np.asarray(total) * 2 > n, (bits,)).reshape(segments, width)
    return over @ (np.int64(1) << np.arange(width, dtype=np.int64))


def _shingles(text: str | None, words: int, most: int = 16_384) -> Iterator[list[bytes]]:
    """All shingles of so many words, A-Z in lower case, in lists of bounded length; of fewer words the whole sequence."""
    parts = (text or "").encode().translate(LOWER).split()
    ends = max(1, len(parts) - words + 1) if parts else 0
    for at in range(0, ends, most):
        yield [b" ".join(parts[i : i + words]) for i in range(at, min(ends, at + most))]


def wide_fingerprints(docs: DataFrame, segments: int, width: int, id_col: str = "doc_id", text_col: str = "text", words: int = PRINT_WORDS) -> DataFrame:
    """doc_id and the segments of its fingerprint (array of longs). Rows without id: left out. Repeated rows: a row each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "segments": [wide_fingerprint(t, segments, width, words) for t in batch["text"]]})

    found = ids_and_texts(docs.where(F.col(id_col).isNotNull()), id_col, text_col)
    return found.mapInPandas(run, "doc_id long, segments array<long>")


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of fingerprints, whose last axis is their words of 64 bits."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


#: Rows of a key that are compared with each other at once; larger keys become cells, which are settled round after round.
SMALL = 6


def _wide_cells(words: int, most: int, small: int = SMALL):
    """Of rows key, node, f0, f1, ... sorted by key and a hash of the node: candidate pairs a < b. Keys of up to `small` rows give all pairs
    that differ in at most `most` bits. Of larger keys each row is paired with the first and with the one before it, and the rows
    themselves are handed on (a, and the key's leader), so that no pair is lost; they're handed on as they come, however many
    there are."""
    names = [f"f{i}" for i in range(words)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = None  # of the long run that may go on: node and fingerprint of its first row, then of its last
        last = None
        for columns, starts, sizes, long, cut in runs(batches, ("key", "node", *names), small):
            keys, nodes = columns[0], columns[1]
            fps = np.stack(columns[2:], axis=1).view(np.uint64)
            a, b = [], []
            for size in range(2, small + 1):
                at = starts[(sizes == size) & ~long]
                for i in range(size):
                    for j in range(i + 1, size):
                        near = at[_distance(fps[at + i], fps[at + j]) <= most]
                        a.append(nodes[near + i])
                        b.append(nodes[near + j])
            rows = np.repeat(long, sizes)
            for at, size, goes_on in zip(starts[long], sizes[long], cut[long], strict=True):
                mine, prints = nodes[at : at + size], fps[at : at + size]
                if goes_on and first is not None and first[0] == keys[at]:
                    mine, prints = np.r_[first[1], mine], np.concatenate([first[2], prints])
                for other in (np.zeros(len(mine), np.int64), np.maximum(np.arange(len(mine)) - 1, 0)):
                    near = _distance(prints, prints[other]) <= most
                    a.append(mine[near])
                    b.append(mine[other[near]])
                first = keys[at], mine[[0, -1]], prints[[0, -1]]
            a, b = np.concatenate([np.zeros(0, np.int64), *a]), np.concatenate([np.zeros(0, np.int64), *b])
            pairs = pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).query("a != b").drop_duplicates().astype("Int64")
            heads, last = leaders(keys[starts[long]], nodes[starts[long]], cut[long], last)
            held = pd.DataFrame({"a": nodes[rows], "leader": np.repeat(heads, sizes[long])}).drop_duplicates().astype("Int64")
            yield pd.concat([pairs, held], ignore_index=True)[["a", "b", "leader"]].astype("Int64")

    return run


def _whole(prints: DataFrame, width: int, words: int) -> DataFrame:
    """prints with the fingerprint once more, as few longs f0, f1, ...: segments one after another, 63 bits in each."""
    bits = F.array_join(F.transform("segments", lambda s: F.lpad(F.bin(s), width, "0")), "")
    return prints.withColumn("bits", bits).select("doc_id", "segments", *[F.conv(F.substring("bits", 63 * i + 1, 63), 2, 10).cast("long").alias(f"f{i}") for i in range(words)])


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SIMILAR_WORDS, percent: int = SIMILARITY, segments: int = SEGMENTS, width: int | None = None, share: float = MOST_SHARE) -> DataFrame:
    """node, component: documents that are connected by links, with the least id of those.

    A link is a Jaccard similarity of at least `percent` of the sets of shingles of so many words, between documents that meet:
    by equal fingerprints of segments * width bits, or by fingerprints that agree in a segment but for one bit. Documents
    of one fingerprint are settled first (cells.settled) and then stand in the index once per component, so a template
    behind many documents is one row there. Every segment is indexed with each of its bits as a wildcard. A segment has three
    bits more than the rows' number has (21 at least), so that unrelated fingerprints seldom meet, whatever the table's size.
    Keys of a few rows give all pairs within `share` of the bits; larger keys are cells, of which no pair is left out
    unless it is connected already. Texts of candidates only travel: picked by their ids and written once.
    """
    width = width or max(LEAST_WIDTH, (docs.count() + 1).bit_length() + 3)
    longs = -(-segments * width // 63)
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null")
    f = [f"f{i}" for i in range(longs)]
    prints = materialize(_whole(wide_fingerprints(docs, segments, width, id_col, text_col), width, longs))
    as_cells = lambda df: df.select(F.lit(0).alias("kind"), "key", "node", F.col("node").alias("label"), F.lit(None).cast("double").alias("dist"))
    texts_of = lambda ids: materialize(within(named, ids.select(F.col("node").alias("id")), "id"))
    pair = "a long, b long"
    many = prints.groupBy(*f).agg(F.count(F.lit(1)).alias("k")).where("k > 1").drop("k")
    equal = materialize(as_cells(prints.join(many, f).select(F.xxhash64(*f).alias("key"), F.col("doc_id").alias("node")).distinct()))
    first = docs.sparkSession.createDataFrame([], pair) if equal.isEmpty() else settled(equal, docs.sparkSession.createDataFrame([], pair), texts_of(equal), words, percent).select(F.col("node").alias("a"), F.col("component").alias("b"))
    first = materialize(first.where("a <> b"))
    placed = prints.join(first.select(F.col("a").alias("doc_id"), F.col("b").alias("part")), "doc_id", "left").withColumn("part", F.coalesce("part", "doc_id"))
    nodes = placed.groupBy(*f, "part").agg(F.min("doc_id").alias("node"), F.first("segments").alias("segments"))
    slots = nodes.select("node", "segments", *f, F.explode(F.sequence(F.lit(0), F.lit(segments * width - 1))).alias("slot"))
    segment = F.element_at("segments", F.expr(f"cast(slot div {width} as int) + 1")).bitwiseAND(F.expr(f"~shiftleft(1L, cast(slot % {width} as int))"))
    index = slots.select((F.shiftleft(F.col("slot").cast("long"), width)).bitwiseOR(segment).alias("key"), "node", *f)
    with arrow_rows(docs.sparkSession, 1 << 14):
        met = materialize(index.repartition("key").sortWithinPartitions("key", F.xxhash64("node"), "node").mapInPandas(_wide_cells(longs, int(share * segments * width)), "a long, b long, leader long"))
    pairs = materialize(met.where("b is not null").select("a", "b").distinct())
    links = materialize(measured(pairs, texts_of(pairs.select(F.explode(F.array("a", "b")).alias("node"))), words, picked=True).where(linked(percent)).select("a", "b").union(first))
    cells = materialize(as_cells(met.where("leader is not null").select(F.col("leader").alias("key"), F.col("a").alias("node")).distinct()))
    return connected_components(links) if cells.isEmpty() else settled(cells, links, texts_of(cells), words, percent)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SIMILAR_WORDS, percent: int = SIMILARITY, **how) -> DataFrame:
    """Of each group of documents that similar_components connects the one with the smallest id, with all its columns.

    Null and wordless texts: alike. Rows without id stay; rows that repeat an id stay or go together.
    Empty table: no rows.
    """
    parts = similar_components(docs, id_col, text_col, words, percent, **how)
    return without(docs, parts.where("node <> component").select(F.col("node").alias("id")), id_col)
