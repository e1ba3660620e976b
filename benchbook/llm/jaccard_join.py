"""N-gram Jaccard join in the metric space of shingle sets: pivots, their regions, windows at the borders, recursion.

The distance of two sets, 1 - intersection / union, is a metric, and documents link at EPS = 0.2 or less. Three levels of
pivots divide the documents; each level hands on only what it can't settle, and none leaves out a pair.

1. A bounded sample of documents are the first pivots. Every document learns its distance to all of them. One within EPS
   of a pivot is a core document of the nearest one (its Voronoi region) and stands for it from then on. By the triangle
   inequality its partners lie within 2 EPS of that pivot: they're core documents of linked pivots, or they are copied
   into the region's shell. A group that a large share of all documents belongs to is thus settled where it is read.
2. All others go to cells. In a fixed order of all shingles (seldom ones first) the shingles from s on are a pivot set:
   a document's distance to its part from s on is the share of its shingles before s. Its own cell is that of its first
   shingle, at distance 0, and it is copied to every cell with s within the window EPS. If two documents link, all
   shingles before their first common one s are missing in the other, at most EPS of each, so they meet at s.
3. Cells of more than a few documents, and regions with a shell, are joined by pivots of their own, round after round:
   a pivot is compared with the documents in its window, linked ones become one component and need no more comparing
   among each other, and the rest gets more pivots, until one component is left or every other document was a pivot.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchbook.llm.cells import EPS, TINY, leaders, linked, measured, runs, settled, shingle_hashes
from benchbook.llm.common import NO_ID, arrow_rows, ids_and_texts, materialize, with_null_ids, within, without
from benchbook.llm.components import connected_components

#: First pivots, about; a pivot has so many shingles at most. Both bound what the driver gets and tasks hold.
PIVOTS = 512
PIVOT_SHINGLES = 4_096
#: Frequent shingles that the order puts last: at most so many, each of at least so many documents.
FREQUENT = 1 << 16
LEAST_FREQUENT = 32
#: Documents of about two million shingles in a row that must share one before a task takes note of it.
LEAST_IN_TASK = 4
#: Documents of a cell that are compared with each other at once.
SMALL = 8
#: First shingles by which documents are looked at before all others.
AHEAD = 4
_BITS = np.uint64(42)


def prefix_length(n: int) -> int:
    """So many first shingles of n hold the first one in common with any linked document: n - ceil(0.8 n) + 1."""
    return n - (4 * n + 4) // 5 + 1


class Lookup:
    """Positions of hashes in a sorted table; a bitmap over their leading bits answers most misses."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[keys >> _BITS] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are in the table, and where there."""
        if not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        some = np.flatnonzero(self.maybe[hashes >> _BITS])
        at = np.minimum(np.searchsorted(self.keys, hashes[some]), len(self.keys) - 1)
        hit = self.keys[at] == hashes[some]
        return some[hit], at[hit]

    def __reduce__(self):
        return Lookup, (self.keys,)


@dataclass
class Pivots:
    """Pivot documents with an inverted table of their shingles, and classes of pivots that link directly."""

    ids: np.ndarray
    sizes: np.ndarray
    lookup: Lookup
    first: np.ndarray  # of each key the first of its entries in `owners`
    owners: np.ndarray
    classes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    links: list[tuple[int, int]] = field(default_factory=list)

    @classmethod
    def of(cls, sets: list[tuple[int, np.ndarray]]) -> Pivots:
        different = {s.tobytes(): (i, s) for i, s in sorted(sets, key=lambda x: -x[0])}  # of equal sets the smallest id
        sets = sorted(different.values(), key=lambda x: x[0])
        flat = np.concatenate([np.zeros(0, np.uint64), *[s for _, s in sets]])
        owners = np.repeat(np.arange(len(sets)), [len(s) for _, s in sets])
        order = np.argsort(flat, kind="stable")
        keys, first = np.unique(flat[order], return_index=True)
        found = cls(np.array([i for i, _ in sets], np.int64), np.array([len(s) for _, s in sets], np.int64), Lookup(keys), np.r_[first, len(flat)], owners[order])
        root = np.arange(len(sets))
        for k, (_, s) in enumerate(sets):
            both, union = found.overlaps(s)
            for j in np.flatnonzero(5 * both >= 4 * union):
                if j < k:
                    found.links.append((int(found.ids[j]), int(found.ids[k])))
                    root[root == root[k]] = root[j]
        found.classes = root
        return found

    def overlaps(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sizes of the intersection and of the union with every pivot."""
        _, at = self.lookup.find(hashes)
        counts = self.first[at + 1] - self.first[at] if len(at) else np.zeros(0, np.int64)
        if not len(counts):
            return np.zeros(len(self.ids), np.int64), self.sizes + len(hashes)
        spread = np.repeat(self.first[at] - np.r_[0, counts.cumsum()[:-1]], counts) + np.arange(counts.sum())
        both = np.bincount(self.owners[spread], minlength=len(self.ids))
        return both, self.sizes + len(hashes) - both


def frequent_shingles(docs: DataFrame, text_col: str) -> tuple[Lookup, np.ndarray]:
    """The most frequent shingles, over all documents, and their counts. Tasks hand on those that they met most; sums decide.

    They only set the order in which prefixes are cut. Any order gives the same links, so what a task doesn't hand on costs time at most.
    """

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, counts, held, n = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0

        def merged():
            flat = np.concatenate([np.zeros(0, np.uint64), *held])
            slot = (flat >> _BITS).astype(np.int64)  # a shingle is no more frequent than its slot
            new, times = np.unique(flat[np.bincount(slot, minlength=1 << 22)[slot] >= LEAST_IN_TASK], return_counts=True)
            new, times = new[times >= LEAST_IN_TASK], times[times >= LEAST_IN_TASK]
            both, back = np.unique(np.r_[keys, new], return_inverse=True)
            sums = np.bincount(back, np.r_[counts, times], len(both)).astype(np.int64)
            most = np.argsort(-sums, kind="stable")[: 1 << 19]
            most.sort()
            return both[most], sums[most]

        for batch in batches:
            for text in batch["text"]:
                held.append(shingle_hashes(text))
                n += len(held[-1])
                if n > 1 << 21:
                    keys, counts = merged()
                    held, n = [], 0
        keys, counts = merged()
        most = np.argsort(-counts, kind="stable")[: 1 << 14]
        yield pd.DataFrame({"h": keys[most].view(np.int64), "n": counts[most]})

    sums = materialize(docs.select(F.col(text_col).cast("string").alias("text")).mapInPandas(counted, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_FREQUENT))
    level = F.floor(4 * F.log2("n"))
    room, least = FREQUENT, 1 << 30
    for r in sorted(sums.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"]):  # whole levels while there's room
        if (room := room - r["count"]) < 0:
            break
        least = r["level"]
    most = sums.where(level >= least).collect()
    table = sorted((r["h"] & (2**64 - 1), r["n"]) for r in most)
    lookup = Lookup(np.array([h for h, _ in table], np.uint64))
    return lookup, np.array([n for _, n in table], np.int64)


def sampled_pivots(docs: DataFrame, id_col: str, text_col: str, pivots: int) -> Pivots:
    """About so many documents, drawn by a hash of the id."""
    n = docs.count()
    if not n or not pivots:
        return Pivots.of([])
    drawn = docs.where(F.col(id_col).isNotNull() & (F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("pivot")), F.lit(n)) < pivots))

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(i, shingle_hashes(t)) for i, t in zip(batch["doc_id"], batch["text"], strict=True)]
            found = [(i, s.tobytes()) for i, s in found if 0 < len(s) <= PIVOT_SHINGLES]
            yield pd.DataFrame({"doc_id": pd.Series([i for i, _ in found], dtype="int64"), "s": pd.Series([s for _, s in found], dtype=object)})

    rows = ids_and_texts(drawn, id_col, text_col).mapInPandas(sets, "doc_id long, s binary").collect()
    return Pivots.of([(r["doc_id"], np.frombuffer(bytes(r["s"]), np.uint64)) for r in rows])


#: home, dist: the pivot whose core document it is; also: pivots that link to the same document; near, far: pivots in
#: whose shell it lies, and how far from them; prefix: its first shingles, for documents without home.
PLACED = "doc_id long, n long, hi long, lo long, home long, dist double, also array<long>, near array<long>, far array<double>, prefix array<long>"


def placed(docs: DataFrame, pivots: Pivots, frequent: Lookup, weights: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """Every document's set (size and 128-bit digest), region, shells and cells."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        told: set[tuple[int, int]] = set()
        for batch in batches:
            rows = []
            for i, text in zip(batch["doc_id"], batch["text"], strict=True):
                s = shingle_hashes(text)
                digest = xxhash.xxh3_128_digest(s.tobytes())
                hi, lo = (int.from_bytes(digest[k : k + 8], "big", signed=True) for k in (0, 8))
                home = dist = None
                also, near, far = [], [], []
                both, union = pivots.overlaps(s)
                if both.any():
                    close = np.flatnonzero(5 * both >= 4 * union)
                    if len(close):
                        share = both[close] / union[close]
                        best = close[share.argmax()]
                        home, dist = int(pivots.ids[best]), float(1 - share.max())
                        new = {(home, int(p)) for p in pivots.ids[close] if p != home and i != NO_ID} - told
                        told |= new
                        also = [p for _, p in new]
                    shell = np.flatnonzero((5 * both < 4 * union) & (1 - both / np.maximum(union, 1) <= 2 * EPS + TINY))
                    if home is not None:
                        shell = shell[pivots.classes[shell] != pivots.classes[best]]
                    near, far = pivots.ids[shell].tolist(), (1 - both[shell] / union[shell]).tolist()
                prefix = []
                if len(s) and home is None:
                    where, at = frequent.find(s)
                    if len(where):
                        weight = np.zeros(len(s), np.int64)
                        weight[where] = weights[at]
                        s = s[np.argsort(weight, kind="stable")]
                    prefix = s[: prefix_length(len(s))].view(np.int64).tolist()
                rows.append((i, len(s), hi, lo, home, dist, also, near, far, prefix))
            names = [c.split()[0] for c in PLACED.split(", ")]
            yield pd.DataFrame(rows, columns=names).astype({"home": "Int64"})

    return ids_and_texts(docs, id_col, text_col).mapInPandas(run, PLACED)


def _may_link(n: np.ndarray, m: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sets of n and m shingles whose first common shingle stands at places i and j: whether enough can be in common."""
    return 9 * np.minimum(n - i, m - j) >= 4 * (n + m)


def _stars(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of rows key, n, node, sorted so: pairs of each row with the first of its key and with the one before it, if their sizes allow a link."""
    last = None  # key, first node and its n, last node and its n
    for batch in batches:
        key, n, node = (batch[c].to_numpy() for c in ("key", "n", "node"))
        if not len(key):
            continue
        if last is not None:
            key, n, node = np.r_[last[0], key], np.r_[last[1], n], np.r_[last[2], node]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        first = np.repeat(starts, np.diff(np.r_[starts, len(key)]))
        here = np.arange(len(key))
        before = np.maximum(here - 1, first)
        a, b = np.r_[node[first], node[before]], np.r_[node, node]
        fits = (5 * np.r_[n[first], n[before]] >= 4 * np.r_[n, n]) & (a != b)
        yield pd.DataFrame({"a": np.minimum(a, b)[fits], "b": np.maximum(a, b)[fits]}).drop_duplicates()
        keep = [first[-1], len(key) - 1] if first[-1] < len(key) - 1 else [len(key) - 1]
        last = key[keep], n[keep], node[keep]


def _cells(small: int):
    """Of rows key, node, part, n, pos, sorted by key and a hash of the node: pairs a, b of cells up to `small` rows that may link
    and aren't in one part yet; of larger cells with more than one part the nodes (a) and the cell's leader."""
    columns = ("key", "node", "part", "n", "pos")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None
        for (key, node, part, n, pos), starts, sizes, long, cut in runs(batches, columns, small):
            out_a, out_b = [], []
            for size in range(2, small + 1):
                at = starts[(sizes == size) & ~long]
                for i in range(size):
                    for j in range(i + 1, size):
                        may = at[(part[at + i] != part[at + j]) & _may_link(n[at + i], n[at + j], pos[at + i], pos[at + j])]
                        out_a.append(node[may + i])
                        out_b.append(node[may + j])
            a, b = np.concatenate([np.zeros(0, np.int64), *out_a]), np.concatenate([np.zeros(0, np.int64), *out_b])
            pairs = pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).query("a != b").drop_duplicates().astype("Int64")
            mixed = np.minimum.reduceat(part, starts) != np.maximum.reduceat(part, starts)
            large = long & (mixed | cut)  # a piece of one part counts too, if other pieces may hold others
            heads, last = leaders(key[starts[large]], node[starts[large]], cut[large], last)
            rows = pd.DataFrame({"a": node[np.repeat(large, sizes)], "leader": np.repeat(heads, sizes[large])}).drop_duplicates().astype("Int64")
            yield pd.concat([pairs, rows], ignore_index=True)[["a", "b", "leader"]].astype("Int64")

    return run


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pivots: int = PIVOTS, small: int = SMALL) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest id reachable by links of five-word shingle sets.

    Null text: no words; documents without words have an empty set and link with nothing. Equal sets are one node, so
    copies never meet. Null id: the component is that of documents with an equal set, null if there are none, and the row
    links no others. Rows that repeat an id are one document: what links one of its texts links it. Empty table: no rows.
    """
    spark = docs.sparkSession
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null")
    frequent, weights = frequent_shingles(docs, text_col)
    first = sampled_pivots(docs, id_col, text_col, pivots)
    rows = materialize(placed(docs, first, frequent, weights, id_col, text_col))
    whole = rows.where((F.col("doc_id") != NO_ID) & (F.col("n") > 0))
    sets = materialize(whole.groupBy("hi", "lo").agg(F.min("doc_id").alias("node"), F.min("home").alias("home"), F.count(F.lit(1)).alias("copies")))
    again = materialize(whole.groupBy("doc_id").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("doc_id"))
    label = F.coalesce("home", "node")
    same = whole.select("doc_id", "hi", "lo").join(again, "doc_id").join(sets, ["hi", "lo"]).select(F.col("doc_id"), label.alias("label"))
    copies = whole.select("doc_id", "hi", "lo").join(sets.where("copies > 1").select("hi", "lo", "node"), ["hi", "lo"]).where("doc_id <> node")
    singles = without(whole, copies.join(again, "doc_id", "left_anti").select(F.col("doc_id").alias("id")), "doc_id")

    # A first look: documents that share one of their first shingles, each with one or two others. What links here needs no comparing later.
    own = singles.where("home is null")
    ahead = own.select(F.col("doc_id").alias("node"), "n", F.explode(F.slice("prefix", 1, AHEAD)).alias("key"))
    with arrow_rows(spark, 1 << 14):
        stars = materialize(ahead.repartition("key").sortWithinPartitions("key", "n", "node").select("key", "n", "node").mapInPandas(_stars, "a long, b long").distinct())
    texts = materialize(within(named, stars.select(F.explode(F.array("a", "b")).alias("id")), "id"))
    copied = materialize(measured(stars, texts, picked=True).where(linked()).select("a", "b"))
    early = connected_components(copied).withColumnRenamed("component", "part")

    # Cells: pairs of the small ones, rows of the large ones, of documents that aren't in one part yet.
    parted = own.select(F.col("doc_id").alias("node"), "n", "prefix").join(early, "node", "left").withColumn("part", F.coalesce("part", "node"))
    index = parted.select("node", "part", "n", F.posexplode("prefix").alias("pos", "key")).select("key", "node", "part", "n", "pos")
    with arrow_rows(spark, 1 << 14):
        met = materialize(index.repartition("key").sortWithinPartitions("key", F.xxhash64("node"), "node").mapInPandas(_cells(small), "a long, b long, leader long"))
    pairs = materialize(met.where("b is not null").select("a", "b").distinct())
    texts = materialize(within(named, pairs.select(F.explode(F.array("a", "b")).alias("id")), "id"))
    known = spark.createDataFrame([*first.links, (None, None)], "a long, b long").where("a is not null")
    shared = rows.select(F.col("home").alias("a"), F.explode("also").alias("b"))
    # An id that repeats stands for all its texts: a chain over their labels.
    chained = same.groupBy("doc_id").agg(F.min("label").alias("a")).join(same, "doc_id").select("a", F.col("label").alias("b"))
    links = materialize(measured(pairs, texts, picked=True).where(linked()).select("a", "b").union(copied).union(known).union(shared).union(chained).where("a <> b").distinct())

    # Large cells, and regions whose shell holds documents of other components.
    parts = connected_components(links)
    part = lambda df, c, to: df.join(parts.select(F.col("node").alias(c), F.col("component").alias(to)), c, "left").withColumn(to, F.coalesce(to, c))
    shell = singles.select(F.col("doc_id").alias("node"), "n", F.coalesce("home", "doc_id").alias("label"), F.explode(F.arrays_zip("near", "far")).alias("e")).select("node", "n", "label", F.col("e.near").alias("pivot"), F.col("e.far").alias("dist"))
    shell = materialize(part(part(shell, "label", "one"), "pivot", "two").where("one <> two").select("node", "n", "label", "pivot", "dist"))
    least = shell.groupBy("pivot").agg(F.min("dist").alias("least"))  # a row for each first pivot at most
    core = singles.select(F.col("doc_id").alias("node"), "n", F.col("home").alias("label"), F.col("home").alias("pivot"), "dist").join(F.broadcast(least), "pivot").where(F.col("dist") >= F.col("least") - EPS - TINY)
    regions = shell.unionByName(core.drop("least")).select(F.lit(1).alias("kind"), F.col("pivot").alias("key"), "node", "label", "dist")
    large = met.where("leader is not null").select(F.col("a").alias("node"), F.col("leader").alias("key")).distinct()
    large = large.select(F.lit(0).alias("kind"), "key", "node", F.col("node").alias("label"), F.lit(None).cast("double").alias("dist"))
    cells = materialize(large.unionByName(regions))
    if not cells.isEmpty():
        texts = materialize(within(named, cells.select(F.col("node").alias("id")), "id"))
        parts = settled(cells, links, texts)

    # Labels to components, components to their smallest id, sets to rows.
    roots = materialize(sets.select("hi", "lo", "node", label.alias("label")).join(parts.withColumnRenamed("node", "label"), "label", "left").select("hi", "lo", "node", F.coalesce("component", "label").alias("root")))
    least_ids = roots.groupBy("root").agg(F.min("node").alias("component_id"))
    ends = roots.join(least_ids, "root").select("hi", "lo", "component_id")
    found = with_null_ids(rows.select("doc_id", F.col("n").alias("n_shingles"), "hi", "lo")).join(ends, ["hi", "lo"], "left")
    return found.select("doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
