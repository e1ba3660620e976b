"""Five-word shingle sets, their exact similarity, and the settling of cells: groups of documents of which any two may link."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from benchbook.llm.common import LOWER, materialize, within
from benchbook.llm.components import connected_components

WORDS = 5
#: Documents link when 100 * intersection >= PERCENT * union.
PERCENT = 80
EPS = 1 - PERCENT / 100
TINY = 1e-9
#: Shingles and characters of sets that a task keeps while it compares.
HELD = 1_000_000
#: Pivots of a cell in its first round.
FIRST_PIVOTS = 4
#: Cells of more rows are crowded; among their texts a shingle of so many texts at most is rare.
CROWDED = 64
RARE = 64


def linked(percent: int = PERCENT) -> str:
    return f"100 * both >= {int(percent)} * whole"


_FACTORS = [np.uint64(f) for f in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]
#: A byte's share of its word's hash, and what a place in the word multiplies it with; odd, so it has an inverse.
_BYTES = np.random.default_rng(42).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9FB21C651E98DF25
#: Bytes of words that are hashed at once; a longer word is hashed by itself.
_STRETCH = 1 << 16
_BLANKS = bytes(32 if 9 <= b <= 13 else b for b in LOWER)


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2^64."""
    with np.errstate(over="ignore"):
        ones = np.ones(n, np.uint64)
        up, down = ones.copy(), ones.copy()
        up[1:], down[1:] = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))
        return np.multiply.accumulate(up), np.multiply.accumulate(down)


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words in order, A-Z in lower case. Words are told apart by blanks, whatever their number."""
    data = (text or "").encode("utf-8", "replace").translate(_BLANKS)
    codes = np.frombuffer(data, np.uint8)
    inside = codes != 32
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    begins, ends = edges[::2], edges[1::2]
    out, i = np.zeros(len(begins), np.uint64), 0
    with np.errstate(over="ignore"):
        while i < len(begins):
            base = begins[i]
            j = int(np.searchsorted(ends, base + _STRETCH, "right"))
            if j == i:
                import xxhash

                out[i] = xxhash.xxh64_intdigest(data[base : ends[i]], 42)
                i += 1
                continue
            some, n = codes[base : ends[j - 1]], ends[j - 1] - base
            up, down = _powers(max(1 << 14, 1 << int(n).bit_length()))
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(_BYTES[some] * up[:n], out=sums[1:])
            b, e = begins[i:j] - base, ends[i:j] - base
            h = (sums[e] - sums[b]) * down[b] + (e - b).astype(np.uint64) * _FACTORS[0]
            h = (h ^ (h >> np.uint64(32))) * _FACTORS[1]
            out[i:j] = h ^ (h >> np.uint64(29))
            i = j
    return out


def shingle_hashes(text: str | None, size: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; of fewer words the whole sequence; without words none."""
    words = word_hashes(text)
    if not len(words):
        return words
    k = min(len(words), size)
    with np.errstate(over="ignore"):
        h = np.full(len(words) - k + 1, np.uint64(k), np.uint64)
        for i in range(k):
            h += words[i : len(words) - k + 1 + i] * _FACTORS[i % 5]
            h = (h << np.uint64(7)) | (h >> np.uint64(57))
        h = (h ^ (h >> np.uint64(33))) * _FACTORS[4]
        h ^= h >> np.uint64(29)
    h.sort()
    return h[np.r_[True, h[1:] != h[:-1]]]


def runs(batches: Iterator[pd.DataFrame], names: tuple[str, ...], small: int) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows sorted by key in pieces: columns, where their runs of one key begin, sizes, which runs are longer than `small`, and
    which may have other pieces.

    A run that may go on in the next batch waits; once it's longer than `small`, its rows are handed on as they come.
    """
    held: pd.DataFrame | None = None
    long_key = None
    for batch in batches:
        data = batch if held is None else pd.concat([held, batch], ignore_index=True)
        held = None
        if not len(data):
            continue
        key = data["key"].to_numpy()
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[starts, len(key)])
        long = sizes > small
        cut = np.zeros(len(starts), bool)
        cut[0] = long_key is not None and key[0] == long_key
        long |= cut
        if not long[-1]:
            held = data.iloc[starts[-1] :]
            data, starts, sizes, long, cut = data.iloc[: starts[-1]], starts[:-1], sizes[:-1], long[:-1], cut[:-1]
        else:
            long_key, cut[-1] = key[-1], True
        if len(data):
            yield [data[c].to_numpy() for c in names], starts, sizes, long, cut
    if held is not None:
        yield [held[c].to_numpy() for c in names], np.zeros(1, np.int64), np.array([len(held)]), np.zeros(1, bool), np.zeros(1, bool)


def measured(edges: DataFrame, texts: DataFrame, size: int = WORDS, picked: bool = False) -> DataFrame:
    """edges (a, b) with both, whole: the sizes of their sets' intersection and union. texts: id, text, of which only those of
    edges travel; picked: they are just those."""

    @F.pandas_udf("both long, whole long")
    def sizes(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        known: dict[str, np.ndarray] = {}
        held = 0

        def of(text: str) -> np.ndarray:
            nonlocal held
            if text not in known:
                if held > HELD:
                    known.clear()
                    held = 0
                known[text] = shingle_hashes(text, size)
                held += len(known[text]) + len(text or "")
            return known[text]

        for one, other in batches:
            out = []
            for x, y in zip(one, other, strict=True):
                x, y = sorted((of(x), of(y)), key=len)
                both = int(np.count_nonzero(y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x)) if len(y) else 0
                out.append((both, len(x) + len(y) - both))
            yield pd.DataFrame(out, columns=["both", "whole"], dtype="int64")

    if not picked:
        texts = within(texts, edges.select(F.explode(F.array("a", "b")).alias("id")), "id")
    first = edges.join(texts.select(F.col("id").alias("a"), F.col("text").alias("one")), "a")
    both = first.join(texts.select(F.col("id").alias("b"), F.col("text").alias("other")), "b")
    return both.select("a", "b", sizes("one", "other").alias("m")).select("a", "b", "m.both", "m.whole")


def leaders(keys: np.ndarray, firsts: np.ndarray, cut: np.ndarray, last: tuple[int, int] | None) -> tuple[np.ndarray, tuple[int, int] | None]:
    """Of pieces of long runs (their keys, first nodes, whether they may have other pieces) the leaders, and key and leader of the
    last run. last: what the call for the pieces before gave. A run's leader is its first node; cells with one leader are one.

    Copies share most of their keys, which differ by a few documents each. With rows of a key in the order of a hash of their
    nodes, nearly all cells of such a group have one leader: what was a row per document and key becomes about one per
    document. No pair is lost, as a cell of one leader holds every pair of its parts.
    """
    if not len(keys):
        return firsts, last
    found = firsts.copy()
    if cut[0] and last is not None and last[0] == keys[0]:
        found[0] = last[1]
    return found, (keys[-1], found[-1])


def flat_shingles(texts: DataFrame, size: int = WORDS) -> DataFrame:
    """node, low, high, h: a row for each shingle of the texts (id, text, low, high)."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingle_hashes(t, size) for t in batch["text"]]
            told = {to: np.repeat(batch[c].to_numpy(np.int64), [len(s) for s in sets]) for to, c in (("node", "id"), ("low", "low"), ("high", "high"))}
            yield pd.DataFrame({**told, "h": np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)})

    return texts.select("id", "text", "low", "high").mapInPandas(counted, "node long, low long, high long, h long")


def _sized(size: int, half: bool):
    """Of texts (id, text) node, h, marks: a row for each shingle (marks 0), or for about one in two, and a row with the size of a
    text's set (h the node, marks one more than the size)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            node, sets = batch["id"].to_numpy(np.int64), [shingle_hashes(t, size) for t in batch["text"]]
            sizes = np.array([len(s) for s in sets], np.int64)
            sets = [s[s & np.uint64(1) == 0] for s in sets] if half else sets
            n = [len(s) for s in sets]
            flat = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
            yield pd.DataFrame({"node": np.r_[np.repeat(node, n), node], "h": np.r_[flat, node], "marks": np.r_[np.zeros(len(flat), np.int64), sizes + 1]})

    return run


def shared_sizes(texts: DataFrame, size: int = WORDS, half: bool = False) -> DataFrame:
    """node, n, c of texts (id, text): the size of a text's set, and how many of its shingles another of these texts has too.

    Two texts can have no more in common than either shares with anything, so c bounds every similarity from above, where
    distances to pivots can't: texts that differ from one base in places of their own. Ids that repeat are left out.
    half: only every other shingle is looked at, all others count as shared; that's a bound too, at half the rows.
    """
    flat = texts.select("id", "text").mapInPandas(_sized(size, half), "node long, h long, marks long")
    # A shingle of one text only is told by that text; all others by none.
    each = flat.groupBy("h", "marks").agg(F.count(F.lit(1)).alias("k"), F.min("node").alias("node")).where("k = 1 or marks > 0")
    told = each.groupBy("node").agg(F.sum(F.when(F.col("marks") > 0, F.col("k")).otherwise(0)).alias("texts"), (F.max("marks") - 1).alias("n"), F.count(F.when(F.col("marks") == 0, 1)).alias("u"))
    return told.where("texts = 1").select("node", "n", (F.col("n") - F.col("u")).alias("c"))


def _told(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of rows key (a shingle), node, low, high, sorted by key: node, h, k for each shingle of up to RARE rows in more than one part;
    node, null, k for k that have no more rows and lie in one part. Frequent shingles tell nothing: they're the rest of a set."""
    for (key, node, low, high), starts, sizes, long, _ in runs(batches, ("key", "node", "low", "high"), RARE):
        k, often = np.repeat(sizes, sizes), np.repeat(long, sizes)
        mixed = np.repeat(np.minimum.reduceat(low, starts) != np.maximum.reduceat(high, starts), sizes)
        rare = ~often & mixed & (k > 1)
        nodes, times = np.unique(node[~often & ~rare], return_counts=True)
        none = pd.array([None] * len(nodes), dtype="Int64")
        yield pd.concat([pd.DataFrame({"node": node[rare], "h": key[rare], "k": k[rare]}).astype("Int64"), pd.DataFrame({"node": nodes, "h": none, "k": times}).astype("Int64")], ignore_index=True)


def _sharing(percent: int):
    """Of rows key, node, label, n, c, f, left, low, high, sorted by key: node, label, p_node, p_label for rows of one key that may
    link, aren't of one part and need a rare shingle in common for that. n 0: nothing is known of its size."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (key, node, label, n, c, f, left, low, high), _, sizes, _, _ in runs(batches, ("key", "node", "label", "n", "c", "f", "left", "low", "high"), RARE):
            found = []
            for step in range(1, sizes.max(initial=1)):
                i = np.flatnonzero(key[step:] == key[:-step])
                j = i + step
                needed, frequent = percent * (n[i] + n[j]), np.minimum(f[i], f[j])
                may = ((100 + percent) * np.minimum(c[i], c[j]) >= needed) & ((100 + percent) * (frequent + np.minimum(left[i], left[j])) >= needed) & ((100 + percent) * frequent < needed)
                may = (may | (n[i] == 0) | (n[j] == 0)) & (node[i] != node[j]) & (label[i] != label[j])
                may &= np.minimum(low[i], low[j]) != np.maximum(high[i], high[j])
                found.append(np.stack([node[i], label[i], node[j], label[j]])[:, may])
            pairs = np.concatenate([np.zeros((4, 0), np.int64), *found], axis=1)
            yield pd.DataFrame(dict(zip(("node", "label", "p_node", "p_label"), pairs, strict=True))).drop_duplicates()

    return run


def by_rare(members: DataFrame, texts: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (node, label, p_node, p_label) of members that may link and share a rare shingle, and node, f: how many frequent ones a
    member has. members: node, label, part, n, c (n and c null for ids that repeat), a row each; texts: id, text, those of members
    at least.

    Two sets that link have percent / (100 + percent) of n + m in common, of which frequent shingles can be as many as the one that
    has less of them has. So they share a rare one as well, or both are frequent enough: the pairs of the second kind are left
    to the caller. A shingle is rare if RARE texts at most have it, so the pairs of the first kind are no more than RARE for each
    rare shingle of a text; of a text's rare shingles, rarest first, so many come last that any partner must share another one.
    Rare shingles of one part only are no partner's; they count neither as rare nor as frequent.
    """
    spans = materialize(members.groupBy("node").agg(F.min("part").alias("low"), F.max("part").alias("high")))
    flat = flat_shingles(within(texts, spans.select(F.col("node").alias("id")), "id").join(spans.withColumnRenamed("node", "id"), "id"), size).select("node", "low", "high", F.col("h").alias("key"))
    told = materialize(flat.repartition("key").sortWithinPartitions("key").select("key", "node", "low", "high").mapInPandas(_told, "node long, h long, k long"))
    spent = told.groupBy("node").agg(F.sum(F.when(F.col("h").isNull(), F.col("k")).otherwise(1)).alias("spent"))
    known = materialize(members.drop("part").join(spans, "node").join(spent, "node", "left").withColumn("f", F.col("n") - F.coalesce("spent", F.lit(0))).drop("spent"))
    order = Window.partitionBy("node").orderBy("k", "h")
    ranked = told.where("h is not null").select("node", F.col("h").alias("key"), "k", F.row_number().over(order).alias("pos"), F.count(F.lit(1)).over(Window.partitionBy("node")).alias("r"))
    least = F.greatest(F.ceil(percent * F.col("n") / 100 - TINY) - F.col("f"), F.lit(1))
    held = ranked.join(known, "node").where(F.coalesce(F.col("pos") <= F.col("r") - least + 1, F.lit(True)))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    index = held.select("key", "node", "label", zero("n"), zero("c"), zero("f"), (F.col("r") - F.col("pos") + 1).cast("long").alias("left"), "low", "high")
    pairs = index.repartition("key").sortWithinPartitions("key", "node").mapInPandas(_sharing(percent), "node long, label long, p_node long, p_label long")
    return pairs.distinct(), known.select("node", "f")


def settled(cells: DataFrame, links: DataFrame, texts: DataFrame, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """node, component over all links (between labels), those of cells included. cells: kind, key, node, label, dist.

    kind 0: cells of a shingle or another key; kind 1: regions of a first pivot, dist the distance to it. A cell is settled when its
    documents are one component. Else pivots are drawn among those outside its largest component, eight times as many each
    round (64 times after a round of few pairs), and compared with all documents of other components that these bounds and windows
    allow; then they leave the cell. The first pivot of a cell also gives its documents a distance, hence windows for those that
    follow. What documents share with any other (shared_sizes) bounds what two of them share; those that share too little with all
    others are settled at once. In crowded cells documents that need a rare shingle in common meet by those (by_rare), and pivots
    are left for those whose frequent shingles alone may be enough: of a group of near copies, those nearest to what all have.
    """
    cell = ["kind", "key"]
    parts = connected_components(links)

    def mixed(cells: DataFrame) -> DataFrame:
        """Rows of cells with more than one part, with part, and main: the part that most of the cell's rows have."""
        labelled = cells.join(parts.withColumnRenamed("node", "label"), "label", "left").withColumn("part", F.coalesce("component", "label")).drop("component")
        largest = labelled.groupBy(*cell, "part").agg(F.count(F.lit(1)).alias("size")).groupBy(*cell).agg(F.max_by("part", F.struct("size", "part")).alias("main"), F.count(F.lit(1)).alias("parts")).where("parts > 1").drop("parts")
        return materialize(labelled.join(largest, cell))

    cells = mixed(cells).drop("part", "main")
    if cells.isEmpty():
        return parts
    for half in (True, False):  # half of the shingles rule out most; the others' sizes are then told by all
        sizes = shared_sizes(within(texts, cells.select(F.col("node").alias("id")), "id"), size, half)
        told = cells.join(sizes, "node", "left").where(F.coalesce(100 * F.col("c") >= percent * F.col("n"), F.lit(True)))
        cells = materialize(told.drop("n", "c") if half else told)

    def compared(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Sizes of pairs (node, label, p_node, p_label), and the links between labels that they give."""
        ordered = pairs.select(F.least("node", "p_node").alias("a"), F.greatest("node", "p_node").alias("b"), F.col("label").alias("x"), F.col("p_label").alias("y"))
        found = materialize(measured(ordered.select("a", "b").distinct(), texts, size))
        return found, materialize(ordered.join(found.where(linked(percent)).select("a", "b"), ["a", "b"], "left_semi").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())

    crowded = materialize(cells.groupBy(*cell).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > CROWDED).drop("rows"))
    if crowded.isEmpty():
        cells = cells.withColumn("f", F.lit(None).cast("long"))
    else:
        members = materialize(mixed(cells).join(crowded, cell, "left_semi").select("node", "label", "part", "n", "c").distinct())
        pairs, frequent = by_rare(members, texts, size, percent)
        _, new = compared(materialize(pairs))
        if not new.isEmpty():
            links = links.union(new)
            parts = connected_components(links)
        marked = cells.join(crowded.withColumn("crowded", F.lit(True)), cell, "left").join(frequent, "node", "left")
        cells = marked.withColumn("f", F.when(F.col("crowded"), F.col("f"))).drop("crowded").where(F.coalesce(100 * F.col("f") >= percent * F.col("n"), F.lit(True)))
    pivots, known = FIRST_PIVOTS, False
    while True:
        cells = mixed(cells)
        if cells.isEmpty():
            return parts
        turn = F.row_number().over(Window.partitionBy(*cell).orderBy(F.xxhash64("node"), "node"))
        drawn = materialize(cells.where("part <> main").withColumn("turn", turn).where(F.col("turn") <= pivots).select(*cell, *[F.col(c).alias(f"p_{c}") for c in ("node", "label", "n", "c", "f", "dist", "part", "turn")]))
        enough = lambda c: F.coalesce((100 + percent) * F.least(c, f"p_{c}") >= percent * (F.col("n") + F.col("p_n")), F.lit(True))
        met = cells.join(drawn, cell).where(
            (F.col("node") != F.col("p_node")) & (F.col("part") != F.col("p_part")) & enough("c") & enough("f")
            & ((F.col("kind") == 0) | (F.col("label") == F.col("key")) | (F.col("p_label") == F.col("key")))  # two of a shell meet elsewhere
            & F.coalesce(F.abs(F.col("dist") - F.col("p_dist")) <= 1 - percent / 100 + TINY, F.lit(True))
        )
        found, new = compared(met.select("node", "label", "p_node", "p_label"))
        rest = cells.join(drawn.select(*cell, F.col("p_node").alias("node")), [*cell, "node"], "left_anti")
        if not known:
            far = found.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"), F.coalesce(1 - F.try_divide("both", "whole"), F.lit(0.0)).alias("far")).select(F.col("e.a").alias("p_node"), F.col("e.b").alias("node"), "far")
            seen = rest.where("kind = 0").join(drawn.where("p_turn = 1").select(*cell, "p_node"), cell, "left").join(far, ["p_node", "node"], "left")
            rest = rest.where("kind = 1").unionByName(seen.drop("dist", "p_node").withColumnRenamed("far", "dist"))
        few = found.count() < cells.count()
        cells = materialize(rest.drop("part", "main"))
        pivots, known = (64 if few else 8) * pivots, True
        if not new.isEmpty():
            links = links.union(new)
            parts = connected_components(links)
