"""Vector code compression: a codebook per part of the vectors, trained in whole numbers over metric trees of the parts."""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchbook.llm.common import NO_ID, materialize, with_null_ids

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Vectors of one block; each of its parts gets a tree. Points of a leaf.
BLOCK = 8_192
LEAF = 24
#: Greatest component times SCALE: squared distances of parts then fit a long.
MOST = 1 << 28
TREES = "ids array<long>, labels array<string>, points binary, trees array<binary>"
CODES = "doc_id long, label string, code string, error long"


class Tree:
    """Balls over points: centre, radius, sum and count of each, two children or a stretch of `order`.

    Built middle-out. Anchors come first: about the square root of the points, each owning the points nearest to it; a new
    anchor is the point farthest from its own, and takes over only points that lie beyond half the way to it, as the
    triangle inequality tells. Each anchor's points become a subtree in the same way, and the anchors' balls are then
    merged upwards, the two that make the smallest ball first.
    """

    FIELDS = ("order", "begin", "end", "left", "right", "centre", "radius", "total")

    def __init__(self, points: np.ndarray | None = None):
        if points is None:
            return
        self._points = points.astype(np.float64)
        self._nodes: list[tuple] = []  # left, right, members (of a leaf), centre, radius, count
        root = self._build(np.arange(len(points)))
        self._flatten(root, points)

    def _leaf(self, members: np.ndarray) -> int:
        mine = self._points[members]
        centre = mine.mean(axis=0)
        self._nodes.append((-1, -1, members, centre, float(np.sqrt(((mine - centre) ** 2).sum(axis=1).max())), len(members)))
        return len(self._nodes) - 1

    def _anchors(self, members: np.ndarray) -> list[np.ndarray]:
        mine = self._points[members]
        owner = np.zeros(len(members), np.int64)
        at = [0]
        far = np.sqrt(((mine - mine[0]) ** 2).sum(axis=1))
        for k in range(1, int(np.ceil(np.sqrt(len(members))))):
            new = int(far.argmax())
            if far[new] == 0:
                break
            between = np.sqrt(((mine[at] - mine[new]) ** 2).sum(axis=1))
            maybe = np.flatnonzero(far > between[owner] / 2)
            d = np.sqrt(((mine[maybe] - mine[new]) ** 2).sum(axis=1))
            closer = d < far[maybe]
            owner[maybe[closer]], far[maybe[closer]] = k, d[closer]
            at.append(new)
        return [members[owner == k] for k in range(len(at))]

    def _build(self, members: np.ndarray) -> int:
        if len(members) <= LEAF:
            return self._leaf(members)
        groups = [g for g in self._anchors(members) if len(g)]
        if len(groups) == 1:  # equal points
            return self._leaf(members)
        return self._merge([self._build(g) for g in groups])

    def _merge(self, nodes: list[int]) -> int:
        size = len(nodes)
        centres = np.array([self._nodes[n][3] for n in nodes])
        radii, counts = np.array([self._nodes[n][4] for n in nodes]), np.array([self._nodes[n][5] for n in nodes], float)
        nodes, alive = list(nodes), np.ones(size, bool)
        apart = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(axis=2))
        ball = np.maximum(np.maximum(radii[:, None], radii[None]), (apart + radii[:, None] + radii[None]) / 2)
        np.fill_diagonal(ball, np.inf)
        for _ in range(size - 1):
            i, j = divmod(int(ball.argmin()), size)
            weight = counts[i] + counts[j]
            centre = (centres[i] * counts[i] + centres[j] * counts[j]) / weight
            radius = max(np.sqrt(((centre - centres[k]) ** 2).sum()) + radii[k] for k in (i, j))
            self._nodes.append((nodes[i], nodes[j], None, centre, float(radius), int(weight)))
            nodes[i], centres[i], radii[i], counts[i], alive[j] = len(self._nodes) - 1, centre, radius, weight, False
            apart = np.sqrt(((centres - centre) ** 2).sum(axis=1))
            row = np.where(alive, np.maximum(np.maximum(radii, radius), (apart + radii + radius) / 2), np.inf)
            row[i] = np.inf
            ball[i], ball[:, i], ball[j], ball[:, j] = row, row, np.inf, np.inf
            last = nodes[i]
        return last

    def _flatten(self, root: int, points: np.ndarray) -> None:
        """Nodes from the root down, a node's points one stretch of order."""
        n, order, stack = len(self._nodes), [], [(root, -1, 0)]
        self.left, self.right = np.full(n, -1, np.int32), np.full(n, -1, np.int32)
        self.begin, self.end = np.zeros(n, np.int32), np.zeros(n, np.int32)
        self.centre, self.radius = np.zeros((n, points.shape[1])), np.zeros(n)
        made = placed = 0
        while stack:
            node, parent, side = stack.pop()
            left, right, members, centre, radius, count = self._nodes[node]
            here, made = made, made + 1
            if parent >= 0:
                (self.left if side == 0 else self.right)[parent] = here
            self.centre[here], self.radius[here], self.begin[here], self.end[here] = centre, radius, placed, placed + count
            if members is None:
                stack += [(right, here, 1), (left, here, 0)]
            else:
                order.append(members)
                placed += count
        self.order = np.concatenate(order).astype(np.int32)
        sums = np.vstack([np.zeros((1, points.shape[1]), np.int64), points[self.order].cumsum(axis=0)])
        self.total = sums[self.end] - sums[self.begin]
        del self._nodes, self._points

    def dumps(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{f: getattr(self, f) for f in self.FIELDS})
        return out.getvalue()

    @classmethod
    def loads(cls, data: bytes) -> Tree:
        tree = cls()
        with np.load(io.BytesIO(data), allow_pickle=False) as arrays:
            for f in cls.FIELDS:
                setattr(tree, f, arrays[f])
        return tree

    def assign(self, points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Entry of each point (nearest, then lowest), and per entry the sum and the number of its points.

        A ball passes on to its children only those entries that can be nearest to one of its points: no entry whose least
        distance to the ball lies beyond another's greatest. A ball that is left with one entry adds its sum and count.
        """
        near = book.astype(np.float64)
        owner = np.zeros(len(points), np.int64)
        sums, counts = np.zeros_like(book), np.zeros(len(book), np.int64)
        stack = [(0, np.arange(len(book)))]
        while stack:
            node, entries = stack.pop()
            if len(entries) > 1:
                d, r = np.sqrt(((near[entries] - self.centre[node]) ** 2).sum(axis=1)), self.radius[node]
                entries = entries[d - r <= (d.min() + r) * (1 + 1e-9) + 1e-6]
            begin, end = self.begin[node], self.end[node]
            if len(entries) == 1:
                sums[entries[0]] += self.total[node]
                counts[entries[0]] += end - begin
                owner[self.order[begin:end]] = entries[0]
            elif self.left[node] >= 0:
                stack += [(self.left[node], entries), (self.right[node], entries)]
            else:
                for at in range(begin, end, 1024):
                    some = self.order[at : min(at + 1024, end)]
                    mine = points[some]
                    best = entries[squared(mine, book[entries]).argmin(axis=1)]
                    owner[some] = best
                    np.add.at(sums, best, mine)
                    counts += np.bincount(best, minlength=len(book))
        return owner, sums, counts


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances in whole numbers, points by entries."""
    return ((points[:, None] - entries[None]) ** 2).sum(axis=2)


def whole(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """doc_id (NO_ID for null), label, v: components as whole numbers. Rows with a null or non-finite component are left out."""
    v = F.col(vector_col).cast("array<double>")
    named = vectors.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"), F.col(label_col).cast("string").alias("label"), v.alias("x"))
    finite = named.where(F.col("x").isNotNull() & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))))
    return finite.select("doc_id", "label", F.transform("x", lambda c: F.floor(c * SCALE)).alias("v"))


def _blocks(parts: int, width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += len(batch)
            if n >= BLOCK:
                yield block(held)
                held, n = [], 0
        if n:
            yield block(held)

    def block(held: list[pd.DataFrame]) -> pd.DataFrame:
        rows = pd.concat(held, ignore_index=True)
        if set(map(len, rows["v"])) != {parts * width}:
            raise ValueError("vectors differ in length")
        points = np.array(rows["v"].tolist(), np.int64)
        if len(points) and np.abs(points).max() > MOST:
            raise ValueError("components are too large for exact distances")
        trees = [Tree(points[:, p * width : (p + 1) * width]).dumps() for p in range(parts)]
        return pd.DataFrame({"ids": [rows["doc_id"].to_numpy()], "labels": [rows["label"].tolist()], "points": [points.astype("<i4").tobytes()], "trees": [trees]})

    return run


def _each(batches: Iterator[pd.DataFrame], books: np.ndarray):
    """Blocks of the batches: the row, and per part its points and their entries, sums and counts."""
    parts, _, width = books.shape
    for batch in batches:
        for row in batch.itertuples(index=False):
            points = np.frombuffer(row.points, "<i4").astype(np.int64).reshape(-1, parts * width)
            cut = [points[:, p * width : (p + 1) * width] for p in range(parts)]
            yield row, cut, [Tree.loads(t).assign(c, books[p]) for p, (t, c) in enumerate(zip(row.trees, cut, strict=True))]


def _sums(trees: DataFrame, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per part and entry the sum and the number of its points. A task adds its blocks up; the driver gets one row per entry."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        for _, _, found in _each(batches, books):
            for p, (_, s, n) in enumerate(found):
                sums[p] += s
                counts[p] += n
        p, e = np.nonzero(counts)
        yield pd.DataFrame({"part": p, "entry": e, "n": counts[p, e]} | {f"s{i}": sums[p, e, i] for i in range(width)})

    schema = "part long, entry long, n long, " + ", ".join(f"s{i} long" for i in range(width))
    rows = trees.mapInPandas(run, schema).groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(width)]).collect()
    sums, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
    for r in rows:
        counts[r["part"], r["entry"]] = r["n"]
        sums[r["part"], r["entry"]] = [r[f"s{i}"] for i in range(width)]
    return sums, counts


def _codes(trees: DataFrame, books: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for row, cut, found in _each(batches, books):
            owners = np.stack([f[0] for f in found], axis=1)
            errors = sum(((c - books[p][f[0]]) ** 2).sum(axis=1) for p, (c, f) in enumerate(zip(cut, found, strict=True)))
            yield pd.DataFrame({"doc_id": row.ids, "label": pd.Series(row.labels, dtype=object), "code": pd.Series(["".join(f"{x:02x}" for x in o) for o in owners.tolist()], dtype=object), "error": errors})

    return trees.mapInPandas(run, CODES)


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, **columns) -> tuple[DataFrame, np.ndarray]:
    """The trees of all blocks (written once) and the codebooks (part, entry, component) after so many rounds.

    Codebooks begin as the parts of the vectors with the smallest ids (ties: by their components; fewer vectors: fewer
    entries). A round assigns all parts and replaces each entry by floor(sum / count) of its parts; unused ones stay.
    Only the codebooks and their sums, a fixed number of rows, pass through the driver.
    """
    rows = whole(vectors, **columns)
    known = rows.where(F.col("doc_id") != NO_ID).select("doc_id", "v").orderBy("doc_id", "v").limit(entries).collect()
    if len(known) < entries:
        known += rows.where(F.col("doc_id") == NO_ID).select("doc_id", "v").orderBy("v").limit(entries - len(known)).collect()
    if not known:
        return vectors.sparkSession.createDataFrame([], TREES), np.zeros((parts, 0, 0), np.int64)
    first = np.array([r["v"] for r in known], np.int64)
    if first.shape[1] % parts:
        raise ValueError(f"vectors of {first.shape[1]} components can't be cut into {parts} equal parts")
    width = first.shape[1] // parts
    books = np.stack([first[:, p * width : (p + 1) * width] for p in range(parts)])
    trees = materialize(rows.mapInPandas(_blocks(parts, width), TREES))
    for _ in range(rounds):
        sums, counts = _sums(trees, books)
        books = np.where(counts[:, :, None] > 0, np.floor_divide(sums, np.maximum(counts, 1)[:, :, None]), books)
    return trees, books


def code_vectors(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, code (two hex digits a part), error, label_error, codebooks_sha256 of each vector with finite components.

    Null or non-finite vectors: left out. Null ids: coded like any other, after all others where codebooks begin.
    Repeated rows: a row each. Null labels are one label. No vectors: no rows. Vectors of different lengths,
    or of components beyond 2^18: an error, as exact distances wouldn't fit a long.
    """
    trees, books = train(vectors, parts, entries, rounds, id_col=id_col, vector_col=vector_col, label_col=label_col)
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    codes = materialize(_codes(trees, books))
    sums = codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "l")
    found = with_null_ids(codes).join(sums, F.col("label").eqNullSafe(F.col("l")))
    return found.select(F.col("doc_id").alias("vec_id"), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
