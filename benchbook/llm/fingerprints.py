"""Document fingerprints of closed syncmers: k-mers whose least inner s-mer stands at an edge."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from benchbook.llm.common import ids_and_texts, materialize, with_null_ids

K, S = 16, 8
#: Hashes that a fingerprint keeps: the least of all anchors' hashes, a fair sample of the set.
KEPT = 64
MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)
BASE = np.uint64(0x100000001B3)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MIX
    return (x ^ (x >> np.uint64(29))) * MULTIPLY


def _rolling(codes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each stretch of width codes; width a power of two, by doubling."""
    h, reach, step = codes, 1, BASE
    while reach < width:
        h = h[:-reach] * step + h[reach:]
        step = step * step * MULTIPLY
        reach *= 2
    return _scramble(h)


def anchors(text: str, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Positions (code points) and hashes of the closed syncmers. Which k-mers are chosen depends on themselves only.

    A text shorter than k has one anchor, the whole text, and the empty text none.
    """
    with np.errstate(over="ignore"):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64) + np.uint64(1)
        if not len(codes):
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        if len(codes) < k:
            h = np.uint64(len(codes))
            for c in codes:
                h = h * BASE + c
            return np.zeros(1, np.int64), _scramble(np.array([h], dtype=np.uint64))
        small, wide = _rolling(codes, s), k - s + 1
        least, reach = small, 1
        while reach * 2 <= wide:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < wide:
            least = np.minimum(least[: len(least) - (wide - reach)], least[wide - reach :])
        at = np.flatnonzero((small[: len(least)] == least) | (small[wide - 1 :] == least))
        return at, _rolling(codes, k)[at]


def sketch(text: str, k: int = K, s: int = S, kept: int = KEPT) -> np.ndarray:
    """The least distinct 32-bit anchor hashes, sorted. Every anchor of the whole text takes part."""
    found = (anchors(text, k, s)[1] >> np.uint64(32)).astype(np.uint32)
    return np.unique(found)[:kept]


def packed(found: np.ndarray) -> bytes:
    return found.astype(">u4").tobytes()


def said(found: np.ndarray) -> str:
    return packed(found).hex()


def likeness(a: np.ndarray, b: np.ndarray, kept: int = KEPT) -> float:
    """Share of the anchors of either text that both have, judged on the least hashes of their union; two empty ones: 1."""
    both = np.union1d(a, b)[:kept]
    if not len(both):
        return 1.0
    return float(np.isin(both, a, assume_unique=True)[np.isin(both, b, assume_unique=True)].sum() / len(both))


def syncmer_anchors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, s: int = S) -> DataFrame:
    """doc_id, position, anchor: every closed syncmer of every text, for positional matching. Null text: no rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                at, hashes = anchors(text or "", k, s)
                yield pd.DataFrame({"doc_id": pd.array([doc] * len(at), dtype="Int64"), "position": at, "anchor": hashes.view(np.int64)})

    return with_null_ids(ids_and_texts(docs, id_col, text_col).mapInPandas(run, "doc_id long, position long, anchor long"))


def positional_matches(left: DataFrame, right: DataFrame, least: int = 3) -> DataFrame:
    """Pairs of documents of two anchor tables that share at least so many anchors at one shift: left_id, right_id, shift, n.

    left is a stated query set, right the corpus. Both sides first lose anchors that the other lacks, by
    semi-joins on the anchor; an anchor that repeats in a document then counts once per shift. Every pair that
    shares an anchor is looked at, however frequent the anchor is, so the work follows the query set's size.
    """
    mine = left.join(right.select("anchor"), "anchor", "left_semi").select(F.col("doc_id").alias("left_id"), F.col("position").alias("p"), "anchor")
    other = right.join(left.select("anchor"), "anchor", "left_semi").select(F.col("doc_id").alias("right_id"), F.col("position").alias("q"), "anchor")
    return mine.join(other, "anchor").groupBy("left_id", "right_id", (F.col("q") - F.col("p")).alias("shift")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


#: Columns as the tasks make them; digests and fingerprints are bytes until the result names them in hexadecimal.
SCHEMA = "doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]
HEX = ("edited_sha256", "fingerprint", "edited_fingerprint")


def _row(doc, text: str, own: np.ndarray, follower: str, after: np.ndarray) -> tuple:
    half = len(text) // 2
    edited = text[: len(text) - half] + follower[:half]
    changed = own if edited == text else sketch(edited)
    return doc, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).digest(), packed(own), packed(changed), likeness(own, changed), likeness(own, after)


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text: NAMES, with the columns HEX in lower-case hexadecimal.

    The edited text has the last floor(n/2) code points replaced by the first as many (or all) of the
    next document in descending order of the id; after the last comes the first. Rows are dealt into
    ranges of the id, so that each task sees neighbours; the last row of a range meets the first one
    of the next range by a join of one row per range.

    Null text: as empty (fingerprint '', likeness of two empty ones 1). Null ids: last in the order.
    Equal ids: in the order of their texts. One row only: it is its own next. Empty table: no rows.
    """
    rows = ids_and_texts(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    order = [F.col("doc_id").desc(), F.col("text")]
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, order[0]).sortWithinPartitions(*order).withColumn("range", F.spark_partition_id())
    wide = f"range int, edge string, text string, {SCHEMA}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in wide.split(", ")]
        frame = lambda rows: pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64", "n_chars": "Int64"})
        last = None
        for batch in batches:
            out = []
            for where, doc, text in zip(batch["range"], batch["doc_id"], batch["text"], strict=True):
                doc = None if pd.isna(doc) else int(doc)
                own = last[3] if last and last[2] == text else sketch(text)
                if last is None:
                    out.append((where, "first", text, doc, *[None] * 6))
                else:
                    out.append((where, None, None, *_row(*last[1:], text, own)))
                last = (where, doc, text, own)
            yield frame(out)
        if last is not None:
            yield frame([(last[0], "last", last[2], last[1], *[None] * 6)])

    found = materialize(dealt.mapInPandas(run, wide))
    edges = found.where("edge is not null").select("range", "edge", "text", "doc_id")
    first = edges.where("edge = 'first'").select("range", F.col("text").alias("follower"))
    # One row per range: a window over them is as small as the number of partitions.
    line = Window.orderBy("range")
    follow = first.withColumn("before", F.lag("range").over(line)).withColumn("before", F.coalesce("before", F.max("range").over(Window.partitionBy())))
    ends = edges.where("edge = 'last'").join(follow.select(F.col("before").alias("range"), "follower"), "range")

    def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [_row(None if pd.isna(d) else int(d), t, sketch(t), f, sketch(f)) for d, t, f in zip(batch["doc_id"], batch["text"], batch["follower"], strict=True)]
            yield pd.DataFrame(out, columns=NAMES).astype({"doc_id": "Int64"})

    whole = found.where("edge is null").select(NAMES).union(ends.mapInPandas(close, SCHEMA))
    return with_null_ids(whole).withColumns({c: F.lower(F.hex(c)) for c in HEX})
