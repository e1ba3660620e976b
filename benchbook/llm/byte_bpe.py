"""Byte-level BPE as a monoid: halves are encoded apart and joined by re-encoding a window around the seam."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from benchbook.llm import tokenizers_ as tok
from benchbook.llm.common import ids_and_texts, with_null_ids

#: Stretches up to this many characters are leaves of the tree; in decoding stretches of a quarter as many ids,
#: since an id stands for about four characters. Nearly every document is longer, so it goes through the tree.
LEAF = 256
#: First reach of the window on either side of a seam, in characters; it doubles until it suffices.
REACH = 16
SCHEMA = "doc_id long, ids array<int>, decoded binary"
#: Letters of scripts that need no blanks, and their marks; letters on which all regex engines agree.
_LETTERS = "\u4e00-\u9fff\uac00-\ud7a3\u3041-\u3096\u30a1-\u30fa"
_MARKS = "\u3001\u3002\uff01\uff08\uff09\uff0c\uff1a\uff1b\uff1f\u300c-\u300f"
#: No match of the split pattern spans a place between a non-blank and a blank, nor one between such a letter and such a
#: mark, and no look-ahead of a match that ends there passes it. So what stands before and after is encoded independently
#: of the other side. ASCII blanks only: all regex engines agree on them.
SEAM = re.compile(rf"(?<=[!-~])(?=[\t\n\r ])|(?<=[{_LETTERS}])(?=[{_MARKS}])|(?<=[{_MARKS}])(?=[{_LETTERS}])")
#: Letters only. A match of the pattern may end between two letters only behind an apostrophe and up to two letters.
RUN = re.compile(rf"[A-Za-z{_LETTERS}]*")


def _edges(ids: list[int], encoding, start: int) -> list[int]:
    """Where tokens end that begin one after another at start, in bytes; the start itself comes first."""
    out = [start]
    for token in encoding.decode_tokens_bytes(ids):
        out.append(out[-1] + len(token))
    return out


def join_in_run(text: str, left: list[int], middle: int, right: list[int], encoding, start: int, end: int, reach: int) -> list[int] | None:
    """As join, where middle lies inside a run of letters, which is one match of the pattern; None where that isn't so.

    Inside one match a row of tokens is its encoding exactly if each two neighbours are what the encoder makes of their
    bytes; so a token that the window and a side have in the same place is a proven edge: what stands beyond it stays, and
    the window's tokens follow. The window grows until there is such a token on both sides.
    """
    while True:
        lo, hi = middle - reach, middle + reach
        if lo - 2 < start or hi > end or not RUN.fullmatch(text, lo - 2, hi):
            return None
        # Each token has a byte at least, so 4 * reach tokens of a side reach as far as the window.
        tail, head = left[max(0, len(left) - 4 * reach) :], right[: 4 * reach]
        before = len(text[lo:middle].encode())
        window = encoding._encode_single_piece(text[lo:hi].encode())
        inner = _edges(window, encoding, -before)
        spans = {(inner[k], inner[k + 1]): k for k in range(len(window))}
        sizes = _edges(tail, encoding, 0)
        lefts = [(k, spans[at]) for k in range(len(tail)) if (at := (sizes[k] - sizes[-1], sizes[k + 1] - sizes[-1])) in spans and at[0] > -before]
        edges = _edges(head, encoding, 0)
        rights = [(k, spans[at]) for k in range(len(head)) if (at := (edges[k], edges[k + 1])) in spans and at[1] < inner[-1]]
        if lefts and rights:
            (i, at), (j, to) = lefts[-1], rights[0]
            return left[: len(left) - len(tail) + i + 1] + window[at + 1 : to] + right[j:]
        reach *= 2


def join(text: str, left: list[int], middle: int, right: list[int], encoding, start: int, end: int, reach: int = REACH) -> list[int]:
    """Ids of text[start:end] from those of its two parts at middle.

    The window reaches from the last safe seam before middle to the first after it, and grows until
    both exist or a side is used up. Ids outside it can't change; those inside are encoded anew. Inside a long run of
    letters without seams, as in scripts without blanks, tokens themselves prove the window's edges (join_in_run).
    """
    if not SEAM.search(text, max(start, middle - reach), middle) or not SEAM.search(text, middle, min(end, middle + reach)):
        found = join_in_run(text, left, middle, right, encoding, start, end, reach)
        if found is not None:
            return found
    lo = hi = middle
    while True:
        lo, hi = max(start, middle - reach), min(end, middle + reach)
        before = [m.start() for m in SEAM.finditer(text, lo, middle + 1) if lo < m.start() < middle]
        after = next((m.start() for m in SEAM.finditer(text, max(start, middle - 1), min(end, hi + 1)) if m.start() > middle and m.start() < end), None)
        if (before or lo == start) and (after is not None or hi == end):
            break
        reach *= 2
    lo, hi = before[-1] if before else start, after if after is not None else end
    keep, drop, sizes = len(left), 0, encoding.decode_tokens_bytes
    tail = len(text[lo:middle].encode())
    while tail > 0:
        keep -= 1
        tail -= len(sizes([left[keep]])[0])
    head = len(text[middle:hi].encode())
    while head > 0:
        head -= len(sizes([right[drop]])[0])
        drop += 1
    if tail or head:
        raise AssertionError("a seam isn't a token's edge")
    return left[:keep] + encoding.encode_ordinary(text[lo:hi]) + right[drop:]


def encode_tree(text: str, encoding, leaf: int = LEAF, start: int = 0, end: int | None = None) -> list[int]:
    """Ids of text[start:end]; a long stretch is halved and its halves' ids are joined."""
    end = len(text) if end is None else end
    if end - start <= max(leaf, 1):
        return encoding.encode_ordinary(text[start:end])
    middle = (start + end) // 2
    return join(text, encode_tree(text, encoding, leaf, start, middle), middle, encode_tree(text, encoding, leaf, middle, end), encoding, start, end)


def decode_tree(ids: list[int], encoding, leaf: int = LEAF // 4) -> bytes:
    """Bytes of the ids: concatenation is the monoid's product, so halves are decoded apart and laid end to end."""
    if len(ids) <= max(leaf, 1):
        return encoding.decode_bytes(ids)
    middle = len(ids) // 2
    return decode_tree(ids[:middle], encoding, leaf) + decode_tree(ids[middle:], encoding, leaf)


def encode_decode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str = tok.BYTE_BPE_RANKS, leaf: int = LEAF) -> DataFrame:
    """Per document its ids and the bytes that they decode to: doc_id, ids, decoded. One pass, no shuffle.

    Null text: as empty (no ids, no bytes). Null id: kept. Repeated rows: a row each. Very long texts
    are encoded by the tree, so no leaf exceeds leaf characters unless a text has no blank.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding = tok.ranked(ranks)
        for batch in batches:
            ids = [encode_tree(t or "", encoding, leaf) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "ids": ids, "decoded": [decode_tree(i, encoding, leaf // 4) for i in ids]})

    return with_null_ids(ids_and_texts(docs, id_col, text_col).mapInPandas(run, SCHEMA))


DIGEST_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_decode_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str = tok.BYTE_BPE_RANKS, leaf: int = LEAF) -> DataFrame:
    """What encode_decode gives, as count and digests, so that ids needn't leave the worker. Edge cases as there."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding = tok.ranked(ranks)
        names = [str(i) for i in range(encoding.n_vocab)]
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = encode_tree(text or "", encoding, leaf)
                said = " ".join(map(names.__getitem__, ids)).encode()
                rows.append((doc, len(ids), hashlib.sha256(said).hexdigest(), hashlib.sha256(decode_tree(ids, encoding, leaf // 4)).hexdigest()))
            yield pd.DataFrame(rows, columns=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]).astype({"doc_id": "Int64"})

    return with_null_ids(ids_and_texts(docs, id_col, text_col).mapInPandas(run, DIGEST_SCHEMA))
