"""Sum-of-squares online packing of tokenised documents into fixed windows."""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchbook.llm import tokenizers_ as tok
from benchbook.llm.common import ids_and_texts, with_null_ids

WINDOW = 1024
END_ID = 0
#: Ids to a fill level. Coarser levels leave fewer windows open.
GRAIN = 16
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class SumOfSquares:
    """Open windows by fill level. A piece goes to the level that makes the sum of the squared level counts least.

    A level is a stretch of grain ids. Within the last of them a window is as good as full: it waits in
    short for a few ids cut off a later piece, and no longer counts.
    """

    def __init__(self, capacity: int, grain: int = GRAIN):
        self.capacity, self.grain = capacity, grain
        self.counts = np.zeros(capacity // grain + 1, dtype=np.int64)
        self.windows: list[list[tuple[int, list]]] = [[] for _ in self.counts]
        self.short: deque[tuple[int, list]] = deque()

    def choose(self, size: int) -> tuple[int, int]:
        """Level and place in it of the window that takes the piece; level -1 for a new window."""
        counts, grain = self.counts, self.grain
        level, place, least = -1, -1, float("inf")
        for h in np.flatnonzero(counts[: (self.capacity - size) // grain + 1])[::-1].tolist():  # of equals the fullest
            found = next((i for i in range(len(self.windows[h]) - 1, -1, -1) if self.windows[h][i][0] + size <= self.capacity), None)
            if found is not None and (change := self._change(h, size, self.windows[h][found][0])) < least:
                level, place, least = h, found, change
        return (level, place) if least <= self._change(-1, size) else (-1, -1)

    def _change(self, level: int, size: int, fill: int = 0) -> float:
        """Change of the sum of squares if a window of that level (-1: a new one) and fill takes the piece, halved."""
        counts, after = self.counts, (fill + size) // self.grain
        change = 0.0 if level < 0 else 0.5 - counts[level]
        if self.capacity - fill - size >= self.grain:
            change += 0.5 + counts[after] - (after == level)
        return change

    def place(self, size: int, piece) -> list | None:
        """Adds the piece; the window's pieces if that fills it."""
        level, at = self.choose(size)
        fill, window = self.windows[level].pop(at) if level >= 0 else (0, [])
        if level >= 0:
            self.counts[level] -= 1
        window.append(piece)
        fill += size
        if fill == self.capacity:
            return window
        if self.capacity - fill < self.grain:
            self.short.append((fill, window))
        else:
            self.counts[fill // self.grain] += 1
            self.windows[fill // self.grain].append((fill, window))
        return None

    def drain(self) -> list[tuple[int, list]]:
        """Fill and pieces of all windows that aren't full, fullest windows first."""
        return sorted([*self.short, *(w for level in self.windows for w in level)], key=lambda w: -w[0])


def encode(texts: list[str], path: str, ranks: str) -> Iterator[np.ndarray]:
    """The ids that the library gives for each text. Plain texts take the same vocabulary's rank file, which is faster."""
    fast, special = tok.ranked(ranks), tok.special_strings(path)
    for text in texts:
        if tok.PLAIN.fullmatch(text) and not any(s in text for s in special):
            yield np.array(fast.encode_ordinary(text), dtype="<u4")
        else:
            yield np.array(tok.library(path).encode(text, add_special_tokens=False).ids, dtype="<u4")


def _cut(piece: tuple, size: int) -> tuple[tuple, tuple]:
    """The first size ids of a piece and the rest."""
    doc, start, ids, total = piece
    return (doc, start, ids[:size], total), (doc, start + size, ids[size:], total)


def topped_up(windows: list[tuple[int, list]], capacity: int) -> Iterator[list]:
    """Full windows and, last, windows whose fills are powers of two, from windows that are open, fullest first.

    The fullest stay as they are and take what they lack from the emptiest, whose pieces are cut for that.
    """
    last = len(windows) - 1
    donor = windows[last][1] if windows else []
    for n, (fill, window) in enumerate(windows):
        while n < last and fill < capacity:
            if not donor:
                last -= 1
                donor = windows[last][1]
                continue
            given = donor.pop()
            if len(given[2]) > capacity - fill:
                given, rest = _cut(given, capacity - fill)
                donor.append(rest)
            window.append(given)
            fill += len(given[2])
        if n >= last:
            break
        yield window
    left = sum(len(p[2]) for p in donor)
    while left:
        space = min(capacity, 1 << (left.bit_length() - 1))
        left, window = left - space, []
        while space:
            given = donor.pop()
            if len(given[2]) > space:
                given, rest = _cut(given, space)
                donor.append(rest)
            window.append(given)
            space -= len(given[2])
        yield window


def pack_partition(docs: Iterator[tuple[int, np.ndarray]], window: int, number: int, grain: int = GRAIN) -> Iterator[tuple]:
    """Rows of SCHEMA. Full windows of long documents stand alone, remainders are placed by their sum of squares.

    A window that lacks less than grain ids gets them from the head of a later remainder. The windows
    that are open at the end top each other up.
    """
    packer, sequence = SumOfSquares(window, grain), (number << 36) - 1

    def rows(pieces: list) -> Iterator[tuple]:
        nonlocal sequence
        sequence += 1
        offset = 0
        for doc, start, ids, total in pieces:
            yield doc, start, len(ids), zlib.crc32(ids.tobytes()), total, sequence, offset
            offset += len(ids)

    for doc, ids in docs:
        total = len(ids)
        whole = total - total % window
        for start in range(0, whole, window):
            yield from rows([(doc, start, ids[start : start + window], total)])
        rest = (doc, whole, ids[whole:].copy(), total)
        # A remainder closes a waiting window if most of it is left over then.
        if packer.short and len(rest[2]) > 2 * (lack := window - packer.short[0][0]):
            head, rest = _cut(rest, lack)
            yield from rows([*packer.short.popleft()[1], head])
        if len(rest[2]) and (filled := packer.place(len(rest[2]), rest)):
            yield from rows(filled)
    for pieces in topped_up(packer.drain(), window):
        yield from rows(pieces)


def pack(
    docs: DataFrame, window: int = WINDOW, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text",
    tokenizer: str = tok.BYTE_BPE_JSON, ranks: str = tok.BYTE_BPE_RANKS,
) -> DataFrame:
    """Packs every document's ids, end_id appended, into sequences of at most window ids: one row per piece.

    Each partition packs its own documents as they come, without a shuffle; its state is the level
    array and the open windows' pieces, of which sum-of-squares keeps few. What a partition leaves open
    is topped up: the fullest windows stay, the emptiest are cut. Sequence ids hold the
    partition's number above 36 bits, so a rerun of a lost task gives the same rows.

    Null or empty text: the end id alone. Very long text: full windows and a remainder. Null id:
    kept. Repeated rows: packed each. Empty table: no rows. The only padding possible is none: every
    sequence has window ids or a power of two.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def each() -> Iterator[tuple]:
            for batch in batches:
                texts = ["" if t is None else t for t in batch["text"]]
                for doc, ids in zip(batch["doc_id"], encode(texts, tokenizer, ranks), strict=True):
                    yield (None if pd.isna(doc) else int(doc)), np.append(ids, np.uint32(end_id))

        context, held, names = TaskContext.get(), [], [c.split()[0] for c in SCHEMA.split(", ")]
        for row in pack_partition(each(), window, context.partitionId() if context else 0):
            held.append(row)
            if len(held) >= 20_000:
                yield pd.DataFrame(held, columns=names).astype({"doc_id": "Int64"})
                held = []
        yield pd.DataFrame(held, columns=names).astype({"doc_id": "Int64"})

    return with_null_ids(ids_and_texts(docs, id_col, text_col).mapInPandas(run, SCHEMA))
