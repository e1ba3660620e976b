"""Token counts by a map-side two-tier lookup: a broadcast table of frequent pre-tokens, then a worker's cache."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchbook.llm import tokenizers_ as tok
from benchbook.llm.common import ids_and_texts, with_null_ids

#: Entries of the table of frequent pre-tokens, entries that a task sends in for it, and pre-tokens that a task counts
#: at a time. They only concern speed: a pre-token that isn't in the table is encoded.
TABLE_ENTRIES = 65_536
TASK_ENTRIES = 16_384
COUNTED = 1_000_000
#: Pre-tokens that a worker remembers beyond the table.
CACHE_ENTRIES = 500_000
#: The file's split pattern, for plain characters in lower case.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+"
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def byte_characters() -> dict[int, int]:
    """Bytes to the characters that stand for them in a byte-level vocabulary: printable ones for themselves, the others from 256 on."""
    others = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
    return {b: 256 + i for i, b in enumerate(others)}


class Lengths(dict):
    """Pre-token to number of tokens; a miss goes to the library's BPE model and is remembered, up to a bound."""

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        super().__init__()
        self.path, self.most = path, entries
        self.model, self.characters = tok.library(path).model, byte_characters()
        self.bytes = {chr(c): b for b, c in ({b: b for b in range(256)} | self.characters).items()}
        self.find, self.special = re.compile(PRE_TOKEN).findall, tok.special_strings(path)
        self.split = re.compile("|".join(map(re.escape, self.special)) or r"(?!)").split

    def __missing__(self, word: str) -> int:
        n = len(self.model.tokenize(word.encode().decode("latin-1").translate(self.characters)))
        if len(self) < self.most:
            self[word] = n
        return n

    def learn(self, table: dict[str, int]) -> None:
        """Adds a table of frequent pre-tokens, unless it is in already."""
        if not self.keys() >= table.keys():
            self.update(table)
            self.most = max(self.most, len(table) + CACHE_ENTRIES)

    def words(self, text: str) -> tuple[int, list[str]]:
        """The special strings in a text, which are a token each, and the pre-tokens of all else.

        Texts of plain characters are split by PRE_TOKEN, others by the file's own normaliser and pre-tokenizer.
        """
        if tok.PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            return 0, self.find(text.lower())
        library, parts = tok.library(self.path), self.split(text)
        pieces = [p for part in parts for p, _ in library.pre_tokenizer.pre_tokenize_str(library.normalizer.normalize_str(part))]
        return len(parts) - 1, [bytes(map(self.bytes.__getitem__, p)).decode() for p in pieces]

    def count(self, text: str) -> int:
        special, words = self.words(text)
        return special + sum(map(self.__getitem__, words))


@lru_cache(maxsize=2)
def of_worker(path: str) -> Lengths:
    """One cache for a worker process, however many tasks it runs."""
    return Lengths(path)


def frequent(docs: DataFrame, path: str, text_col: str, entries: int = TABLE_ENTRIES) -> dict[str, int]:
    """Token lengths of the most frequent pre-tokens of all rows.

    Each task counts its own pre-tokens and sends in the most frequent ones with their counts; these few rows are
    all that is shuffled. The table is of bounded size.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lengths, seen = of_worker(path), Counter()
        for batch in batches:
            for text in batch["text"]:
                seen.update(lengths.words(text or "")[1])
            if len(seen) > COUNTED:
                seen = Counter(dict(seen.most_common(COUNTED // 2)))
        best = seen.most_common(TASK_ENTRIES)
        yield pd.DataFrame({"word": [w for w, _ in best], "n": [n for _, n in best]}).astype({"word": object, "n": "int64"})

    counts = docs.select(F.col(text_col).cast("string").alias("text")).mapInPandas(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    lengths = Lengths(path)
    return {r["word"]: lengths[r["word"]] for r in counts.orderBy(F.desc("n"), "word").limit(entries).collect()}


def token_counts(
    docs: DataFrame, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = tok.WORD_BPE_JSON
) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens as the tokenizers library counts them, over_limit.

    Two passes over the texts, one for the table of frequent pre-tokens; no text and no pre-token beyond
    that table's candidates is shuffled.

    Null text: 0 bytes, 0 tokens. Null id: kept. Repeated rows: a row each. Strings of special tokens
    inside a text count as the library's default has it (one token). Empty table: no rows.
    """
    table = docs.sparkSession.sparkContext.broadcast(frequent(docs, tokenizer, text_col))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lengths = of_worker(tokenizer)
        lengths.learn(table.value)
        for batch in batches:
            texts = [t or "" for t in batch["text"]]
            counts = [lengths.count(t) for t in texts]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "n_bytes": [len(t.encode()) for t in texts], "n_tokens": counts, "over_limit": [n > limit for n in counts]})

    return with_null_ids(ids_and_texts(docs, id_col, text_col).mapInPandas(run, SCHEMA))
