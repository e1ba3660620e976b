"""Lexers for full-text search: texts to words and queries to words, as column expressions."""

from __future__ import annotations

import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_BREAK = r"[^a-z0-9]+"
#: UTF-8 bytes of a lower-cased text: all but those of words become blanks.
_WORDS = bytes(b if chr(b) in "abcdefghijklmnopqrstuvwxyz0123456789" else 32 for b in range(256))


def raw_words(text: str) -> list[bytes]:
    """Words of a text inside a task, as WORD_BREAK would give them."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_WORDS).split()


@dataclass(frozen=True)
class Lexer:
    """Lower-cases, splits at everything but ASCII letters and digits, drops stop words but keeps their places."""

    stop: frozenset[str] = frozenset()

    def words(self, query: str) -> list[str | None]:
        """Words of a query; None stands where a stop word was."""
        return [None if w in self.stop else self.stem(w) for w in re.split(WORD_BREAK, query.lower()) if w]

    def lexemes(self, query: str) -> list[str]:
        return [w for w in self.words(query) if w]

    def stem(self, word: str) -> str:
        return word

    def lexeme(self, word: str) -> str:
        """What a text's word counts as; empty for a stop word."""
        return "" if word in self.stop else self.stem(word)

    def column(self, text: Column) -> Column:
        """Array of the text's words in order; stop words keep their places as empty strings, null text is an empty array."""
        words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), WORD_BREAK), lambda w: w != "")
        if not self.stop:
            return words
        stop = F.array(*[F.lit(w) for w in sorted(self.stop)])
        return F.transform(words, lambda w: F.when(F.array_contains(stop, w), "").otherwise(w))


# Common English function words.
ENGLISH_STOP = frozenset(
    "a about after all also am an and any are as at be because been before being but by can did do does for from had has have he her his how i if in into is it its just me more most my no nor not now of on once only or other our out over own same she so some such than that the their them then there these they this those through to too under until up very was we were what when where which while who whom why will with you your".split()
)
PORTABLE = Lexer()


@dataclass(frozen=True)
class English(Lexer):
    """Words by the published suffix-stripping rules for English (steps 1 to 5), stop words out.

    The text side runs the same rules as an Arrow UDF, once per distinct word of a batch.
    """

    stop: frozenset[str] = ENGLISH_STOP

    def stem(self, word: str) -> str:
        from benchbook.functions.stemmer import stem

        return stem(word)

    def column(self, text: Column) -> Column:

        stop = self.stop

        @F.pandas_udf("array<string>")
        def lex(texts: pd.Series) -> pd.Series:
            from benchbook.functions.stemmer import stem

            known: dict[str, str] = {}

            def one(text):
                out = []
                for w in re.split(WORD_BREAK, (text or "").lower()):
                    if w:
                        if w not in known:
                            known[w] = "" if w in stop else stem(w)
                        out.append(known[w])
                return out

            return texts.map(one)

        return lex(F.coalesce(text, F.lit("")))


def match_all(tokens: Column, lexemes: list[str]) -> Column:
    """All lexemes occur. A query without lexemes matches nothing."""
    if not lexemes:
        return F.lit(False)
    found = F.array_contains(tokens, lexemes[0])
    for w in lexemes[1:]:
        found &= F.array_contains(tokens, w)
    return found


def match_phrase(tokens: Column, words: list[str | None]) -> Column:
    """The lexemes occur in order, as far apart as in the query (stop words leave gaps)."""
    while words and words[0] is None:
        words = words[1:]
    while words and words[-1] is None:
        words = words[:-1]
    if not words:
        return F.lit(False)
    if None not in words:
        padded = F.concat(F.lit(" "), F.array_join(tokens, " "), F.lit(" "))
        return padded.contains(f" {' '.join(words)} ")
    first = F.filter(F.transform(tokens, lambda w, i: F.when(w == words[0], i)), lambda i: i.isNotNull())

    def fits(i: Column) -> Column:
        ok = F.lit(True)
        for shift, w in enumerate(words):
            if w is not None:
                ok &= F.coalesce(F.get(tokens, i + shift) == w, F.lit(False))
        return ok

    return F.exists(first, fits)
