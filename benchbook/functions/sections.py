"""Bare section numbers of a provision's text: one walk over its words, numbers and bracketed levels."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that name a unit; they tell nothing themselves. `s.` counts with its dot only.
UNITS = {"section", "sections", "article", "articles", "order", "orders", "rule", "rules", "clause", "clauses", "regulation", "regulations", "sec", "sec.", "art", "art.", "s."}
SECTION = {"section", "sec", "sec.", "s."}
SUBUNITS = {f"{a}{b}{c}" for a in ("sub", "sub-") for b in ("section", "clause") for c in ("", "s")}
RULES = {"rule", "rules", "r."}
#: Words between two provisions; what follows `of` or `part` up to the next of these belongs to no section.
BETWEEN = {"and", "or", "to", "alternatively", "r/w"}
REST = {"of", "part"}

_LEXEME = re.compile(r"(?P<between>\br/w\b|[/,;&])|(?P<level>\([^\s/,;&()]*\)?[^\s/,;&(]*)|(?P<number>-?\d[^\s/,;&(]*)|(?P<word>[a-z][\w']*(?:-[a-z][\w']*)*\.?)", re.IGNORECASE | re.ASCII)
_GLUED = re.compile(r"(?<=\d)[A-Za-z]{3,}\]*\Z|\]+\Z")
_NUMBER = re.compile(r"\d{1,3}(?:-?[A-Z]{1,2})?")
_LEVEL = re.compile(r"\([0-9A-Za-z]{1,4}(\)?)\]*")
_ROMAN = re.compile(r"[IVXLC]+|\d+", re.IGNORECASE)


class Walk:
    """Places in a text's lexemes, and the sections found so far. A section is its number and its levels."""

    def __init__(self, text: str):
        self.lexemes = [(m.lastgroup, m.group()) for m in _LEXEME.finditer(text)]
        self.found: list[tuple[str, list[str]]] = []
        self.open: tuple[str | None, list[str]] | None = None
        self.whole = True

    def word(self, i: int) -> str:
        return self.lexemes[i][1].lower() if i < len(self.lexemes) else ""

    def begin(self, number: str | None, good: bool = True) -> None:
        self.close()
        self.open, self.whole = (number, []), good

    def add(self, level: str) -> None:
        m = _LEVEL.fullmatch(level)
        if self.open is None:
            self.begin(None)
        cut = bool(self.open[1]) and not self.open[1][-1].endswith(")")
        self.whole = self.whole and m is not None and not cut
        self.open[1].append(level.rstrip("]"))

    def close(self) -> None:
        """Ends the open section. Levels without a number go on from the section before, in place of its last level."""
        if self.open and self.whole:
            number, levels = self.open
            levels = [x if x.endswith(")") else x + ")" for x in levels]
            if number is not None:
                self.found.append((number, levels))
            elif self.found and self.found[-1][1]:
                self.found.append((self.found[-1][0], self.found[-1][1][:-1] + levels))
        self.open, self.whole = None, True

    def subsection(self, i: int) -> bool:
        """Whether `sub-section (2) of section 56` begins here."""
        kinds = [k for k, _ in self.lexemes[i : i + 5]]
        return kinds == ["word", "level", "word", "word", "number"] and self.word(i + 2) == "of" and self.word(i + 3) in SECTION

    def order_and_rule(self, i: int) -> int:
        """Where `order XX, rule 1` that begins here ends; i if none does."""
        j = i + 1
        if j >= len(self.lexemes) or not _ROMAN.fullmatch(self.lexemes[j][1]):
            return i
        j += 2 if self.word(j + 1) == "," else 1
        if self.word(j) not in RULES or j + 1 >= len(self.lexemes) or self.lexemes[j + 1][0] == "between":
            return i
        j += 2
        while j < len(self.lexemes) and self.lexemes[j][0] == "level":
            j += 1
        return j

    def run(self) -> list[str]:
        i, skip, said, unit = 0, False, False, False
        while i < len(self.lexemes):
            kind, raw = self.lexemes[i]
            low = raw.lower()
            if kind == "between" or low in BETWEEN or (low == "read" and self.word(i + 1) == "with"):
                self.close()
                skip = said = unit = False
                i += 2 if low == "read" else 1
                continue
            if low == "order" and (after := self.order_and_rule(i)) > i:
                self.close()
                i, unit = after, False
                continue
            if low in SUBUNITS and self.subsection(i):
                level, number = self.lexemes[i + 1][1], self.lexemes[i + 4][1]
                if not skip:
                    self.begin(number, _NUMBER.fullmatch(number) is not None)
                    self.add(level)
                i, said, unit = i + 5, True, False
                continue
            if low in REST and said:
                self.close()
                skip = True
            elif not skip and kind == "number":
                number = _GLUED.sub("", raw.removeprefix("-") if unit else raw)
                self.begin(number, _NUMBER.fullmatch(number) is not None)
                said = True
            elif not skip and kind == "level":
                self.add(raw)
                said = True
            elif not skip and low not in UNITS:
                # Levels behind another word are that word's.
                self.begin(None, False)
                said = said or low not in SUBUNITS
            unit = low in UNITS
            i += 1
        self.close()
        return [number + "".join(levels) for number, levels in self.found]


def listed(text: str | None) -> list[str]:
    return Walk(text or "").run()


def _listed(texts: pd.Series) -> pd.Series:
    return texts.map(listed)


def section_numbers(text: Column) -> Column:
    """Bare section numbers of a provision's text, none for null; `(s)` after `181(2)(r)` goes on at the same level."""
    return F.pandas_udf(_listed, "array<string>")(text)
