"""What a judgment decides: rules over the words of its last sentences, read from the end and no further than needed.

The rules ask for words and for how far apart they stand. They run in one Arrow UDF: a text's windows are
looked at one after another, each sentence from the last on, and the first that tells an outcome ends the search.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from benchbook.functions import vocabulary as v

#: Numbered paragraphs, or characters of a text without them, that are read from the end, step by step.
LAST_PARAGRAPHS = (2, 4, 8)
LAST_CHARACTERS = (800, 1500, 2500)
FEWEST_PARAGRAPHS = 3

#: Words between a helping verb and what it helps (`is, accordingly, allowed`), and between a forum and what it did.
BETWEEN, NARRATED = 4, 14
HELPS = {"is", "are", "stand", "stands"}
HELPED = HELPS | {"was", "were", "stood"}
#: Courts below, as one or two words.
FORUMS = {("high", "court"), ("trial", "court"), ("session", "court"), ("sessions", "court"), ("district", "court"), ("magistrate",), ("tribunal",), ("forum", "below")}
DECIDED = {("allowed",), ("dismissed",), ("quashed",), ("disposed",), ("set", "aside")}
#: What may follow `allowed` when the helping verb is missing.
EXTENT = {("as", "above"), ("in", "the", "aforesaid", "terms"), ("to", "the", "above", "extent"), ("in", "part")}
SIDE = {("application",), ("applications",), ("ia",), ("ias",), ("i", "a"), ("i", "as")}
MAIN = {"appeal", "petition", "writ"}

_PARAGRAPH = re.compile(v.PARAGRAPH, re.ASCII)
_END = re.compile(v.SENTENCE_END, re.ASCII)
_LAST_WORD = re.compile(r"([A-Za-z']+)\s*\Z")
_WORD = re.compile(r"[a-z0-9']+")
#: Without one of these no rule holds; most sentences have none.
_TELLING = re.compile("allow|dismissed|withdrawn|remand|quashed|aside|disposed", re.IGNORECASE)


class Words:
    """A sentence as lower-case words, with questions about where some of them stand."""

    def __init__(self, sentence: str):
        self.words = _WORD.findall(sentence.lower())

    def places(self, *phrases: tuple[str, ...]) -> list[int]:
        w = self.words
        return [i for i in range(len(w)) if any(tuple(w[i : i + len(p)]) == p for p in phrases)]

    def has(self, *phrases: tuple[str, ...]) -> bool:
        return bool(self.places(*phrases))

    def helped(self, *phrases: tuple[str, ...]) -> bool:
        """Whether one of the phrases follows a helping verb with few words between."""
        helps = [i for i, w in enumerate(self.words) if w in HELPS]
        return any(0 < at - i <= BETWEEN + 1 for at in self.places(*phrases) for i in helps)

    def near(self, stem: str, word: str) -> bool:
        """Whether word follows a form of stem with few words between."""
        return any(w.startswith(stem) and word in self.words[i + 1 : i + 2 + BETWEEN] for i, w in enumerate(self.words))

    def tells_of_a_forum_below(self) -> bool:
        """Whether a court below is said to have decided. What is or was decided of its order counts as this court's work."""
        for at in self.places(*FORUMS):
            ends = [i for i in self.places(*DECIDED) if at < i <= at + NARRATED]
            if ends:
                return not HELPED & set(self.words[at : ends[-1]])
        return False

    def on_the_side(self) -> bool:
        """Whether an application is meant and no appeal, petition or writ comes after it."""
        return any(not MAIN & set(self.words[at:]) for at in self.places(*SIDE))


def outcome(sentence: str) -> str | None:
    """The outcome that a sentence tells: the most telling one, in this order."""
    if not _TELLING.search(sentence):
        return None
    s = Words(sentence)
    if s.tells_of_a_forum_below():
        return None
    if s.has(("partly", "allowed"), ("party", "allowed")) or s.near("allow", "partly"):
        return "Partly Allowed"
    if s.helped(("allowed",)) or s.has(*[("allowed", *e) for e in EXTENT]):
        return "Allowed"
    if s.helped(("dismissed",)):
        return "Dismissed"
    if s.has(("withdrawn",)):
        return "Withdrawn"
    if s.has(*[(verb, *back, "to") for verb in ("remand", "remanded") for back in ((), ("back",))]):
        return "Remanded"
    if s.has(("quashed",)):
        return "Quashed"
    if s.has(("set", "aside")):
        return "Set Aside"
    if s.helped(("disposed", "of")) and not s.on_the_side():
        return "Disposed"
    return None


def sentences(text: str) -> list[str]:
    """Sentences of a text whose blanks are single: a full stop closes one, unless an abbreviation stands before it."""
    done, held = [], []
    for part in _END.split(text):
        held.append(part.rstrip(" "))
        word = _LAST_WORD.search(part.rstrip()[-24:])  # no abbreviation is as long
        if word is None or word[1].lower() not in v.ABBREVIATIONS:
            done.append(". ".join(held).strip(" ") + ".")
            held = []
    done.append(". ".join(held).strip(" "))
    return [s for s in done if s not in ("", ".")]


def paragraphs(text: str) -> list[str]:
    """Texts of the paragraphs numbered 1, 2, 3 and so on; fewer than three give none."""
    starts: list[tuple[int, int]] = []
    for mark in _PARAGRAPH.finditer(text):
        if int(mark[1]) == len(starts) + 1:
            starts.append((mark.start(), mark.end()))
    if len(starts) < FEWEST_PARAGRAPHS:
        return []
    ends = [start for start, _ in starts[1:]] + [len(text)]
    return [p for p in (text[begin:end].strip() for (_, begin), end in zip(starts, ends, strict=True)) if p]


def _windows(text: str) -> Iterator[str]:
    found = paragraphs(text)
    if found:
        yield from (" ".join(found[-n:]) for n in LAST_PARAGRAPHS)
    else:
        yield from (text[-n:] for n in LAST_CHARACTERS)


def decide(text: str | None) -> tuple[str | None, str | None]:
    """The last sentence that tells an outcome, and the outcome."""
    for window in _windows(text or ""):
        for sentence in reversed(sentences(" ".join(window.split()))):
            if label := outcome(sentence):
                return sentence, label
    return None, None


def disposition(text: Column) -> Column:
    """struct(disposition_raw, disposition_category): the last telling sentence of the last 2, 4, 8 paragraphs, or,
    if there are no numbered ones, of the last 800, 1500, 2500 characters."""

    @F.pandas_udf("disposition_raw string, disposition_category string")
    def told(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([decide(t) for t in texts], columns=["disposition_raw", "disposition_category"], dtype=object)

    return told(text)
