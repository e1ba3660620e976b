"""Names without titles: rules over a text's words and the gaps between them, as column expressions.

A phrase is a list of words in capitals; it stands where its words follow one another with nothing but blanks or a dot
between. What goes with a phrase is decided by its place: anywhere (titles), at the end (an ending), at the start (a
lead), or all from it on (a tail).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Phrase = tuple[str, ...]


def phrases(text: str) -> list[Phrase]:
    """Phrases of a text that parts them by commas."""
    return [tuple(p.split()) for p in text.split(",")]


# The words that are titles of judges and advocates, and those that begin or end a party's name.
JUDGE_TITLES = phrases("HON'BLE, HONBLE, CHIEF JUSTICE, CJI, JUSTICE, ACTING, SMT, SHRI, SH, MR, MRS, MS, DR")
JUDGE_ENDINGS = ["J.", "JJ.", "PRESIDING", "COMPANION"]
ADVOCATE_TITLES = phrases("SR ADVOCATE, SR ADV, SENIOR ADVOCATE, ADVOCATE, ADV, AOR, AMICUS CURIAE, MR, MRS, MS, DR, SHRI, SMT")
PARTY_LEADS = phrases("IN THE MATTER OF, BETWEEN")
PARTY_TAILS = phrases("THROUGH ITS, SECRETARY, DEPARTMENT OF, REPRESENTED BY, AUTH SIGNATORY, REGISTERED OFFICE, ALIAS")
ACT_NOUNS = ["act", "code", "rule", "rules", "regulation", "regulations"]
ACT_POINTERS = ["the", "said", "aforesaid", "above", "abovesaid"]

#: Signs that no name begins or ends with.
EDGES = r"\s,.()\[\]\-"


def pieces(c: Column) -> Column:
    """Words (letters, digits, apostrophes) and the gaps between them in turn; joined they are the text."""
    return F.split(c, r"(?<=[\w'])(?![\w'])|(?<![\w'])(?=[\w'])")


def _stands(parts: Column, at: Column, phrase: Phrase) -> Column:
    here = F.lit(True)
    for k, word in enumerate(phrase):
        here = here & (F.upper(F.get(parts, at + 2 * k)) == word)
        if k:
            here = here & F.trim(F.get(parts, at + (2 * k - 1))).isin("", ".")
    return F.coalesce(here, F.lit(False))


def _inside(parts: Column, at: Column, listed: Sequence[Phrase]) -> Column:
    """Whether the piece is a word of a phrase, or a gap inside of one."""
    hit = F.coalesce(F.upper(F.get(parts, at)).isin([p[0] for p in listed if len(p) == 1]), F.lit(False))
    for phrase in listed:
        if len(phrase) > 1:
            for back in range(2 * len(phrase) - 1):
                hit = hit | _stands(parts, at - back, phrase)
    return hit


def without(c: Column, listed: Sequence[Phrase]) -> Column:
    """c without the phrases, wherever they stand. A dot behind one goes only where the next word follows at once."""

    def goes(parts: Column, piece: Column, i: Column) -> Column:
        glued = (piece == ".") & (F.coalesce(F.get(parts, i + 1), F.lit("")) != "")
        return _inside(parts, i, listed) | (glued & _inside(parts, i - 1, listed))

    return F.get(F.transform(F.array(pieces(c)), lambda parts: F.array_join(F.filter(parts, lambda p, i: ~goes(parts, p, i)), "")), F.lit(0))


def without_ending(c: Column, endings: Sequence[str]) -> Column:
    """c without its last word, if that is an ending and something stands before it."""
    last = F.element_at(F.split(c, r"[,\s]"), -1)
    return F.when(F.upper(last).isin(*endings) & (F.length(last) < F.length(c)), F.substr(c, F.lit(1), F.length(c) - F.length(last))).otherwise(c)


def without_lead(c: Column, leads: Sequence[Phrase]) -> Column:
    """c without the phrase that it begins with. A single word takes its colon along."""

    def cut(parts: Column) -> Column:
        out = c
        for lead in leads:
            rest = F.array_join(F.slice(parts, 2 * len(lead), F.greatest(F.size(parts), F.lit(1))), "")
            out = F.when(_stands(parts, F.lit(0), lead), F.regexp_replace(rest, "^:", "") if len(lead) == 1 else rest).otherwise(out)
        return out

    return F.get(F.transform(F.array(pieces(c)), cut), F.lit(0))


def before_tail(c: Column, tails: Sequence[Phrase]) -> Column:
    """What stands before the first of the phrases, or before a sign of another name (@) between two words."""

    def begins(parts: Column, piece: Column, i: Column) -> Column:
        hit = (piece == "@") & (i > 0) & (F.coalesce(F.get(parts, i + 1), F.lit("")) != "")
        for tail in tails:
            hit = hit | _stands(parts, i, tail)
        return hit

    def cut(parts: Column) -> Column:
        at = F.array_position(F.transform(parts, lambda p, i: begins(parts, p, i)), F.lit(True)).cast("int")
        return F.when(at > 0, F.array_join(F.slice(parts, 1, F.greatest(at - 1, F.lit(0))), "")).otherwise(c)

    return F.get(F.transform(F.array(pieces(c)), cut), F.lit(0))


def is_pointer(act: Column) -> Column:
    """Whether an act's name only points at one named before: a noun behind pointing words, `the said Act`."""
    words = F.split(F.lower(F.regexp_replace(act, r"\.$", "")), r"[\s\-]+")
    return F.element_at(words, -1).isin(*ACT_NOUNS) & F.forall(F.slice(words, 1, F.size(words) - 1), lambda w: w.isin(*ACT_POINTERS))
