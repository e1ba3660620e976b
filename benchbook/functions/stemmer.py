"""English suffix stripping by the published second-generation rules (a helper of the English lexer)."""

from __future__ import annotations

import re
from functools import lru_cache

V = "[aeiouy]"
DOUBLE = re.compile(r"(bb|dd|ff|gg|mm|nn|pp|rr|tt)$")
LI = set("cdeghkmnrt")
# Words the rules name as exceptions.
IRREGULAR = {"skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl"}
INVARIANT = {"sky", "news", "howe", "atlas", "cosmos", "bias", "andes"}
AFTER_1A = {"inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"}
# The rules' suffixes and what replaces them.
STEP2 = {
    "ization": "ize", "ational": "ate", "fulness": "ful", "ousness": "ous", "iveness": "ive", "tional": "tion", "biliti": "ble", "lessli": "less", "entli": "ent",
    "ation": "ate", "alism": "al", "aliti": "al", "ousli": "ous", "iviti": "ive", "fulli": "ful", "enci": "ence", "anci": "ance", "abli": "able", "izer": "ize",
    "ator": "ate", "alli": "al", "bli": "ble",
}
STEP3 = {"ational": "ate", "tional": "tion", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP4 = ["ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti", "ous", "ive", "ize", "al", "er", "ic"]


def regions(w: str) -> tuple[int, int]:
    """Starts of R1 and R2: what follows the first non-vowel after a vowel, and the same within R1."""
    m = re.match(r"(?:gener|commun|arsen)", w)
    m = m or re.match(rf".*?{V}[^aeiouy]", w)
    r1 = m.end() if m else len(w)
    m = re.compile(rf".*?{V}[^aeiouy]").match(w, r1)
    return r1, m.end() if m else len(w)


def short_end(w: str) -> bool:
    return bool(re.search(rf"[^aeiouy]{V}[^aeiouywxY]$", w) or re.fullmatch(rf"{V}[^aeiouy]", w))


@lru_cache(maxsize=100_000)
def stem(word: str) -> str:
    """The stem of a lower-case word. Words of up to two characters stay."""
    if len(word) <= 2 or word in INVARIANT:
        return word
    if word in IRREGULAR:
        return IRREGULAR[word]
    w = re.sub(r"^y|(?<=[aeiouy])y", "Y", word)
    r1, r2 = regions(w)
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith(("ied", "ies")):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif w.endswith("s") and not w.endswith(("us", "ss")) and re.search(V, w[:-2]):
        w = w[:-1]
    if w in AFTER_1A:
        return w
    if m := re.search(r"(eedly|eed)$", w):
        if m.start() >= r1:
            w = w[: m.start()] + "ee"
    elif (m := re.search(r"(ingly|edly|ing|ed)$", w)) and re.search(V, w[: m.start()]):
        w = w[: m.start()]
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif DOUBLE.search(w):
            w = w[:-1]
        elif short_end(w) and r1 >= len(w):
            w += "e"
    if len(w) > 2 and w[-1] in "yY" and w[-2] not in "aeiouy":
        w = w[:-1] + "i"
    w = _step2(w, r1)
    if w.endswith("ative"):
        w = w[:-5] if len(w) - 5 >= r2 else w
    else:
        w = _longest(w, STEP3, r1)
    for s in STEP4:
        if w.endswith(s):
            w = w[: -len(s)] if len(w) - len(s) >= r2 else w
            break
    else:
        if w.endswith("ion") and len(w) > 3 and w[-4] in "st" and len(w) - 3 >= r2:
            w = w[:-3]
    if w.endswith("e"):
        if len(w) - 1 >= r2 or (len(w) - 1 >= r1 and not short_end(w[:-1])):
            w = w[:-1]
    elif w.endswith("ll") and len(w) - 1 >= r2:
        w = w[:-1]
    return w.lower()


def _longest(w: str, table: dict[str, str], r: int) -> str:
    for s in sorted(table, key=len, reverse=True):
        if w.endswith(s):
            return w[: -len(s)] + table[s] if len(w) - len(s) >= r else w
    return w


def _step2(w: str, r1: int) -> str:
    if any(w.endswith(s) for s in STEP2):
        return _longest(w, STEP2, r1)
    if w.endswith("ogi") and w[-4:-3] == "l" and len(w) - 3 >= r1:
        return w[:-1]
    if w.endswith("li") and w[-3:-2] in LI and len(w) - 2 >= r1:
        return w[:-2]
    return w
