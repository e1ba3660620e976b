"""Places of pattern matches, which Spark's regex functions don't tell: one small Arrow UDF, the rest are columns."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from benchbook.functions import vocabulary as v
from benchbook.functions.text import R, full, split_paragraphs, squeeze

SPAN = "array<struct<start:int,end:int,text:string,pattern:int>>"


def match_spans(text: Column, *patterns: str) -> Column:
    """start, end (code points from 0), text and pattern number of every match, by pattern, then in order."""

    @F.pandas_udf(SPAN)
    def find(texts: pd.Series) -> pd.Series:
        regexes = [re.compile(p) for p in patterns]
        return texts.map(lambda t: [{"start": m.start(), "end": m.end(), "text": m.group(0), "pattern": i} for i, r in enumerate(regexes) for m in r.finditer(t)])

    return find(full(text))


ARTIFACTS = {"signature_block": v.SIGNATURE_BLOCK, "page_number": v.PAGE_LINE, "toc_dot_leader": v.DOT_LEADER}


def artifact_spans(spans: Column) -> Column:
    """struct(start, end, kind, text) of scan artifacts by start; a span that overlaps one kept before is left out.

    spans: match_spans(text, *ARTIFACTS.values()), a column of its own, since lambdas can't hold a Python UDF.
    """
    kinds = F.array(*[F.lit(k) for k in ARTIFACTS])

    def keep(found: Column, s: Column) -> Column:
        clash = F.exists(found, lambda o: (s["start"] < o["end"]) & (s["end"] > o["start"]))
        return F.when(clash, found).otherwise(F.concat(found, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"), F.get(kinds, s["pattern"]).alias("kind"), s["text"].alias("text")))))

    return F.array_sort(F.aggregate(spans, F.array().cast("array<struct<start:int,end:int,kind:string,text:string>>"), keep))


def _capped(chunks: Column, most: int, chars: int) -> Column:
    """Chunks joined by blank lines; ends after the chunk with which either bound is reached."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("chars"), F.array().cast("array<string>").alias("kept"))

    def step(s: Column, c: Column) -> Column:
        over = (s["n"] >= most) | (s["chars"] >= chars)
        return F.struct(F.when(over, s["n"]).otherwise(s["n"] + 1).alias("n"), F.when(over, s["chars"]).otherwise(s["chars"] + F.length(c)).alias("chars"), F.when(over, s["kept"]).otherwise(F.concat(s["kept"], F.array(c))).alias("kept"))

    return F.array_join(F.aggregate(F.filter(chunks, lambda c: c != ""), start, step)["kept"], "\n\n")


def provision_paragraphs(text: Column, spans: Column, most: int = 15, chars: int = 4000, around: int = 200) -> Column:
    """Paragraphs that cite a provision, or, without numbered paragraphs, merged windows around the citations.

    spans: match_spans(text, PROVISION).
    """
    paragraphs = split_paragraphs(text)
    cited = F.transform(F.filter(paragraphs, lambda p: p["text"].rlike(v.PROVISION)), lambda p: F.concat(F.lit("[Para "), p["number"].cast("string"), F.lit("] "), p["text"]))
    n = F.length(full(text))
    wide = F.transform(spans, lambda s: F.struct(F.greatest(s["start"] - around, F.lit(0)).alias("a"), F.least(s["end"] + around, n).alias("b")))

    def merge(found: Column, s: Column) -> Column:
        last = F.element_at(found, F.size(found))
        joins = (F.size(found) > 0) & (s["a"] <= last["b"])
        grown = F.concat(F.slice(found, 1, F.size(found) - 1), F.array(F.struct(last["a"].alias("a"), F.greatest(last["b"], s["b"]).alias("b"))))
        return F.when(joins, grown).otherwise(F.concat(found, F.array(s)))

    merged = F.aggregate(wide, F.array().cast("array<struct<a:int,b:int>>"), merge)
    windows = F.transform(merged, lambda s: squeeze(F.substring(full(text), s["a"] + 1, s["b"] - s["a"])))
    return F.when(F.size(paragraphs) > 0, _capped(cited, most, chars)).otherwise(_capped(windows, most, chars))


CITATIONS = (v.NEUTRAL_CITATION, v.REPORTER_CITATION)


def citation_candidates(text: Column, spans: Column, around: int = 150) -> Column:
    """struct(raw_citation, context): distinct citation-like strings of five characters or more, by pattern, then place.

    spans: match_spans(text, *CITATIONS).
    """

    def told(s: Column) -> Column:
        start = F.greatest(s["start"] - around, F.lit(0))
        context = F.substring(full(text), start + 1, s["end"] + around - start)
        return F.struct(F.trim(s["text"]).alias("raw_citation"), F.trim(R(context, "\n", " ")).alias("context"))

    found = F.transform(spans, told)
    names = F.transform(found, lambda x: x["raw_citation"])
    return F.filter(found, lambda x, i: (F.length(x["raw_citation"]) >= 5) & (F.array_position(names, x["raw_citation"]) == i + 1))
