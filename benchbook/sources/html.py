"""HTML pages to rows: a small Arrow UDF lists table cells and marked elements, columns do the rest."""

from __future__ import annotations

import re
from html import unescape
from html.parser import HTMLParser
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from benchbook.functions import text as t

CELL = "array<struct<tab:int,key:string,heading:string,row:int,col:int,text:string,lines:array<string>,groups:array<array<string>>,bold:array<string>,href:string>>"
ROW = "array<struct<row:int,fields:map<string,string>,href:string>>"
MARK = "array<struct<tag:string,cls:string,inside:string,text:string>>"
VOID = {"br", "img", "input", "hr", "meta", "link"}


class Cells(HTMLParser):
    """Cells of all tables in order: their words, lines, blocks of lines, bold texts and first link."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.tables, self.heading, self.cell, self.n, self.in_heading = [], [], "", None, 0, False
        self.group_depth, self.bold, self.depth = None, False, 0

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        words = set(a.get("class", "").split())
        if tag not in VOID:
            self.depth += 1
        if tag == "h3":
            self.in_heading, self.heading = True, ""
        elif tag == "table":
            self.tables.append([self.n, f"{a.get('id', '')} {a.get('class', '')}".strip(), self.heading.strip(), -1, -1])
            self.n += 1
        elif tag == "tr" and self.tables:
            self.tables[-1][3] += 1
            self.tables[-1][4] = -1
        elif tag in ("td", "th") and self.tables:
            tab = self.tables[-1]
            tab[4] += 1
            self.cell = {"tab": tab[0], "key": tab[1], "heading": tab[2], "row": max(tab[3], 0), "col": tab[4], "lines": [""], "groups": [], "bold": [], "href": None}
            self.out.append(self.cell)
            # What was left open in another cell doesn't reach into this one.
            self.group_depth, self.bold = None, False
        elif self.cell is not None:
            if tag in ("br", "div", "p", "li"):
                self.cell["lines"].append("")
            if tag == "div" and "d-flex" in words:
                self.cell["groups"].append([])
                self.group_depth = self.depth
            if tag == "span" and "fw-semibold" in words:
                self.bold = True
                self.cell["bold"].append("")
            if tag == "a" and self.cell["href"] is None:
                self.cell["href"] = a.get("href")

    def handle_endtag(self, tag):
        if tag in VOID:
            return
        if tag == "h3":
            self.in_heading = False
        elif tag == "table" and self.tables:
            self.tables.pop()
            self.cell = None
        elif tag in ("td", "th"):
            self.cell = None
        elif tag == "span":
            self.bold = False
        elif tag == "div":
            if self.group_depth == self.depth:
                self.group_depth = None
            if self.cell is not None:
                self.cell["lines"].append("")
        self.depth -= 1

    def handle_data(self, data):
        if self.in_heading:
            self.heading += data
        if self.cell is None:
            return
        self.cell["lines"][-1] += data
        words = " ".join(data.split())
        if words and self.group_depth is not None:
            self.cell["groups"][-1].append(words)
        if self.bold:
            self.cell["bold"][-1] += data

    def found(self) -> list[dict]:
        for c in self.out:
            c["lines"] = [x for x in (" ".join(line.split()) for line in c["lines"]) if x]
            c["bold"] = [" ".join(x.split()) for x in c["bold"]]
            c["text"] = " ".join(c["lines"])
        return self.out


class Report(Cells):
    """Rows below a table's first one, from heading to text (of repeated headings the last counts), with their first link; rows
    without a case number go, of equal numbers the first stays."""

    def found(self) -> list[dict]:
        lines: dict[tuple, list[tuple]] = {}
        for c in super().found():
            lines.setdefault((c["tab"], c["row"]), []).append((c["col"], c["text"], c["href"] is not None, c["href"] or ""))
        out, told = [], set()
        for tab, row in sorted(lines):
            if not row or (tab, 0) not in lines:
                continue
            mine = sorted(lines[tab, row])
            fields: dict[str, str] = {}
            for (_, head, *_), (_, text, *_) in zip(sorted(lines[tab, 0]), mine, strict=False):
                fields.pop(head, None)  # it stands where its last one does
                fields[head] = text
            number = fields.get("Case Number", "").upper()
            if number and number not in told:
                told.add(number)
                out.append({"row": row, "fields": list(fields.items()), "href": next((href for _, _, there, href in mine if there), None)})
        return out


class Marks(HTMLParser):
    """p, span and title elements with their classes and those of the elements around them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.out = [], []

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            return
        cls = dict(attrs).get("class") or ""
        mark = None
        if tag in ("p", "span", "title"):
            mark = {"tag": tag, "cls": cls, "inside": " ".join(c for _, c, _ in self.open if c), "text": ""}
            self.out.append(mark)
        self.open.append((tag, cls, mark))

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                break

    def handle_data(self, data):
        for _, _, mark in self.open:
            if mark is not None:
                mark["text"] += data

    def found(self) -> list[dict]:
        for m in self.out:
            m["text"] = " ".join(m["text"].split())
        return self.out


class _Told(Exception):
    """What was asked for has been read."""


class Titles(Marks):
    """The first title only, as Marks has it; what follows it isn't read."""

    def handle_starttag(self, tag, attrs):
        if tag == "title" and not self.out:
            super().handle_starttag(tag, attrs)
        elif tag not in VOID:
            self.open.append((tag, "", None))

    def handle_endtag(self, tag):
        super().handle_endtag(tag)
        if self.out and not any(mark for *_, mark in self.open):
            raise _Told

    def feed(self, data):
        try:
            super().feed(data)
        except _Told:
            self.rawdata = ""  # nothing is left for close()


# A tag as most pages write them, or the text up to the next one.
PLAIN = re.compile(r'''<(/?)([A-Za-z][A-Za-z0-9]*)((?:[ \t\n\r\f]+[A-Za-z][A-Za-z0-9_-]*(?:="[^"<>]*")?)*)[ \t\n\r\f]*(/?)>|([^<]+)''')
ATTRIBUTE = re.compile(r'''([A-Za-z][A-Za-z0-9_-]*)(?:="([^"]*)")?''')
# Elements whose content isn't read as tags.
RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "noscript", "xmp", "plaintext"}


def _events(html: str) -> list[tuple] | None:
    """What the library's parser would tell of a page of plain tags only; None for any other page. Attributes without a value have an empty one."""
    if PLAIN.sub("", html):
        return None
    out = []
    for ends, tag, attrs, closed, data in PLAIN.findall(html):
        if data:
            out.append((None, unescape(data) if "&" in data else data, False))
            continue
        tag = tag.lower()
        if tag in RAW or (ends and (attrs or closed)):
            return None
        if ends:
            out.append((tag, None, False))
        else:
            out.append((tag, [(k.lower(), unescape(v) if "&" in v else v) for k, v in ATTRIBUTE.findall(attrs)] if attrs else [], bool(closed)))
    return out


def _parsed(parser, html: str | None) -> list[dict]:
    p = parser()
    events = None if parser is Titles else _events(html or "")
    if events is None:
        p.feed(html or "")
        p.close()
        return p.found()
    for tag, told, closed in events:
        if tag is None:
            p.handle_data(told)
        elif told is None:
            p.handle_endtag(tag)
        else:
            p.handle_starttag(tag, told)
            if closed:
                p.handle_endtag(tag)
    return p.found()


#: Pages parsed at once, so that what is found of few pages only is held as Python objects.
AT_ONCE = 256


def _listed(html: Column, parser, shape: str) -> Column:
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    kind = to_arrow_type(_parse_datatype_string(shape))
    fields = list(kind.value_type)

    def found(pages: list) -> pa.Array:
        lists = [_parsed(parser, h) for h in pages]
        rows = [x for one in lists for x in one]
        return pa.ListArray.from_arrays(pa.array([0, *accumulate(map(len, lists))], pa.int32()), pa.StructArray.from_arrays([pa.array([x[f.name] for x in rows], f.type) for f in fields], fields=fields), type=kind)

    @F.arrow_udf(shape)
    def run(pages: pa.Array) -> pa.Array:
        parts = [found(pages.slice(i, AT_ONCE).to_pylist()) for i in range(0, len(pages), AT_ONCE)]
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    return run(html)


def cells(html: Column) -> Column:
    return _listed(html, Cells, CELL)


def marks(html: Column) -> Column:
    return _listed(html, Marks, MARK)


def title(html: Column) -> Column:
    """Text of the first title; empty if there is none. Nothing else of a page comes back from Python."""
    return F.coalesce(F.get(_listed(html, Titles, "array<struct<text:string>>"), F.lit(0))["text"], F.lit(""))


def settled(rows: DataFrame, *columns: str) -> DataFrame:
    """rows whose given columns are computed once: an explode of one element keeps Catalyst from repeating them per use."""
    others = [c for c in rows.columns if c not in columns]
    return rows.select(*others, F.explode(F.array(F.struct(*columns))).alias("s")).select(*others, *[F.col("s")[c].alias(c) for c in columns])


def first(items: Column, cond) -> Column:
    return F.get(F.filter(items, cond), F.lit(0))


def labelled(own: Column) -> Column:
    """The value cell behind the label cell of the same row, as array of struct(label, cell)."""
    even = F.filter(own, lambda c: c["col"] % 2 == 0)
    pair = lambda c: F.struct(F.lower(F.regexp_replace(c["text"], "^[: ]+|[: ]+$", "")).alias("label"), first(own, lambda v: (v["tab"] == c["tab"]) & (v["row"] == c["row"]) & (v["col"] == c["col"] + 1)).alias("cell"))
    return F.filter(F.transform(even, pair), lambda x: (x["label"] != "") & x["cell"].isNotNull())


def value_of(pairs: Column, label: str) -> Column:
    """A label's cell; the last of repeated labels; null if absent."""
    return F.try_element_at(F.filter(pairs, lambda x: x["label"] == label.lower()), F.lit(-1))["cell"]


def filled(cell: str) -> Column:
    """Text of a cell; null if absent or empty."""
    return F.nullif(F.col(f"{cell}.text"), F.lit(""))


def case_details(pages: DataFrame, key: str) -> DataFrame:
    """Case status pages of the second court: key and fields, parties, advocates, acts. Pages without the table: no row."""
    listed = settled(pages.select(key, cells(F.col("html")).alias("cells")), "cells")
    own = settled(listed.select(key, F.filter("cells", lambda c: F.contains(c["key"], F.lit("case-details-table"))).alias("own")), "own")
    rows = settled(own.select(key, labelled(F.col("own")).alias("pairs")), "pairs").where("size(pairs) > 0")
    labels = {"number": "case no.", "status": "status", "disposal": "disp.type", "category": "category", "listed": "last listed on", "act": "act", "p": "petitioner(s)", "r": "respondent(s)", "pa": "petitioner advocate(s)", "ra": "respondent. advocate(s)"}
    rows = settled(rows.select(key, *[value_of(F.col("pairs"), label).alias(n) for n, label in labels.items()]), *labels)
    rows = settled(rows.select(key, *labels, t.parse_case_no_cell(filled("number")).alias("no"), F.transform("act.lines", t.parse_act_line).alias("acts"), *[F.transform(f"{c}.bold", t.parse_advocate_cell).alias(f"{c}_told") for c in ("pa", "ra")]), *labels, "no", "acts", "pa_told", "ra_told")
    there = lambda c: F.coalesce(F.array_compact(c), F.array())
    people = lambda cell: F.coalesce(F.transform(f"{cell}.groups", lambda g: F.struct(F.get(g, F.lit(0)).alias("name"), F.get(g, F.lit(1)).alias("relation"), F.get(g, F.lit(2)).alias("address"))), F.array())
    return rows.select(
        key, filled("number").alias("case_no_line"), "no.case_type_name", "no.case_type_code", "no.registered_on", "no.cnr",
        filled("status").alias("status_line"), filled("disposal").alias("disposition_type"), t.category_subject(filled("category")).alias("subject_category"), t.bracketed_judges(filled("listed")).alias("judges"),
        F.array_distinct(there("acts")).alias("acts"), people("p").alias("petitioners"), people("r").alias("respondents"), there("pa_told").alias("petitioner_advocates"), there("ra_told").alias("respondent_advocates"),
    )


CASE_LINE = r"^\s*([A-Za-z]+)/([A-Za-z]+)/(\d+)/(\d{4})\s*$"


def detail_pane(pages: DataFrame, key: str) -> DataFrame:
    """Detail cards of reported cases; cards without the case line: no row."""
    rows = settled(pages.select(key, marks(F.col("html")).alias("m"), F.regexp_replace("html", r"<[^>]*>", "\n").alias("plain")), "m", "plain")
    m, plain = F.col("m"), F.col("plain")
    line = first(m, lambda x: (x["tag"] == "p") & F.contains(x["inside"], F.lit("card-header")) & x["text"].rlike(CASE_LINE))["text"]
    texts = lambda cls, inside, tag: F.transform(F.filter(m, lambda x: (x["tag"] == tag) & F.contains(x["cls"], F.lit(cls)) & F.contains(x["inside"], F.lit(inside))), lambda x: x["text"])
    parties = texts("info-box-text", "card-body", "span")
    side = lambda role: F.filter(F.transform(parties, lambda x, i: F.when((i % 2 == 0) & F.contains(F.lower(F.get(parties, i + 1)), F.lit(role)), x)), lambda x: x.isNotNull())
    judges = F.filter(F.flatten(F.transform(texts("text-left", "card-header", "span"), lambda x: F.transform(F.split(x, r"(?=Mr\.\s+Justice\b|Ms\.\s+Justice\b)"), lambda n: F.trim(n)))), lambda n: n != "")
    said = lambda label: F.trim(t.group(plain, label + r"\s*([^\n]+)", 1))
    return rows.where(line.isNotNull()).select(
        key, *[F.regexp_extract(line, CASE_LINE, i + 1).alias(n) for i, n in enumerate(("bench", "case_type", "case_no", "registration_year"))],
        said("Neutral Citation\\s*-").alias("neutral_citation"), said("Published in\\s*-").alias("ilr_citation"), said("Decision date-").alias("decision_date"),
        F.concat(t.group(plain, r"\(\s*(Single|Division)\s+Bench\s*\)", 1), F.lit(" Bench")).alias("bench_type"), judges.alias("judges"), side("petitioner").alias("petitioners"), side("respondent").alias("respondents"),
        F.get(texts("info-box-text", "card-body", "p"), F.lit(0)).alias("headnote"),
    )


def status_page(pages: DataFrame, key: str) -> DataFrame:
    """Status pages of the third court: primary fields, category, and arrays of parties, applications and orders."""
    c = F.col("c")
    under = lambda title: F.filter(c, lambda x: F.upper(x["heading"]) == title)
    kept = {"primary": "PRIMARY DETAILS", "category_cells": "CATEGORY", "ia": "IA DETAILS", "order_cells": "ORDERS", "asking": "PETITIONER(S)", "asked": "RESPONDENT(S)"}
    rows = settled(pages.select(key, cells(F.col("html")).alias("c")), "c").where("size(c) > 0")
    rows = settled(rows.select(key, *[under(title).alias(n) for n, title in kept.items()]), *kept)
    rows = settled(rows.select(key, *kept, labelled(F.col("primary")).alias("p"), labelled(F.col("category_cells")).alias("q")), *kept, "p", "q")

    def table(own: str, names: tuple[str, ...], skip: int) -> Column:
        starts = F.filter(own, lambda x: (x["col"] == 0) & (x["row"] >= skip))
        at = lambda line, i: first(line, lambda x: x["col"] == i)
        made = F.transform(F.transform(starts, lambda s: F.filter(own, lambda x: x["row"] == s["row"])), lambda line: F.struct(*[at(line, i)["text"].alias(n) for i, n in enumerate(names)], at(line, len(names))["href"].alias("href")))
        return F.filter(made, lambda r: r[names[-1]].isNotNull())

    people = lambda own: F.transform(F.filter(own, lambda x: (x["col"] == 1) & (F.size(x["lines"]) > 0)), lambda x: F.struct(F.get(x["lines"], F.lit(0)).alias("name"), F.array_join(F.slice(x["lines"], 2, 100), " ").alias("details")))
    fields = {"main_number": "Main Number", "sr_number": "SR Number", "cnr_no": "CNR No.", "petitioner": "Petitioner", "respondent": "Respondent", "case_status": "Case Status", "filing_date": "Filing Date", "disposal_type": "Type"}
    told = settled(rows.select(key, *kept, *[value_of(F.col("p"), label).alias(n) for n, label in fields.items()], value_of(F.col("q"), "Category").alias("category")), *kept, *fields, "category")
    return told.select(
        key, *[filled(n).alias(n) for n in (*fields, "category")], people("asking").alias("petitioners"), people("asked").alias("respondents"),
        table("ia", ("ia_number", "filing_date", "advocate", "misc_type", "status", "prayer", "order_date"), 1).alias("applications"), table("order_cells", ("order_on", "judge_name", "date", "order_type"), 1).alias("orders"),
    )


def report_rows(pages: DataFrame, key: str) -> DataFrame:
    """Rows of report tables as maps from heading to text, with the link; rows without a case number go, of equal numbers the first stays."""
    return pages.select(key, F.explode(_listed(F.col("html"), Report, ROW)).alias("r")).select(key, "r.*")


def read_row(headers: Column, values: Column) -> Column:
    """Map from header to cell; of repeated headers the last counts."""
    entries = F.arrays_zip(headers.alias("k"), values.alias("v"))
    keep = F.filter(entries, lambda e, i: ~F.exists(F.slice(headers, i + 2, F.greatest(F.size(headers) - i - 1, F.lit(0))), lambda h: h == e["k"]))
    return F.map_from_arrays(F.transform(keep, lambda e: e["k"]), F.transform(keep, lambda e: e["v"]))


def json_case(raw: Column) -> Column:
    """struct(cnr, petitioner, orders): a case answer in JSON; null if it is no object."""
    shape = "primary struct<cnrno:string,petitioner:string>, orderdetails array<struct<judge:string,date:string>>"
    parsed = F.from_json(raw, shape)
    return F.when(F.startswith(F.trim(raw), F.lit("{")), F.struct(parsed["primary"]["cnrno"].alias("cnr"), parsed["primary"]["petitioner"].alias("petitioner"), F.coalesce(parsed["orderdetails"], F.array().cast("array<struct<judge:string,date:string>>")).alias("orders")))
