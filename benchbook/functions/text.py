"""Text functions as column expressions: each takes columns and returns a column; null in means empty unless said."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from benchbook.functions import persons
from benchbook.functions import vocabulary as v

R = F.regexp_replace


def full(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def group(c: Column, pattern: str, n: int) -> Column:
    """Group n of the first match; null if there is no match or the group is empty."""
    return F.nullif(F.regexp_extract(c, pattern, n), F.lit(""))


def let(value: Column, use) -> Column:
    """use(value) with value computed once, however often use refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def squeeze(c: Column) -> Column:
    return F.trim(R(c, r"\s+", " "))


def strip_chars(c: Column, chars: str) -> Column:
    return R(c, f"^[{chars}]+|[{chars}]+$", "")


def title(c: Column) -> Column:
    """Every run of letters begins with a capital, also behind dots and hyphens, unlike initcap."""
    return F.array_join(F.transform(F.split(c, r"(?<=[^\p{L}])(?=\p{L})"), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 100_000)))), "")


# --- parties, advocates, judges ---------------------------------------------------------------


def parse_party_names(raw: Column) -> Column:
    """struct(petitioner, respondent): split once at the separator; without one all is the petitioner."""
    text = F.nullif(F.trim(full(raw)), F.lit(""))
    parts = F.split(text, v.PARTY_SPLIT, 2)
    both = F.size(parts) == 2
    side = lambda n: F.nullif(strip_chars(F.get(parts, F.lit(n)), " ."), F.lit(""))
    return F.struct(F.when(both, side(0)).otherwise(text).alias("petitioner"), F.when(both, side(1)).alias("respondent"))


def parse_advocates(raw: Column) -> Column:
    """struct(petitioner_advocate, respondent_advocate): one name is the petitioner's, further ones are joined."""
    parts = F.filter(F.transform(F.split(F.trim(full(raw)), v.ADVOCATE_SPLIT), lambda p: strip_chars(p, r" \._")), lambda p: p != "")
    rest = F.array_join(F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))), " - ")
    return F.struct(F.get(parts, F.lit(0)).alias("petitioner_advocate"), F.nullif(rest, F.lit("")).alias("respondent_advocate"))


def clean_judge_name(raw: Column) -> Column:
    name = F.trim(R(full(raw), r"\[.*?\]|\(.*?\)", ""))
    name = persons.without(persons.without_ending(name, persons.JUDGE_ENDINGS), persons.JUDGE_TITLES)
    return F.upper(squeeze(strip_chars(name, persons.EDGES)))


def clean_advocate_name(raw: Column) -> Column:
    return F.upper(squeeze(strip_chars(persons.without(full(raw), persons.ADVOCATE_TITLES), persons.EDGES + "_")))


def clean_party_name(raw: Column) -> Column:
    return F.upper(squeeze(persons.before_tail(persons.without_lead(full(raw), persons.PARTY_LEADS), persons.PARTY_TAILS)))


def parse_bench(raw: Column) -> Column:
    """Judges' names in bench order; leftovers that are no names are dropped."""
    names = F.transform(F.split(F.trim(full(raw)), v.BENCH_SPLIT), clean_judge_name)
    return F.filter(names, lambda n: (F.length(n) > 3) & ~n.isin("THE", "AND"))


def bracketed_judges(cell: Column) -> Column:
    """Names inside the first brackets."""
    return F.filter(F.transform(F.split(F.regexp_extract(full(cell), r"\[(.+?)\]", 1), v.BENCH_SPLIT), clean_judge_name), lambda n: F.length(n) > 3)


def parse_advocate_cell(cell: Column) -> Column:
    """struct(name, role, enrollment_no, enrollment_year), null if the cell has another shape."""
    text = F.trim(cell)
    return F.when(
        text.rlike(v.ADVOCATE_CELL),
        F.struct(
            squeeze(F.regexp_extract(text, v.ADVOCATE_CELL, 1)).alias("name"), group(text, v.ADVOCATE_CELL, 2).alias("role"),
            F.regexp_extract(text, v.ADVOCATE_CELL, 3).alias("enrollment_no"), F.regexp_extract(text, v.ADVOCATE_CELL, 4).try_cast("int").alias("enrollment_year"),
        ),
    )


# --- cells, numbers, dates --------------------------------------------------------------------


def parse_judgment_cell(raw: Column) -> Column:
    """struct(decision_date_raw, neutral_citation_raw, language): the citation's label wins."""
    language = F.coalesce(group(raw, v.JUDGMENT_CITATION, 2), group(raw, v.JUDGMENT_DATE, 2))
    return F.struct(group(raw, v.JUDGMENT_DATE, 1).alias("decision_date_raw"), group(raw, v.JUDGMENT_CITATION, 1).alias("neutral_citation_raw"), title(language).alias("language"))


def filing_year(number: Column) -> Column:
    """Year of the first of three shapes, if it is from 1950 to 2100."""
    found = F.coalesce(*[group(number, v.FILING_YEAR, n) for n in (1, 2, 3)]).cast("int")
    return F.when(found.between(1950, 2100), found)


def classify_category(number: Column) -> Column:
    """struct(category_code, category_name) of the pattern that matches earliest, of equals the first listed."""
    hits = [F.when(F.regexp_instr(number, F.lit(f"(?i){p}")) > 0, F.struct(F.regexp_instr(number, F.lit(f"(?i){p}")).alias("at"), F.lit(i).alias("i"), F.lit(code).alias("category_code"), F.lit(name).alias("category_name"))) for i, (p, code, name) in enumerate(v.CATEGORIES)]
    best = F.array_min(F.array(*hits))
    return F.struct(best["category_code"].alias("category_code"), best["category_name"].alias("category_name"))


def split_arising_out_of(number: Column) -> Column:
    """struct(case_number, reference): the closing parenthesis goes, unless the number before it is blank."""
    reference = R(F.trim(group(number, v.ARISING, 1)), r"\.+$", "")
    rest = F.trim(R(number, v.ARISING, ""))
    return F.struct(F.when(number.rlike(v.ARISING) & rest.rlike(v.OWN_NUMBER), rest).otherwise(number).alias("case_number"), reference.alias("reference"))


def parse_date(raw: Column) -> Column:
    """The first of the known formats that fits, after ordinal endings and commas are gone."""
    text = F.trim(F.replace(R(raw, r"(?i)(\d{1,2})(st|nd|rd|th)", "$1"), F.lit(","), F.lit("")))
    shapes = [r"^\d{4}-\d{1,2}-\d{1,2}$", r"^\d{1,2}-\d{1,2}-\d{4}$", r"^\d{1,2}\.\d{1,2}\.\d{4}$", r"^\d{1,2}/\d{1,2}/\d{4}$", r"^\d{1,2}-[A-Za-z]{3}-\d{4}$", r"^\d{1,2} [A-Za-z]{4,} \d{4}$|^\d{1,2} May \d{4}$", r"^\d{1,2} [A-Za-z]{3} \d{4}$"]
    return F.coalesce(*[F.when(text.rlike(s), F.try_to_date(title(text), f)) for s, f in zip(shapes, v.DATE_FORMATS, strict=True)])


def normalize_case_type(raw: Column, digits: bool = False) -> Column:
    return F.upper(R(full(raw), "[^A-Za-z0-9]" if digits else "[^A-Za-z]", ""))


def normalize_case_no(raw: Column) -> Column:
    """Without leading zeros if it is a number, else as it is."""
    text = F.trim(full(raw))
    return F.when(text.rlike("^[0-9]+$"), F.regexp_replace(text, "^0+(?=[0-9])", "")).otherwise(text)


def case_label(bench: Column, kind: Column, number: Column, year: Column) -> Column:
    return F.concat(bench, F.lit("/"), kind, F.lit("/"), number, F.lit("/"), year.cast("string"))


def parse_case_no_cell(cell: Column) -> Column:
    """struct(case_type_name, case_type_code, case_no, year, registered_on, cnr)."""
    names = ("case_type_name", "case_type_code", "case_no", "year", "registered_on", "cnr")
    return F.struct(*[F.trim(group(cell, v.CASE_NO_CELL, i + 1)).alias(n) for i, n in enumerate(names)])


def category_subject(cell: Column) -> Column:
    return F.trim(group(cell, v.CATEGORY_SUBJECT, 1))


def parse_act_line(line: Column) -> Column:
    """struct(act_code, act_name, sections), null if the line has another shape."""
    parts = F.filter(F.transform(F.split(F.regexp_extract(line, v.ACT_LINE, 3), "[/,]"), lambda s: F.trim(s)), lambda s: s != "")
    return F.when(line.rlike(v.ACT_LINE), F.struct(F.regexp_extract(line, v.ACT_LINE, 1).alias("act_code"), F.trim(F.regexp_extract(line, v.ACT_LINE, 2)).alias("act_name"), parts.alias("sections")))


TS_NUMBER = r"(?i)([A-Z][A-Z.\s()]*?)[\s\-]*(?:No\.?\s*)?(\d+)\s*(?:/|of)\s*(\d{4})"


def case_number_parts(raw: Column) -> Column:
    """struct(case_type, case_no, year, case_number) of `TYPE NO/YEAR` in any spelling; nulls if there is none."""
    kind, number, year = normalize_case_type(group(raw, TS_NUMBER, 1), digits=True), normalize_case_no(group(raw, TS_NUMBER, 2)), group(raw, TS_NUMBER, 3)
    hit = year.isNotNull()
    return F.struct(F.when(hit, kind).alias("case_type"), F.when(hit, number).alias("case_no"), year.alias("year"), F.when(hit, F.concat(kind, F.lit(" "), number, F.lit("/"), year)).alias("case_number"))


def date_windows(start: Column, end: Column, days: int = 30) -> Column:
    """array of struct(from_date, to_date): consecutive windows of at most so many days."""
    firsts = F.when(start <= end, F.sequence(start, end, F.expr(f"interval {days} day")))
    return F.transform(F.coalesce(firsts, F.array().cast("array<date>")), lambda d: F.struct(d.alias("from_date"), F.least(F.date_add(d, days - 1), end).alias("to_date")))


def year_from_range(start: Column, end: Column) -> Column:
    """The year of both ends, null if they differ; require_one_year() raises instead."""
    return F.when(F.year(start) == F.year(end), F.year(start))


def require_one_year(start: Column, end: Column) -> Column:
    return F.coalesce(year_from_range(start, end), F.raise_error("both dates must be in one year").cast("int"))


def validate_enum(value: Column, allowed: list[str]) -> Column:
    return F.when(value.isin(*allowed), value)


def item_key(*parts: Column) -> Column:
    """The first part that is neither null nor empty."""
    return F.coalesce(*[F.nullif(p, F.lit("")) for p in parts])


def duration_format(seconds: Column) -> Column:
    """`1h 5m`, `5m 7s` or `7s`."""
    s = seconds.cast("int")
    h, m = F.floor(s / 3600).cast("int"), F.floor(F.pmod(s, F.lit(3600)) / 60).cast("int")
    return F.when(h > 0, F.format_string("%dh %dm", h, m)).when(m > 0, F.format_string("%dm %ds", m, F.pmod(s, F.lit(60)))).otherwise(F.format_string("%ds", s))


# --- closed lists -----------------------------------------------------------------------------


def _listed(items: list[str]) -> Column:
    return F.array(*[F.lit(x) for x in items])


def find_ministry(party: Column, names: list[str] = v.MINISTRIES) -> Column:
    """The first listed ministry whose name the party's name contains."""
    low = F.lower(full(party))
    return F.get(F.filter(_listed(names), lambda n: F.contains(low, F.lower(n))), F.lit(0))


def resolve_listed(raw: Column, names: list[str]) -> Column:
    """The listed name that equals the text without regard to case and blanks around it; else null."""
    low = F.lower(F.trim(raw))
    return F.get(F.filter(_listed(names), lambda n: F.lower(n) == low), F.lit(0))


def _act_aliases() -> Column:
    """struct(alias, name, code, year) in the order in which they are tried."""
    seen: dict[str, tuple] = {}
    for name, code, year, aliases in v.ACTS:
        for alias in (name, code, *aliases):
            seen[alias.lower().strip()] = (name, code, year)
    return F.array(*[F.struct(F.lit(a).alias("alias"), F.lit(n).alias("name"), F.lit(c).alias("code"), F.lit(y).alias("year")) for a, (n, c, y) in seen.items()])


def resolve_act(raw: Column) -> Column:
    """struct(act_name, short_code, act_year): exact alias, else the first alias that contains the name or is in it, else title case."""
    aliases = _act_aliases()

    def found(x: Column) -> Column:
        own = F.when(F.length(x["cleaned"]) > 2, title(x["cleaned"])).otherwise("Special Act")
        name = F.when(x["text"] == "", "Unknown Act").otherwise(F.coalesce(x["hit"]["name"], own))
        return F.struct(name.alias("act_name"), F.when(x["text"] != "", x["hit"]["code"]).alias("short_code"), F.when(x["text"] != "", x["hit"]["year"]).alias("act_year"))

    def looked_up(x: Column) -> Column:
        exact = F.get(F.filter(aliases, lambda a: a["alias"] == x["key"]), F.lit(0))
        near = F.get(F.filter(aliases, lambda a: F.contains(x["key"], a["alias"]) | F.contains(a["alias"], x["key"])), F.lit(0))
        return F.struct(x["text"].alias("text"), x["cleaned"].alias("cleaned"), F.coalesce(exact, near).alias("hit"))

    text = F.trim(full(raw))
    cleaned = F.trim(R(text, r"(?i)^(?:of\s+the|of|under|with|in)\s+", ""))
    start = let(F.struct(text.alias("text"), cleaned.alias("cleaned")), lambda x: F.struct(x["text"].alias("text"), x["cleaned"].alias("cleaned"), F.lower(x["cleaned"]).alias("key")))
    return let(let(start, looked_up), found)


# --- judgments --------------------------------------------------------------------------------


def has_overruled_keyword(text: Column) -> Column:
    return full(text).rlike(v.OVERRULED)


def page_count_check(text: Column, pages: Column) -> Column:
    """Null without a page mark; false if the marks disagree; else whether they equal the page count."""
    totals = F.array_distinct(F.regexp_extract_all(full(text), F.lit(v.PAGE_MARK), 2))
    return F.when(F.size(totals) == 1, F.get(totals, F.lit(0)).cast("int") == pages).when(F.size(totals) > 1, False)


def subject_from_jurisdiction(text: Column) -> Column:
    """The word before JURISDICTION in the first 1000 characters, or before the kind of jurisdiction that stands there."""
    words = F.transform(F.split(F.upper(F.substring(text, 1, 1000)), r"\s+"), lambda w: R(w, r"^[^A-Z]+|[^A-Z]+$", ""))

    def subject(before: Column) -> Column:
        back = lambda n: F.get(before, F.size(before) - n)
        passed = F.when((back(1) == "ORIGINAL") & (back(2) == "ORDINARY"), 2).when(back(1).isin(*v.JURISDICTIONS), 1).otherwise(0)
        return let(passed, lambda n: F.coalesce(back(n + 1), back(n)))

    found = let(words, lambda w: let(F.slice(w, 1, F.greatest(F.array_position(w, "JURISDICTION").cast("int") - 1, F.lit(0))), subject))
    return title(F.nullif(found, F.lit("")))


def _is_title(line: Column, titles: list[str], colon: bool = True) -> Column:
    return F.upper(R(line, r"\s+|:\s*$" if colon else r"\s+", "")).isin(*[F.lit(t.replace(" ", "")) for t in titles])


def after_title(text: Column, titles: list[str], first: int = 1, colon: bool = True) -> Column:
    """What follows the first line, from line `first` on, that is one of the titles but for blanks (letters may be spaced)
    and a colon at its end; null if there is none."""

    def rest(lines: Column) -> Column:
        place = F.array_position(F.transform(lines, lambda line, i: (i >= first - 1) & _is_title(line, titles, colon)), F.lit(True)).cast("int")
        return let(place, lambda at: F.when(at > 0, F.array_join(F.slice(lines, at + 1, F.size(lines)), "\n")))

    return let(F.split(text, "\n"), rest)


def before_match(text: Column, pattern: str) -> Column:
    """What stands before the first match; all of the text if there is none."""
    return F.get(F.split(text, pattern, 2), F.lit(0))


def judgment_body(text: Column) -> Column:
    """What follows the body's title; the first line, the court's name, is none."""
    return F.nullif(R(after_title(text, v.BODY_TITLES, 2, colon=False), r"^\s+|\s+$", ""), F.lit(""))


def section_after(text: Column, titles: list[str], most: int = 3000) -> Column:
    """Text of a section up to the next heading, at most so many characters."""
    rest = F.substring(R(after_title(text, titles), r"^\s*\n", ""), 1, most)
    return F.nullif(squeeze(before_match(rest, v.SECTION_STOP)), F.lit(""))


def strip_ocr_noise(text: Column) -> Column:
    out = full(text)
    for pattern in (v.SIGNATURE_BLOCK, v.DOT_LEADER, v.PAGE_LINE):
        out = R(out, pattern, "")
    return R(R(R(out, r"[ \t]{2,}", " "), r"\n{3,}", "\n\n"), r"^\s+|\s+$", "")


def split_paragraphs(text: Column) -> Column:
    """array of struct(number, text): paragraphs numbered 1, 2, 3 and so on; fewer than three give none.

    Numbers that don't continue the run are part of the paragraph that they stand in.
    """
    numbers = F.regexp_extract_all(full(text), F.lit(v.PARAGRAPH), 1)
    marks = F.regexp_extract_all(full(text), F.lit(v.PARAGRAPH), 0)
    pieces = F.slice(F.split(full(text), v.PARAGRAPH), 2, F.greatest(F.size(numbers), F.lit(1)))

    def step(at: Column, x: Column) -> Column:
        return F.when(x["numbers"].cast("int") == F.size(at) + 1, F.concat(at, F.array(x["i"]))).otherwise(at)

    def cut(parts: Column) -> Column:
        # The fold keeps places only; each text is joined once, from its slice.
        places = F.aggregate(parts, F.array().cast("array<int>"), step)
        return let(places, lambda at: F.transform(at, lambda a, k: joined(parts, a, F.coalesce(F.get(at, k + 1), F.size(parts) + 1), k)))

    def joined(parts: Column, a: Column, b: Column, k: Column) -> Column:
        rest = F.array_join(F.transform(F.slice(parts, a + 1, b - a - 1), lambda x: F.concat(x["marks"], x["pieces"])), "")
        return F.struct((k + 1).alias("number"), F.concat(F.element_at(parts, a)["pieces"], rest).alias("text"))

    zipped = F.arrays_zip(numbers.alias("numbers"), marks.alias("marks"), pieces.alias("pieces"))
    found = let(F.transform(zipped, lambda x, i: F.struct(x["numbers"].alias("numbers"), x["marks"].alias("marks"), x["pieces"].alias("pieces"), (i + 1).alias("i"))), cut)
    return let(found, _numbered)


def _numbered(found: Column) -> Column:
    kind = "array<struct<number:int,text:string>>"
    trimmed = F.filter(F.transform(found, lambda p: F.struct(p["number"].alias("number"), R(p["text"], r"^\s+|\s+$", "").alias("text"))), lambda p: p["text"] != "")
    return F.when(F.size(found) >= 3, trimmed).otherwise(F.array().cast(kind))


def split_sentences(text: Column) -> Column:
    """Sentences: a full stop before a capital or the end closes one, unless an abbreviation stands before it."""
    short = _listed(v.ABBREVIATIONS)
    # Whether a fragment goes on shows in its own last word, so the ends are found first and each sentence is joined once.
    goes_on = lambda f: F.array_contains(short, F.lower(F.regexp_extract(f, r"([A-Za-z']+)\s*$", 1)))
    marked = F.transform(F.split(full(text), v.SENTENCE_END), lambda f: F.struct(F.rtrim(f).alias("f"), goes_on(f).alias("on")))

    def joined(parts: Column, a: Column, n: Column) -> Column:
        return F.trim(F.array_join(F.transform(F.slice(parts, a, n), lambda p: p["f"]), ". "))

    def cut(parts: Column) -> Column:
        ends = F.filter(F.sequence(F.lit(1), F.size(parts)), lambda i: ~F.element_at(parts, i)["on"])
        return let(ends, lambda e: sentences(parts, e))

    def sentences(parts: Column, ends: Column) -> Column:
        before = lambda k: F.when(k > 0, F.get(ends, k - 1)).otherwise(0)
        done = F.transform(ends, lambda e, k: F.concat(joined(parts, before(k) + 1, e - before(k)), F.lit(".")))
        last = before(F.size(ends))
        return F.concat(done, F.array(joined(parts, last + 1, F.size(parts) - last)))

    return F.filter(let(marked, cut), lambda s: ~s.isin("", "."))


def extract_provisions(text: Column, most: int = 30) -> Column:
    """array of struct(act_name, short_code, act_year, section_number): distinct references that name their act."""
    numbers, acts = (F.regexp_extract_all(full(text), F.lit(v.PROVISION), n) for n in (2, 3))
    named = F.filter(F.arrays_zip(numbers.alias("number"), F.transform(acts, squeeze).alias("act")), lambda x: (x["act"] != "") & ~persons.is_pointer(x["act"]))

    def entry(x: Column) -> Column:
        return let(resolve_act(x["act"]), lambda act: F.struct(act["act_name"].alias("act_name"), act["short_code"].alias("short_code"), act["act_year"].alias("act_year"), F.trim(x["number"]).alias("section_number")))

    return F.slice(F.array_distinct(F.transform(named, entry)), 1, most)


def connected_matters(text: Column) -> Column:
    """Distinct matters (by number and year) of the cause title: the first 8000 characters up to the body's heading."""
    lines = F.split(F.substring(full(text), 1, 8000), "\n")
    body = lambda rows: F.array_position(F.transform(rows, lambda line: _is_title(line, v.BODY_TITLES, colon=False)), F.lit(True)).cast("int")
    head = let(lines, lambda rows: let(body(rows), lambda at: F.array_join(F.when(at > 0, F.slice(rows, 1, at - 1)).otherwise(rows), "\n")))
    whole, number, year = (F.regexp_extract_all(head, F.lit(v.MATTER), n) for n in (0, 1, 2))
    found = F.transform(F.arrays_zip(whole.alias("w"), number.alias("n"), year.alias("y")), lambda x: F.struct(F.concat_ws("|", x["n"], x["y"]).alias("key"), squeeze(x["w"]).alias("matter")))
    keys = F.transform(found, lambda x: x["key"])
    return F.transform(F.filter(found, lambda x, i: F.array_position(keys, x["key"]) == i + 1), lambda x: x["matter"])


def build_excerpt(text: Column, whole: int = 60_000, head: int = 6_000, tail: int = 24_000) -> Column:
    """struct(excerpt, mode): short texts as they are; of long ones the start and the end, from the last operative
    heading of the second half on."""
    clean = strip_ocr_noise(text)
    n = F.length(clean)
    half = F.substring(clean, F.ceil(n / 2).cast("int") + 1, n)
    after = F.element_at(F.split(F.regexp_replace(half, v.OPERATIVE, "\u0001$0"), "\u0001"), -1)
    found = F.regexp_instr(half, F.lit(v.OPERATIVE)) > 0
    end = F.substring(F.when(found, after).otherwise(F.right(clean, F.lit(tail))), 1, tail)
    parts = F.concat(F.substring(clean, 1, head), F.lit("\n[... middle of judgment omitted ...]\n"), end)
    return F.struct(F.when(n <= whole, clean).otherwise(parts).alias("excerpt"), F.when(n <= whole, "full").otherwise("long").alias("mode"))


def llm_json(raw: Column, schema: str) -> Column:
    """The outermost braces of an answer, fences or not, as a struct; null if there are none or they aren't JSON."""
    return F.from_json(group(raw, r"(?s)(\{.*\})", 1), schema)


def prompt(hints: Column, excerpt: Column, block: Column, most: int = 40_000) -> Column:
    return F.concat_ws("\n\n", hints, excerpt, F.nullif(F.substring(full(block), 1, most), F.lit("")))


def describe(fields: dict[str, tuple[Column, Column]]) -> Column:
    """`Filled: a, b. Kept existing: c. Not found: d.`: per field its value before and the one that came in."""
    names = lambda cond: F.array_join(F.filter(F.array(*[F.when(cond(old, new), F.lit(n)) for n, (old, new) in fields.items()]), lambda x: x.isNotNull()), ", ")
    lines = [("Filled: ", names(lambda o, n: o.isNull() & n.isNotNull())), ("Kept existing: ", names(lambda o, n: o.isNotNull())), ("Not found: ", names(lambda o, n: o.isNull() & n.isNull()))]
    return F.concat_ws(" ", *[F.when(x != "", F.concat(F.lit(head), x, F.lit("."))) for head, x in lines])


def any_of(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, columns)


LEAST_LAYER = 20


def layer_route(layer: Column) -> Column:
    """text_layer where a file's own text has at least 20 characters besides outer blanks, else ocr."""
    return F.when(F.length(F.trim(F.coalesce(layer, F.lit("")))) < LEAST_LAYER, "ocr").otherwise("text_layer")
