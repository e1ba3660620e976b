"""Queries of the text functions, over cells and judgments derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchbook.functions import outcomes, persons, sections, spans, text
from benchbook.functions import vocabulary as v
from benchbook.operators import entities
from benchbook.plans.registry import query
from benchbook.sources.domain import CTES, Domain


def scalar(name: str, raw: str, make, out: str, extra: str = "") -> None:
    """raw: an expression over cases that both dialects read; make: raw -> column or struct; out: SQL columns over x(case_id, raw, ...)."""

    def run(d: Domain) -> DataFrame:
        rows = d.cases().select("case_id", F.expr(raw).alias("raw"), *[F.expr(e) for e in extra.split(";") if e])
        done = rows.select("case_id", make(F.col("raw")).alias("result"))
        kind = done.schema["result"].dataType.typeName()
        return done.select("case_id", "result.*") if kind == "struct" else done

    columns = "".join(f", {e}" for e in extra.split(";") if e)
    query(name, f"SELECT case_id, {out} FROM (SELECT case_id, {raw} raw{columns} FROM cases) x")(run)


def rx(group: str) -> str:
    return group.replace("'", "''")


def first(raw: str, pattern: str, n: int) -> str:
    return f"nullif(regexp_extract({raw}, '{rx(pattern)}', {n}), '')"


SEP = f"regexp_extract(raw, '{v.PARTY_SPLIT}')"
scalar(
    "parse_party_names", "petitioner || (CASE case_id % 4 WHEN 0 THEN ' Vs ' WHEN 1 THEN ' versus ' WHEN 2 THEN '  vs.  ' ELSE ' and ' END) || respondent || ' . '", text.parse_party_names,
    f"CASE WHEN {SEP} <> '' THEN nullif(trim(substr(trim(raw), 1, strpos(trim(raw), {SEP}) - 1), ' .'), '') ELSE trim(raw) END petitioner, CASE WHEN {SEP} <> '' THEN nullif(trim(substr(trim(raw), strpos(trim(raw), {SEP}) + length({SEP})), ' .'), '') END respondent",
)
PARTS = "list_filter(list_transform(regexp_split_to_array(trim(raw), '\\s*-\\s*|_+'), lambda p: trim(p, ' ._')), lambda p: p <> '')"
scalar(
    "parse_advocates", "CASE case_id % 5 WHEN 0 THEN '__' WHEN 1 THEN petitioner || '__' WHEN 2 THEN petitioner || ' __ ' || respondent WHEN 3 THEN petitioner || ' - ' || respondent || ' - ' || party_raw ELSE party_raw END", text.parse_advocates,
    f"({PARTS})[1] petitioner_advocate, nullif(array_to_string(({PARTS})[2:], ' - '), '') respondent_advocate",
)
scalar(
    "parse_judgment_cell", "CASE case_id % 4 WHEN 0 THEN '06-01-2026(English) 2026 INSC ' || case_id || '(Hindi)' WHEN 1 THEN '6/1/2026 (ENGLISH)' WHEN 2 THEN coalesce(neutral_citation, '') || '(tamil)' ELSE 'none' END", text.parse_judgment_cell,
    f"{first('raw', v.JUDGMENT_DATE, 1)} decision_date_raw, {first('raw', v.JUDGMENT_CITATION, 1)} neutral_citation_raw, "
    + (lambda l: f"upper(substr({l}, 1, 1)) || lower(substr({l}, 2)) \"language\"")(f"coalesce({first('raw', v.JUDGMENT_CITATION, 2)}, {first('raw', v.JUDGMENT_DATE, 2)})"),
)


def worded(listed: list[persons.Phrase]) -> str:
    """Phrases as alternatives of a pattern, longer ones first."""
    return "|".join("[.\\s]+".join(p) for p in sorted(listed, key=len, reverse=True)).replace("'", "''")


def bounded(c: str, edges: str = "") -> str:
    return f"upper(trim(regexp_replace(regexp_replace({c}, '^[{persons.EDGES}{edges}]+|[{persons.EDGES}{edges}]+$', '', 'g'), '\\s+', ' ', 'g')))"


def judge_named(c: str) -> str:
    endings = "|".join(e.replace(".", "\\.") for e in persons.JUDGE_ENDINGS)
    plain = f"trim(regexp_replace({c}, '\\[.*?\\]|\\(.*?\\)', '', 'g'))"
    return bounded(f"regexp_replace(regexp_replace({plain}, '(?i)[,\\s]+({endings})$', ''), '(?i)\\b({worded(persons.JUDGE_TITLES)})\\b', '', 'g')")


scalar(
    "clean_judge_name", "(CASE case_id % 4 WHEN 0 THEN 'HON''BLE MR. JUSTICE ' WHEN 1 THEN 'Smt. ' WHEN 2 THEN 'Dr. Justice (Retd) ' ELSE '' END) || replace(petitioner, '#', ' K.  ') || (CASE case_id % 3 WHEN 0 THEN ', J.' WHEN 1 THEN ' [presiding]' ELSE ' JJ.' END)", text.clean_judge_name,
    judge_named("raw") + " \"result\"",
)
scalar(
    "clean_advocate_name", "(CASE case_id % 3 WHEN 0 THEN 'Mr. ' WHEN 1 THEN '_ ' ELSE '' END) || petitioner || (CASE case_id % 4 WHEN 0 THEN ', Sr. Adv.' WHEN 1 THEN ' (AOR)' WHEN 2 THEN ' senior advocate' ELSE '' END)", text.clean_advocate_name,
    bounded(f"regexp_replace(raw, '(?i)\\b({worded(persons.ADVOCATE_TITLES)})\\b', '', 'g')", "_") + " \"result\"",
)
scalar(
    "clean_party_name", "(CASE case_id % 3 WHEN 0 THEN 'In the matter of ' WHEN 1 THEN 'between: ' ELSE '' END) || petitioner || (CASE case_id % 4 WHEN 0 THEN ' through its Secretary' WHEN 1 THEN ' represented by x' ELSE '  and  Co' END)", text.clean_party_name,
    f"upper(trim(regexp_replace(regexp_replace(regexp_replace(raw, '(?i)^({worded(persons.PARTY_LEADS)}):?', ''), '(?i)\\b({worded(persons.PARTY_TAILS)})\\b.*', ''), '\\s+', ' ', 'g'))) \"result\"",
)
scalar(
    "filing_year", "case_number", text.filing_year,
    "CASE WHEN y BETWEEN 1950 AND 2100 THEN y END \"result\"".replace("y", f"CAST(coalesce({', '.join(first('raw', v.FILING_YEAR, n) for n in (1, 2, 3))}) AS INTEGER)"),
)
AT = ", ".join(f"CASE WHEN regexp_matches(raw, '(?i){rx(p)}') THEN {{{{'at': length(regexp_extract(raw, '(?is)^(.*?)(?:{rx(p)})', 1)), 'i': {i}, 'code': '{c}', 'name': '{n}'}}}} END".replace("{{", "{").replace("}}", "}") for i, (p, c, n) in enumerate(v.CATEGORIES))
scalar(
    "classify_category", "CASE case_id % 5 WHEN 0 THEN 'Civil Appeal 7 (Arising out of SLP (C) No. ' || case_id || ')' WHEN 1 THEN 'W.P.(Crl) ' || case_id WHEN 2 THEN 'Cont. Pet. in ' || case_number ELSE case_number END", text.classify_category,
    f"list_sort(list_filter([{AT}], lambda h: h IS NOT NULL))[1].code category_code, list_sort(list_filter([{AT}], lambda h: h IS NOT NULL))[1].name category_name",
)
REST = f"trim(regexp_replace(raw, '{v.ARISING}', ''))"
scalar(
    "split_arising_out_of", "CASE case_id % 3 WHEN 0 THEN 'Civil Appeal No. ' || case_id || ' of 2026 (Arising out of SLP (C) No. 5 of 2025.)' WHEN 1 THEN 'Civil Appeal No. ___ of 2026 (arisen from: ' || case_number || ')' ELSE case_number END", text.split_arising_out_of,
    f"CASE WHEN regexp_matches(raw, '{v.ARISING}') AND regexp_matches({REST}, '{v.OWN_NUMBER}') THEN {REST} ELSE raw END case_number, regexp_replace(trim({first('raw', v.ARISING, 1)}), '\\.+$', '') reference",
)
DATES = ["%Y-%m-%d", "%d-%m-%Y", "%d.%m.%Y", "%d/%m/%Y", "%d-%b-%Y", "%d %B %Y", "%d %b %Y"]
scalar(
    "parse_date", "CASE case_id % 8 WHEN 0 THEN CAST(judgment_date AS VARCHAR(10)) WHEN 1 THEN '06-01-2026' WHEN 2 THEN '6.1.2026' WHEN 3 THEN '31/12/1999' WHEN 4 THEN '7-Mar-2001' WHEN 5 THEN '21st March, 2004' WHEN 6 THEN '3rd feb 2010' ELSE 'on 5 May 2001' END", text.parse_date,
    "CAST(coalesce(" + ", ".join(f"try_strptime(replace(regexp_replace(raw, '(?i)(\\d{{1,2}})(st|nd|rd|th)', '\\1', 'g'), ',', ''), '{f}')" for f in DATES) + ") AS DATE) \"result\"",
)
scalar("find_ministry", "petitioner || (CASE case_id % 5 WHEN 0 THEN ', Ministry of Railways and MINISTRY OF FINANCE' WHEN 1 THEN ' Reserve bank of India' ELSE '' END)", text.find_ministry, "CASE case_id % 5 WHEN 0 THEN 'Ministry of Finance' WHEN 1 THEN 'Reserve Bank of India' END \"result\"")
scalar("resolve_ministry", "CASE case_id % 3 WHEN 0 THEN ' ministry of COAL ' WHEN 1 THEN 'Coal' END", lambda c: text.resolve_listed(c, v.MINISTRIES), "CASE WHEN lower(trim(raw)) = 'ministry of coal' THEN 'Ministry of Coal' END \"result\"")
scalar("resolve_industry", "CASE case_id % 4 WHEN 0 THEN 'fmcg' WHEN 1 THEN 'Banks ' WHEN 2 THEN 'Banking' END", lambda c: text.resolve_listed(c, v.INDUSTRIES), "CASE lower(trim(raw)) WHEN 'fmcg' THEN 'FMCG' WHEN 'banks' THEN 'Banks' END \"result\"")
scalar("has_overruled_keyword", "CASE case_id % 4 WHEN 0 THEN 'stands Overruled' WHEN 1 THEN 'unoverruled' WHEN 2 THEN 'no  longer good law' END", text.has_overruled_keyword, f"regexp_matches(coalesce(raw, ''), '{v.OVERRULED}') \"result\"")
scalar("normalize_case_type", "case_number", text.normalize_case_type, "upper(regexp_replace(raw, '[^A-Za-z]', '', 'g')) \"result\"")
scalar("normalize_case_no", "CASE case_id % 3 WHEN 0 THEN ' 000' || case_id || ' ' WHEN 1 THEN '0' || case_id || 'A' ELSE '000' END", text.normalize_case_no, "CASE WHEN regexp_matches(trim(raw), '^[0-9]+$') THEN CAST(CAST(trim(raw) AS BIGINT) AS VARCHAR) ELSE trim(raw) END \"result\"")
scalar(
    "parse_advocate_cell", "CASE case_id % 3 WHEN 0 THEN petitioner || '[P-1] [' || case_id || '/1996]' WHEN 1 THEN ' Advocate  General [77 / 2014] ' ELSE petitioner END", text.parse_advocate_cell,
    "trim(regexp_replace({0}, '\\s+', ' ', 'g')) \"name\", {1} \"role\", {2} enrollment_no, CAST({3} AS INTEGER) enrollment_year".format(*[first("trim(raw)", v.ADVOCATE_CELL, n) for n in (1, 2, 3, 4)]),
)
scalar(
    "parse_act_line", "CASE case_id % 3 WHEN 0 THEN '231 - Code of Criminal Procedure (Section - 374(2)/' || case_id || ', 5)' WHEN 1 THEN 'A1 - Some Act (Section - 7)' ELSE case_number END",
    lambda c: F.struct(text.parse_act_line(c)["act_code"].alias("act_code"), text.parse_act_line(c)["act_name"].alias("act_name"), F.array_join(text.parse_act_line(c)["sections"], ";").alias("sections")),
    f"{first('raw', v.ACT_LINE, 1)} act_code, trim({first('raw', v.ACT_LINE, 2)}) act_name, CASE WHEN regexp_matches(raw, '{v.ACT_LINE}') THEN array_to_string(list_filter(list_transform(regexp_split_to_array(regexp_extract(raw, '{v.ACT_LINE}', 3), '[/,]'), lambda s: trim(s)), lambda s: s <> ''), ';') END sections",
)
scalar(
    "case_no_cell", "CASE case_id % 3 WHEN 0 THEN 'CRIMINAL APPEAL (CRA) ' || case_id || '/2024 Registered On 30-05-2024 CNR: MP' || case_id WHEN 1 THEN 'WRIT PETITION (WP) ' || case_id || ' / 2018' ELSE case_number END", text.parse_case_no_cell,
    ", ".join(f"trim({first('raw', v.CASE_NO_CELL, n)}) {name}" for n, name in ((1, "case_type_name"), (2, "case_type_code"), (3, "case_no"), (4, "\"year\""), (5, "registered_on"), (6, "cnr"))),
)
scalar("category_subject", "CASE case_id % 2 WHEN 0 THEN 'CRIMINAL LAW & PROCEDURE-12100 Code-12102' ELSE case_number END", text.category_subject, f"trim({first('raw', v.CATEGORY_SUBJECT, 1)}) \"result\"")
scalar("bracketed_judges", "'10-11-2025 [ HON''BLE SHRI JUSTICE ' || replace(petitioner, '#', ' ') || ' ]'", lambda c: F.array_join(text.bracketed_judges(c), ";"), "upper(replace(regexp_extract(raw, 'JUSTICE (.+?) \\]', 1), '#', ' ')) \"result\"")
scalar("case_label", "CASE WHEN case_id % 7 = 0 THEN NULL ELSE 'WP' END", lambda c: text.case_label(F.lit("Jabalpur"), c, F.col("case_id").cast("string"), F.lit(2018)), "'Jabalpur/' || raw || '/' || case_id || '/2018' \"result\"")
TS = [first("raw", text.TS_NUMBER, n) for n in (1, 2, 3)]
TS_PARTS = [f"upper(regexp_replace({TS[0]}, '[^A-Za-z0-9]', '', 'g'))", f"CAST(CAST({TS[1]} AS BIGINT) AS VARCHAR)"]
scalar(
    "extract_case_number_ts", "CASE case_id % 3 WHEN 0 THEN 'W.P. No. 00' || case_id || ' of 2019' WHEN 1 THEN 'crl.a-' || case_id || '/2020' ELSE 'no number' END", text.case_number_parts,
    f"{TS_PARTS[0]} case_type, {TS_PARTS[1]} case_no, {TS[2]} \"year\", {TS_PARTS[0]} || ' ' || {TS_PARTS[1]} || '/' || {TS[2]} case_number",
)
scalar("validate_enum", "CASE case_id % 3 WHEN 0 THEN disposition WHEN 1 THEN 'Partly allowed' ELSE 'Partly Allowed' END", lambda c: text.validate_enum(c, v.DISPOSITIONS), "CASE WHEN raw IN ('Allowed', 'Dismissed', 'Partly Allowed') THEN raw END \"result\"")
scalar("item_key", "neutral_citation", lambda c: text.item_key(c, F.when(F.col("case_id") % 2 == 0, ""), F.concat(F.lit("url-"), F.col("case_id").cast("string"))), "coalesce(raw, 'url-' || case_id) \"result\"")
scalar("duration_format", "case_id * 37 % 9000", lambda c: text.duration_format(c), "CASE WHEN raw >= 3600 THEN (raw // 3600) || 'h ' || (raw % 3600 // 60) || 'm' WHEN raw >= 60 THEN (raw // 60) || 'm ' || (raw % 60) || 's' ELSE raw || 's' END \"result\"")
scalar(
    "page_count_check", "CASE case_id % 4 WHEN 0 THEN 'Page 1 of 3 ... page 2 of 3' WHEN 1 THEN 'Page 1 of 3 Page 2 of 4' WHEN 2 THEN 'Page 1 of ' || (case_id % 9) END", lambda c: text.page_count_check(c, F.lit(3)),
    f"CASE WHEN len(list_distinct(regexp_extract_all(coalesce(raw, ''), '{v.PAGE_MARK}', 2))) = 1 THEN regexp_extract(raw, '{v.PAGE_MARK}', 2) = '3' WHEN len(list_distinct(regexp_extract_all(coalesce(raw, ''), '{v.PAGE_MARK}', 2))) > 1 THEN false END \"result\"",
)
scalar("year_from_range", "judgment_date", lambda c: text.year_from_range(c, F.date_add(c, 100)), "CASE WHEN year(raw) = year(raw + 100) THEN CAST(year(raw) AS INTEGER) END \"result\"")
scalar("year_required", "judgment_date", lambda c: F.when(c.isNotNull(), text.require_one_year(c, F.least(F.date_add(c, 100), F.last_day(F.add_months(F.trunc(c, "year"), 11))))), "CAST(year(raw) AS INTEGER) \"result\"")


@query(
    "date_windows",
    "SELECT case_id, CAST(from_date AS DATE) from_date, CAST(least(from_date + INTERVAL 29 DAY, last_date) AS DATE) to_date FROM (SELECT case_id, judgment_date + CAST(case_id % 100 AS INTEGER) last_date, unnest(generate_series(judgment_date, judgment_date + CAST(case_id % 100 AS INTEGER), INTERVAL 30 DAY)) from_date FROM cases WHERE judgment_date IS NOT NULL) x",
)
def date_windows(d: Domain) -> DataFrame:
    rows = d.cases().where("judgment_date is not null").withColumn("last", F.date_add("judgment_date", (F.col("case_id") % 100).cast("int")))
    return rows.select("case_id", F.explode(text.date_windows(F.col("judgment_date"), F.col("last"))).alias("w")).select("case_id", "w.*")


@query("content_checksum", "SELECT doc_id, sha256(text) checksum FROM documents")
def content_checksum(d: Domain) -> DataFrame:
    return d.raw("documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("checksum"))


@query("acts_sections_group", "SELECT case_id, act_name, string_agg(section_number, ';' ORDER BY section_id) sections FROM (SELECT case_id, act_name, section_number, min(section_id) section_id FROM case_sections JOIN sections USING (section_id) JOIN acts USING (act_id) GROUP BY ALL) x GROUP BY case_id, act_name")
def acts_sections_group(d: Domain) -> DataFrame:
    pairs = d.lines().join(F.broadcast(d.acts()), "act_id")
    return entities.sections_by_act(pairs.select("case_id", "act_name", "section_number", F.col("section_id").alias("place"))).select("case_id", "act_name", F.array_join("sections", ";").alias("sections"))


def judgments(d: Domain) -> DataFrame:
    """Judgment texts made of cases and their documents: title, heading, numbered paragraphs with provisions, an outcome, a footer."""
    k = F.col("case_id")
    pick = lambda *xs: F.element_at(F.array(*[F.lit(x) for x in xs]), (k % len(xs)).cast("int") + 1)
    lead = F.concat(
        F.lit("IN THE SUPREME COURT OF INDIA\n"), pick("CIVIL", "CRIMINAL", "CIVIL"), F.lit(" APPELLATE JURISDICTION\n"), F.lit("CIVIL APPEAL NO. "), k.cast("string"), F.lit(" OF 2024\nSLP (CRL.) NO. 13988/2025\n"),
        pick("\nJ U D G M E N T\n", "\nORDER\n", "\n"), F.lit("FACTS OF THE CASE:\nThe suit was filed. "),
    )
    body = F.concat(
        F.lit("\n1. "), F.regexp_replace(F.col("text"), "\n", " "), F.lit(" See (2024) 1 SCC 234 and 2023 INSC "), k.cast("string"), F.lit(".\n2. "),
        pick("Under Section 302 of the Indian Penal Code and article 21 of the Constitution the claim fails.", "Section 138 of the NI Act, and rule 5 of the said Rules apply."), pick("\n7\n3. ", "\nCONCLUSION:\n3. "),
        pick("The appeal is, accordingly, allowed. Pending applications, if any, stand disposed of.", "The High Court allowed the revision. The petition in SLP (CIVIL) NO. 6 is dismissed.", "List the matter for hearing.", "We allow this appeal partly."),
        F.lit("\nDigitally signed by\nA B\nSignature Not Verified\nConclusion .......... 42\n"),
    )
    return d.cases(text=True).where("text is not null").select("case_id", F.concat(lead, body).alias("text"))


# The same texts in SQL.
def picked(*xs: str) -> str:
    return "[" + ", ".join("'" + x.replace("'", "''").replace("\n", "' || chr(10) || '") + "'" for x in xs) + f"][CAST(case_id % {len(xs)} AS INTEGER) + 1]"


CTES["judgments"] = f"""SELECT case_id, {picked("IN THE SUPREME COURT OF INDIA\n")} || {picked("CIVIL", "CRIMINAL", "CIVIL")} || {picked(" APPELLATE JURISDICTION\nCIVIL APPEAL NO. ")} || case_id || {picked(" OF 2024\nSLP (CRL.) NO. 13988/2025\n")} ||
    {picked("\nJ U D G M E N T\n", "\nORDER\n", "\n")} || {picked("FACTS OF THE CASE:\nThe suit was filed. ")} || {picked("\n1. ")} || replace(text, chr(10), ' ') || ' See (2024) 1 SCC 234 and 2023 INSC ' || case_id || {picked(".\n2. ")} ||
    {picked("Under Section 302 of the Indian Penal Code and article 21 of the Constitution the claim fails.", "Section 138 of the NI Act, and rule 5 of the said Rules apply.")} || {picked("\n7\n3. ", "\nCONCLUSION:\n3. ")} ||
    {picked("The appeal is, accordingly, allowed. Pending applications, if any, stand disposed of.", "The High Court allowed the revision. The petition in SLP (CIVIL) NO. 6 is dismissed.", "List the matter for hearing.", "We allow this appeal partly.")} ||
    {picked("\nDigitally signed by\nA B\nSignature Not Verified\nConclusion .......... 42\n")} AS text FROM cases JOIN documents ON doc_id = case_id WHERE text IS NOT NULL"""


def of_judgments(name: str, make, sql: str | None = None) -> None:
    """make: text -> a value, a struct or an array of structs; structs become columns, their arrays rows. sql: over judgments."""

    def run(d: Domain) -> DataFrame:
        done = judgments(d).select("case_id", make(F.col("text")).alias("result"))
        if sql and done.schema["result"].dataType.typeName() == "array":
            done = done.select("case_id", F.explode("result").alias("result"))
        return done.select("case_id", "result.*") if done.schema["result"].dataType.typeName() == "struct" else done

    query(name, sql)(run)


def of_spans(name: str, make, *patterns: str) -> None:
    """As of_judgments, for functions of the text and the places of pattern matches in it."""

    def run(d: Domain) -> DataFrame:
        found = judgments(d).withColumn("spans", spans.match_spans(F.col("text"), *patterns))
        return found.select("case_id", make(F.col("text"), F.col("spans")).alias("result"))

    query(name)(run)


def squeezed(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def bare(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def titled(x: str) -> str:
    """Capitals at the start of each run of letters."""
    parts = f"string_split(regexp_replace({x}, '([^\\p{{L}}])(\\p{{L}})', '\\1' || chr(1) || '\\2', 'g'), chr(1))"
    return f"array_to_string(list_transform({parts}, lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), '')"


def title_places(lines: str, titles: list[str], colon: str = "|:\\s*$", first: int = 1) -> str:
    listed = ", ".join(f"'{t.replace(' ', '')}'" for t in titles)
    return f"list_position(list_transform({lines}, lambda line, i: i >= {first} AND upper(regexp_replace(line, '\\s+{colon}', '', 'g')) IN ({listed})), true)"


def behind(titles: list[str], colon: str = "|:\\s*$", first: int = 1) -> str:
    lines = "string_split(text, chr(10))"
    place = title_places(lines, titles, colon, first)
    return f"CASE WHEN {place} > 0 THEN array_to_string({lines}[{place} + 1:], chr(10)) END"


def section(titles: list[str]) -> str:
    rest, stop = f"substr(regexp_replace({behind(titles)}, '^\\s*\\n', ''), 1, 3000)", rx(v.SECTION_STOP)
    cut = f"CASE WHEN regexp_matches({rest}, '{stop}') THEN regexp_extract({rest}, '(?s)^(.*?)(?:{stop})', 1) ELSE {rest} END"
    return f"SELECT case_id, nullif({squeezed(cut)}, '') \"result\" FROM judgments"


# Numbered marks become chr(1) mark chr(2) number chr(3); a mark belongs to the run if it has the run's next number.
PARAGRAPHS = f"""WITH RECURSIVE p AS (SELECT case_id, string_split(regexp_replace(text, '{rx(v.PARAGRAPH)}', chr(1) || '\\0' || chr(2) || '\\1' || chr(3), 'g'), chr(1)) parts FROM judgments),
u AS (SELECT case_id, i, parts[i] part FROM (SELECT case_id, parts, unnest(generate_series(2, len(parts))) i FROM p) x),
m AS (SELECT case_id, i, split_part(part, chr(2), 1) mark, CAST(split_part(split_part(part, chr(2), 2), chr(3), 1) AS INTEGER) n, split_part(part, chr(3), 2) piece FROM u),
r AS (SELECT case_id, 1 n, min(i) i FROM m WHERE n = 1 GROUP BY case_id UNION ALL SELECT r.case_id, r.n + 1, min(m.i) FROM r JOIN m ON m.case_id = r.case_id AND m.n = r.n + 1 AND m.i > r.i GROUP BY r.case_id, r.n),
o AS (SELECT *, coalesce(lead(i) OVER (PARTITION BY case_id ORDER BY n), 1000000000) upto, count(*) OVER (PARTITION BY case_id) runs FROM r),
t AS (SELECT o.case_id, o.n "number", {bare("string_agg(CASE WHEN m.i = o.i THEN piece ELSE mark || piece END, '' ORDER BY m.i)")} "text" FROM o JOIN m ON m.case_id = o.case_id AND m.i >= o.i AND m.i < o.upto WHERE runs >= 3 GROUP BY o.case_id, o.n)
SELECT * FROM t WHERE "text" <> ''"""
# Fragments end before chr(1); those that end with an abbreviation go on in the next one.
SHORT = ", ".join(f"'{rx(a)}'" for a in v.ABBREVIATIONS)
SENTENCES = f"""WITH f AS (SELECT case_id, string_split(regexp_replace(text, '\\.(\\s+(?:\\d{{1,3}}\\s+)?[A-Z]|\\s*$)', chr(1) || '\\1', 'g'), chr(1)) parts FROM judgments),
u AS (SELECT case_id, i, rtrim(parts[i]) f FROM (SELECT case_id, parts, unnest(generate_series(1, len(parts))) i FROM f) x),
w AS (SELECT *, lower(regexp_extract(f, '([A-Za-z'']+)\\s*$', 1)) IN ({SHORT}) goes_on FROM u),
g AS (SELECT *, coalesce(sum(CASE WHEN goes_on THEN 0 ELSE 1 END) OVER (PARTITION BY case_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) k FROM w),
j AS (SELECT case_id, k, trim(string_agg(f, '. ' ORDER BY i)) || CASE WHEN bool_or(NOT goes_on) THEN '.' ELSE '' END sentence FROM g GROUP BY case_id, k)
SELECT case_id, CAST(row_number() OVER (PARTITION BY case_id ORDER BY k) AS INTEGER) place, sentence FROM j WHERE sentence NOT IN ('', '.')"""
TIDY = "text"
for noise in (v.SIGNATURE_BLOCK, v.DOT_LEADER, v.PAGE_LINE):
    TIDY = f"regexp_replace({TIDY}, '{rx(noise)}', '', 'g')"
TIDY = bare(f"regexp_replace(regexp_replace({TIDY}, '[ \\t]{{2,}}', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g')")
EXCERPT = f"""WITH c AS (SELECT case_id, {TIDY} x FROM judgments), h AS (SELECT *, substr(x, CAST(ceil(length(x) / 2) AS INTEGER) + 1) half FROM c),
e AS (SELECT *, CASE WHEN regexp_matches(half, '{rx(v.OPERATIVE)}') THEN string_split(regexp_replace(half, '{rx(v.OPERATIVE)}', chr(1) || '\\0', 'g'), chr(1))[-1] ELSE "right"(x, 24000) END ending FROM h)
SELECT case_id, CASE WHEN length(x) <= 60000 THEN x ELSE substr(x, 1, 6000) || chr(10) || '[... middle of judgment omitted ...]' || chr(10) || substr(ending, 1, 24000) END excerpt, CASE WHEN length(x) <= 60000 THEN 'full' ELSE 'long' END "mode" FROM e"""
TOP = "string_split(substr(text, 1, 8000), chr(10))"
AT_BODY = title_places(TOP, v.BODY_TITLES, "")
HEAD = f"array_to_string(CASE WHEN {AT_BODY} > 0 THEN {TOP}[:{AT_BODY} - 1] ELSE {TOP} END, chr(10))"
FOUND = ", ".join(f"regexp_extract_all({HEAD}, '{rx(v.MATTER)}', {n})" for n in (0, 1, 2))
MATTERS = f"""WITH x AS (SELECT case_id, list_transform(list_zip({FOUND}), lambda z: {{'matter': {squeezed("z[1]")}, 'key': z[2] || '|' || z[3]}}) found FROM judgments)
SELECT case_id, array_to_string(list_transform(list_filter(found, lambda f, i: list_position(list_transform(found, lambda g: g.key), f.key) = i), lambda f: f.matter), ';') "result" FROM x"""
ALIASES = {alias.lower().strip(): (name, code, year) for name, code, year, aliases in v.ACTS for alias in (name, code, *aliases)}
ALIAS_ROWS = ", ".join(f"({i}, '{rx(a)}', '{rx(n)}', '{c}', {y})" for i, (a, (n, c, y)) in enumerate(ALIASES.items()))


def acts_of(rows: str, keys: str) -> str:
    """rows and further CTEs up to resolved(raw, act_name, short_code, act_year): the distinct acts that the CTE keys names."""
    return f"""{rows}, alias(i, alias, "name", code, "year") AS (VALUES {ALIAS_ROWS}),
raws AS (SELECT raw, trim(regexp_replace(trim(raw), '(?i)^(?:of\\s+the|of|under|with|in)\\s+', '')) cleaned FROM (SELECT DISTINCT raw FROM {keys}) x),
hits AS (SELECT raw, arg_min({{'n': "name", 'c': code, 'y': "year"}}, i + CASE WHEN alias = lower(cleaned) THEN 0 ELSE 1000 END) hit FROM raws JOIN alias ON contains(lower(cleaned), alias) OR contains(alias, lower(cleaned)) WHERE trim(raw) <> '' GROUP BY raw),
resolved AS (SELECT raws.raw, CASE WHEN trim(raws.raw) = '' THEN 'Unknown Act' ELSE coalesce(hit.n, CASE WHEN length(cleaned) > 2 THEN {titled("cleaned")} ELSE 'Special Act' END) END act_name, hit.c short_code, hit.y act_year FROM raws LEFT JOIN hits ON hits.raw = raws.raw)"""


NUMBERS, ACT_NAMES = (f"regexp_extract_all(text, '{rx(v.PROVISION)}', {n})" for n in (2, 3))
NOUNS, POINTERS = (", ".join(f"'{w}'" for w in listed) for listed in (persons.ACT_NOUNS, persons.ACT_POINTERS))
ACT_WORDS = f"string_split_regex(lower(regexp_replace({squeezed('act')}, '\\.$', '')), '[\\s\\-]+')"
POINTER = f"({ACT_WORDS}[-1] IN ({NOUNS}) AND len(list_filter({ACT_WORDS}[:-2], lambda w: w NOT IN ({POINTERS}))) = 0)"
NAMED = f"""z AS (SELECT case_id, unnest(n) section_number, unnest(a) act, unnest(range(len(n))) i FROM (SELECT case_id, {NUMBERS} n, {ACT_NAMES} a FROM judgments) x),
named AS (SELECT case_id, trim(section_number) section_number, {squeezed("act")} raw, i FROM z WHERE {squeezed("act")} <> '' AND NOT {POINTER})"""
PROVISIONS = f"""WITH {acts_of(NAMED, "named")}, firsts AS (SELECT case_id, act_name, short_code, act_year, section_number, min(i) i FROM named JOIN resolved USING (raw) GROUP BY ALL)
SELECT case_id, act_name, short_code, act_year, section_number FROM firsts QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY i) <= 30"""
BEFORE = "substr(upper(substr(text, 1, 1000)), 1, strpos(upper(substr(text, 1, 1000)), 'JURISDICTION') - 1)"
SUBJECT = f"regexp_extract(regexp_replace(trim({BEFORE}), ' (APPELLATE|APPEAL|ORDINARY ORIGINAL|ORIGINAL|EXTRAORDINARY)$', ''), '([A-Z]+)$', 1)"

of_judgments("subject_from_jurisdiction", text.subject_from_jurisdiction, f"SELECT case_id, {titled(SUBJECT)} \"result\" FROM judgments")
of_judgments("judgment_body", text.judgment_body, f"SELECT case_id, nullif({bare(behind(v.BODY_TITLES, "", 2))}, '') \"result\" FROM judgments")
of_judgments("extract_provisions", text.extract_provisions, PROVISIONS)
of_spans("provision_paragraphs", spans.provision_paragraphs, v.PROVISION)
of_judgments("disposition", outcomes.disposition)
of_judgments("split_sentences", lambda c: F.transform(text.split_sentences(c), lambda s, i: F.struct((i + 1).alias("place"), s.alias("sentence"))), SENTENCES)
of_judgments("facts", lambda c: text.section_after(c, v.FACTS_HEADING), section(v.FACTS_HEADING))
of_judgments("conclusion", lambda c: text.section_after(c, v.CONCLUSION_HEADING), section(v.CONCLUSION_HEADING))
of_judgments("split_paragraphs", text.split_paragraphs, PARAGRAPHS)
of_judgments("strip_ocr_noise", text.strip_ocr_noise, f"SELECT case_id, {TIDY} \"result\" FROM judgments")
of_spans("artifact_spans", lambda c, s: spans.artifact_spans(s), *spans.ARTIFACTS.values())
of_judgments("build_excerpt", text.build_excerpt, EXCERPT)
of_judgments("connected_matters", lambda c: F.array_join(text.connected_matters(c), ";"), MATTERS)
of_spans("citation_candidates", spans.citation_candidates, *spans.CITATIONS)

scalar(
    "parse_bench", "'HON''BLE MRS. JUSTICE ' || replace(petitioner, '#', ' K. ') || ' HON''BLE MR. JUSTICE ' || respondent || (CASE case_id % 3 WHEN 0 THEN ', J. [presiding]' WHEN 1 THEN ' and' ELSE '' END) || ' HON''BLE THE CHIEF JUSTICE'", lambda c: F.array_join(text.parse_bench(c), ";"),
    f"array_to_string(list_filter(list_transform(string_split(regexp_replace(trim(raw), '(?i)(HON''?BLE)', chr(1) || '\\1', 'g'), chr(1)), lambda j: {judge_named("j")}), lambda n: length(n) > 3), ';') \"result\"",
)
ACT_CELL = "CASE case_id % 5 WHEN 0 THEN 'of the Indian Penal Code' WHEN 1 THEN 'the code of civil procedure' WHEN 2 THEN 'u.p. land act ' || case_id WHEN 3 THEN ' ' ELSE 'under ' || petitioner || ' Motor Vehicles Act' END"


@query("resolve_act", f"WITH {acts_of(f'cells AS (SELECT case_id, {ACT_CELL} raw FROM cases)', 'cells')} SELECT case_id, act_name, short_code, act_year FROM cells JOIN resolved USING (raw)")
def resolve_act(d: Domain) -> DataFrame:
    return d.cases().select("case_id", text.resolve_act(F.expr(ACT_CELL)).alias("act")).select("case_id", "act.*")


scalar(
    "section_numbers", "'Section ' || (case_id % 400) || '/34 r/w ' || (case_id % 90) || '(2)(r) and (s) of BNS'", lambda c: F.array_join(sections.section_numbers(c), ";"),
    "regexp_replace(raw, '^Section (\\d+)/(\\d+) r/w (\\d+)(\\(\\d\\))(\\(r\\)) and (\\(s\\)) of BNS$', '\\1;\\2;\\3\\4\\5;\\3\\4\\6') \"result\"",
)
BRACED = "regexp_extract(raw, '(?s)(\\{.*\\})', 1)"
ANSWER = f"CASE WHEN json_valid({BRACED}) THEN {BRACED} END"
scalar(
    "llm_json_parse", "CASE case_id % 4 WHEN 0 THEN 'no answer' WHEN 1 THEN '{\"case_note\": broken' ELSE '```json {\"case_note\": \"' || petitioner || '\", \"year\": ' || (case_id % 9) || '} ```' END", lambda c: text.llm_json(c, "case_note string, year int"),
    f"json_extract_string({ANSWER}, '$.case_note') case_note, CAST(json_extract_string({ANSWER}, '$.year') AS INTEGER) \"year\"",
)
query("llm_prompt_build", "SELECT case_id, concat_ws(chr(10) || chr(10), petitioner, respondent, nullif(substr(case_number, 1, 40000), '')) \"result\" FROM cases")(
    lambda d: d.cases().select("case_id", text.prompt(F.col("petitioner"), F.col("respondent"), F.col("case_number")).alias("result"))
)


def told(head: str, **fields: str) -> str:
    names = ", ".join(f"CASE WHEN {when} THEN '{name}' END" for name, when in fields.items())
    return f"'{head}: ' || nullif(concat_ws(', ', {names}), '') || '.'"


FILLED = told("Filled", citation="neutral_citation IS NOT NULL", favouring_party="favouring_party IS NOT NULL")
MISSED = told("Not found", citation="neutral_citation IS NULL", disposition="disposition IS NULL", favouring_party="favouring_party IS NULL")


@query("enrichment_describe", f"SELECT case_id, concat_ws(' ', {FILLED}, {told('Kept existing', disposition='disposition IS NOT NULL')}, {MISSED}) \"result\" FROM cases")
def enrichment_describe(d: Domain) -> DataFrame:
    none, col = F.lit(None).cast("string"), F.col
    said = text.describe({"citation": (none, col("neutral_citation")), "disposition": (col("disposition"), col("disposition")), "favouring_party": (none, col("favouring_party"))})
    return d.cases().select("case_id", said.alias("result"))


@query("ner_postprocess")
def ner_postprocess(d: Domain) -> DataFrame:
    found = judgments(d).select("case_id", F.posexplode(text.split_sentences(F.col("text"))).alias("sentence", "text"))
    return entities.paired_provisions(entities.entity_spans(found))


# A recogniser's spans, as lines of cases would give them: parties with slips, citations, mentions without parties, and (supra).
SLIP = "CASE WHEN {n} % 2 = 0 THEN substr({t}, 2) ELSE {t} END"
CITE = "' (1999) ' || (l_partkey % 3) || ' SCC ' || (l_partkey % 4)"
SPANS = f"""SELECT DISTINCT l_orderkey case_id, 'PRECEDENT' label, CAST(l_linenumber * 1000 + l_partkey % 500 AS INTEGER) "start", CAST(l_linenumber * 1000 + l_partkey % 500 + 40 AS INTEGER) "end",
CASE WHEN l_partkey % 5 = 0 THEN 'In' ELSE {SLIP.format(n='l_partkey', t='s_name')} || ' v. ' || {SLIP.format(n='l_linenumber', t='p_name')} END || CASE WHEN l_partkey % 5 = 0 OR l_partkey % 4 = 1 THEN {CITE} ELSE '' END "text"
FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey"""


def recognised(d: Domain) -> DataFrame:
    slip = lambda n, t: F.when(F.col(n) % 2 == 0, F.substring(t, 2, 1000)).otherwise(F.col(t))
    part = F.col("l_partkey")
    lines = d.raw("lineitem").join(d.raw("part").select("p_partkey", "p_name"), F.col("p_partkey") == part).join(d.raw("supplier").select("s_suppkey", "s_name"), F.col("s_suppkey") == F.col("l_suppkey"))
    cite = F.concat(F.lit(" (1999) "), (part % 3).cast("string"), F.lit(" SCC "), (part % 4).cast("string"))
    named = F.when(part % 5 == 0, "In").otherwise(F.concat(slip("l_partkey", "s_name"), F.lit(" v. "), slip("l_linenumber", "p_name")))
    start = (F.col("l_linenumber") * 1000 + part % 500).cast("int")
    return lines.select(
        F.col("l_orderkey").alias("case_id"), F.lit("PRECEDENT").alias("label"), start.alias("start"), (start + 40).alias("end"), F.concat(named, F.when((part % 5 == 0) | (part % 4 == 1), cite).otherwise("")).alias("text"), "l_linenumber", "p_name"
    ).distinct()


CLUSTERS = rf"""m AS (SELECT *, regexp_extract("text", '[(\[]?\d+[)\]]?(?:\s*[(\[]?\d+[)\]]?)?\s*[A-Z][A-Z.]*(?:\s*[(\[]?\d+[)\]]?)*') c FROM ({SPANS}) s),
n AS (SELECT case_id, "start", "text", nullif(c, '') c, CASE WHEN "text" LIKE '% v. %' THEN trim(split_part("text", ' v. ', 1)) END p,
CASE WHEN "text" LIKE '% v. %' THEN trim(CASE WHEN c = '' THEN split_part("text", ' v. ', 2) ELSE split_part(split_part("text", ' v. ', 2), c, 1) END) END r FROM m),
reach AS (SELECT case_id, "start" s, "text" t, "start" s0, "text" t0 FROM n UNION SELECT reach.case_id, s, t, b."start", b."text" FROM reach JOIN n a ON a.case_id = reach.case_id AND a."start" = s0 AND a."text" = t0 JOIN n b ON b.case_id = a.case_id
AND (a."text" = b."text" OR (a.p IS NOT NULL AND b.p IS NOT NULL AND levenshtein(lower(a.p), lower(b.p)) < 5 AND levenshtein(lower(a.r), lower(b.r)) < 5) OR ((a.p IS NULL OR b.p IS NULL) AND a.c = b.c))),
clusters AS (SELECT case_id, s "start", t "text", min(s0) "cluster" FROM reach GROUP BY ALL)"""


@query("precedent_clusters", f"WITH RECURSIVE {CLUSTERS} SELECT * FROM clusters")
def precedent_clusters(d: Domain) -> DataFrame:
    return entities.precedent_clusters(recognised(d).drop("l_linenumber", "p_name").distinct())


@query("supra_matches", f"""WITH RECURSIVE {CLUSTERS}, q AS (SELECT DISTINCT l_orderkey case_id, CAST(l_linenumber * 1000 + 900 AS INTEGER) "start", '  ' || upper(p_name) || ' (Supra)' "text", p_name part FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_linenumber > 1)
SELECT q.case_id, q."start", q."text", max_by(c."text", (c."start", c."text")) precedent, max_by("cluster", (c."start", c."text")) "cluster" FROM q JOIN clusters c ON c.case_id = q.case_id AND c."start" <= q."start" + 8 AND contains(lower(replace(c."text", ' ', '')), replace(lower(part), ' ', '')) GROUP BY ALL""")
def supra_matches(d: Domain) -> DataFrame:
    found = recognised(d)
    start = (F.col("l_linenumber") * 1000 + 900).cast("int")
    supra = found.where("l_linenumber > 1").select("case_id", F.lit("SUPRA").alias("label"), start.alias("start"), (start + 8).alias("end"), F.concat(F.lit("  "), F.upper("p_name"), F.lit(" (Supra)")).alias("text")).distinct()
    return entities.supra_matches(found.drop("l_linenumber", "p_name").distinct().unionByName(supra))


LAYER = r"regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')"


@query("pdf_text_layer", f"SELECT page_id, length(trim({LAYER})) n_chars, CASE WHEN length(trim({LAYER})) < 20 THEN 'ocr' ELSE 'text_layer' END route FROM pages UNION ALL SELECT -1 - doc_id, length(trim(coalesce(\"text\", ''), ' ')), CASE WHEN length(trim(coalesce(\"text\", ''), ' ')) < 20 THEN 'ocr' ELSE 'text_layer' END FROM documents")
def pdf_text_layer(d: Domain) -> DataFrame:
    """A file's whole text layer tells its way: pages without their marks, and documents (ids below zero) as they are."""
    pages = d.raw("pages").select("page_id", F.regexp_replace(F.regexp_replace("html", "<[^>]*>", " "), r"[ \t\n\f\r]+", " ").alias("layer"))
    files = pages.union(d.raw("documents").select(-1 - F.col("doc_id"), "text"))
    return files.select("page_id", F.length(F.trim(F.coalesce("layer", F.lit("")))).cast("long").alias("n_chars"), text.layer_route(F.col("layer")).alias("route"))
