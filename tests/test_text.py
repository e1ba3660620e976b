"""Text functions on hand-made cases."""

import datetime
import time

import pytest
from pyspark.sql import functions as F

from benchbook.functions import outcomes, persons, sections, spans, text
from benchbook.functions import vocabulary as v
from benchbook.functions.lexers import PORTABLE, English, match_all, match_phrase
from benchbook.functions.stemmer import stem
from benchbook.operators import entities


def plain(x):
    if hasattr(x, "asDict"):
        return tuple(plain(i) for i in x)
    return [plain(i) for i in x] if isinstance(x, list) else x


def apply(spark, make, *values):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(values)], "i int, x string")
    return [plain(r["y"]) for r in df.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()]


def test_parties_and_advocates(spark):
    assert apply(spark, text.parse_party_names, "A. Vs State of B .", "A versus B vs C", "only", "", None, " Vs x") == [("A", "State of B"), ("A", "B vs C"), ("only", None), (None, None), (None, None), ("Vs x", None)]
    assert apply(spark, text.parse_advocates, "A B__", "__", "A - B - C", None, "A __ B") == [("A B", None), (None, None), ("A", "B - C"), (None, None), ("A", "B")]
    assert apply(spark, text.clean_party_name, "In the matter of  x  y represented by z", None) == ["X Y", ""]
    assert apply(spark, text.clean_advocate_name, "Mr. A B, Sr. Adv.", "_ c (AOR)") == ["A B", "C"]


def test_judges(spark):
    assert apply(spark, text.clean_judge_name, "HON'BLE MR. JUSTICE A B, J.", "Smt. C (Retd) [x]", "", None) == ["A B", "C", "", ""]
    assert apply(spark, text.parse_bench, "HON'BLE MRS. JUSTICE A BCD HON'BLE THE CHIEF JUSTICE HONBLE MR. X YZ", None) == [["A BCD", "X YZ"], []]
    assert apply(spark, text.bracketed_judges, "10-11-2025 [ HON'BLE SHRI JUSTICE A BCD ]", "none") == [["A BCD"], []]


def test_titles_go_by_their_place(spark):
    judges = {"Dr.B Smt. Kumar, JJ.": "B . KUMAR", "X CHIEF  JUSTICE": "X", "CHIEF A.K. Sikri": "CHIEF A.K. SIKRI", "X, J. PRESIDING": "X, J", "J.": "J", "Mrs.Justice-A": "A", "JUSTICEX": "JUSTICEX", "PRESIDING": "PRESIDING"}
    assert apply(spark, text.clean_judge_name, *judges) == list(judges.values())
    advocates = {"Sr.Adv A, Amicus Curiae": "A", "Sr. K Advocates": "SR. K ADVOCATES", "A (AOR) and B Senior  Advocate": "A () AND B", "_": ""}
    assert apply(spark, text.clean_advocate_name, *advocates) == list(advocates.values())
    parties = {"between: A @ B": "A @ B", "X@Y": "X", "IN THE MATTER A": "IN THE MATTER A", "In  the matter of: A": ": A", "The Secretary, A": "THE", "Secretaryship of A": "SECRETARYSHIP OF A", "A Auth. Signatory B": "A", "": ""}
    assert apply(spark, text.clean_party_name, *parties) == list(parties.values())
    acts = {"the said Act": True, "above-said Rules.": True, "Act": True, "NI Act": False, "the said": False, "": False}
    assert apply(spark, persons.is_pointer, *acts) == list(acts.values())


def test_judgment_cell_and_dates(spark):
    got = apply(spark, text.parse_judgment_cell, "06-01-2026(english) 2026 INSC 15(HINDI)", "06-01-2026(English)", "x", None)
    assert got == [("06-01-2026", "2026 INSC 15", "Hindi"), ("06-01-2026", None, "English"), (None, None, None), (None, None, None)]
    day = datetime.date
    got = apply(spark, text.parse_date, "2020-1-5", "5-1-2020", "5.1.2020", "5/1/2020", "5-jan-2020", "5th January, 2020", "1st MAY 2020", "31-02-2020", "soon", None)
    assert got == [day(2020, 1, 5)] * 6 + [day(2020, 5, 1), None, None, None]


def test_case_numbers(spark):
    assert apply(spark, text.filing_year, "x of 2020", "x/1949", "x - 2001 ", "1 of 1800/2000", None) == [2020, None, 2001, None, None]
    got = apply(spark, text.classify_category, "Civil Appeal 1 (Arising out of SLP (C) No. 2)", "C.A. No. 5 @ SLP(C) No. 3", "W.P.(Crl) 3", "none", None)
    assert got == [("C.A.", "Civil Appeal"), ("C.A.", "Civil Appeal"), ("W.P.(CRL)", "Writ Petition (Criminal)"), (None, None), (None, None)]
    got = apply(spark, text.split_arising_out_of, "Civil Appeal No. 5 of 2020 (Arising out of: SLP 3.)", "Civil Appeal No. __ of 2026 (arisen from SLP 3)", "C.A. 1", None)
    assert got == [("Civil Appeal No. 5 of 2020", "SLP 3"), ("Civil Appeal No. __ of 2026 (arisen from SLP 3)", "SLP 3"), ("C.A. 1", None), (None, None)]
    assert apply(spark, text.normalize_case_no, " 0012 ", "000", "0A", None) == ["12", "0", "0A", ""]
    assert apply(spark, text.case_number_parts, "W.P. No. 007 of 2019", "nothing") == [("WP", "7", "2019", "WP 7/2019"), (None, None, None, None)]
    assert apply(spark, lambda c: text.duration_format(c.cast("int")), "5", "65", "3700") == ["5s", "1m 5s", "1h 1m"]


def test_acts(spark):
    got = apply(spark, text.resolve_act, "of the IPC", "the code of civil procedure", "u.p. land act", "xy", " ", None)
    assert got == [
        ("Indian Penal Code, 1860", "IPC", 1860), ("Code of Criminal Procedure, 1973", "CrPC", 1973), ("U.P. Land Act", None, None), ("Special Act", None, None), ("Unknown Act", None, None), ("Unknown Act", None, None),
    ]


# The kinds of provision text: slash lists, a sub-section of a section, a level that goes on, glued names, years, orders and rules.
SECTIONS = [
    ("Section 11", ["11"]), ("Sections 11, 12 and 13", ["11", "12", "13"]), ("11/12", ["11", "12"]), ("section-11,12", ["11", "12"]), ("11 r/w 12", ["11", "12"]),
    ("sub-section (3) of Section 9", ["9(3)"]), ("18(1)(a) and (b)", ["18(1)(a)", "18(1)(b)"]), ("21 of BNS", ["21"]), ("22CrPC", ["22"]), ("12AA", ["12AA"]), ("1998", []), ("Order XXXIX Rule 1", []), ("IX", []),
    ("4(2)(f)]", ["4(2)(f)"]), ("Article 14 & 21", ["14", "21"]), ("65-B", ["65-B"]), ("s. 7 read with 8", ["7", "8"]), ("", []),
    ("Section 411", ["411"]), ("Article 19", ["19"]), ("section-17", ["17"]), ("s. 3(1)(b)", ["3(1)(b)"]), ("120,34", ["120", "34"]), ("61/2(4", ["61", "2(4)"]), ("9 alternatively 61/2(4", ["9", "61", "2(4)"]),
    ("Regulation 9 (b)", ["9(b)"]), ("Regulation 6(2)(a) to (c)]", ["6(2)(a)", "6(2)(c)"]), ("300 Part I/II, or cases of 7 CRA-12-2019", ["300"]), ("376AB", ["376AB"]), ("under section 25(1)", ["25(1)"]), ("18 clause (b)", ["18(b)"]),
    ("Order XX, Rule 1(2) and 5", ["5"]), ("(a) and 7", ["7"]), ("302-304", []), (None, []),
]


def test_section_numbers(spark):
    assert apply(spark, sections.section_numbers, *[s for s, _ in SECTIONS]) == [n for _, n in SECTIONS]


PARAGRAPHS = "Head\n1. First one.\n12) not next\n2. Second cites Section 5 of the NI Act.\n3. Third. The appeal is dismissed."


def test_paragraphs_and_sentences(spark):
    got = apply(spark, text.split_paragraphs, PARAGRAPHS, "1. a\n2. b", None)
    assert got[0] == [(1, "First one.\n12) not next"), (2, "Second cites Section 5 of the NI Act."), (3, "Third. The appeal is dismissed.")]
    assert got[1:] == [[], []]
    got = apply(spark, text.split_sentences, "SLP NO. 6 is Mr. X. 3 The end. Ors. came", "", None)
    assert got[0] == ["SLP NO. 6 is Mr.  X.", "3 The end.", "Ors. came."] and got[1:] == [[], []]


OUTCOMES = [
    ("The appeal is partly allowed.", "Partly Allowed"), ("We allow this appeal partly.", "Partly Allowed"), ("The appeal stands allowed. Pending applications, if any, stand disposed of.", "Allowed"),
    ("The petition is, accordingly, dismissed.", "Dismissed"), ("The High Court allowed the revision and set aside the order.", None), ("The order of the High Court is set aside.", "Set Aside"),
    ("The matter is remanded to the court.", "Remanded"), ("List on Monday.", None), ("The appeal is disposed of.", "Disposed"), ("The petition was withdrawn.", "Withdrawn"),
    ("The appeals are allowed in the aforesaid terms.", "Allowed"), ("Appeal allowed to the above extent.", "Allowed"), ("Allowed as above. No costs.", "Allowed"), ("Appeal allowed.", None),
    ("The writ petitions stand dismissed with costs.", "Dismissed"), ("The suit dismissed earlier was restored.", None), ("We remand the matter. It is remanded back to the Tribunal.", "Remanded"),
    ("The proceedings in the FIR are hereby quashed.", "Quashed"), ("The trial court dismissed the suit.", None), ("The Tribunal had in its order of May allowed the claim.", None),
    ("The judgment of the trial court was set aside.", "Set Aside"), ("Pending I.A.s are disposed of.", None), ("The application and the appeal are disposed of.", "Disposed"),
    ("All pending applications stand disposed of.", None), ("The petition is disposed-of.", "Disposed"), ("It is a long way from what is said here by anyone to what was ever allowed.", None),
]


@pytest.mark.parametrize(("body", "label"), OUTCOMES)
def test_disposition(body, label):
    assert outcomes.decide(body)[1] == label


def test_sentences_and_paragraphs_equal_those_of_the_columns(spark):
    """The search from the end cuts texts as the column functions do."""
    texts = [PARAGRAPHS, "SLP NO. 6 is Mr. X. 3 The end. Ors. came", "", "1. a\n2. b", "1. One.\n\n2) Two is here.\n3. Three. No. 4 v. Ors. Five.\n7\n4. Four.", *[b for b, _ in OUTCOMES]]
    assert apply(spark, text.split_sentences, *texts) == [outcomes.sentences(t) if "\n" not in t else apply(spark, text.split_sentences, t)[0] for t in texts]
    assert [[p for _, p in found] for found in apply(spark, text.split_paragraphs, *texts)] == [outcomes.paragraphs(t) for t in texts]


def test_a_long_judgment_is_read_from_its_end():
    began = time.perf_counter()
    body = "".join(f"{i}. The High Court allowed the revision and so on and so forth, as is said in No. {i}. It went on. \n" for i in range(1, 3000)) + "3000. The appeal is dismissed."
    assert len(body) > 290_000 and outcomes.decide(body) == ("The appeal is dismissed.", "Dismissed")
    assert time.perf_counter() - began < 1


def test_disposition_reads_the_last_numbered_paragraphs(spark):
    early = "1. The suit is allowed.\n" + "".join(f"{i}. Nothing here {i}.\n" for i in range(2, 12))
    assert apply(spark, outcomes.disposition, PARAGRAPHS, early, None) == [("The appeal is dismissed.", "Dismissed"), (None, None), (None, None)]


def test_provisions(spark):
    got = apply(spark, text.extract_provisions, "under Section 302 of the Indian Penal Code, section 302 of the IPC and rule 5 of the said Rules; Rs. 5000; disorder 5", None)
    assert got == [[("Indian Penal Code, 1860", "IPC", 1860, "302")], []]
    df = spark.createDataFrame([(1, PARAGRAPHS), (2, "a" * 300 + " Section 5 x " + "b" * 150 + " section 6 " + "c" * 300), (3, "Rs. 5000"), (4, None)], "i int, x string")
    got = [r[0] for r in df.withColumn("s", spans.match_spans(F.col("x"), v.PROVISION)).orderBy("i").select(spans.provision_paragraphs(F.col("x"), F.col("s"))).collect()]
    assert got[0] == "[Para 2] Second cites Section 5 of the NI Act."
    assert got[1] == ("a" * 199 + " Section 5 x " + "b" * 150 + " section 6 " + "c" * 199) and got[2:] == ["", ""]


def test_artifacts(spark):
    body = "Start\n  12\nText Digitally signed by\nA\nSignature Not Verified\nConclusion ......... 42\nEnd"
    assert apply(spark, text.strip_ocr_noise, body, None, "a   b\n\n\n\nc") == ["Start\nText \nEnd", "", "a b\n\nc"]
    df = spark.createDataFrame([(body,), (None,)], "x string")
    got = [plain(r[0]) for r in df.withColumn("s", spans.match_spans(F.col("x"), *spans.ARTIFACTS.values())).select(spans.artifact_spans(F.col("s"))).collect()]
    assert [(s[2], body[s[0] : s[1]] == s[3]) for s in got[0]] == [("page_number", True), ("signature_block", True), ("toc_dot_leader", True)] and got[1] == []


def test_headings_and_excerpts(spark):
    assert apply(spark, text.judgment_body, "x\nJ U D G M E N T\n body \n", "x\nOrder\n", "none", None) == ["body", None, None, None]
    assert apply(spark, lambda c: text.section_after(c, v.FACTS_HEADING), "BRIEF FACTS:\nA  b\nREASONING\nc", None) == ["A b", None]
    emoji = "\U0001f600" * 5
    assert apply(spark, text.judgment_body, f"x{emoji}\nORDER\nbody {emoji}", "ORDER\nfirst line", "x\nORDER:\nno title") == [f"body {emoji}", None, None]
    assert apply(spark, lambda c: text.section_after(c, v.FACTS_HEADING), f"{emoji}\nFacts of the case :\n\n {emoji} A\n5. Next", "FACTS\n\n", "The facts\nA") == [f"{emoji} A", None, None]
    got = apply(spark, text.subject_from_jurisdiction, "CIVIL ORDINARY ORIGINAL JURISDICTION", "CRIMINAL JURISDICTION.", "APPELLATE JURISDICTION", "JURISDICTION", "", None)
    assert got == ["Civil", "Criminal", "Appellate", None, None, None]
    assert apply(spark, text.subject_from_jurisdiction, "IN THE SUPREME COURT OF INDIA\nCIVIL APPELLATE JURISDICTION", "none") == ["Civil", None]
    long = "s" * 100 + "\nRESULT\nearly\n" + "m" * 300 + "\nOPERATIVE PART\nfinal words"
    short, cut = apply(spark, lambda c: text.build_excerpt(c, 200, 10, 50), "short", long)
    assert short == ("short", "full") and cut[1] == "long" and cut[0].startswith("s" * 10 + "\n[") and cut[0].endswith("OPERATIVE PART\nfinal words")


def test_matters_and_citations(spark):
    title = "CIVIL APPEAL NO. 5 OF 2020\nSLP (C) NO. 7/2021 civil appeal no. 5 of 2020 WRIT PETITION NO. ___ OF 2026\nJUDGMENT\nCIVIL APPEAL NO. 9 OF 2020"
    assert apply(spark, text.connected_matters, title, None) == [["CIVIL APPEAL NO. 5 OF 2020", "SLP (C) NO. 7/2021"], []]
    df = spark.createDataFrame([("see 2024 INSC 12 and (2019) 3 SCC 45, 2024 INSC 12",)], "x string")
    got = df.withColumn("s", spans.match_spans(F.col("x"), *spans.CITATIONS)).select(spans.citation_candidates(F.col("x"), F.col("s"), 5)).first()[0]
    assert [r["raw_citation"] for r in got] == ["2024 INSC 12", "(2019) 3 SCC 45"] and got[0]["context"] == "see 2024 INSC 12 and"
    assert apply(spark, text.has_overruled_keyword, "is overruled", "per  incuriam", "ruled", None) == [True, True, False, False]


def test_json_and_description(spark):
    assert apply(spark, lambda c: text.llm_json(c, "a int"), '```json {"a": 1} ```', "no", '{"a": ', None) == [(1,), None, None, None]
    got = apply(spark, lambda c: text.describe({"x": (F.lit(None).cast("string"), c), "y": (c, c)}), "v", None)
    assert got == ["Filled: x. Kept existing: y.", "Not found: x, y."]


def test_pairing(spark):
    sentences = spark.createDataFrame([(1, 0, "Section 302 of the Indian Penal Code applies."), (1, 1, "So does section 34."), (2, 0, "Section 5 alone.")], "case_id int, sentence int, text string")
    got = sorted((r["case_id"], r["provision"], r["statute"], r["sections"]) for r in entities.paired_provisions(entities.entity_spans(sentences)).collect())
    assert got == [(1, "Section 302", "Indian Penal Code", ["302"]), (1, "section 34", "Indian Penal Code", ["34"])]


# Published examples of the rules.
STEMS = {
    "consign": "consign", "consigned": "consign", "consignment": "consign", "consistency": "consist", "consisting": "consist", "knack": "knack", "knackeries": "knackeri", "knavish": "knavish", "kneeled": "kneel",
    "knightly": "knight", "knots": "knot", "hopping": "hop", "hoping": "hope", "tied": "tie", "cries": "cri", "by": "by", "say": "say", "gas": "gas", "gaps": "gap", "kiwis": "kiwi", "luxuriated": "luxuri", "generically": "generic", "dying": "die",
}


def test_stems():
    assert {w: stem(w) for w in STEMS} == STEMS


def test_english_search(spark):
    lexer = English()
    df = spark.createDataFrame([(1, "The appeals were dismissed by the courts"), (2, "appeal to a court"), (3, None)], "i int, x string").withColumn("w", lexer.column(F.col("x")))
    ids = lambda cond: [r["i"] for r in df.where(cond).orderBy("i").collect()]
    assert ids(match_all(F.col("w"), lexer.lexemes("the appeal court"))) == [1, 2]
    assert ids(match_phrase(F.col("w"), lexer.words("dismissed by the court"))) == [1]
    assert ids(match_phrase(F.col("w"), lexer.words("dismissed court"))) == []
    assert ids(match_all(F.col("w"), lexer.lexemes("the of"))) == [] and ids(~match_all(F.col("w"), lexer.lexemes("the of"))) == [1, 2, 3]
    assert PORTABLE.words("A-b  c") == ["a", "b", "c"]


def test_both_dates_must_be_in_one_year(spark):
    rows = lambda last: spark.createDataFrame([("2020-01-02", last)], ["a", "z"]).select(text.require_one_year(F.to_date("a"), F.to_date("z")).alias("y"))
    assert rows("2020-12-31").first()["y"] == 2020
    with pytest.raises(Exception, match="one year"):
        rows("2021-01-01").collect()
