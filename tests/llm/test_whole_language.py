"""No language is left out of the fit, and no document with a letter out of the corpus."""

import random

import numpy as np

from benchbook.llm import language


def test_more_than_64_languages_and_long_texts_are_learnt(spark):
    letters = [chr(0x4E00 + i) for i in range(700)]
    words = {f"l{n:02}": "".join(letters[7 * n : 7 * n + 7]) for n in range(80)}
    rows = [(i, " ".join([w] * 20), name) for i, (name, w) in enumerate((x, y) for x, y in words.items() for _ in range(2))]
    rows += [(1000 + i, "ωστόσο λοιπόν " * 4000, "el") for i in range(3)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == sorted([*words, "el"]) and len(model.slots) == 2
    assert {name: model.predict(f"{w} {w}")[0] for name, w in words.items()} == {name: name for name in words}
    assert model.predict("λοιπόν ωστόσο")[0] == "el"


def brute_grams(text, n=4):
    """The n-grams themselves: lower-case letters, all else one blank."""
    out = " "
    for c in text.lower():
        out += c if c.isalpha() else " " if out[-1] != " " else ""
    out += " " if out[-1] != " " else ""
    return [out[i : i + n] for i in range(len(out) - n + 1)]


def test_masks_against_sets_of_grams(spark):
    rng = random.Random(4)
    alphabets = ["".join(rng.sample("abcdefghijklmnopqrstuvwxyzäöüßéèñçøå", 9)) for _ in range(70)]
    write = lambda a, n: " ".join("".join(rng.choice(a) for _ in range(rng.randrange(2, 8))) for _ in range(n))
    rows = [(10 * k + i, write(a, 40), f"l{k:02}") for k, a in enumerate(alphabets) for i in range(3)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3))
    known = {}
    for _, text, name in rows:
        known.setdefault(name, set()).update(brute_grams(text))
    assert model.languages == sorted(known) and len(model.slots) == 2
    for a in alphabets[::7]:
        text = write(a, 30) + ", 12 " + write("xyz", 3)
        found = brute_grams(text)
        want = [sum(g in known[name] for g in found) for name in model.languages]
        # A Bloom filter adds false positives only, which the correction takes away on average.
        assert len(found) == len(language.grams(text))
        assert np.abs(model.counts(language.grams(text)) - np.array(want)).max() <= 2
        assert want[model.languages.index(model.predict(text)[0])] >= max(want) - 2


def test_the_sample_of_a_language_is_bounded(spark):
    drawn = spark.range(20_000).selectExpr("id as doc_id", "'some words' as text", "if(id < 10, 'few', 'many') as lang")
    model = language.fit(drawn, rows=100)
    assert model.languages == ["few", "many"] and model.default == "many"


def test_the_stage_keeps_documents_of_unknown_grams(spark):
    rows = [(i, "plain english words stand here", "en") for i in range(20)] + [(100, "日本語のテキスト", None), (101, "a", None), (102, "1 2 3", None), (103, None, None), (104, "", "en")]
    kept = {r["doc_id"] for r in language.keep_known(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert kept == {*range(20), 100, 101}
    bare = spark.createDataFrame([(1, "words", None), (2, None, None)], "doc_id long, text string, lang string")
    assert [r["doc_id"] for r in language.keep_known(bare).collect()] == [1]


def test_the_prediction_decides(spark, monkeypatch):
    rows = [(i, f"the house and the garden of the king number {'x' * (i % 5)}", "en") for i in range(40)] + [(100 + i, f"das haus und der garten des schoenen hofes {'y' * (i % 5)}", "de") for i in range(40)]
    rows += [(200, "the garden and the house", None), (201, "der garten und das haus", None), (202, None, "en"), (203, "123 !", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r["doc_id"]: r["lang"] for r in language.keep_known(docs).collect()}
    assert kept == {i: lang or ("en" if i == 200 else "de") for i, t, lang in rows if i < 202}
    only = {r["doc_id"] for r in language.keep_known(docs, wanted=("de",)).collect()}
    assert only == {*range(100, 140), 201}
    model = language.fit(docs)
    swapped = language.Filter(model.languages[::-1], model.slots, model.rates, model.default)
    monkeypatch.setattr(language, "fit", lambda *a, **k: swapped)
    assert {r["doc_id"] for r in language.keep_known(docs, wanted=("de",)).collect()} == {*range(40), 200}
