"""Small documents with the edge cases that every operator must bear."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, kept boolean, size int, hash string"
LONG = "".join(f"word{i % 977} " + ("\n" if i % 13 == 0 else "") for i in range(9000)) + "x" * 70_000
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from the big bad wolf."),
    (2, "The  quick brown fox jumps over the lazy dog\tand runs away from the big bad wolf."),
    (3, "The quick brown fox jumps over the lazy dog and runs away from the big bad wolf."),
    (4, None),
    (5, ""),
    (6, " \t\n\r\x0b\x0c"),
    (7, LONG),
    (8, "Voilà l'été; c'est déjà fini, n'est-ce pas? ÀÉÎ œuvre"),
    (9, "日本語のテキスト 😀 naïve ﬁ ½ İstanbul Σίσυφος line"),
    (10, "Released under the MIT License. Under the  Apache-License, and the GNU general public license!"),
    (11, "a<|endoftext|>b <|startoftext|> 's 'S don't we'RE"),
    (12, "word"),
    (13, "1234 567 !!! ???"),
    (14, "licensed under the apache big license version 2 0"),
]


def documents(spark, texts=TEXTS, repeat=()):
    rows = [(i, t, "en" if i % 3 else None, "s", None if t is None else len(t), i, True, 1, "h") for i, t in [*texts, *[(i, dict(texts)[i]) for i in repeat]]]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=lambda r: tuple((x is None, x) for x in r))
