"""License scans by diagonal voting: rolling word k-grams meet template positions, votes are counted per diagonal."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from benchbook.llm.common import materialize
from benchbook.llm.license_texts import NOTICES, TEXTS

#: Words of a gram: for phrases and notices of one sentence, and for whole license texts.
GRAM, TEXT_GRAM = 2, 4
#: Diagonals up to this far apart belong to one span (words put in or left out), for notices and for whole texts.
NEIGHBOUR, TEXT_NEIGHBOUR = 2, 8
#: Share of a template's words that a span must hold, one by one, to give the template's label.
COVERED = 0.8

# Phrases and labels of the contract.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words: runs of digits, letters a-z after A-Z are lower-cased, and characters beyond ASCII, which stay as they are."""
    text = F.coalesce(text, F.lit(""))
    low = F.when(F.char_length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(low, SEPARATOR), "")


def template_words(text: str) -> list[str]:
    """What words() gives for a template."""
    return [w for w in re.split(SEPARATOR, text.translate(str.maketrans(UPPER, LOWER))) if w]


def templates(notices: list[tuple[str, str]], texts: list[tuple[str, str]], base: dict[str, str]) -> list[tuple]:
    """template, label, is_base, k, neighbour, words of all templates, numbered in order."""
    rows = [(label, True, GRAM, 0, phrase) for phrase, label in base.items()]
    rows += [(label, False, GRAM, NEIGHBOUR, t) for label, t in notices] + [(label, False, TEXT_GRAM, TEXT_NEIGHBOUR, t) for label, t in texts]
    return [(i, label, is_base, k, near, template_words(t)) for i, (label, is_base, k, near, t) in enumerate(rows)]


def template_grams(spark: SparkSession, known: list[tuple]) -> DataFrame:
    """template, tk, tpos, tgram: a table as large as the templates, which are a parameter."""
    flat = [(i, k, p, w[p : p + k]) for i, _, _, k, _, w in known for p in range(len(w) - k + 1)]
    return spark.createDataFrame(flat, "template int, tk int, tpos int, tgram array<string>")


def hits(docs: DataFrame, known: list[tuple], id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_hash, n_words, template, tpos, pos: where a gram of a text is that of a template, and for each row of docs one
    row more, without template. One pass over the texts, in which each is split once; what it finds is written."""
    sizes = sorted({k for _, _, _, k, _, _ in known})
    of = lambda gram, at, k: F.xxhash64(*[F.get(gram, at + i) for i in range(k)])
    table = template_grams(docs.sparkSession, known)
    table = table.withColumn("thash", F.coalesce(*[F.when(F.col("tk") == k, of(F.col("tgram"), F.lit(0), k)) for k in sizes]))
    text, grams = F.col(text_col).cast("string"), F.col("words")
    split = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), words(text).alias("words"))
    rolling = split.select("*", F.size("words").cast("long").alias("n_words"), F.posexplode_outer("words").alias("pos", "word"))
    # At each place one hash for each size of gram. One that runs over the text's end has too few words to equal a template's.
    own = [F.struct(F.lit(k).alias("k"), of(grams, F.col("pos"), k).alias("hash")) for k in sizes]
    document = F.struct(F.lit(0).alias("k"), F.lit(None).cast("long").alias("hash"))
    both = F.when(F.coalesce("pos", F.lit(0)) == 0, F.array(document, *own)).otherwise(F.array(*own))
    places = rolling.select("doc_id", "text_hash", "n_words", "words", "pos", F.inline(both))
    same = (F.col("hash") == F.col("thash")) & (F.col("k") == F.col("tk")) & (F.slice("words", F.col("pos") + 1, F.col("k")) == F.col("tgram"))
    met = places.join(F.broadcast(table), same, "left").where((F.col("k") == 0) | F.col("template").isNotNull())
    return materialize(met.select("doc_id", "text_hash", "n_words", "template", "tpos", "pos"))


SPANS = ["doc_id", "text_hash", "template", "label", "is_base", "first", "last", "covered"]


def spans_of(found: DataFrame, known: list[tuple]) -> DataFrame:
    """SPANS from the hits. Votes are counted per diagonal (place in the text less place in the template); a phrase
    of base must stand whole on one diagonal. Of other templates diagonals that are near and whose places
    overlap are merged, and a span counts if it holds at least COVERED of the template's words."""
    about = found.sparkSession.createDataFrame([(i, label, is_base, k, near, len(w)) for i, label, is_base, k, near, w in known], "template int, label string, is_base boolean, k int, near int, t_words int")
    key = ["doc_id", "text_hash", "template"]
    # On one diagonal a template fits between diagonal and diagonal + t_words, so votes there are one span.
    votes = found.where("template is not null").groupBy(*key, (F.col("pos") - F.col("tpos")).alias("diagonal")).agg(F.collect_set("tpos").alias("tpos"), F.min("pos").alias("first"), F.max("pos").alias("last"))
    votes = votes.join(F.broadcast(about), "template").withColumn("last", F.col("last") + F.col("k") - 1)
    whole = votes.where("is_base and size(tpos) = t_words - k + 1").withColumn("covered", F.lit(1.0))

    line = Window.partitionBy(*key).orderBy("diagonal")
    goes_on = (F.col("diagonal") - F.lag("diagonal").over(line) <= F.col("near")) & (F.col("first") - F.lag("last").over(line) <= F.col("t_words"))
    islands = votes.where("not is_base").withColumn("opens", F.when(goes_on, 0).otherwise(1)).withColumn("island", F.sum("opens").over(line))
    merged = islands.groupBy(*key, "label", "is_base", "t_words", "k", "island").agg(F.flatten(F.collect_list("tpos")).alias("tpos"), F.min("first").alias("first"), F.max("last").alias("last"))
    places = F.array_distinct(F.flatten(F.transform("tpos", lambda t: F.sequence(t, t + F.col("k") - 1))))
    spans = merged.withColumn("covered", F.size(places) / F.col("t_words")).where(F.col("covered") >= COVERED)
    return whole.select(SPANS).union(spans.select(SPANS))


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", notices: list[tuple[str, str]] | None = None, texts: list[tuple[str, str]] | None = None, base: dict[str, str] | None = None
) -> DataFrame:
    """Spans of license phrases, notices and texts: SPANS (first and last: words from 0).

    Every gram of every text is joined to the template positions (a broadcast table of fixed size) by its
    hash, and compared word by word in the same join. Repeated rows of one id and text count once.
    """
    known = templates(NOTICES if notices is None else notices, TEXTS if texts is None else texts, BASE if base is None else base)
    return spans_of(hits(docs, known, id_col, text_col), known)


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base counts the places of the base phrases; first_word and last_word are the least and largest
    start of one. labels also holds those of the spans that scan() verifies; score is the best
    coverage. Null or wordless text: zeros, empty strings and nulls. Null id: matched by its text.
    Repeated rows: a row each, each with the same result. Empty table: no rows.
    """
    known = templates(NOTICES, TEXTS, BASE)
    found = hits(docs, known, id_col, text_col)
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    base = F.col("is_base")
    per = spans_of(found, known).groupBy(F.col("doc_id").alias("d"), F.col("text_hash").alias("t")).agg(
        F.count(F.when(base, 1)).alias("n_base"), F.min(F.when(base, F.col("first"))).cast("long").alias("first_word"), F.max(F.when(base, F.col("first"))).cast("long").alias("last_word"),
        joined(F.when(base, F.col("label"))).alias("base_labels"), joined("label").alias("labels"), F.max("covered").alias("score"),
    )
    rows = found.where("template is null").select("doc_id", "text_hash", "n_words")
    return rows.join(per, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("text_hash").eqNullSafe(F.col("t")), "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )
