"""Language ID by a bit-sliced Bloom filter: one probe gives, as a bitmask, all languages that contain an n-gram."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from benchbook.llm.common import ids_and_texts, with_null_ids

#: Bound of the labelled sample that the filter is fitted on: rows per language (drawn by a
#: hash of the id) of at most so many characters. Languages with fewer such rows are learnt from pieces of longer ones too.
SAMPLE_PER_LANGUAGE = 400
SAMPLE_CHARS = 20_000
#: n-gram length, most frequent n-grams that a language puts into the filter, slots and probes.
GRAM = 4
GRAMS_PER_LANGUAGE = 4_000
SLOTS = 1 << 18
PROBES = 3
#: Languages in one mask; more languages take more masks.
MASK = 64
MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
UNKNOWN = "und"
SCHEMA = "doc_id long, lang_pred string, score double"


def grams(text: str, n: int = GRAM) -> np.ndarray:
    """Hashes of the lower-case n-grams of letters; other characters become one blank, as do the text's ends."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = _letters(codes)
    codes = np.where(letter, codes, np.uint32(32))
    codes = codes[np.r_[True, letter[1:] | letter[:-1]]].astype(np.uint64)
    if len(codes) < n:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        h = np.zeros(len(codes) - n + 1, np.uint64)
        for i in range(n):
            h = h * np.uint64(0x100000001B3) + codes[i : len(codes) - n + 1 + i]
        h = (h ^ (h >> np.uint64(29))) * MULTIPLY
        return h ^ (h >> np.uint64(32))


_TABLE = None


def _letters(codes: np.ndarray) -> np.ndarray:
    """Which code points are letters."""
    global _TABLE
    if _TABLE is None:
        _TABLE = np.array([chr(c).isalpha() for c in range(0x10FFFF + 1)])
    return _TABLE[codes]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class Filter:
    """slots[m, i]: bitmask of those of languages 64 * m and on that set slot i. rates: each language's chance of a false positive."""

    languages: list[str]
    slots: np.ndarray
    rates: np.ndarray
    default: str

    @staticmethod
    def _at(hashes: np.ndarray, slots: int) -> Iterator[np.ndarray]:
        step = (hashes >> np.uint64(32)) | np.uint64(1)
        with np.errstate(over="ignore"):
            for probe in range(PROBES):
                yield (hashes + np.uint64(probe) * step) % np.uint64(slots)

    @classmethod
    def of(cls, found: dict[str, np.ndarray], default: str, slots: int = SLOTS) -> Filter:
        languages = sorted(found)
        table = np.zeros((-(-len(languages) // MASK), slots), np.uint64)
        for n, name in enumerate(languages):
            for at in cls._at(found[name], slots):
                table[n // MASK, at] |= np.uint64(1) << np.uint64(n % MASK)
        fill = np.array([np.count_nonzero(table[n // MASK] & (np.uint64(1) << np.uint64(n % MASK))) / slots for n in range(len(languages))])
        return cls(languages, table, fill**PROBES, default)

    def counts(self, hashes: np.ndarray) -> np.ndarray:
        """Per language the n-grams that it contains, less those expected to be false positives."""
        masks = np.full((len(self.slots), len(hashes)), ~np.uint64(0))
        for at in self._at(hashes, self.slots.shape[1]):
            masks &= self.slots[:, at]
        hits = np.array([np.count_nonzero(masks[n // MASK] & (np.uint64(1) << np.uint64(n % MASK))) for n in range(len(self.languages))], dtype=float)
        return np.maximum(0, (hits - len(hashes) * self.rates) / (1 - self.rates))

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language that contains most n-grams, and the share of the n-grams that it contains."""
        if not has_letter(text):
            return UNKNOWN, 0.0
        hashes = grams(text)
        counts = self.counts(hashes)
        best = int(np.argmax(counts)) if len(counts) else -1
        if best < 0 or counts[best] <= 0:
            return self.default, 0.0
        return self.languages[best], min(1.0, float(counts[best] / len(hashes)))


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", rows: int = SAMPLE_PER_LANGUAGE, chars: int = SAMPLE_CHARS) -> Filter:
    """Fits the filter on a bounded sample of labelled rows: rows with text and a language, about `rows` per language.

    Counts per language come first; then one scan draws the sample by a hash of the id, each language with
    a share of its own. Longer texts than chars characters are left out, but where a language has too few
    rows without them they stand for a piece of that length. n-grams are counted in the tasks and summed by
    Spark; what reaches the driver is the most frequent ones of each language, 16 bytes for each. No
    language is left out. Rows without text or language are skipped. Without labelled rows the filter
    knows no language and predicts `und`.
    """
    good = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"), F.col(id_col).alias("doc_id")).where("lang is not null and text is not null")
    short = F.length("text") <= int(chars)
    counts = {r["lang"]: (r["n"], r["short"]) for r in good.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count_if(short).alias("short")).orderBy(F.desc("n"), "lang").collect()}
    if not counts:
        return Filter.of({}, UNKNOWN)
    spark = labelled.sparkSession
    shares = spark.createDataFrame([(name, min(1.0, rows / (some if some >= rows else n)), some < rows) for name, (n, some) in counts.items()], "lang string, share double, few boolean")
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("fit")), F.lit(2**31)) / F.lit(float(2**31))
    start = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("piece")), F.greatest(F.length("text") - int(chars) + 1, F.lit(1))).cast("int") + 1
    piece = F.when(short, F.col("text")).otherwise(F.substring("text", start, F.lit(int(chars))))
    # A row per language: a table as small as the model itself.
    drawn = good.join(F.broadcast(shares), "lang").where((short | F.col("few")) & (draw < F.col("share"))).select("lang", piece.alias("text"))

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, texts in batch.groupby("lang")["text"]:
                seen, times = np.unique(np.concatenate([np.zeros(0, np.uint64), *map(grams, texts)]), return_counts=True)
                yield pd.DataFrame({"lang": name, "gram": seen.view(np.int64), "n": times})

    sums = drawn.mapInPandas(counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = sums.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(F.col("place") <= GRAMS_PER_LANGUAGE)
    top = best.select("lang", "gram").toPandas()
    found = {name: np.zeros(0, np.uint64) for name in counts} | {name: part.to_numpy().view(np.uint64) for name, part in top.groupby("lang")["gram"]}
    return Filter.of(found, default=next(iter(counts)))


def predict(docs: DataFrame, model: Filter, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every whole text. Only the text is looked at.

    Null text and text without a letter: `und`, score 0. Letters but no known n-gram: the most frequent
    language, score 0. Null id: kept. Repeated rows: a row each. Empty table: no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for batch in batches:
            found = [own.predict(t) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "lang_pred": [f[0] for f in found], "score": [f[1] for f in found]})

    return with_null_ids(ids_and_texts(docs, id_col, text_col).mapInPandas(run, SCHEMA))


def held_out(doc_id) -> F.Column:
    """Rows that no model may learn from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score: fitted on the rows of docs that aren't held out, applied to all."""
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    return predict(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_known(docs: DataFrame, wanted: tuple[str, ...] | None = None, least: float = 0.0, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Rows of docs whose predicted language is one of `wanted` (none given: any that the model knows) with a score of at least
    `least`; their language, where it is null, becomes the predicted one.

    `und` (null texts, texts without a letter) is rejected. A text of unknown n-grams has the most frequent language, score 0.
    A model without any language, where no row has a label, rejects no text with a letter.
    What the model says is a column, so rows with all their columns stay where they are: no shuffle.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs.where(~held_out(F.col(id_col))), text_col, lang_col, id_col))

    @F.pandas_udf("lang string, score double")
    def told(texts: pd.Series) -> pd.DataFrame:
        found = [model.value.predict(t) for t in texts]
        found = [f if f[0] != UNKNOWN or model.value.languages or not has_letter(t) else (None, 0.0) for f, t in zip(found, texts, strict=True)]
        return pd.DataFrame({"lang": pd.Series([f[0] for f in found], dtype=object), "score": pd.Series([f[1] for f in found], dtype=float)})

    name = "__told"
    # Not to be repeated: else the filter would predict once more for itself.
    said = docs.withColumn(name, told.asNondeterministic()(F.col(text_col).cast("string")))
    kept = said.where(~F.col(f"{name}.lang").eqNullSafe(UNKNOWN) & (F.col(f"{name}.score") >= least))
    if wanted is not None:
        kept = kept.where(F.col(f"{name}.lang").isin(*wanted))
    return kept.withColumn(lang_col, F.coalesce(F.col(lang_col), F.col(f"{name}.lang").cast(docs.schema[lang_col].dataType))).drop(name)
