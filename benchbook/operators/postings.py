"""The search vector kept as an inverted table: for each term the cases that have it, with its places and the classes of its fields.

A table is a folder of segments. Building writes the first; when cases change, their new rows are one more segment and
their ids tell that older rows of them don't count. A segment counts once its ids are written, which comes last.
Requests read the rows of their own terms only: files are laid out by a bucket of the term and sorted by it. A row holds a
term's cases of one block of texts, so tasks turn their texts into rows by themselves and nothing but the texts is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from benchbook.functions.lexers import PORTABLE, Lexer, raw_words
from benchbook.sources.landing import shared_folder

#: Folders that terms are spread over; a request lists and opens only those of its terms.
BUCKETS = 16
#: Words that a task holds before they become rows.
BLOCK = 1_000_000
#: Per term and block: cases, all their places one after another and where each case's places end, and each case's classes as bits of FIELDS.
BLOCKS = "term string, cases array<long>, ends array<int>, places array<int>, classes array<tinyint>"
SCHEMA = f"segment int, bucket int, {BLOCKS}"
#: Class and fields of the vector, in the order of their places. The classes.
FIELDS = (("A", ("case_note",)), ("B", ("case_number", "petitioner", "respondent")), ("C", ("judgment", "conclusion")), ("D", ("text",)))
_CLASSES = ["".join(name for k, (name, _) in enumerate(FIELDS) if mask >> k & 1) for mask in range(1 << len(FIELDS))]


def bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


class _Numbers(dict):
    """Words of a block, numbered by what the lexer makes of them as they come; 0: a stop word."""

    def __init__(self, lexer: Lexer):
        self.lexer, self.of = lexer, {"": 0}

    def __missing__(self, word: bytes) -> int:
        n = self[word] = self.of.setdefault(self.lexer.lexeme(word.decode()), len(self.of))
        return n


def _lists(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


def _block(terms: list[str], ids: list[int | None], words: list[np.ndarray], marks: list[np.ndarray]) -> pa.RecordBatch:
    """Rows of BLOCKS for so many cases: the numbers of their words in order, and the bit of each word's class."""
    sizes = [len(w) for w in words]
    word, mark = np.concatenate(words), np.concatenate(marks)
    case, place = np.repeat(np.arange(len(ids)), sizes), np.concatenate([np.arange(n, dtype=np.int32) for n in sizes])
    order = np.argsort(word, kind="stable")  # cases and places stay in order
    order = order[np.searchsorted(word[order], 1) :]
    word, mark, case, place = word[order], mark[order], case[order], place[order]
    new = np.r_[True, word[1:] != word[:-1]][: len(word)]
    rows = np.flatnonzero(new)
    held = np.flatnonzero(new | np.r_[True, case[1:] != case[:-1]][: len(word)])
    ends = np.r_[np.searchsorted(held, rows), len(held)]
    known = pa.array(ids, pa.int64())
    cases = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), known.take(pa.array(case[held])))
    classes = np.bitwise_or.reduceat(mark, held) if len(held) else mark
    ended = (np.r_[held[1:], len(word)] if len(held) else held) - np.repeat(rows, np.diff(ends))  # within a row
    columns = [pa.array([terms[w] for w in word[rows]], pa.string()), cases, _lists(ends, ended.astype(np.int32)), _lists(np.r_[rows, len(word)], place), _lists(ends, classes)]
    return pa.RecordBatch.from_arrays(columns, ["term", "cases", "ends", "places", "classes"])


def vectors(cases: DataFrame, lexer: Lexer) -> DataFrame:
    """Rows of BLOCKS with their bucket. Fields that cases don't have are empty; stop words have places but no rows."""
    lexed = []
    for k, (_, fields) in enumerate(FIELDS):
        there = [F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields if f in cases.columns]
        if there:
            lexed.append((1 << k, F.concat_ws(" ", *there)))
    bits = [bit for bit, _ in lexed]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, ids, words, marks, held = _Numbers(lexer), [], [], [], 0
        for batch in batches:
            for case_id, *texts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                split = [raw_words(t) for t in texts]
                n = sum(map(len, split))
                ids.append(case_id)
                words.append(np.fromiter((numbers[w] for part in split for w in part), np.int32, n))
                marks.append(np.repeat(np.array(bits, np.int8), [len(part) for part in split]))
                held += n
                if held >= BLOCK:
                    yield _block(list(numbers.of), ids, words, marks)
                    numbers, ids, words, marks, held = _Numbers(lexer), [], [], [], 0
        if held:
            yield _block(list(numbers.of), ids, words, marks)

    texts = cases.select(F.col("case_id").cast("long").alias("case_id"), *[text.alias(f"t_{bit}") for bit, text in lexed])
    return texts.mapInArrow(blocks, BLOCKS).withColumn("bucket", bucket(F.col("term")))


def each(blocks: DataFrame) -> DataFrame:
    """A row per term and case in place of BLOCKS: case_id, places, classes beside all other columns."""
    told, at = F.array(*[F.lit(c) for c in _CLASSES]), lambda values, i: F.get(F.col(values), i)
    begin = lambda i: F.coalesce(at("ends", i - 1), F.lit(0))
    one = lambda case, i: F.struct(case.alias("case_id"), F.slice("places", begin(i) + 1, at("ends", i) - begin(i)).alias("places"), F.get(told, at("classes", i).cast("int")).alias("classes"))
    other = [c for c in blocks.columns if c not in ("cases", "ends", "places", "classes")]
    return blocks.select(*other, F.explode(F.transform("cases", one)).alias("x")).select(*other, "x.*")


class Postings:
    """An inverted table in a folder. One writer at a time; readers see whole segments."""

    def __init__(self, spark: SparkSession, folder: str, lexer: Lexer = PORTABLE):
        self.spark, self.folder, self.lexer = spark, folder, lexer

    @classmethod
    def build(cls, cases: DataFrame, lexer: Lexer = PORTABLE, folder: str | None = None) -> Postings:
        made = cls(cases.sparkSession, folder or shared_folder(cases.sparkSession), lexer)
        made._add(cases, 0)
        return made

    def _add(self, cases: DataFrame, segment: int) -> None:
        laid = vectors(cases, self.lexer).sortWithinPartitions("bucket", "term")
        # An attempt that failed before its ids were written is overwritten, not counted.
        laid.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/rows/segment={segment}")
        cases.select(F.col("case_id").cast("long").alias("case_id")).distinct().write.mode("overwrite").parquet(f"{self.folder}/cases/segment={segment}")

    def segments(self) -> DataFrame:
        """segment, case_id: which cases were written when."""
        return self.spark.read.schema("case_id long, segment int").parquet(f"{self.folder}/cases")

    def upsert(self, cases: DataFrame) -> None:
        """New rows for these cases in place of those that they have; rows of other cases stay as they are."""
        self._add(cases, self.segments().agg(F.max("segment")).first()[0] + 1)

    def remove(self, ids: DataFrame) -> None:
        """Cases that are gone: a segment of ids without rows."""
        empty = self.spark.createDataFrame([], "case_note string")
        self.upsert(ids.select("case_id").join(empty, F.lit(False), "left"))

    def rows(self, terms: list[str]) -> DataFrame:
        """term, case_id, places, classes of these terms, of each case's last segment."""
        buckets = [r[0] for r in self.spark.createDataFrame([(t,) for t in terms], "term string").select(bucket(F.col("term"))).distinct().collect()] if terms else []
        read = each(self.spark.read.schema(SCHEMA).parquet(f"{self.folder}/rows").where(F.col("bucket").isin(*buckets) & F.col("term").isin(*terms)))
        last = self.segments().groupBy("case_id").agg(F.max("segment").alias("segment"), F.count(F.lit(1)).alias("n"))
        if self.segments().where("segment > 0").isEmpty():
            return read.drop("segment", "bucket")
        return read.join(last.where("n > 1").withColumnRenamed("segment", "last").drop("n"), "case_id", "left").where("last is null or segment = last").select("term", "case_id", "places", "classes")

    def all_of(self, lexemes: list[str]) -> DataFrame:
        """case_id of cases with all lexemes; without lexemes none."""
        wanted = sorted(set(lexemes))
        found = self.rows(wanted)
        if len(wanted) == 1:
            return found.select("case_id")
        if not wanted:
            return found.select("case_id").where(F.lit(False))
        return found.groupBy("case_id").agg(*[F.bool_or(F.col("term") == w).alias(f"has_{k}") for k, w in enumerate(wanted)]).where(" and ".join(f"has_{k}" for k in range(len(wanted)))).select("case_id")

    def phrase(self, words: list[str | None]) -> DataFrame:
        """case_id of cases with the words as far apart as here; None stands for a stop word.

        A case's places of each word are moved back by the word's place in the phrase; where all words meet, the phrase begins.
        """
        shifts = [(w, k) for k, w in enumerate(words) if w is not None]
        if not shifts:
            return self.rows([]).select("case_id")
        wanted = sorted({w for w, _ in shifts})
        found = self.rows(wanted)
        if len(wanted) == 1:  # a word alone needs no other row; one that repeats meets itself
            per = found.select("case_id", F.col("places").alias("of_0"))
        else:
            of = lambda w: F.flatten(F.collect_list(F.when(F.col("term") == w, F.col("places"))))
            per = found.groupBy("case_id").agg(*[of(w).alias(f"of_{k}") for k, w in enumerate(wanted)])
        back = lambda k: lambda place: place - k
        starts = [F.transform(f"of_{wanted.index(w)}", back(k)) for w, k in shifts]
        return per.where(F.size(reduce(F.array_intersect, starts)) > 0).select("case_id").distinct()


_KEPT: dict[tuple, Postings] = {}


def kept(spark: SparkSession, key: str, lexer: Lexer, cases) -> Postings:
    """The session's table for a folder of tables, built (from cases()) by the first request that needs it."""
    name = (spark.sparkContext.applicationId, key, type(lexer).__name__, lexer.stop)
    if name not in _KEPT:
        _KEPT[name] = Postings.build(cases(), lexer)
    return _KEPT[name]
