"""Source divergence audit: how far the sources of a language differ in their words, all in exact integers."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from benchbook.llm.common import BROADCAST_IDS, materialize

SCALE = 1_000_000_000
#: A term is kept where at least so many documents of its language have it; ranks of the term part that are reported.
LEAST_DOCS = 3
TOP_TERMS = 200
#: Different (language, source, term) entries that a task holds before it hands them on.
HELD = 400_000
#: Bytes that end a term become blanks, A-Z small letters; bytes of characters beyond ASCII stay.
#: Columns of what a task hands on.
ENTRY = (("lang", object), ("source", object), ("term", object), ("n", "int64"), ("docs", "int64"))
TERM_BYTES = bytes(b if b >= 0x80 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def terms(text: str | None) -> Counter:
    """Terms of a text with their counts."""
    return Counter((text or "").encode("utf-8", "replace").translate(TERM_BYTES).split())


def collapsed(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", broadcast_hashes: int = BROADCAST_IDS) -> DataFrame:
    """lang, text, sources, times: one row per different text of a language, with how often each source has it.

    A text whose hash occurs once stays where it is. Only texts behind a repeated hash are grouped, by the whole text;
    copies combine on the map side, so a text that a third of all rows share is one row per task before it travels.
    """
    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    named = named.withColumn("hash", F.xxhash64("lang", "text"))
    repeated = materialize(named.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash"))
    few = repeated.limit(broadcast_hashes + 1).count() <= broadcast_hashes
    repeated = F.broadcast(repeated) if few else repeated
    once = named.join(repeated, "hash", "left_anti").select("lang", "text", F.array("source").alias("sources"), F.array(F.lit(1).cast("long")).alias("times"))
    copies = named.join(repeated, "hash", "left_semi").groupBy("lang", "text", "source").agg(F.count(F.lit(1)).alias("n"))
    grouped = copies.groupBy("lang", "text").agg(F.collect_list(F.struct("source", "n")).alias("x"))
    return once.unionByName(grouped.select("lang", "text", F.col("x.source").alias("sources"), F.col("x.n").alias("times")))


def _weighted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per language, source and term: occurrences and documents. Each text is split into terms once, then weighted."""
    held: dict[tuple[str, str], dict[bytes, list[int]]] = defaultdict(dict)
    n = 0

    def rows() -> pd.DataFrame:
        flat = [(lang, source, t.decode("utf-8", "replace"), *v) for (lang, source), found in held.items() for t, v in found.items()]
        return pd.DataFrame({c: pd.Series([r[k] for r in flat], dtype=kind) for k, (c, kind) in enumerate(ENTRY)})

    for batch in batches:
        for lang, text, sources, times in zip(batch["lang"], batch["text"], batch["sources"], batch["times"], strict=True):
            counts = terms(text)
            for source, k in zip(sources, times, strict=True):
                mine, k = held[lang, source], int(k)
                before = len(mine)
                for t, c in counts.items():
                    if (at := mine.get(t)) is None:
                        mine[t] = [c * k, k]
                    else:
                        at[0] += c * k
                        at[1] += k
                n += len(mine) - before
                if n > HELD:
                    yield rows()
                    held.clear()
                    n = 0
    yield rows()


def kept_terms(docs: DataFrame, least_docs: int = LEAST_DOCS, **columns) -> DataFrame:
    """lang, term, n (in the language), by_source (source, n): the terms that at least least_docs documents of a language have.

    One shuffle by language and term; what follows, sums per source, documents and the list of sources, needs no other.
    """
    parts = collapsed(docs, **columns).mapInPandas(_weighted, "lang string, source string, term string, n long, docs long").repartition("lang", "term")
    sums = parts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    whole = sums.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("by_source"))
    return whole.where(F.col("docs") >= least_docs).drop("docs")


def share(n: Column, total: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / total), exact: decimals of 38 digits hold any count of a long."""
    top = (n + 1).cast("decimal(28,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.lit(1) + whole_quotient(top, total.cast("decimal(20,0)"))


def whole_quotient(a: Column, b: Column) -> Column:
    """floor(a / b) of numbers that aren't negative, as a long."""
    return F.call_function("div", a, b)


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q)."""
    return whole_quotient((p - q) * (p - q), q)


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank: per source of a language its gap to every other one (part pair) and its
    terms that stand out against the language (part term, the first top_terms).

    Terms are runs of letters A-Z and of characters beyond ASCII, A-Z in lower case. A group's share of a term is
    p = 1 + floor(10^9 * (n + 1) / (N + V)): n its occurrences, N those of all kept terms, V their number in the language.
    A gap is floor((p - q)^2 / q). The pair sum runs over all kept terms, but only terms that both groups have are
    paired: a group's other terms meet the other group's share of an absent term, which depends on nothing but the
    term's count, so a histogram of counts per group stands for them, and V for the terms that neither has.
    Null text, language or source: ''. Equal rows count as often as they occur. A group without kept terms has only
    absent ones. A language without kept terms: pair values of 0, no term rows. Empty table: no rows.
    """
    columns = {"text_col": text_col, "lang_col": lang_col, "source_col": source_col}
    kept = materialize(kept_terms(docs, least_docs, **columns))
    groups = materialize(docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source")).distinct())
    languages = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("V"), F.sum("n").alias("LN"))
    entries = kept.select("lang", "term", F.col("n").alias("ln"), F.explode("by_source").alias("e")).select("lang", "term", "ln", "e.source", "e.n")
    histogram = materialize(entries.groupBy("lang", "source", "n").agg(F.count(F.lit(1)).alias("h")))
    totals = histogram.groupBy("lang", "source").agg(F.sum(F.col("n") * F.col("h")).alias("N"))
    none = F.lit(0).cast("long")
    stats = materialize(
        groups.join(languages, "lang", "left").join(totals, ["lang", "source"], "left").select("lang", "source", F.coalesce("V", none).alias("V"), (F.coalesce("N", none) + F.coalesce("V", none)).alias("M"), (F.coalesce("LN", none) + F.coalesce("V", none)).alias("LM"))
    )
    return _terms_part(entries, stats, top_terms).unionByName(_pairs_part(kept, histogram, stats))


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def _terms_part(entries: DataFrame, stats: DataFrame, top: int) -> DataFrame:
    shares = entries.join(stats, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("M"))).withColumn("q", share(F.col("ln"), F.col("LM"))).where("p > q")
    return _ranked(shares.select("lang", "source", F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value")), "term").where(F.col("rank") <= top)


def _pairs_part(kept: DataFrame, histogram: DataFrame, stats: DataFrame) -> DataFrame:
    """Sums over four kinds of terms, each in proportion to what the groups have: of neither, of one, of the other, of both."""
    none = F.lit(0).cast("long")
    known = stats.withColumn("p0", F.when(F.col("V") > 0, share(none, F.col("M"))))
    a = known.select("lang", F.col("source").alias("a"), "V", F.col("M").alias("Ma"), F.col("p0").alias("a0"))
    b = known.select("lang", F.col("source").alias("b"), F.col("M").alias("Mb"), F.col("p0").alias("b0"))
    grid = a.join(b, "lang").where("a <> b")
    absent = gap(F.col("a0"), F.col("b0"))
    base = grid.select("lang", "a", "b", F.coalesce(F.col("V") * absent, none).alias("value"))
    mine = grid.join(histogram.withColumnRenamed("source", "a"), ["lang", "a"]).withColumn("pa", share(F.col("n"), F.col("Ma")))
    theirs = grid.join(histogram.withColumnRenamed("source", "b"), ["lang", "b"]).withColumn("pb", share(F.col("n"), F.col("Mb")))
    first = kept.select("lang", F.explode("by_source").alias("x"), "by_source")
    both = first.select("lang", "x", F.explode("by_source").alias("y")).where("x.source < y.source")
    # Terms of the same two counts add the same: the joint histogram of counts per pair of groups.
    met = both.groupBy("lang", F.col("x.source").alias("s"), F.col("y.source").alias("t"), F.col("x.n").alias("ns"), F.col("y.n").alias("nt")).agg(F.count(F.lit(1)).alias("h"))
    sides = F.explode(F.array(F.struct(F.col("s").alias("a"), F.col("t").alias("b"), F.col("ns").alias("na"), F.col("nt").alias("nb")), F.struct(F.col("t").alias("a"), F.col("s").alias("b"), F.col("nt").alias("na"), F.col("ns").alias("nb"))))
    met = met.select("lang", "h", sides.alias("e")).select("lang", "h", "e.*").join(a, ["lang", "a"]).join(b, ["lang", "b"])
    met = met.withColumn("pa", share(F.col("na"), F.col("Ma"))).withColumn("pb", share(F.col("nb"), F.col("Mb")))
    pa, pb, a0, b0 = F.col("pa"), F.col("pb"), F.col("a0"), F.col("b0")
    parts = [
        base,
        mine.select("lang", "a", "b", (F.col("h") * (gap(pa, b0) - absent)).alias("value")),
        theirs.select("lang", "a", "b", (F.col("h") * (gap(a0, pb) - absent)).alias("value")),
        met.select("lang", "a", "b", (F.col("h") * (gap(pa, pb) - gap(pa, b0) - gap(a0, pb) + absent)).alias("value")),
    ]
    sums = parts[0]
    for p in parts[1:]:
        sums = sums.union(p)
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    return _ranked(sums.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value"), "pair")


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents
), g AS (SELECT DISTINCT lang, source FROM d), w AS (SELECT k, lang, source, unnest(ts) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS ln FROM w GROUP BY lang, term HAVING count(DISTINCT k) >= 3),
c AS (SELECT w.lang, source, w.term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
l AS (SELECT lang, count(*) AS v, sum(ln) AS all_n FROM kept GROUP BY lang),
t AS (SELECT lang, source, sum(n) AS own_n FROM c GROUP BY lang, source),
p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, CAST(1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(own_n, 0) + v) AS HUGEINT) AS p,
         CAST(1 + (1000000000::HUGEINT * (ln + 1)) // (all_n + v) AS HUGEINT) AS q
  FROM g JOIN kept USING (lang) JOIN l USING (lang) LEFT JOIN t ON t.lang = g.lang AND t.source = g.source LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
), pairs AS (
  SELECT x.lang, x.source, y.source AS item, coalesce(s, 0) AS value
  FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN (SELECT a.lang, a.source AS sa, b.source AS sb, sum((a.p - b.p) * (a.p - b.p) // b.p) AS s FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term GROUP BY ALL) z
    ON z.lang = x.lang AND sa = x.source AND sb = y.source
), tops AS (SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM p WHERE n > 0 AND p > q),
r AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM tops
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= 200
"""
