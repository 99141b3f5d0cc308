"""Which sources of a language use other words than the others: distances of term distributions, and each source's own terms.

Each term is one wide row: an array of its counts, one place for each source of
its language. Higher-order functions in the JVM emit a contribution for each
pair of sources of which one has the term at least; partial aggregates sum them
before the shuffle. What the terms that a pair lacks add is a product, so no row
is made for them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize, partitions, ship, tidied

from .encoder import slices

#: The least number of documents, the added count, the scale of shares, terms reported.
LEAST_DOCS, ADDED, SCALE, TOP = 30, 5, 1_000_000_000, 50
#: Sources (over all languages) up to which their names and totals are broadcast; beyond, they meet the terms in a salted join.
BROADCAST_SOURCES = 100_000


def _counts(batches) -> Iterator:
    """(lang, source, term, n, df) summed over a batch: texts become words in bytes, as all that parts terms is ASCII."""
    import pyarrow as pa

    plain = bytes(c if c > 127 else c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 else 32 for c in range(256))
    names = ["lang", "source", "term", "n", "df"]
    for batch in batches:
        for piece in slices(batch, "text"):
            words = [t.encode().translate(plain).split() for t in piece.column("text").to_pylist()]
            places: dict[tuple[str, str], int] = {}
            group = np.array([places.setdefault(g, len(places)) for g in zip(piece.column("lang").to_pylist(), piece.column("source").to_pylist(), strict=True)])
            langs, sources = (pa.array(x, pa.string()) for x in zip(*places, strict=True))
            yield pa.RecordBatch.from_arrays([langs, sources, pa.nulls(len(places), pa.string()), *[pa.array(np.zeros(len(places), np.int64))] * 2], names=names)
            terms = pa.array([w for d in words for w in d], pa.binary()).dictionary_encode()
            if len(terms):
                v = len(terms.dictionary)
                of_doc, n = np.unique(np.repeat(np.arange(len(words)), [len(d) for d in words]) * v + terms.indices.to_numpy(), return_counts=True)
                of_group, back = np.unique(group[of_doc // v] * v + of_doc % v, return_inverse=True)
                which, term = pa.array(of_group // v), terms.dictionary.take(pa.array(of_group % v)).cast(pa.string())
                yield pa.RecordBatch.from_arrays([langs.take(which), sources.take(which), term, pa.array(np.bincount(back, n).astype(np.int64)), pa.array(np.bincount(back))], names=names)


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, df) summed over docs; each group has a row whose term is null, too."""
    ship(docs.sparkSession)
    plain = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    cells = plain.mapInArrow(_counts, "lang string, source string, term string, n long, df long")
    return cells.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def _share(count: str, total: str) -> str:
    """SQL of 1 + floor(SCALE * (count + ADDED) / (total + ADDED * v)); exact, as decimals."""
    return f"1 + (CAST({count} + {ADDED} AS DECIMAL(20, 0)) * CAST({SCALE} AS DECIMAL(10, 0))) div CAST({total} + {ADDED} * v AS DECIMAL(20, 0))"


def _with_language(rows: DataFrame, langs: DataFrame, sources: int, spread: Column) -> DataFrame:
    """rows JOIN langs on lang: by broadcast where `sources` is small, else each language goes to many tasks, which share its rows by `spread`."""
    if sources <= BROADCAST_SOURCES:
        return rows.join(F.broadcast(langs), "lang")
    k = partitions(rows.sparkSession)
    salted = langs.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(k)).cast("int")).join(salted, ["lang", "_salt"]).drop("_salt")


@tidied("langs", "vectors")
def divergence(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank from docs (lang, source, text).

    Terms are runs of ASCII letters, lowered, and of characters beyond ASCII.
    A lang keeps the V terms that at least `least` of its rows have. A group
    (lang, source) and each lang give each kept term the share p of count +
    ADDED in its total, in units of 1 / SCALE, rounded down, plus 1. Part
    `pair`: item is each other source of the lang, value the sum over kept
    terms of the distance of both shares, 0 where V is 0. Part `term`: item is
    each kept term that the group has and whose share there is above the
    lang's, value the difference, ranks up to `top` only. rank counts from 1 in
    each group and part, by value descending, then item.

    Null text, lang and source count as ''. Repeated rows count each. A lang of
    one source has no pairs. An empty table gives an empty result; other
    columns aren't read. Texts are read once; what is shuffled is one row for
    each lang, source and term of a task, then one for each kept term.
    """
    cells = materialize(term_counts(docs), "cells")
    names = cells.select("lang", "source").distinct()
    wide = cells.filter("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("df").alias("df"), F.collect_list(F.struct("source", "n")).alias("cells")).filter(F.col("df") >= least)
    wide = materialize(wide.select("lang", "term", "cells"), "wide")
    totals = wide.select("lang", F.inline("cells")).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    kept = wide.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    of_source = names.join(totals, ["lang", "source"], "left").select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"))
    langs = of_source.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("source", "total"))).alias("s"), F.sum("total").alias("all")).join(kept, "lang", "left")
    langs = materialize(langs.select("lang", F.col("s.source").alias("names"), F.col("s.total").alias("totals"), "all", F.coalesce("v", F.lit(0)).alias("v")), "langs")
    sources = langs.agg(F.sum(F.size("names"))).first()[0] or 0

    met = _with_language(wide, langs, sources, F.col("term")).withColumn("at", F.map_from_entries("cells"))
    counts = met.select("lang", "term", "totals", "all", "v", F.expr("transform(names, s -> coalesce(at[s], 0L))").alias("counts"))
    shares = F.expr(f"transform(counts, (c, i) -> {_share('c', 'get(totals, i)')})").alias("p")
    whole = F.expr(_share("aggregate(counts, 0L, (a, c) -> a + c)", "all")).alias("q")
    vectors = materialize(counts.select("lang", "term", "counts", shares, whole), "vectors")

    return _pairs(vectors, langs).unionByName(_terms(vectors, langs, top))


def _pairs(vectors: DataFrame, langs: DataFrame) -> DataFrame:
    has = vectors.select("lang", "counts", "p", F.posexplode("counts").alias("i", "c")).filter("c > 0")
    emitted = "transform(p, (x, j) -> struct(least(i, j) AS a, greatest(i, j) AS b, abs(x - get(p, i)) AS d, j <> i AND (j > i OR get(counts, j) = 0) AS mine))"
    seen = has.select("lang", F.inline(F.expr(f"filter({emitted}, x -> x.mine)"))).groupBy("lang", "a", "b").agg(F.sum("d").alias("d"), F.count(F.lit(1)).alias("n"))
    # of a pair, the other kept terms have the share of no occurrence in both
    none = langs.select("lang", "names", "v", F.expr(f"CASE WHEN v = 0 THEN transform(totals, t -> 0L) ELSE transform(totals, t -> {_share('0L', 't')}) END").alias("p0"))
    one = none.select("lang", "names", "v", "p0", F.posexplode("names").alias("a", "first"))
    both = one.select("lang", "a", "first", "v", F.inline(F.expr("filter(transform(names, (x, j) -> struct(j AS b, x AS second, abs(get(p0, a) - get(p0, j)) AS d0)), x -> x.b > a)")))
    nothing = F.lit(None)
    rows = both.select("lang", "a", "b", "first", "second", "v", "d0", F.lit(0).cast("long").alias("d"), F.lit(0).cast("long").alias("n")).unionByName(
        seen.select("lang", "a", "b", nothing.cast("string").alias("first"), nothing.cast("string").alias("second"), nothing.cast("long").alias("v"), nothing.cast("long").alias("d0"), "d", "n")
    )
    sums = rows.groupBy("lang", "a", "b").agg(*(F.max(c).alias(c) for c in ("first", "second", "v", "d0")), F.sum("d").alias("d"), F.sum("n").alias("n"))
    value = sums.select("lang", "first", "second", (F.col("d") + (F.col("v") - F.col("n")) * F.col("d0")).alias("value"))
    sides = value.select("lang", "value", F.inline(F.array(F.struct(F.col("first").alias("source"), F.col("second").alias("item")), F.struct(F.col("second").alias("source"), F.col("first").alias("item")))))
    return sides.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank"))


def _terms(vectors: DataFrame, langs: DataFrame, top: int) -> DataFrame:
    above = "filter(transform(counts, (c, i) -> struct(i, get(p, i) - q AS value, c)), x -> x.c > 0 AND x.value > 0)"
    rows = vectors.select("lang", F.col("term").alias("item"), F.inline(F.expr(above))).select("lang", "i", "item", "value")
    rank = F.row_number().over(Window.partitionBy("lang", "i").orderBy(F.desc("value"), "item"))
    best = rows.withColumn("rank", rank).filter(F.col("rank") <= top)
    names = langs.select("lang", F.posexplode("names").alias("i", "source"))
    return best.join(names, ["lang", "i"]).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
