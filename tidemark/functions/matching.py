"""Entity resolution: which search result is the series that was looked for.

Rows are pairs of a query and one of its search results, with pos, the
result's place; open_...() find the pairs of two whole tables themselves. Every rule scores pairs natively and keeps the best with a
grouped maximum, so a query's results never meet in one task but as a maximum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text
from .similar import Likeness, pairs as alike


def search_hits(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    """Pairs that share a word: queries (query, title), candidates (cand_title, pos, ...)."""
    return alike(queries, candidates, text.words(text.spaced(F.col("title"))), text.words(text.spaced(F.col("cand_title"))), Likeness("any", 0.0)).drop("score")


def _same_form(queries: DataFrame, candidates: DataFrame, form: Column, forms: Column) -> DataFrame:
    """Pairs of queries of a single word with candidates one of whose forms equals it."""
    q = queries.withColumn("_f", form).filter((F.size(F.split("_f", " ")) == 1) & (F.col("_f") != ""))
    c = candidates.withColumn("_f", F.explode(F.array_distinct(forms)))
    return q.join(c, "_f").drop("_f")


def open_dice_match(queries: DataFrame, candidates: DataFrame, least: float = 0.4) -> DataFrame:
    """dice_match() of all queries (query, title) with all candidates (cand_title, pos, slug), however many: only pairs that can reach `least` meet."""
    q, c = text.spaced(F.col("title")), text.spaced(F.col("cand_title"))
    near = alike(queries.filter(F.size(F.split(q, " ")) > 1), candidates, text.bigrams(q), text.bigrams(c), Likeness("dice", least)).drop("score")
    same = _same_form(queries, candidates, q, F.array(c, text.spaced(text.slug_title(F.col("slug")))))
    return dice_match(near.unionByName(same), least)


def open_jaccard_match(queries: DataFrame, candidates: DataFrame, least: float = 0.4) -> DataFrame:
    """jaccard_match() of all queries with all candidates; each form of a candidate is matched by itself, and the rule takes the best."""
    q = text.stripped(F.col("title"))
    forms = F.transform(F.concat(text.split_joined(F.col("cand_title")), F.array(text.slug_title(F.col("slug")))), text.stripped)
    each = candidates.withColumn("_form", F.explode(F.array_distinct(forms)))
    near = alike(queries.filter(F.size(F.split(q, " ")) > 1), each, F.split(q, " "), F.split("_form", " "), Likeness("jaccard", least)).drop("score", "_form")
    return jaccard_match(near.unionByName(_same_form(queries, candidates, q, forms)), least)


def best(pairs: DataFrame, score: Column, least: Column | float, order: Column | None = None) -> DataFrame:
    """(query, cand_title, score): the highest score of each query, the first in order among equals, if it reaches `least`."""
    at = F.col("pos") if order is None else order
    scored = pairs.withColumn("_s", score).filter(F.col("_s") > 0)
    limit = F.lit(least) if isinstance(least, float) else least
    top = scored.withColumn("_least", limit).groupBy("query").agg(F.max(F.struct(F.col("_s"), (-at).alias("_at"), "cand_title", "_least")).alias("b"))
    return top.filter("b._s >= b._least").select("query", F.col("b.cand_title").alias("cand_title"), F.round("b._s", 6).alias("score"))


def first_where(pairs: DataFrame, condition: Column) -> DataFrame:
    """(query, cand_title, score 1): the first result that meets the condition."""
    top = pairs.filter(condition).groupBy("query").agg(F.min(F.struct("pos", "cand_title")).alias("b"))
    return top.select("query", F.col("b.cand_title").alias("cand_title"), F.lit(1.0).alias("score"))


def _guard(form: Column, strict_parity: bool) -> Column:
    """Titles without any ASCII word normalise to the empty text, which is like any other such title; unless strict_parity they match nothing."""
    return F.lit(True) if strict_parity else form != ""


def dice_match(pairs: DataFrame, least: float = 0.4, strict_parity: bool = False) -> DataFrame:
    """Bigram similarity; a title of a single word needs an equal title or slug."""
    q, c = text.spaced(F.col("title")), text.spaced(F.col("cand_title"))
    p = pairs.withColumns({"_q": q, "_c": c}).filter(_guard(F.col("_q"), strict_parity))
    single = F.size(F.split("_q", " ")) == 1
    same = (F.col("_c") == F.col("_q")) | (text.spaced(text.slug_title(F.col("slug"))) == F.col("_q"))
    many = best(p.filter(~single), text.dice(F.col("_q"), F.col("_c")), least)
    return many.unionByName(first_where(p.filter(single), same))


def jaccard_match(pairs: DataFrame, least: float = 0.4, strict_parity: bool = False) -> DataFrame:
    """Word overlap of the title with the titles run together in a result and with its slug; a single word needs an equal one."""
    p = pairs.withColumn("_q", text.stripped(F.col("title"))).filter(_guard(F.col("_q"), strict_parity))
    forms = F.concat(text.split_joined(F.col("cand_title")), F.array(text.slug_title(F.col("slug"))))
    p = p.withColumn("_f", F.transform(forms, text.stripped))
    single = F.size(F.split("_q", " ")) == 1
    scores = F.transform(F.col("_f"), lambda f: text.jaccard(F.col("_q"), f))
    many = best(p.filter(~single), F.array_max(scores), least)
    return many.unionByName(first_where(p.filter(single), F.array_contains(F.col("_f"), F.col("_q"))))


def edit_match(pairs: DataFrame, strict_parity: bool = False) -> DataFrame:
    """Contained or near by edits; 0.5 is enough for a single word and 0.6 otherwise."""
    q, c = text.stripped_inside(F.col("title")), text.stripped_inside(F.col("cand_title"))
    p = pairs.withColumns({"_q": q, "_c": c}).filter(_guard(F.trim("_q"), strict_parity))
    n = F.size(F.filter(F.split("_q", r"\s+"), lambda w: w != ""))
    return best(p, text.edit_score(F.col("_q"), F.col("_c")), F.when(n == 1, 0.5).otherwise(0.6))


def exact_or_jaccard_match(pairs: DataFrame, least: float = 0.7) -> DataFrame:
    """A result equal to a variant by title or slug, the first such; else word overlap."""
    v = F.filter(F.transform("variants", text.spaced), lambda x: x != "")
    forms = F.array(text.spaced(F.col("cand_title")), text.spaced(text.slug_title(F.col("slug"))))
    p = pairs.withColumns({"_v": v, "_f": forms})
    equal = first_where(p, F.exists("_f", lambda f: (f != "") & F.array_contains(F.col("_v"), f)))
    rest = p.join(equal.select("query"), "query", "left_anti")
    scores = F.flatten(F.transform("_f", lambda f: F.transform("_v", lambda x: text.jaccard(x, f, False))))
    return equal.unionByName(best(rest, F.array_max(scores), least))


def id_match(pairs: DataFrame) -> DataFrame:
    """The first result that names the series' external id; a missing id or 0 matches nothing."""
    return first_where(pairs, (F.col("mal_id") != 0) & (F.col("mal_id").cast("string") == F.col("cand_mal")))


def titles_match(pairs: DataFrame, stop: float = 0.7, least: float = 0.4) -> DataFrame:
    """Several titles of a query in turn (step): the best bigram score so far carries over, and titles after one that brought it to `stop` aren't tried; a single-word title with an equal result or slug ends the search there and then."""
    q, c = text.spaced(F.col("title")), text.spaced(F.col("cand_title"))
    p = pairs.withColumns({"_q": q, "_c": c}).filter(F.col("_q") != "")
    single = F.size(F.split("_q", " ")) == 1
    equal = (F.col("_c") == F.col("_q")) | (text.spaced(text.slug_title(F.col("slug"))) == F.col("_q"))
    p = p.withColumn("_s", F.when(single, F.when(equal, 1.0).otherwise(0.0)).otherwise(text.dice(F.col("_q"), F.col("_c"))))
    reached = p.filter((F.col("_s") >= stop)).groupBy("query").agg(F.min("step").alias("_end"))
    p = p.join(reached, "query", "left").filter(F.col("_end").isNull() | (F.col("step") <= F.col("_end")))
    top = p.filter("_s > 0").groupBy("query").agg(F.max(F.struct("_s", (-F.col("step")).alias("a"), (-F.col("pos")).alias("b"), "cand_title")).alias("x"))
    return top.filter(F.col("x._s") >= least).select("query", F.col("x.cand_title").alias("cand_title"), F.round("x._s", 6).alias("score"))


def verified(alternatives: Column, variants: Column, least: float = 0.7) -> Column:
    """Whether a page's alternative titles meet any variant; a page without any (null or empty) is taken as it is."""
    same = F.exists(alternatives, lambda a: F.exists(variants, lambda v: (text.spaced(a) == text.spaced(v)) | (text.dice(text.spaced(a), text.spaced(v)) >= least)))
    return F.when(F.coalesce(F.size(alternatives), F.lit(0)) <= 0, True).otherwise(same)


#: SQL of the composite score over arrays s and r of significant words. cp(a, b) is the length of the common prefix.
def _cp(a: str, b: str) -> str:
    return f"aggregate(sequence(1, greatest(least(length({a}), length({b})), 1)), 0, (n, i) -> CASE WHEN n = i - 1 AND substr({a}, i, 1) = substr({b}, i, 1) THEN i ELSE n END)"


def composite_score() -> Column:
    """Weighted shares of words met exactly, partly, in order, missing and extra; see SCORE_TERMS."""
    inside = "(contains(b, a) OR contains(a, b))"
    partly = "((contains(b, a) AND length(a) > 3) OR (contains(a, b) AND length(b) > 3))"
    shorter = "least(length(a), length(b))"
    cp = _cp("a", "b")
    n, m = "greatest(size(s), 1)", "greatest(size(r), 1)"
    similar = f"exists(r, b -> {partly} OR ({shorter} >= 4 AND {cp} >= 4))"
    terms = {
        "exact": f"size(filter(s, a -> array_contains(r, a))) / {n}",
        "similar": f"size(filter(s, a -> {similar})) / {n}",
        "total": f"size(array_distinct(filter(s, a -> array_contains(r, a) OR {similar}))) / {n}",
        "long": f"coalesce(size(filter(s, a -> length(a) > 5 AND exists(r, b -> {inside} OR {cp} >= least(5, {shorter} - 1)))) / nullif(size(filter(s, a -> length(a) > 5)), 0), 0)",
        "unique": f"coalesce(size(filter(s, a -> length(a) > 7 AND exists(r, b -> {inside}))) / nullif(size(filter(s, a -> length(a) > 7)), 0), 0)",
        "missing": f"0.8D * size(filter(s, a -> NOT exists(r, b -> a = b OR {partly} OR {cp} >= least(4, 0.7D * {shorter})))) / {n}",
        "unmatched": f"size(filter(r, b -> NOT exists(s, a -> a = b OR {inside} OR {cp} >= 4))) / {m}",
        "extra": f"1.2D * size(filter(r, b -> length(b) > 6 AND NOT exists(s, a -> a = b OR {inside} OR {cp} >= 4))) / {m}",
        "order": f"""CASE WHEN size(s) > 1 THEN aggregate(transform(s, a -> coalesce(array_min(filter(transform(r, (b, i) -> CASE WHEN {inside} THEN i END), i -> i IS NOT NULL)), -1)),
            named_struct('last', -1, 'n', 0), (t, i) -> CASE WHEN i > t.last THEN named_struct('last', i, 'n', t.n + 1) ELSE t END, t -> t.n) / {n} ELSE 0 END""",
    }
    return F.expr(" + ".join(f"({w}D) * ({terms[k]})" for k, w in SCORE_TERMS.items()))


#: The weights of the composite score.
SCORE_TERMS = {"exact": 0.30, "total": 0.25, "long": 0.15, "similar": 0.10, "unique": 0.10, "order": 0.10, "unmatched": -0.15, "missing": -0.60, "extra": -0.50}


def composite_match(pairs: DataFrame, least: float = 0.3) -> DataFrame:
    """The composite score. One significant word: the first result whose only significant word it is. Otherwise the best, if it reaches `least`, and, for queries of at most two words, has no long word beyond the query's; the second best is never tried."""
    p = pairs.withColumn("_t", text.cleaned(F.col("title")))
    p = p.withColumns({"s": text.significant(F.col("_t")), "r": text.significant(text.cleaned(F.col("cand_title")))})
    one = first_where(p.filter("size(s) = 1"), F.expr("size(r) = 1 AND r[0] = s[0]"))
    scored = p.filter("size(s) <> 1").withColumn("_s", composite_score())
    cp = _cp("a", "b")
    more = F.expr(f"exists(r, b -> length(b) > 6 AND NOT exists(s, a -> a = b OR contains(b, a) OR contains(a, b) OR {cp} >= 4))")
    short = F.size(text.words(F.col("_t"))) <= 2
    top = scored.withColumn("_no", more & short).groupBy("query").agg(F.max(F.struct("_s", (-F.col("pos")).alias("at"), "cand_title", "_no")).alias("b"))
    many = top.filter((F.col("b._s") >= least) & ~F.col("b._no")).select("query", F.col("b.cand_title").alias("cand_title"), F.round("b._s", 6).alias("score"))
    return one.unionByName(many)
