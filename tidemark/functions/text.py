"""Title functions as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that carry no meaning in a title; the shorter list serves keyword searches.
COMMON_WORDS = (
    "the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for",
    "of", "with", "by", "from", "as", "is", "was", "are", "were", "be",
    "been", "being", "have", "has", "had", "do", "does", "did", "will",
    "would", "should", "could", "may", "might", "must", "can",
)
STOP_WORDS = (
    "the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for",
    "of", "with", "by", "from", "as", "is", "was", "are", "were", "be",
    "been", "being", "have", "has", "had", "do", "does", "did",
)

#: White space beyond ASCII, which a JavaScript \\s matches and Java's doesn't.
WIDE_SPACES = "                 　﻿"


def plain_spaces(t: Column) -> Column:
    return F.translate(t, WIDE_SPACES, " " * len(WIDE_SPACES))


def squeeze(t: Column) -> Column:
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def spaced(t: Column) -> Column:
    """Lower case; what is neither ASCII word nor white space becomes a space."""
    return squeeze(F.regexp_replace(plain_spaces(F.lower(t)), r"[^\w\s]", " "))


def stripped(t: Column) -> Column:
    """Lower case; what is neither ASCII word nor white space goes."""
    return squeeze(F.regexp_replace(plain_spaces(F.lower(t)), r"[^\w\s]", ""))


def stripped_inside(t: Column) -> Column:
    """Like stripped(), but trimmed before marks go: a space beside a lost mark at the edge stays."""
    return F.regexp_replace(F.regexp_replace(F.trim(plain_spaces(F.lower(t))), r"[^\w\s]", ""), r"\s+", " ")


def cleaned(t: Column) -> Column:
    """For the composite score: apostrophe suffixes, hyphens and a leading article go as well. Curly apostrophes are plain marks."""
    t = F.regexp_replace(plain_spaces(F.lower(t)), r"['`]\w*", "")
    t = F.regexp_replace(F.regexp_replace(t, "[-_]", " "), r"^the\s+", "")
    return squeeze(F.regexp_replace(t, r"[^\w\s]", ""))


def words(t: Column) -> Column:
    return F.filter(F.split(t, " "), lambda w: w != "")


def significant(t: Column) -> Column:
    """Words of a cleaned title with three letters or more that carry meaning."""
    common = F.array(*[F.lit(w) for w in COMMON_WORDS])
    return F.filter(F.split(t, " "), lambda w: (F.length(w) > 2) & ~F.array_contains(common, w))


def longest_words(t: Column, most: int = 3) -> Column:
    """The longest words of four letters or more, longest first, equal ones in order; without any the trimmed title."""
    stop = F.array(*[F.lit(w) for w in STOP_WORDS])
    bare = F.transform(F.split(F.regexp_replace(plain_spaces(F.lower(t)), r"[^\w\s']", " "), r"\s+"), lambda w: F.when(F.instr(w, "'") > 1, F.substring_index(w, "'", 1)).otherwise(w))
    kept = F.filter(bare, lambda w: (F.length(w) > 3) & ~F.array_contains(stop, w))
    ranked = F.array_sort(F.transform(kept, lambda w, i: F.struct((-F.length(w)).alias("n"), i.alias("i"), w.alias("w"))))
    top = F.array_join(F.transform(F.slice(ranked, 1, most), lambda x: x["w"]), " ")
    return F.when(F.size(kept) == 0, F.trim(t)).otherwise(top)


def longest_word(t: Column, least: int = 5) -> Column:
    """The first of the longest words of `least` letters or more; null without any."""
    kept = F.filter(F.split(F.regexp_replace(plain_spaces(F.lower(t)), r"[^\w\s]", " "), r"\s+"), lambda w: F.length(w) >= least)
    return F.when(F.size(kept) > 0, F.aggregate(kept, F.lit(""), lambda best, w: F.when(F.length(w) > F.length(best), w).otherwise(best)))


def first_words(t: Column, n: int = 3) -> Column:
    return F.array_join(F.slice(F.split(F.trim(t), r"\s+"), 1, n), " ")


def truncated(t: Column, least: int = 5) -> Column:
    """The title up to its first mark, if at least `least` characters come before it."""
    head = F.trim(F.regexp_extract(t, r"^([\w\s]+)", 1))
    return F.when(F.length(head) >= least, head).otherwise(t)


def split_joined(t: Column) -> Column:
    """Titles run together, cut where a capital follows a small letter."""
    parts = F.filter(F.transform(F.split(t, "(?<=[a-z])(?=[A-Z])"), lambda x: F.trim(x)), lambda x: x != "")
    return F.when(F.size(parts) > 0, parts).otherwise(F.array(t))


def slug(path: Column) -> Column:
    """The last part of an id or URL path; the whole if that part is empty."""
    last = F.element_at(F.split(path, "/"), -1)
    return F.when(last == "", path).otherwise(last)


def slug_title(s: Column) -> Column:
    return F.regexp_replace(s, "-", " ")


def decoded(t: Column) -> Column:
    """Percent-decoded, a plus left as it is; null where that can't be."""
    return F.try_url_decode(F.replace(t, F.lit("+"), F.lit("%2B")))


def rendered(t: Column) -> Column:
    """The text that an HTML fragment shows: without tags, every entity decoded, trimmed. Only the standard library knows all entities, so this one function runs in Python, over Arrow batches."""

    @F.arrow_udf("string")
    def unescape(texts):
        import html

        import pyarrow as pa

        return pa.array([None if x is None else html.unescape(x) for x in texts.to_pylist()], pa.string())

    return F.regexp_replace(plain_spaces(unescape(F.regexp_replace(t, r"</?[A-Za-z][^<>]*>", ""))), r"^\s+|\s+$", "")


def url_slug(url: Column, part: str, stop: str = "/?#") -> Column:
    """What follows /part/ in a URL up to a character of `stop`, decoded, hyphens and underscores as spaces; null without such a part, or where it can't be decoded."""
    raw = F.regexp_extract(url, rf"(?i)/{part}/([^{stop}]+)", 1)
    return F.regexp_replace(decoded(F.nullif(raw, F.lit(""))), "[-_]+", " ")


def jaccard(a: Column, b: Column, empty_is_word: bool = True) -> Column:
    """Of the words of two normalised titles. empty_is_word: an empty title has one empty word; otherwise none, and scores 0."""
    x, y = (F.array_distinct(F.split(t, " ") if empty_is_word else words(t)) for t in (a, b))
    n = F.size(F.array_union(x, y))
    return F.when((a == b) & F.lit(empty_is_word), 1.0).when(n == 0, 0.0).otherwise(F.size(F.array_intersect(x, y)) / n)


def bigrams(t: Column) -> Column:
    """The distinct pairs of neighbouring characters; none in texts of under two."""
    places = F.sequence(F.lit(1), F.greatest(F.length(t) - 1, F.lit(1)))
    return F.array_distinct(F.filter(F.transform(places, lambda i: F.substring(t, i, F.lit(2))), lambda g: F.length(g) == 2))


def dice(a: Column, b: Column) -> Column:
    x, y = bigrams(a), bigrams(b)
    some = (F.size(x) > 0) & (F.size(y) > 0)
    return F.when(some, 2 * F.size(F.array_intersect(x, y)) / (F.size(x) + F.size(y))).otherwise(F.when(a == b, 1.0).otherwise(0.0))


def edit_score(query: Column, title: Column) -> Column:
    """1 if equal, 0.95 if the title contains the query, else 0.7 * share of query words met + 0.3 * edit similarity."""
    q, t = F.filter(F.split(query, r"\s+"), lambda w: w != ""), F.split(title, r"\s+")
    met = F.size(F.filter(q, lambda w: F.exists(t, lambda x: F.contains(x, w))))
    near = 1 - F.levenshtein(query, title) / F.greatest(F.length(query), F.length(title))
    return F.when(query == title, 1.0).when(F.contains(title, query), 0.95).otherwise(met / F.size(q) * 0.7 + near * 0.3)


def absolute(href: Column, base: Column, always_slash: bool = True) -> Column:
    """href as an absolute URL; always_slash puts one between the base and a path that doesn't begin with it."""
    gap = F.when(F.startswith(href, F.lit("/")) | F.lit(not always_slash), "").otherwise("/")
    return F.when(F.startswith(href, F.lit("http")), href).otherwise(F.concat(base, gap, href))


def url_component(t: Column) -> Column:
    """Percent-encoded, spaces as %20, and the marks that browsers leave alone as they are."""
    out = F.url_encode(t)
    for code, mark in (("+", "%20"), ("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~")):
        out = F.replace(out, F.lit(code), F.lit(mark))
    return out


def variants(titles: Column, most: int | None = 3) -> Column:
    """The first titles (None: all) of an array whose normalised forms are new, not empty and hold a Latin letter."""
    forms = F.transform(titles, lambda t, i: F.struct(spaced(t).alias("f"), i.alias("i"), t.alias("t")))
    good = F.filter(forms, lambda x: x["f"].rlike("[a-z]"))
    new = F.filter(good, lambda x: ~F.exists(good, lambda y: (y["f"] == x["f"]) & (y["i"] < x["i"])))
    kept = F.transform(new, lambda x: x["t"])
    return kept if most is None else F.slice(kept, 1, most)


def alternatives(main: Column, listed: Column) -> Column:
    """The main title and those of a list parted by semicolons, trimmed, empty ones dropped."""
    return F.array_prepend(F.filter(F.transform(F.split(F.coalesce(listed, F.lit("")), ";"), lambda x: F.trim(x)), lambda x: x != ""), main)
