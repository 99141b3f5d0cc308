"""Chapter numbers from texts, links and ids: the first pattern that hits, in a source's own order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Each source's patterns, in order. N is a number; (?i) ignores case.
N = r"(\d+(?:\.\d+)?)"
LINK_PATTERN = rf"/chapter/{N}"
PATTERNS = {
    "park": ((rf"(?i)chapter\s*{N}", rf"(?i)ch\.?\s*{N}", rf"(?i)ep\.?\s*{N}", rf"\b{N}\b"), (rf"(?i)chapter[-/]{N}",)),
    "weeb": ((rf"(?i)chapter[:\s-]*{N}", rf"(?i)ch[:\s.-]*{N}", rf"(?i)episode[:\s-]*{N}", rf"(?i)ep[:\s.-]*{N}", rf"#{N}", rf"\b{N}\b"), (N,)),
    "katana": ((rf"(?i)chapter\s*{N}", rf"(?i)ch\.?\s*{N}", rf"(?i)ep\.?\s*{N}", rf"(?i)c{N}", rf"\b{N}\b"), (rf"(?i)[/c]{N}$",)),
}


def number(t: Column, pattern: str, group: int = 1) -> Column:
    """The pattern's number in t, or null."""
    return F.nullif(F.regexp_extract(t, pattern, group), F.lit("")).try_cast("double")


def prefix_number(t: Column) -> Column:
    """The number that a text begins with (`10a` is 10); null without one."""
    return number(t, r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)")


def by_patterns(source: str, title: Column, link: Column, given: Column | None = None) -> Column:
    """given, if it is a number; else the source's patterns over the title, then over the link or id."""
    over_title, over_link = PATTERNS[source]
    tries = [number(title, p) for p in over_title] + [number(link, p) for p in over_link]
    return F.coalesce(*([given] if given is not None else []), *tries)


def from_path(link: Column) -> Column:
    return number(link, LINK_PATTERN)


def from_title_or_id(title: Column, ident: Column) -> Column:
    """`chapter N` of the title, else `chapter-N[-M]` of the id (N.M), else 0."""
    m = F.regexp_extract(ident, r"(?i)chapter-(\d+(?:-\d+)?)", 1)
    return F.coalesce(number(title, rf"(?i)chapter[:\s]*{N}"), F.nullif(F.regexp_replace(m, "^([0-9]+)-", "$1."), F.lit("")).try_cast("double"), F.lit(0.0))


def from_markup(raw: Column, link: Column) -> Column:
    """The first number of the raw text, else `chapter-N` or `chapter-N-M` (N.M) of the link."""
    pattern = r"(?i)chapter[-_/]?(\d+)(?:[-.](\d+))?"
    whole, part = F.regexp_extract(link, pattern, 1), F.regexp_extract(link, pattern, 2)
    by_link = F.nullif(F.when(part != "", F.concat(whole, F.lit("."), part)).otherwise(whole), F.lit("")).try_cast("double")
    return F.coalesce(number(raw, N), by_link)
