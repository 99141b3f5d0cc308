"""Sources as plugins: what a source is, and the contract that an outcome keeps.

A source is a name, a type and a function from captured pages to chapter rows.
Every captured page gets one attempt row whose outcome is `chapters`, `empty`
(read, and nothing was there) or `error` (a bad status, a challenge, or an
answer that can't be read); a breakage is never an empty result, and no page
goes missing. An extractor of columns reads as null what it can't read. One that
is a Python function of a page may raise: then that page is an `error`, and
costs no other.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize, ship

from . import extract, searches
from . import html as h

Extract = Callable[[DataFrame, Column], DataFrame]
Search = Callable[[DataFrame], DataFrame]
#: (html, url) -> (chapter number, link, release date or None) of each chapter of a page.
Read = Callable[[str, str], Iterable[tuple[float, str, datetime.datetime | None]]]


@dataclass(frozen=True)
class Source:
    """extract: (pages (page_id, url, html), now) -> rows with page_id, chapter_number, link, release_date, and, if pages can fail, error: a page with one is an error. search: search pages (page_id, url, html) -> rows with page_id, pos, title and a link or id."""

    name: str
    type: str
    extract: Extract
    enabled: bool = True
    search: Search | None = None


def theme_site(name: str, base: str, type: str = "manhwa", enabled: bool = True, prefixes: tuple[str, ...] = ("/manga/",)) -> Source:
    """A site of the common theme: configuration is all that it needs."""
    return Source(name, type, lambda pages, now: extract.theme_pages(pages, base, now), enabled, lambda pages: searches.theme_search(pages, base, prefixes))


def divided_site(name: str, base: str, type: str = "manhwa", enabled: bool = True) -> Source:
    return Source(name, type, lambda pages, now: extract.divided_list(pages, base, now).select(*extract.ROW), enabled, lambda pages: searches.grid_search(pages, base))


def boxed_site(name: str, base: str, patterns: str, box: str, fallback: bool = False, type: str = "multiple", enabled: bool = True, search: Search | None = None) -> Source:
    return Source(name, type, lambda pages, now: extract.boxed_list(pages, base, patterns, box, "/chapter/", now, fallback), enabled, search)


def fragment_site(name: str, base: str, type: str = "multiple", enabled: bool = True) -> Source:
    return Source(name, type, lambda pages, now: extract.fragment_list(pages, base), enabled, searches.card_search)


def read_pages(pages: DataFrame, read: Read) -> DataFrame:
    """(page_id, chapter_number, link, release_date, error) by a Python function of each page (page_id, url, html); a page for which it raises, or gives what is no chapter, has one row with its error."""
    ship(pages.sparkSession)

    def one(page, url, html) -> list[tuple]:
        import pyarrow as pa

        try:
            rows = [(page, float(n), str(link), when, None) for n, link, when in read(html or "", url or "")]
            pa.array([r[3] for r in rows], pa.timestamp("us")), [r[2].encode() for r in rows]  # what a batch can't hold raises here
            return rows
        except Exception as error:  # noqa: BLE001  whatever it is, it is this page's
            return [(page, None, None, None, f"{type(error).__name__}: {error}"[:300])]

    def run(batches) -> Iterator:
        import pyarrow as pa

        kinds = (pa.int64(), pa.float64(), pa.string(), pa.timestamp("us"), pa.string())
        names = [*extract.ROW, "error"]
        for batch in batches:
            rows: list[tuple] = []
            for page, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
                rows += one(page, url, html)
                if len(rows) > 5000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, chapter_number double, link string, release_date timestamp_ntz, error string")


def page_site(name: str, read: Read, type: str = "multiple", enabled: bool = True, search: Search | None = None) -> Source:
    """A site whose pages a Python function reads."""
    return Source(name, type, lambda pages, now: read_pages(pages, read), enabled, search)


def registered(sources: list[Source]) -> list[tuple[str, str, bool, int]]:
    """(name, type, enabled, idx) as selection.compatible() takes them; a name stands once."""
    if len({s.name for s in sources}) < len(sources):
        raise ValueError("two sources have one name")
    return [(s.name, s.type, s.enabled, i) for i, s in enumerate(sources)]


def _key(name: str) -> str:
    return "".join(name.lower().split())


def lookup(sources: list[Source], name: str) -> Source | None:
    """The source of that name, whatever its case and spaces; the last of several."""
    return next((s for s in reversed(sources) if _key(s.name) == _key(name)), None)


def switched(sources: list[Source], name: str, enabled: bool) -> list[Source]:
    """The sources with that one on or off; an unknown name changes nothing."""
    return [replace(s, enabled=enabled) if _key(s.name) == _key(name) else s for s in sources]


def find(source: Source, captures: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(answers (page_id, provider, outcome, found, blank), candidates) of captured search pages (page_id, url, status, html).

    outcome is `found`, `empty` or `error`, one row a page; blank marks an
    answer too short to be one, which is worth another try. Candidates of
    pages with outcome error don't count.
    """
    if source.search is None:
        raise ValueError(f"{source.name} has no search")
    met = source.search(captures.select("page_id", "url", "html"))
    state = h.outcomes(captures, met).withColumn("outcome", F.when(F.col("outcome") == "chapters", "found").otherwise(F.col("outcome")))
    hit = F.col("outcome") == "found"
    answers = state.select("page_id", F.lit(source.name).alias("provider"), "outcome", F.when(hit, F.col("rows")).otherwise(0).alias("found"), "blank")
    return answers, met.join(state.filter(hit).select("page_id"), "page_id", "left_semi").withColumn("provider", F.lit(source.name))


def scrape(source: Source, captures: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """(attempts (page_id, provider, outcome, chapters, blank), rows) of captures (page_id, url, status, html). Rows of pages with outcome error don't count."""
    found = source.extract(captures.select("page_id", "url", "html"), now)
    if "error" in found.columns:
        found = materialize(found, "found")  # a page is read once
        failed = found.filter("error IS NOT NULL").select("page_id").distinct()
        found = found.filter("error IS NULL").select(*extract.ROW)
        state = h.outcomes(captures, found).join(failed.withColumn("_failed", F.lit(True)), "page_id", "left")
        state = state.withColumn("outcome", F.when(F.col("_failed"), "error").otherwise(F.col("outcome")))
    else:
        state = h.outcomes(captures, found)
    attempts = state.select("page_id", F.lit(source.name).alias("provider"), "outcome", F.when(F.col("outcome") == "chapters", F.col("rows")).otherwise(0).alias("chapters"), "blank")
    rows = found.join(state.filter("outcome = 'chapters'").select("page_id"), "page_id", "left_semi").withColumn("provider", F.lit(source.name))
    return attempts, rows
