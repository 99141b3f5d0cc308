"""Series of HTML search pages, by the rules of each kind of site: (page_id, pos, title, link or id).

Every page is parsed once; which elements count, where a title stands and
which repeats go are column expressions over its elements. All windows and
groups are by page, so one exchange serves a whole search; the grid, with most
links a page, is worked out within each page's row and needs none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import text

from . import html as h
from .extract import by_box, first_by, first_in, own


def _attr(name: str) -> Column:
    return F.coalesce(F.col("attrs")[name], F.lit(""))


def _bare(t: Column) -> Column:
    """Without white space at the edges, as browsers trim."""
    return F.regexp_replace(text.plain_spaces(t), r"^\s+|\s+$", "")


def _trimmed(t: Column) -> Column:
    """_bare(); null if nothing is left."""
    return F.nullif(_bare(t), F.lit(""))


def _squeezed(t: Column) -> Column:
    return F.regexp_replace(text.plain_spaces(t), r"\s+", " ")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out once, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _inner(where: Column) -> Column:
    return where & (F.col("pos") != F.col("box"))


def _first(where: Column, *values: Column | str) -> Column:
    """first_in() among the elements inside a box."""
    return first_in(_inner(where), *values)


def _joined(where: Column) -> Column:
    """The texts of all elements of a box that meet the condition, one after the other; null if they are blank."""
    found = F.array_sort(F.collect_list(F.when(_inner(where), F.struct("pos", "text"))))
    return _trimmed(F.array_join(F.transform(found, lambda x: x["text"]), ""))


def theme_search(pages: DataFrame, base: str, prefixes: tuple[str, ...]) -> DataFrame:
    """Sites of the common theme: links below one of the prefixes, the first of each slug; title from the link's title, its image, its text or the slug."""
    img = _first(h.marked("img"), F.col("attrs")["alt"].alias("alt"))
    a = by_box(h.elements(pages, marks={"a": "a", "img": "img"}), h.marked("a"), a=own(_attr("href").alias("href"), _attr("title").alias("given"), "text"), img=img)
    full = text.absolute(F.col("a.href"), F.lit(base))
    a = a.filter("a.href <> ''").withColumn("_path", F.when(F.startswith(full, F.lit(base)), F.substring(full, len(base) + 1, F.length(full))))
    a = a.withColumn("_prefix", F.coalesce(*[F.when(F.startswith("_path", F.lit(p)), F.lit(p)) for p in prefixes]))
    a = first_by(a.withColumn("slug", F.substring_index(F.expr("substr(_path, length(_prefix) + 1)"), "/", 1)).filter("slug <> ''"), "slug")
    title = F.coalesce(_trimmed(F.col("a.given")), _trimmed(F.col("img.alt")), _trimmed(_squeezed(F.col("a.text"))), text.slug_title(F.col("slug")))
    return a.select("page_id", "pos", title.alias("title"), "slug", F.concat(F.lit(base), "_prefix", "slug", F.lit("/")).alias("link"))


def grid_search(pages: DataFrame, base: str, most: int = 10) -> DataFrame:
    """Links to comics, not to chapters, inside the page's grid: two columns wide if there is such, else any grid, else the whole page. Titles have 1 to 199 characters; the first of each link, at most `most` a page."""
    grids = (".grid.grid-cols-2", ".grid", "[class*='grid']")
    marks = {"link": "a[href*='comics/']", "bold": "span.block.font-bold", "img": "img"} | {f"grid{i}": g for i, g in enumerate(grids)} | {f"in{i}": f"{g} a[href*='comics/']" for i, g in enumerate(grids)}
    e = h.by_page(pages, ("href", "title", "alt"), marks=marks, texts=("link", "bold"))
    all_ = F.aggregate("e", F.lit(0).cast("long"), lambda bits, x: bits.bitwiseOR(x["marks"]))

    def is_link(x: Column, all_: Column) -> Column:
        within = h.met(x["marks"], marks, "link")
        for i in reversed(range(len(grids))):
            within = F.when(h.met(all_, marks, f"grid{i}"), h.met(x["marks"], marks, f"in{i}")).otherwise(within)
        return within & ~F.contains(x["href"], F.lit("/chapter/"))

    def titled(b: Column) -> Column:
        img = F.get(b["imgs"], F.lit(0))
        given = [F.when(t != "", t) for t in (b["a"]["title"], b["bold"], img["alt"], img["title"])]
        title = F.trim(_squeezed(F.coalesce(*given, b["a"]["text"])))
        return F.struct(b["a"]["pos"].alias("pos"), title.alias("title"), text.absolute(b["a"]["href"], F.lit(base)).alias("link"))

    def parts(a: Column, inner: Column) -> Column:
        bold = F.transform(F.filter(inner, lambda x: h.met(x["marks"], marks, "bold")), lambda x: x["text"])
        return F.struct(a.alias("a"), _let(bold, lambda t: F.when(F.size(t) > 0, _bare(F.array_join(t, "")))).alias("bold"), F.filter(inner, lambda x: h.met(x["marks"], marks, "img")).alias("imgs"))

    def boxes(e: Column, at: Column) -> Column:
        """The links at these places, each with what stands in it, up to the next one."""
        cut = F.transform(at, lambda i, k: F.struct(F.get(e, i).alias("a"), F.slice(e, i + 2, F.coalesce(F.get(at, k + 1), F.size(e)) - i - 1).alias("after")))
        return F.transform(cut, lambda b: parts(b["a"], F.filter(b["after"], lambda x: x["pos"] < b["a"]["end"])))

    def add(kept: Column, r: Column) -> Column:
        new = F.length(r["title"]).between(1, 199) & ~F.exists(kept, lambda x: x["link"] == r["link"])
        return F.when(new, F.concat(kept, F.array(r))).otherwise(kept)

    none = F.array().cast("array<struct<pos:int,title:string,link:string>>")
    at = _let(all_, lambda all_: F.filter(F.transform("e", lambda x, i: F.when(is_link(x, all_), i)), lambda i: i.isNotNull()))
    found = _let(F.struct("e", at.alias("at")), lambda x: boxes(x["e"], x["at"]))
    rows = F.aggregate(found, none, lambda kept, b: F.when(F.size(kept) >= most, kept).otherwise(_let(titled(b), lambda r: add(kept, r))))
    return e.select("page_id", F.inline(rows))


def row_search(pages: DataFrame, base: str) -> DataFrame:
    """Rows of a result list with their first link to a title; without any row, every such link. The first of each link counts, even if it has no title and goes."""
    row, link = h.marked("row"), h.marked("link")
    marks = {"row": "div[class*='flex border-b border-b-base-200 pb-5']", "link": "a[href*='/title/']", "named": "h3, h4, .title, .name"}
    e = h.elements(pages, marks=marks, texts=("link", "named")).withColumn("_listed", F.max(row).over(Window.partitionBy("page_id")))
    values = (_attr("href").alias("href"), F.col("text"), _attr("title").alias("given"))
    a = first_in(link, *values)  # the box itself, where links are boxes
    rows = by_box(e, F.when(F.col("_listed"), row).otherwise(link), a=a, named=_first(h.marked("named"), F.col("text"))).filter("a IS NOT NULL")
    title = F.coalesce(_trimmed(F.col("a.text")), _trimmed(F.col("named.text")), F.nullif("a.given", F.lit("")))
    rows = rows.select("page_id", "pos", title.alias("title"), text.absolute(F.col("a.href"), F.lit(base)).alias("link"))
    return first_by(rows, "link").filter("title IS NOT NULL")


def list_search(pages: DataFrame, base: str) -> DataFrame:
    """Items of the book list with the first link of their title. The first of each link counts, even if it has no text and goes."""
    e = h.elements(pages, marks={"item": "#book_list .item", "link": ".title a"}, texts=("link",))
    a = _first(h.marked("link"), _attr("href").alias("href"), F.col("text"))
    rows = by_box(e, h.marked("item"), a=a).filter("a.href <> ''")
    rows = rows.select("page_id", "pos", _trimmed(F.col("a.text")).alias("title"), text.absolute(F.col("a.href"), F.lit(base)).alias("link"))
    return first_by(rows, "link").filter("title IS NOT NULL")


def card_search(pages: DataFrame) -> DataFrame:
    """Cards with an id after /series/ in their first link, and a title from the wide layout's tooltip, else from the shortened text. Repeats stay."""
    marks = {"card": "article.bg-base-300", "link": "section a", "wide": "section.hidden.lg\\:block .tooltip a", "short": "section a .text-ellipsis"}
    e = h.elements(pages, marks=marks, texts=("wide", "short"))
    a = _first(h.marked("link"), _attr("href").alias("href"))
    rows = by_box(e, h.marked("card"), a=a, wide=_joined(h.marked("wide")), short=_joined(h.marked("short")))
    ident = F.get(F.split("a.href", "/series/"), F.lit(1))
    return rows.select("page_id", "pos", F.coalesce("wide", "short").alias("title"), ident.alias("id")).filter("id <> '' AND title IS NOT NULL")


def redirected(answers: DataFrame, base: str) -> DataFrame:
    """(page_id, query, status, location) of a search that led straight to a series: its link, and its title from the link, or the query where there is none. Other answers have no row."""
    link = text.absolute(F.col("location"), F.lit(base))
    rows = answers.filter((F.col("status") >= 300) & (F.col("status") < 400) & (F.coalesce("location", F.lit("")) != "")).withColumn("link", link)
    part = F.nullif(F.regexp_extract("link", "/manga/([^/]+)", 1), F.lit(""))
    title = F.trim(F.regexp_replace(text.slug_title(text.decoded(part)), r"\.\d+$", ""))
    return rows.select("page_id", F.coalesce(title, F.trim("query")).alias("title"), "link")
