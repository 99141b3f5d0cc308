"""Canonical chapter rows (page_id, chapter_number, link, release_date) from pages, one extractor a kind of source."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import dates, numbers, text
from tidemark.session import materialize, ship

from . import html as h

ROW = ("page_id", "chapter_number", "link", "release_date")


def first_by(rows: DataFrame, *key: str, order: tuple[str, ...] = ("pos",)) -> DataFrame:
    """The first row in document order for each key."""
    return rows.withColumn("_rn", F.row_number().over(Window.partitionBy("page_id", *key).orderBy(*order))).filter("_rn = 1").drop("_rn")


def url_then_number(rows: DataFrame) -> DataFrame:
    """Document order: a row goes if its link or its number was accepted before; a rejected row leaves no trace.

    What a row's fate is depends on those of all before it, so a page's rows
    are replayed in order, in time that grows with their number.
    """
    ship(rows.sparkSession)
    pages = rows.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("pos", "link", "chapter_number", "release_date"))).alias("x"))  # the rows of one page

    def replay(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            page, at = [], []
            flat, ends = batch.column("x").flatten(), batch.column("x").offsets.to_pylist()
            links, numbers_ = flat.field("link").to_pylist(), flat.field("chapter_number").to_pylist()
            for ident, a, b in zip(batch.column("page_id").to_pylist(), ends, ends[1:], strict=False):
                seen: set = set()
                for i in range(a - ends[0], b - ends[0]):
                    mine = [v for v in (links[i], numbers_[i]) if v is not None]
                    if seen.isdisjoint(mine):
                        seen.update(mine)
                        page.append(ident)
                        at.append(i)
            kept = flat.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(page, pa.int64()), *(kept.field(c) for c in ("pos", "chapter_number", "link", "release_date"))], names=["page_id", "pos", "chapter_number", "link", "release_date"])

    return pages.mapInArrow(replay, "page_id long, pos int, chapter_number double, link string, release_date timestamp_ntz")


def islands(pages: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """((page_id, chapter_number) of locked chapters, page_ids whose lock list could be read): premium, or in early access after now. Only a page's first readable island counts."""
    found = h.elements(pages, ("astro-island",)).select("page_id", "pos", F.col("attrs")["props"].alias("props")).filter("props IS NOT NULL")
    c = h.island_chapters(found)
    first = c.groupBy("page_id").agg(F.min("pos").alias("pos"))
    c = c.join(first, ["page_id", "pos"])
    late = F.coalesce(F.col("until").try_cast("timestamp") > now.cast("timestamp"), F.lit(False))
    locked = c.filter(F.coalesce("premium", F.lit(False)) | late).select("page_id", numbers.prefix_number(F.col("number")).alias("chapter_number")).filter("chapter_number IS NOT NULL").distinct()
    return locked, first.select("page_id")


def divided_list(pages: DataFrame, base: str, now: Column) -> DataFrame:
    """Links to /chapter/N inside a divided list, without locked chapters; locks_known is false where the lock list can't be read, and then nothing is held back."""
    listed = h.elements(pages, marks={"link": ".divide-y a[href*='/chapter/']"})
    href = F.col("attrs")["href"]
    link = F.when(F.startswith(href, F.lit("http")), href).when(F.startswith(href, F.lit("/")), F.concat(F.lit(base), href)).otherwise(F.concat("url", F.lit("/"), href))
    rows = listed.join(pages.select("page_id", "url"), "page_id").select("page_id", "pos", numbers.from_path(href).alias("chapter_number"), link.alias("link"), dates.absolute(F.regexp_extract("text", r"([A-Z][a-z]+ \d+(?:st|nd|rd|th)?,? \d{4})", 1)).alias("release_date"))
    locked, readable = islands(pages, now)
    rows = first_by(rows.filter("chapter_number IS NOT NULL").join(locked, ["page_id", "chapter_number"], "left_anti"), "chapter_number").select(*ROW)
    return rows.join(readable.withColumn("_known", F.lit(True)), "page_id", "left").select(*ROW, F.coalesce("_known", F.lit(False)).alias("locks_known"))


def boxed(e: DataFrame, opens: Column) -> DataFrame:
    """Elements that meet a condition (pos = box) and those inside them, up to the next such element. All windows are by page: one exchange."""
    before = Window.partitionBy("page_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    marked = e.withColumn("_box", F.last(F.when(opens, F.struct("pos", "end")), True).over(before))
    return marked.filter(F.col("pos") < F.col("_box.end")).withColumn("box", F.col("_box.pos")).drop("_box")


def first_in(where: Column, *values: Column | str) -> Column:
    """The values of a box's first element that meets the condition, as a struct; null without one."""
    return F.min_by(F.struct(*values), F.when(where, F.col("pos")))


def own(*values: Column | str) -> Column:
    """The values of the element that is the box itself."""
    return first_in(F.col("pos") == F.col("box"), *values)


def by_box(e: DataFrame, opens: Column, **values: Column) -> DataFrame:
    """One row a box: page_id, pos, and aggregates over boxed()."""
    return boxed(e, opens).groupBy("page_id", F.col("box").alias("pos")).agg(*[v.alias(k) for k, v in values.items()])


#: Where a chapter's date stands in its box.
DATED = "time, [datetime], .date, .time, .release-date, .update_time"


def boxed_list(pages: DataFrame, base: str, source: str, box: str, link_part: str, now: Column, fallback: bool = False) -> DataFrame:
    """Boxes (a selector) with a first link each: number by the source's patterns, date from the box. Without any box on a page, with fallback, every link to a chapter is a box."""
    marks = {"box": box, "link": f"a[href*='{link_part}']" if link_part else "a", "date": DATED} | ({"alone": "a[href*='/chapter/']"} if fallback else {})
    e, opens = h.elements(pages, marks=marks), h.marked("box")
    if fallback:
        e = e.withColumn("_listed", F.max(h.marked("box")).over(Window.partitionBy("page_id")))
        opens = F.when(F.col("_listed"), opens).otherwise(h.marked("alone"))
    a = first_in(h.marked("link"), F.col("attrs")["href"].alias("href"), "text")
    d = first_in(h.marked("date"), F.col("attrs")["datetime"].alias("at"), F.trim("text").alias("text"))
    rows = by_box(e, opens, a=a, d=d, box=own("text")).filter("a IS NOT NULL")
    title = F.when(F.trim("a.text") != "", F.col("a.text")).otherwise(F.col("box.text"))
    n = numbers.by_patterns(source, title, F.col("a.href"))
    rows = rows.select("page_id", "pos", text.absolute(F.col("a.href"), F.lit(base)).alias("link"), n.alias("chapter_number"), dates.attribute_or_text(F.col("d.at"), F.col("d.text"), now).alias("release_date"))
    return url_then_number(rows.filter("chapter_number IS NOT NULL")).select(*ROW)


def fragment_list(pages: DataFrame, base: str) -> DataFrame:
    """Links to /chapters/ID; number from the first inner span's text, else from the id. Repeats stay: see the upsert's first_by_key()."""
    e = h.elements(pages, marks={"link": "a[href*='/chapters/']", "title": "span.grow span", "time": "time"}, texts=("title",))
    title = first_in(h.marked("title"), F.trim("text").alias("t"))
    time = first_in(h.marked("time"), F.col("attrs")["datetime"].alias("t"))
    rows = by_box(e, h.marked("link"), a=own(F.split(F.col("attrs")["href"], "/chapters/")[1].alias("id")), s=title, d=time).select("page_id", "a.id", "s", "d").filter("id <> ''")
    n = numbers.by_patterns("weeb", F.coalesce("s.t", F.lit("")), F.col("id"))
    return rows.select("page_id", n.alias("chapter_number"), F.concat(F.lit(f"{base}/chapters/"), "id").alias("link"), F.col("d.t").try_cast("timestamp").cast("timestamp_ntz").alias("release_date")).filter("chapter_number IS NOT NULL")


#: What marks a paid chapter, and the parts of the theme.
THEME = {
    "item": "#chapterlist li",
    "number": ".eph-num",
    "listed": "#chapterlist li .eph-num",
    "around": "li, .chbox",
    "link": "a[href]",
    "paid": ".text-gold, .fa-coins, .fa-coin, .fa-lock, [class*='coin'], [class*='locked'], [class*='premium']",
    "name": ".chapternum",
    "date": ".chapterdate",
    "data": "script[type='application/ld+json']",
}


def _paid(e: DataFrame, full) -> DataFrame:
    """(page_id, link) of paid chapters: a price stands in an item of the chapter list, or around another .eph-num in its nearest item or .chbox (in itself without one)."""
    alone = h.marked("number") & ~h.marked("listed")
    scopes = e.filter(h.marked("item")).select("page_id", "pos").unionByName(e.filter(alone).select("page_id", F.when(F.col("up") >= 0, F.col("up")).otherwise(F.col("pos")).alias("pos"))).distinct()
    opened = e.join(scopes.withColumn("_scope", F.lit(True)), ["page_id", "pos"], "left")
    inner = F.col("pos") != F.col("box")
    first = first_in(inner & h.marked("link") & (F.col("attrs")["href"] != ""), F.col("attrs")["href"].alias("href"))
    priced = by_box(opened, F.col("_scope").isNotNull(), a=first, paid=F.max(inner & h.marked("paid"))).filter("paid AND a IS NOT NULL")
    return priced.select("page_id", full(F.col("a.href")).alias("link")).distinct()


def theme_pages(pages: DataFrame, base: str, now: Column) -> DataFrame:
    """Three ways at once: JSON-LD, the theme's list, any link to a chapter. Paid links go before all; a number is filled by the first way, then by document order."""
    e = materialize(h.elements(pages, marks=THEME, texts=("name", "date", "data"), up="around"), "elements")  # each page is parsed once
    key = lambda c: F.lower(F.regexp_replace(c, "/+$", ""))
    full = lambda c: text.absolute(c, F.lit(base), False)
    href = F.col("attrs")["href"]
    paid = _paid(e, full).select("page_id", key(F.col("link")).alias("key")).distinct()
    one = lambda c: first_in(h.marked(c), F.trim("text").alias("t"))
    opens = h.marked("item") | (h.marked("number") & ~h.marked("listed"))
    theme = by_box(e, opens, a=first_in(h.marked("link"), href.alias("href")), n=one("name"), d=one("date"), own=own(F.col("attrs")["data-num"].alias("num"))).filter("a IS NOT NULL")
    theme = theme.select("page_id", F.lit(2).alias("way"), "pos", F.lit(0).alias("at"), F.col("a.href").alias("href"), F.coalesce(F.nullif("own.num", F.lit("")), "n.t").alias("raw"), F.col("d.t").alias("date"))
    scripts = e.filter(h.marked("data")).select("page_id", "pos", "text")
    ld = h.json_ld(scripts).filter("type = 'Chapter' AND url IS NOT NULL").select("page_id", F.lit(1).alias("way"), "pos", "at", F.col("url").alias("href"), F.coalesce("position", "name").alias("raw"), F.col("date_published").alias("date"))
    any_ = e.filter(h.marked("link") & href.rlike(r"(?i)chapter[-_/]?\d") & (F.startswith(href, F.lit("/")) | F.startswith(href, F.lit(base))))
    any_ = any_.select("page_id", F.lit(3).alias("way"), "pos", F.lit(0).alias("at"), href.alias("href"), F.lit(None).cast("string").alias("raw"), F.lit(None).cast("string").alias("date"))
    rows = ld.unionByName(theme).unionByName(any_).withColumn("link", full(F.col("href"))).withColumn("key", key(F.col("link"))).join(paid, ["page_id", "key"], "left_anti")
    rows = rows.withColumn("chapter_number", numbers.from_markup(F.col("raw"), F.col("href"))).filter("chapter_number IS NOT NULL").withColumn("release_date", dates.fixed_units(F.col("date"), now))
    return first_by(rows, "chapter_number", order=("way", "pos", "at")).select(*ROW)


def api_chapters(rows: DataFrame, base: str) -> DataFrame:
    """Rows of an API (page_id, id, title, release_date): a number that can't be read is 0 and flagged."""
    n = numbers.from_title_or_id(F.col("title"), F.col("id"))
    return rows.select("page_id", n.alias("chapter_number"), F.concat(F.lit(f"{base}/chapters/"), "id").alias("link"), "release_date", (n == 0).alias("defaulted"))


def results_search(bodies: DataFrame) -> DataFrame:
    """Series of an API's search answer (page_id, body): pos, id, title; an answer without results has none."""
    rows = bodies.select("page_id", F.posexplode(F.from_json("body", "struct<results:array<struct<id:string,title:string>>>")["results"]).alias("pos", "s"))
    return rows.select("page_id", "pos", F.col("s.id").alias("id"), F.col("s.title").alias("title"))


def info_chapters(bodies: DataFrame, base: str) -> DataFrame:
    """Chapters of an API's series answer (page_id, body), as api_chapters() makes them; a date that can't be read is null."""
    rows = bodies.select("page_id", F.explode(F.from_json("body", "struct<chapters:array<struct<id:string,title:string,releasedDate:string>>>")["chapters"]).alias("c"))
    return api_chapters(rows.select("page_id", "c.id", "c.title", F.col("c.releasedDate").try_cast("timestamp").cast("timestamp_ntz").alias("release_date")), base)


#: One page of a chapter feed as it is captured.
FEED = "struct<data:array<struct<id:string,attributes:struct<chapter:string,publishAt:string,externalUrl:string,pages:int>>>>"


def feed(captures: DataFrame, base: str, page_size: int = 100) -> DataFrame:
    """Chapters of captured feed pages (page_id, part, status, body): external ones go before repeats do; a unit with a failed page or without its last (short) page has outcome 'error' and no rows.

    One row a chapter, and one row with a null number for every unit, that carries its outcome.
    """
    p = captures.withColumn("d", F.from_json("body", FEED)).withColumn("n", F.size("d.data"))
    ok = F.col("status").between(200, 299) & F.col("d.data").isNotNull()
    unit = p.groupBy("page_id").agg(F.min(F.coalesce(ok, F.lit(False)).cast("int")).alias("ok"), F.max("part").alias("last"), F.count(F.lit(1)).alias("parts"), F.max_by("n", "part").alias("tail"))
    good = (F.col("ok") == 1) & (F.col("parts") == F.col("last") + 1) & (F.col("tail") < page_size)
    unit = unit.select("page_id", good.alias("good"))
    rows = p.join(unit.filter("good"), "page_id").select("page_id", "part", F.posexplode("d.data").alias("i", "c"))
    rows = rows.filter("coalesce(c.attributes.externalUrl, '') = ''").select("page_id", (F.col("part") * page_size + F.col("i")).alias("pos"), numbers.prefix_number(F.col("c.attributes.chapter")).alias("chapter_number"), F.concat(F.lit(f"{base}/chapter/"), "c.id").alias("link"), F.col("c.attributes.publishAt").try_cast("timestamp").cast("timestamp_ntz").alias("release_date"))
    rows = first_by(rows.filter("chapter_number IS NOT NULL"), "chapter_number").select(*ROW)
    counts = rows.groupBy("page_id").agg(F.count(F.lit(1)).alias("n"))
    state = unit.join(counts, "page_id", "left").select("page_id", F.lit(None).cast("double").alias("chapter_number"), F.when(~F.col("good"), "error").when(F.col("n") > 0, "chapters").otherwise("empty").alias("link"), F.lit(None).cast("timestamp_ntz").alias("release_date"))
    return rows.unionByName(state)


def search_titles(bodies: DataFrame) -> DataFrame:
    """Series of a search answer (page_id, body): id, title by language preference, all alternative titles, external id."""
    kind = "struct<data:array<struct<id:string,attributes:struct<title:map<string,string>,altTitles:array<map<string,string>>,links:map<string,string>>>>>"
    rows = bodies.select("page_id", F.posexplode(F.from_json("body", kind)["data"]).alias("pos", "s"))
    t = F.col("s.attributes.title")
    title = F.coalesce(t["en"], t["ja-ro"], t["ja"], F.get(F.map_values(t), F.lit(0)), F.lit("Unknown"))
    alt = F.flatten(F.transform(F.coalesce("s.attributes.altTitles", F.array().cast("array<map<string,string>>")), lambda m: F.map_values(m)))
    return rows.select("page_id", "pos", F.col("s.id").alias("id"), title.alias("title"), alt.alias("alt_titles"), F.col("s.attributes.links")["mal"].alias("mal_id"))


def rest_search(bodies: DataFrame) -> DataFrame:
    """Series of a REST search answer (page_id, body): (pos, link, slug, title), without rows that lack a link or slug; the title as text."""
    kind = "array<struct<link:string,slug:string,title:struct<rendered:string>>>"
    rows = bodies.select("page_id", F.posexplode(F.from_json("body", kind)).alias("pos", "s")).filter("s.link IS NOT NULL AND s.slug IS NOT NULL")
    return rows.select("page_id", "pos", F.col("s.link").alias("link"), F.col("s.slug").alias("slug"), text.rendered(F.coalesce("s.title.rendered", F.lit(""))).alias("title"))


def search_links(pages: DataFrame, prefix: str, most: int = 10) -> DataFrame:
    """Series links of a search page: the first by slug in document order, with a title of 1 to 199 characters from the link's text, title or image; no chapter links; at most `most` a page."""
    e = h.elements(pages, ("a", "img"))
    href = F.col("attrs")["href"]
    a = e.filter((F.col("tag") == "a") & F.startswith(F.coalesce(href, F.lit("")), F.lit(prefix)) & ~F.contains(F.coalesce(href, F.lit("")), F.lit("/chapter")))
    img = e.filter("tag = 'img'").select("page_id", F.col("parent").alias("pos"), F.col("attrs")["alt"].alias("alt")).groupBy("page_id", "pos").agg(F.min("alt").alias("alt"))
    title = F.coalesce(F.nullif(text.squeeze(F.col("text")), F.lit("")), F.nullif(F.col("attrs")["title"], F.lit("")), F.nullif("alt", F.lit("")))
    rows = a.join(img, ["page_id", "pos"], "left").select("page_id", "pos", href.alias("link"), F.regexp_extract(href, r"/([^/?#]+)/?(?:[?#].*)?$", 1).alias("slug"), title.alias("title"))
    rows = first_by(rows.filter("title IS NOT NULL AND length(title) < 200 AND slug <> ''"), "slug")
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("page_id").orderBy("pos"))).filter(F.col("rank") <= most)
