import datetime as dt
import json
import random

from pyspark.sql import functions as F

from tidemark.plans import registry
from tidemark.sources import extract, searches
from tidemark.sources import html as h

def NOW():
    return F.lit("2026-08-30 00:00:00").cast("timestamp_ntz")



def pages(spark, *html):
    return spark.createDataFrame([(i, "https://x.example/s", t) for i, t in enumerate(html)], "page_id long, url string, html string")


def numbers(df):
    return sorted((r.page_id, r.chapter_number, r.link) for r in df.collect())


def island(*chapters):
    def one(n, premium, until):
        return [0, {"number": [0, n], "is_premium": [0, premium], "early_access_until": [0, until]}]

    return "<astro-island props='" + json.dumps({"chapters": [1, [one(*c) for c in chapters]]}) + "'></astro-island>"


def test_locked_rows_of_an_island_are_left_out(spark):
    links = '<div class="divide-y"><a href="/c/x/chapter/12">12 <i>March 4th 2024</i></a><a href="/c/x/chapter/11">11</a><a href="chapter/11">again</a></div>'
    late = island((12, True, "2026-08-30T01:00:00Z"), (11, False, "2026-08-29T23:00:00Z"))
    got = numbers(extract.divided_list(pages(spark, late + links, links), "https://b.example", NOW()))
    assert got == [(0, 11.0, "https://b.example/c/x/chapter/11"), (1, 11.0, "https://b.example/c/x/chapter/11"), (1, 12.0, "https://b.example/c/x/chapter/12")]
    dated = extract.divided_list(pages(spark, links), "https://b.example", NOW()).filter("chapter_number = 12").first()
    assert dated.release_date == dt.datetime(2024, 3, 4)


def theme(n, paid):
    price = '<span class="text-gold">100</span>' if paid else ""
    return f'<li data-num="{n}"><div class="chbox"><div class="eph-num"><a href="https://r.example/s-chapter-{n}/"><span class="chapternum">Chapter {n}</span><span class="chapterdate">August 24, 2026</span></a></div>{price}</div></li>'


def test_paid_rows_of_a_theme_are_left_out_of_every_way(spark):
    listed = f'<div id="chapterlist"><ul>{theme(9, True)}{theme(8, False)}</ul></div>'
    ld = json.dumps({"@graph": [{"@type": "ComicSeries", "hasPart": [{"@type": "Chapter", "url": f"https://r.example/s-chapter-{n}/", "position": n, "datePublished": "2026-08-01T00:00:00Z"} for n in (7, 8, 9)]}]})
    page = listed + f'<script type="application/ld+json">{ld}</script><script type="application/ld+json">{{broken</script><a href="/s-chapter-6-5/">old</a>'
    rows = {r.chapter_number: (r.link, r.release_date) for r in extract.theme_pages(pages(spark, page), "https://r.example", NOW()).collect()}
    assert sorted(rows) == [6.5, 7.0, 8.0]
    assert rows[8.0][1] == dt.datetime(2026, 8, 1) and rows[6.5] == ("https://r.example/s-chapter-6-5/", None)
    only = {r.chapter_number: r.release_date for r in extract.theme_pages(pages(spark, listed), "https://r.example", NOW()).collect()}
    assert only == {8.0: dt.datetime(2026, 8, 24)}


def test_boxed_list(spark):
    box = '<div class="chapter"><a href="/m/c{0}">Chapter {0}</a><div class="update_time">2 days ago</div></div>'
    page = '<div class="chapters">' + "".join(box.format(n) for n in (3, 2, 2.5, 3)) + '<div class="chapter">none</div></div>'
    rows = extract.boxed_list(pages(spark, page), "https://k.example", "katana", ".chapters .chapter", "", NOW())
    assert numbers(rows) == [(0, 2.0, "https://k.example/m/c2"), (0, 2.5, "https://k.example/m/c2.5"), (0, 3.0, "https://k.example/m/c3")]
    assert rows.first().release_date == dt.datetime(2026, 8, 28)


def test_boxed_list_falls_back_by_page(spark):
    box = '<div class="group flex"><div><a href="/title/x/c{0}">Chapter {0}</a></div></div>'
    got = numbers(extract.boxed_list(pages(spark, box.format(4), '<a href="/title/x/chapter/5">go</a>'), "https://p.example", "park", "div.group.flex > div", "/title/", NOW(), fallback=True))
    assert got == [(0, 4.0, "https://p.example/title/x/c4"), (1, 5.0, "https://p.example/title/x/chapter/5")]


def test_fragment_list_keeps_repeats(spark):
    link = '<a href="https://w.example/chapters/{0}"><span class="grow"><span>{1}</span></span><time datetime="2026-01-02T03:04:05Z"></time></a>'
    got = extract.fragment_list(pages(spark, link.format("A1", "Chapter 4.5") + link.format("B2", "Extra")), "https://w.example")
    assert numbers(got) == [(0, 2.0, "https://w.example/chapters/B2"), (0, 4.5, "https://w.example/chapters/A1")]
    assert got.first().release_date == dt.datetime(2026, 1, 2, 3, 4, 5)


def chapter(i, n, external=None):
    return {"id": i, "attributes": {"chapter": n, "publishAt": "2026-09-01T00:00:00+00:00", "externalUrl": external, "pages": 1}}


def test_feed_drops_external_rows_before_repeats(spark):
    body = json.dumps({"data": [chapter("e", "150", "https://k.example/1"), chapter("s", "150"), chapter("f", "151", "https://k.example/2"), chapter("z", None)]})
    full = json.dumps({"data": [chapter(f"c{i}", str(i)) for i in range(100)]})
    df = spark.createDataFrame([(1, 0, 200, body), (2, 0, 200, full), (3, 0, 200, full), (3, 1, 500, None), (4, 0, 200, '{"data": []}')], "page_id long, part int, status int, body string")
    rows = extract.feed(df, "https://d.example").collect()
    assert [(r.page_id, r.chapter_number, r.link) for r in rows if r.chapter_number is not None] == [(1, 150.0, "https://d.example/chapter/s")]
    assert {r.page_id: r.link for r in rows if r.chapter_number is None} == {1: "chapters", 2: "error", 3: "error", 4: "empty"}


def test_search_answers(spark):
    md = json.dumps({"data": [{"id": "a", "attributes": {"title": {"ja": "J", "en": "E"}, "altTitles": [{"fr": "F"}, {"de": "D"}], "links": {"mal": "7"}}}, {"id": "b", "attributes": {"title": {"ko": "K"}, "altTitles": [], "links": None}}]})
    got = extract.search_titles(spark.createDataFrame([(1, md)], "page_id long, body string")).collect()
    assert [(r.title, r.alt_titles, r.mal_id) for r in got] == [("E", ["F", "D"], "7"), ("K", [], None)]
    wp = json.dumps([{"link": "l", "slug": "s", "title": {"rendered": "A &amp; B&#8217;s"}}, {"link": None, "slug": "x"}])
    assert [(r.link, r.title) for r in extract.rest_search(spark.createDataFrame([(1, wp)], "page_id long, body string")).collect()] == [("l", "A & B’s")]


def test_a_box_ends_where_its_element_ends(spark):
    other = '<a href="/other"><span class="grow"><span>Chapter 99</span></span><time datetime="2024-01-02T03:04:05Z"></time></a>'
    (row,) = extract.fragment_list(pages(spark, '<a href="/chapters/7x"></a>' + other), "https://w.example").collect()
    assert (row.chapter_number, row.release_date) == (7.0, None)


def test_search_links(spark):
    page = "".join(f'<a href="https://s.example/series/t{i}/"> T  {i} </a>' for i in range(12)) + '<a href="https://s.example/series/t1/">again</a><a href="https://s.example/series/t1/chapter-2">c</a><a href="https://s.example/series/pic"><img alt="Pic"></a>'
    got = extract.search_links(pages(spark, page), "https://s.example/series/").orderBy("rank").collect()
    assert [r.title for r in got][:2] == ["T 0", "T 1"] and len(got) == 10


def test_outcomes_keep_every_payload(spark):
    df = spark.createDataFrame([(1, 200, "x" * 6000), (2, 503, "<a>"), (3, 200, "<title>Just a moment"), (4, 200, None), (5, 200, "<a>")], "page_id long, status int, html string")
    found = spark.createDataFrame([(5, 1)], "page_id long, n int")
    assert {r.page_id: (r.outcome, r.blank) for r in h.outcomes(df, found).collect()} == {1: ("empty", False), 2: ("error", True), 3: ("error", True), 4: ("empty", True), 5: ("chapters", False)}


def test_json_helpers():
    assert h.unwrap({"a": [0, 1], "b": [1, [[0, "x"], [0, True]]], "c": [0]}) == {"a": 1, "b": ["x", True], "c": None}
    assert [o.get("n") for o in h.flatten_objects([{"n": 1, "k": {"n": 2}}, [{"n": 3}]])] == [1, 2, 3]


def test_api_numbers_default_to_zero(spark):
    df = spark.createDataFrame([(1, "1/chapter-10-5", "Oneshot", None), (1, "1/x", "Oneshot", None), (1, "1/y", "Chapter: 3", None)], "page_id long, id string, title string, release_date string")
    assert [(r.chapter_number, r.defaulted) for r in extract.api_chapters(df, "https://a.example").collect()] == [(10.5, False), (0.0, True), (3.0, False)]


def test_a_price_beside_the_link_outside_a_list_is_seen(spark):
    def box(n, price):
        return f'<div class="chbox"><div class="eph-num"><a href="/s-chapter-{n}/"><span class="chapternum">Chapter {n}</span></a></div>{price}</div>'

    page = "<div>" + box(4, "") + box(5, '<span class="text-gold">10</span>') + box(6, "") + '<div class="eph-num"><a href="/s-chapter-7/">Chapter 7</a><i class="fa-lock"></i></div></div>'
    got = [r.chapter_number for r in extract.theme_pages(pages(spark, page), "https://r.example", NOW()).collect()]
    assert sorted(got) == [4.0, 6.0]


def test_searches_of_empty_and_null_pages(spark):
    none = pages(spark, "", None, "<p>nothing</p>", '<a>no link</a><article class="bg-base-300"></article><div class="grid"></div>')
    base = "https://s.example"
    found = [searches.theme_search(none, base, ("/manga/",)), searches.grid_search(none, base), searches.row_search(none, base), searches.list_search(none, base), searches.card_search(none)]
    assert [f.count() for f in found] == [0] * 5


def test_rendered_titles(spark):
    wp = json.dumps([{"link": "l", "slug": str(i), "title": {"rendered": t}} for i, t in enumerate(["&hearts; <em>A</em> &#x26; &eacute;&nbsp;", "1 < 2 &amp;lt;", "", "&unknown; &copy"])] + [{"link": "l", "slug": "4", "title": None}])
    got = extract.rest_search(spark.createDataFrame([(1, wp)], "page_id long, body string")).orderBy("pos").collect()
    assert [r.title for r in got] == ["\u2665 A & \u00e9", "1 < 2 &lt;", "", "&unknown; \u00a9", ""]


# ---- the grid by a slow search over all elements


def slow_grid(page, base="https://g.example", most=10):
    nodes = h.parse(page)
    by = {n[0]: n for n in nodes}

    def above(n, grid):
        while n[2] in by:
            n = by[n[2]]
            if grid(n[5].get("class", "")):
                return True
        return False

    kinds = [lambda c: {"grid", "grid-cols-2"} <= set(c.split()), lambda c: "grid" in c.split(), lambda c: "grid" in c]
    grid = next((g for g in kinds if any(g(n[5].get("class", "")) for n in nodes)), None)
    links = [n for n in nodes if n[4] == "a" and "comics/" in n[5].get("href", "") and "/chapter/" not in n[5]["href"] and (grid is None or above(n, grid))]
    out, seen = [], set()
    for a, after in zip(links, [n[0] for n in links[1:]] + [len(nodes)], strict=False):
        inner = [n for n in nodes if a[0] < n[0] < min(a[1], after)]
        bold = "".join(n[7] for n in inner if n[4] == "span" and {"block", "font-bold"} <= set(n[5].get("class", "").split())).strip()
        img = next((n[5] for n in inner if n[4] == "img"), {})
        title = next((t for t in (a[5].get("title"), bold, img.get("alt"), img.get("title")) if t), a[7])
        title = " ".join(title.split())
        href = a[5]["href"]
        link = href if href.startswith("http") else base + ("" if href.startswith("/") else "/") + href
        if title and len(title) < 200 and link not in seen and len(out) < most:
            seen.add(link)
            out.append((a[0], title, link))
    return out


def test_the_grid_is_what_a_slow_search_finds(spark):
    some = random.Random(3)
    parts = ['<div class="grid">', '<div class="a grid grid-cols-2">', "<div class='my-grid'>", "<div>", "</div>", "</div>", "<table><tr><td>", "</table>", "</a>", "</span>", "x", " \n y ", " ", '<span class="block font-bold">', '<SPAN CLASS="font-bold  block k">', "<img alt='Alt'>", '<img alt="" title=" T  1 ">', "<img>"]
    parts += [f'<a href="{x}comics/{n}"{t}>' for x in ("/", "", "https://o.example/") for n in (1, 2, "1/chapter/3") for t in ("", ' title=" A\tb "', f' title="{"z" * 200}"')] + ['<a href="/other">', "<a>"]
    many = "".join(f'<a href="/comics/{i % 13}" title="{i}"></a>' for i in range(40))
    html = ["".join(some.choices(parts, k=some.randint(1, 40))) for _ in range(400)] + [many, f'<p class="grid">{many}', None, ""]
    want = [(i, *r) for i, page in enumerate(html) for r in slow_grid(page)]
    got = searches.grid_search(pages(spark, *html), "https://g.example").select("page_id", "pos", "title", "link").collect()
    assert sorted(map(tuple, got)) == want and len(want) > 200 and max(i for i, *_ in want) == 401


def test_a_grid_is_worked_out_where_its_page_is(spark, small):
    """Pages are dealt out before they are made, however few files hold their keys, and nothing is shuffled after that."""
    found = registry.QUERIES["grid_search"](spark, small)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("MapInArrow") < plan.index("Exchange")
    assert found.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_tags_are_remembered_within_bounds():
    marks = {"a": "a[href^='/1']"}
    page = "".join(f'<a href="/{i}">' for i in range(3 * h.Plan.MOST)) + f'<a href="/1{"x" * 1000}">'
    once, again = h.parse(page, marks), h.parse(page, marks)
    assert once == again and len(once) == 1 + sum(str(i).startswith("1") for i in range(3 * h.Plan.MOST))
    known = h._plan(tuple(marks.items())).tags
    assert len(known) <= h.Plan.MOST and max(map(len, known)) <= h.Plan.LONGEST
