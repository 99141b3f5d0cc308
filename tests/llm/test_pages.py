import hashlib

import pytest

from tidemark.llm import url_filter, warc
from tidemark.llm.queries import DOMAIN_RULES

# ---- WARC


@pytest.fixture(scope="module")
def some(spark):
    data = [(1, "http://a/1", "same"), (2, "http://a/2", "same"), (3, None, "same"), (4, "u", None), (5, "u\r\nX: y", ""), (6, "u", "é\r\n\r\nWARC/1.1\r\n\u0000"), (None, "n", "same"), (7, "u", "big " * 60_000), (7, "v", "big " * 60_000), (8, "w", "other")]
    return spark.createDataFrame([(*r, 1, "x") for r in data], "page_id long, url string, html string, refers_to long, digest string").repartition(3)


@pytest.mark.parametrize("least", [0, 10])
def test_archive_round_trip(spark, some, tmp_path, least):
    path = f"file://{tmp_path}/a"
    files = warc.write_archive(some, path, least=least)
    got = warc.read_archive(spark, path, files).collect()
    assert len(got) == some.count() == sum(n for _, n in files)
    top = {}
    for r in some.collect():
        body = (r.html or "").encode()
        if r.page_id is not None and len(body) >= least:
            top[body] = max(top.get(body, r.page_id), r.page_id)
    want = sorted((str(r.page_id), len(b := (r.html or "").encode()), hashlib.sha1(b).hexdigest(), str(top[b] if r.page_id is not None and b in top and r.page_id < top[b] else None)) for r in some.collect())
    import base64

    assert sorted((str(r.page_id), r.payload_bytes, base64.b32decode(r.payload_digest).hex(), str(r.refers_to)) for r in got) == want
    for r in got:
        assert (r.record_type == "revisit") == (r.refers_to is not None) == (r.payload is None)
        assert r.payload is None or hashlib.sha1(r.payload).hexdigest() == base64.b32decode(r.payload_digest).hex()


def test_archive_of_nothing(spark, some, tmp_path):
    assert warc.read_archive(spark, f"file://{tmp_path}/a", warc.write_archive(some.filter("false"), f"file://{tmp_path}/a")).count() == 0


def test_file_begins_with_its_dictionary(spark, tmp_path):
    pages = spark.range(400).selectExpr("id AS page_id", "concat('http://x/', id) AS url", "concat('<html><body>', repeat(concat('row ', id, ' of the table '), 30), '</body></html>') AS html").coalesce(1)
    (name, n), = warc.write_archive(pages, f"file://{tmp_path}/a")
    data = (tmp_path / "a" / name).read_bytes()
    assert data[:4] == bytes.fromhex("5d2a4d18") and int.from_bytes(data[4:8], "little") > 0
    with open(tmp_path / "a" / name, "rb") as f:
        assert sum(1 for _ in warc.read_records(f)) == n == 400


# ---- URL filter


@pytest.mark.parametrize(
    "url,host,path,rule,verdict",
    [
        ("http://example.com/en/1", "example.com", "/en/1", "example.com/en/", "block"),
        ("https://m.EXAMPLE.com/en/", "m.example.com", "/en/", "example.com/en/", "block"),
        ("https://www.example.com/en/x?y", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
        ("https://a.www.example.com/en/x", "a.www.example.com", "/en/x", "www.example.com/en/", "allow"),
        ("https://example.com/EN/x", "example.com", "/EN/x", "com/", "allow"),
        ("https://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
        ("https://x.net/fr", "x.net", "/fr", None, "allow"),
        ("https://x.net/fr/a#b", "x.net", "/fr/a", "net/fr/", "block"),
        ("https://x.org?a=http://y.net/fr/", "x.org", "", None, "allow"),
        ("https://com", "com", "", None, "allow"),
        ("x.net/fr/", "", "", None, "allow"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("https://x.org/login/", "x.org", "/login/", None, "block"),
        ("https://x.org/a?page=2&ref=x", "x.org", "/a", None, "block"),
        ("https://best-casino.org/", "best-casino.org", "/", None, "block"),
        ("https://x.org/?phpsessid=1", "x.org", "/", None, "block"),
    ],
)
def test_verdicts(url, host, path, rule, verdict):
    index = url_filter.Index(DOMAIN_RULES, list(url_filter.PATTERNS), {})
    assert index.judge(url, "allow")[:4] == (host, path, rule, verdict)


def test_index_finds_what_all_rules_find(spark, small):
    urls = spark.read.parquet(f"{small}/pages.parquet").select("page_id", "url")
    more = spark.createDataFrame([(None, None), (1, ""), (1, "http://a.b/tag/x/page/3"), (1, "http://a.b/feed/rss")], "page_id long, url string")
    both = urls.union(more)
    got = sorted((tuple(r) for r in url_filter.filter_urls(both, "page_id", DOMAIN_RULES).drop("candidates").collect()), key=repr)
    every = url_filter.Index(DOMAIN_RULES, list(url_filter.PATTERNS), {})
    every.always, every.by_token = list(range(len(every.rules))), {}
    assert got == sorted(((r.page_id, *every.judge(r.url, "allow")[:5]) for r in both.collect()), key=repr)


def test_rarest_token_is_the_key():
    index = url_filter.Index([], [url_filter.PatternRule("a", "/wp-login", ("wp", "login"))], {"login": 9, "wp": 2})
    assert list(index.by_token) == ["wp"]


SAMPLES = {
    "paged_listing": ["http://a.b/x?page=2&y", "http://a.b/x?y&page=22&"], "search_results": ["http://a.b/search?q", "http://a.b/search/"], "login": ["http://a.b/login.aspx", "http://a.b/login/x"],
    "wp_login": ["http://a.b/wp-login.php", "http://a.b/wp-login.php5", "http://a.b/wp-login.phpx?y"], "cart": ["http://a.b/cart/1", "http://a.b/cart?1"], "checkout": ["http://a.b/checkout/1"],
    "tag_listing": ["http://a.b/tag/x/page/3", "http://a.b/tag/x/page/3x"], "calendar": ["http://a.b/calendar/2024/x"], "session_id": ["http://a.b/?phpsessid=1", "http://a.b/;sessid=1"],
    "casino": ["http://my-casino.b/", "http://casino"], "xxx": ["http://a.xxx", "http://a.xxx:80/"], "feed": ["http://a.b/feed/atom", "http://a.b/feed/rss?x"],
}


@pytest.mark.parametrize("rule", url_filter.PATTERNS, ids=lambda r: r.name)
def test_every_token_finds_its_rule(rule):
    for key in rule.tokens or (None,):
        index = url_filter.Index([], [rule], {t: 0 if t == key else 9 for t in rule.tokens})
        assert all(index.judge(u, "allow")[3:5] == ("block", rule.name) for u in SAMPLES[rule.name])


def test_no_urls(spark):
    none = spark.createDataFrame([], "page_id long, url string, host int, verdict int")
    assert url_filter.filter_urls(none, "page_id", DOMAIN_RULES).count() == 0


def dictionary_of(path):
    data = path.read_bytes()
    return data[8 : 8 + int.from_bytes(data[4:8], "little")]


@pytest.mark.parametrize("n", [1, 2, 7, 15])
@pytest.mark.parametrize("length", [0, 40, 300_000, 1_500_000])
def test_few_and_large_records_have_a_dictionary_too(spark, tmp_path, n, length):
    pages = spark.range(n).selectExpr("id AS page_id", "concat('http://x/', id) AS url", f"CASE WHEN {length} > 0 THEN left(repeat(concat('row ', id, ' of ', uuid()), {length} div 30 + 1), {length}) END AS html").cache().coalesce(1)
    files = warc.write_archive(pages, f"file://{tmp_path}/a")
    assert [k for _, k in files] == [n] and len(dictionary_of(tmp_path / "a" / files[0][0])) > 100
    got = warc.read_archive(spark, f"file://{tmp_path}/a", files)
    assert sorted((r.page_id, r.payload_bytes) for r in got.collect()) == [(i, length) for i in range(n)]


def test_nothing_is_left_of_an_archive_but_its_files(spark, some, tmp_path, monkeypatch):
    monkeypatch.setattr("tidemark.session.shared_dir", lambda s: f"file://{tmp_path}/shared")
    warc.write_archive(some, f"file://{tmp_path}/a")
    assert not list((tmp_path / "shared").glob("*")) if (tmp_path / "shared").exists() else True


def test_dictionaries_of_anything():
    import zstandard

    from tidemark.llm import dictionaries

    for samples in ([b"x"], [b"ab" * 4], [b"same"] * 1000, [bytes(range(256)) * 9000], [dictionaries.MAGIC + b"y" * 100], [b"", b"q" * 70_000], [hashlib.sha256(bytes([i])).digest() for i in range(40)]):
        d = dictionaries.train(samples)
        assert 0 < len(d) <= dictionaries.SIZE
        data = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d)).compress(samples[-1] * 2)
        assert zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(d)).decompress(data) == samples[-1] * 2
    assert dictionaries.train([]) == dictionaries.train([b"", b""]) == b""
