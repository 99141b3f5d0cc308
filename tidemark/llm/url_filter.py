"""URL filters: regular-expression rules behind an index of literal tokens.

Each rule names literal tokens that stand whole in any URL it can match. It is
indexed by the one that is rarest among the URLs at hand; the tokens of a URL
fetch the candidate rules, and only their regular expressions run.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import ship

TOKEN = re.compile("[a-z0-9]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Rules travel with the tasks; so many characters at most.
MOST_CHARS = 16 << 20


@dataclass(frozen=True)
class DomainRule:
    """Fits the host before the first slash of `rule` and all its subdomains, where the path begins with the rest."""

    action: str
    rule: str

    def pattern(self) -> str:
        return r"\A(?:[^/]*\.)?" + re.escape(self.rule)

    def tokens(self) -> list[str]:
        """Tokens with a separator on either side: the last may go on in the URL's path."""
        return [m[0] for m in TOKEN.finditer(self.rule.translate(LOWER)) if m.end() < len(self.rule) or "/" not in self.rule]


@dataclass(frozen=True)
class PatternRule:
    """Blocks URLs (A-Z lower-cased) that contain `pattern`; `tokens` stand whole in all of them. Without tokens it runs on every URL."""

    name: str
    pattern: str
    tokens: tuple[str, ...] = ()


#: Listing, account and machine pages rather than documents.
PATTERNS = (
    PatternRule("paged_listing", r"[?&]page=[0-9]+&", ("page",)),
    PatternRule("search_results", r"/search[/?]", ("search",)),
    PatternRule("login", r"/login[/?.]", ("login",)),
    PatternRule("wp_login", r"/wp-login\.php", ("wp", "login")),
    PatternRule("cart", r"/cart[/?]", ("cart",)),
    PatternRule("checkout", r"/checkout[/?]", ("checkout",)),
    PatternRule("tag_listing", r"/tag/[^/]+/page/[0-9]+", ("tag", "page")),
    PatternRule("calendar", r"/calendar/[0-9]{4}/", ("calendar",)),
    PatternRule("session_id", r"[?&;](?:php)?sessid=", ()),
    PatternRule("casino", r"://[^/?#]*\bcasino\b", ("casino",)),
    PatternRule("xxx", r"://[^/?#]*\.xxx(?:[/?#:]|\Z)", ("xxx",)),
    PatternRule("feed", r"/feed/(?:rss|atom)(?:[/?]|\Z)", ("feed",)),
)


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): host after the first :// up to / ? # or the end, A-Z lower-cased; path then up to ? # or the end. Both empty without ://."""
    if not url or (a := url.find("://")) < 0:
        return "", ""
    rest = re.split(r"[?#]", url[a + 3 :], maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    return host.translate(LOWER), slash + path


def token_counts(urls: DataFrame, tokens: set[str]) -> dict[str, int]:
    """In how many URLs each of the tokens stands; counted over all rows, one row a token returned."""
    found = urls.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("url"), F.lit("([a-z0-9]+)"), F.lit(1)))).alias("token"))
    return {r.token: r.n for r in found.filter(F.col("token").isin(sorted(tokens))).groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect()} if tokens else {}


class Index:
    """Rules by their rarest token."""

    def __init__(self, domains: list[DomainRule], patterns: list[PatternRule], counts: dict[str, int]):
        self.rules: list[tuple] = [(0, r, re.compile(r.pattern())) for r in domains] + [(1, r, re.compile(r.pattern)) for r in patterns]
        self.by_token: dict[str, list[int]] = {}
        self.always: list[int] = []
        for i, (kind, rule, _) in enumerate(self.rules):
            literal = rule.tokens() if kind == 0 else rule.tokens
            if literal:
                self.by_token.setdefault(min(literal, key=lambda t: (counts.get(t, 0), t)), []).append(i)
            else:
                self.always.append(i)

    def judge(self, url: str | None, default: str) -> tuple[str, str, str | None, str, str | None, int]:
        """host, path, rule, verdict, pattern, number of regular expressions run."""
        host, path = split_url(url)
        low = (url or "").translate(LOWER)
        candidates = [*self.always, *(i for t in set(TOKEN.findall(low)) for i in self.by_token.get(t, ()))] if low else []
        best: DomainRule | None = None
        name = None
        for i in candidates:
            kind, rule, regex = self.rules[i]
            if kind == 0:
                if host and regex.match(host + path) and (best is None or (len(rule.rule), rule.rule) > (len(best.rule), best.rule)):
                    best = rule
            elif regex.search(low) and (name is None or rule.name < name):
                name = rule.name
        verdict = best.action if best else "block" if name else default
        return host, path, best.rule if best else None, verdict, name, len(candidates)


def filter_urls(urls: DataFrame, key: str, domains: list[DomainRule], patterns: list[PatternRule] | tuple = PATTERNS, default: str = "allow") -> DataFrame:
    """key, host, path, rule, verdict, pattern, candidates of every row of urls (key, url).

    Of the domain rules that fit, the longest decides (of equal length, the
    last in order of text); if none fits, a URL that a pattern matches is
    blocked and any other gets `default`. pattern is the first name of those
    that match, or null. A null or empty URL, or one without ://, has an empty
    host and path; patterns still see it. Rows stay as they are: null and
    repeated keys too; an empty table gives an empty one. No shuffle but for
    one count a rule token.
    """
    spark = urls.sparkSession
    ship(spark)
    size = sum(len(d.rule) for d in domains) + sum(len(p.pattern) for p in patterns)
    if size > MOST_CHARS:
        raise ValueError(f"{size} characters of rules; {MOST_CHARS} at most go with each task")
    source = urls.select(F.col(key).alias("key"), "url")
    tokens = {t for d in domains for t in d.tokens()} | {t for p in patterns for t in p.tokens}
    counts = token_counts(source, tokens)
    domains, patterns = list(domains), list(patterns)

    def run(batches) -> Iterator:
        import pyarrow as pa

        index = Index(domains, patterns, counts)
        for batch in batches:
            rows = [index.judge(u, default) for u in batch.column("url").to_pylist()]
            cols = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([batch.column("key"), *(pa.array(c, t) for c, t in zip(cols, [pa.string()] * 5 + [pa.int64()], strict=True))], names=["key", "host", "path", "rule", "verdict", "pattern", "candidates"])

    kind = dict(source.dtypes)["key"]
    return source.mapInArrow(run, f"key {kind}, host string, path string, rule string, verdict string, pattern string, candidates long").withColumnRenamed("key", key)
