"""Quality rules as a short-circuit cascade of native expressions.

Each rule is a condition under which a document is rejected, over metrics of
its text. A sample tells how many documents each rule rejects, alone and after
others, and what the metrics that it needs cost; the rules are then ordered by
rejections per cost, greedily: a metric that an earlier rule has worked out
costs nothing more, and a document that it has rejected counts no more. In the
cascade a metric stands behind a condition, so it isn't evaluated for documents
that are rejected already. The order changes the time, never the verdict: a
document is kept if no rule rejects it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = r"[^\\x20\\x09-\\x0D]+"
WHITE = r"[\\x20\\x09-\\x0D]+"
SYMBOL = r"[#*$%&|<>]"
#: Bits of a packed trigram key that hold the position; longer texts take the path by strings.
POSITION_BITS = 24


@dataclass(frozen=True)
class Metric:
    """sql: over the text {t} and the metrics in needs. ns: SQL for its cost in nanoseconds, over {bytes} and {words}; weights measured once on one core."""

    sql: str
    needs: tuple[str, ...] = ()
    ns: str = "0"


def definitions() -> dict[str, Metric]:
    """Every metric by name.

    Trigrams are compared by sorted 40-bit hashes with their positions; where
    two different trigrams share a hash, and in texts of 2^24 words or more,
    by the words themselves. So the counts are exact.
    """
    mask = (1 << POSITION_BITS) - 1
    at, before = f"cast({{keys}}[j] & {mask}L as int)", f"cast({{keys}}[j - 1] & {mask}L as int)"
    differ = " OR ".join(f"{{words}}[{at} + {k}] <> {{words}}[{before} + {k}]" for k in range(3))
    return {
        "words": Metric(f"regexp_extract_all({{t}}, '{WORD}', 0)", ns="25 * {bytes}"),
        "n_words": Metric("cast(size({words}) as long)", ("words",)),
        "word_chars": Metric(f"cast(length(regexp_replace({{t}}, '{WHITE}', '')) as long)", ns="20 * {bytes}"),
        "n_symbols": Metric(f"cast(octet_length({{t}}) - octet_length(regexp_replace({{t}}, '{SYMBOL}', '')) as long)", ns="6 * {bytes}"),
        "lines": Metric(r"filter(split({t}, '\\n'), x -> x RLIKE '[^\\x20\\x09-\\x0D]')", ns="5 * {bytes}"),
        "n_lines": Metric("cast(size({lines}) as long)", ("lines",)),
        "n_dup_lines": Metric("cast(size({lines}) - size(array_distinct({lines})) as long)", ("lines",), "{bytes}"),
        "n_capitals": Metric("cast(length(regexp_replace({t}, '[^A-Z]+', '')) as long)", ns="10 * {bytes}"),
        "n_letters": Metric(r"cast(length(regexp_replace({t}, '\\P{{L}}+', '')) as long)", ns="18 * {bytes}"),
        "keys": Metric(f"""CASE WHEN size({{words}}) BETWEEN 3 AND {mask} THEN sort_array(transform(sequence(0, size({{words}}) - 3),
        i -> (xxhash64({{words}}[i], {{words}}[i + 1], {{words}}[i + 2]) & {~mask}L) | cast(i as long))) ELSE cast(array() as array<long>) END""", ("words",), "400 * {words}"),
        "equal": Metric(f"CASE WHEN size({{keys}}) < 2 THEN cast(array() as array<int>) ELSE filter(sequence(1, size({{keys}}) - 1), j -> shiftright({{keys}}[j], {POSITION_BITS}) = shiftright({{keys}}[j - 1], {POSITION_BITS})) END", ("keys",), "100 * {words}"),
        "by_words": Metric(f"CASE WHEN size({{words}}) > {mask} OR exists({{equal}}, j -> {differ}) THEN array_sort(transform(sequence(0, size({{words}}) - 3), i -> struct(concat_ws(' ', {{words}}[i], {{words}}[i + 1], {{words}}[i + 2]) AS g, i AS p))) END", ("words", "keys", "equal")),
        "places": Metric(f"""array_sort(CASE WHEN {{by_words}} IS NULL THEN array_distinct(flatten(transform({{equal}}, j -> array({{keys}}[j] & {mask}L, {{keys}}[j - 1] & {mask}L))))
        ELSE transform(filter(sequence(0, size({{by_words}}) - 1), j -> (j > 0 AND {{by_words}}[greatest(j - 1, 0)].g = {{by_words}}[j].g) OR (j + 1 < size({{by_words}}) AND {{by_words}}[least(j + 1, size({{by_words}}) - 1)].g = {{by_words}}[j].g)), j -> cast({{by_words}}[j].p as long)) END)""", ("keys", "equal", "by_words")),
        "n_repeat_words": Metric("""CASE WHEN size({places}) = 0 THEN 0L ELSE 3L * size({places}) - CASE WHEN size({places}) < 2 THEN 0L ELSE
        aggregate(sequence(1, size({places}) - 1), 0L, (a, k) -> a + greatest(0L, 3L - ({places}[k] - {places}[k - 1]))) END END""", ("places",), "30 * {words}"),
    }


@dataclass(frozen=True)
class Rule:
    """reject: SQL condition over the metrics in needs, in braces."""

    name: str
    reject: str
    needs: tuple[str, ...]


#: The base: too few words, or more than half of them in repeated windows of three.
BASE = (
    Rule("few_words", "{n_words} < 50", ("n_words",)),
    Rule("repeated_words", "100 * {n_repeat_words} > 50 * {n_words}", ("n_repeat_words", "n_words")),
)
#: The production rules. Junk here is marked up, shouted or repeated; prose of any language stays far from each limit.
RULES = (
    Rule("symbols", "10 * {n_symbols} > 3 * {n_words}", ("n_symbols", "n_words")),
    Rule("word_length", "{word_chars} > 20 * {n_words} OR 2 * {n_words} > {word_chars}", ("word_chars", "n_words")),
    Rule("repeated_lines", "{n_dup_lines} > 0 AND 2 * {n_dup_lines} > {n_lines}", ("n_dup_lines", "n_lines")),
    Rule("capitals", "2 * {n_capitals} > {word_chars}", ("n_capitals", "word_chars")),
    Rule("no_letters", "2 * {n_letters} < {word_chars}", ("n_letters", "word_chars")),
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


class Sheet:
    """docs with columns under names that no column of docs begins with; a metric is added once, evaluated only where `unless` is null."""

    def __init__(self, docs: DataFrame):
        self.prefix = "_q_"
        while any(c.lower().startswith(self.prefix) for c in docs.columns):
            self.prefix += "_"
        self.known = definitions()
        self.df = docs.withColumn(self.name("t"), F.coalesce(F.col("text"), F.lit("")))
        self.have = {"t": self.name("t")}

    def name(self, column: str) -> str:
        return self.prefix + column

    def put(self, column: str, sql: str) -> None:
        self.df = self.df.withColumn(self.name(column), F.expr(sql))
        self.have[column] = self.name(column)

    def metric(self, name: str, unless: str | None = None) -> None:
        if name in self.have:
            return
        m = self.known[name]
        for other in m.needs:
            self.metric(other, unless)
        sql = m.sql.format(**self.have)
        self.put(name, sql if unless is None else f"CASE WHEN {unless} IS NULL THEN {sql} END")

    def cascade(self, rules: list[Rule] | tuple[Rule, ...]) -> str:
        """Adds the name of the first rule, in this order, that rejects; null if none does. Returns its column."""
        for i, rule in enumerate(rules):
            now = self.have.get("rejected")
            for name in rule.needs:
                self.metric(name, now)
            hit = f"CASE WHEN {rule.reject.format(**self.have)} THEN '{rule.name}' END"
            self.df = self.df.withColumn(self.name(f"r{i}"), F.expr(hit if now is None else f"CASE WHEN {now} IS NULL THEN {hit} ELSE {now} END"))
            self.have["rejected"] = self.name(f"r{i}")
        # a filter on the verdict would be pushed below the metrics and repeat them at each mention; the row number stops it
        last = self.have.get("rejected", "cast(null as string)")
        self.put("verdict", f"CASE WHEN monotonically_increasing_id() < 0 THEN cast(null as string) ELSE {last} END")
        return self.have["verdict"]


def metrics(docs: DataFrame) -> DataFrame:
    """doc_id and the metrics of COUNTS of the whole text (all long; null counts as empty)."""
    sheet = Sheet(docs.select("doc_id", "text"))
    for name in COUNTS:
        sheet.metric(name)
    return sheet.df.select("doc_id", *[F.col(sheet.have[c]).alias(c) for c in COUNTS])


def order_rules(docs: DataFrame, rules: tuple[Rule, ...] = BASE + RULES, known: tuple[str, ...] = (), sample: int = 2000, seed: int = 7) -> list[Rule]:
    """The rules by rejections per cost, on about `sample` documents of all partitions, chosen by a hash of doc_id, where there is one, and text (texts of under 1 MB); so copies are in the sample in proportion.

    known names metrics that are worked out in any case and cost nothing. The
    sample stays where it is: what comes to the driver is a count for each set
    of rules that reject together, 2^len(rules) rows at most. The same rows
    give the same order.
    """
    if len(rules) > 16:
        raise ValueError("at most 16 rules can be ordered together")
    share = min(1.0, sample / max(1, docs.count()))
    drawn_by = [c for c in ("doc_id",) if c in docs.columns] + ["text"]
    some = docs.select(*drawn_by).where("coalesce(octet_length(text), 0) < 1000000")
    if share < 1:
        some = some.where(F.pmod(F.xxhash64(*drawn_by, F.lit(seed)), F.lit(1 << 40)) < int(share * (1 << 40)))
    sheet = Sheet(some.select("text"))
    for name in {n for rule in rules for n in rule.needs} | {"words"}:
        sheet.metric(name)
    mask = " + ".join(f"CASE WHEN {rule.reject.format(**sheet.have)} THEN {1 << i} ELSE 0 END" for i, rule in enumerate(rules))
    size = {"bytes": f"octet_length({sheet.have['t']})", "words": f"size({sheet.have['words']})"}
    costs = [F.sum(F.expr(m.ns.format(**size)).cast("double")).alias(n) for n, m in sheet.known.items()]
    found = sheet.df.groupBy(F.expr(mask).alias("mask")).agg(F.count(F.lit(1)).alias("n"), *costs).collect()

    def needed(rule: Rule, have: set[str]) -> set[str]:
        out, todo = set(), list(rule.needs)
        while todo:
            name = todo.pop()
            if name not in have | out:
                out.add(name)
                todo += sheet.known[name].needs
        return out

    have: set[str] = set()
    for name in known:
        have |= {name} | needed(Rule("", "", (name,)), set())
    order, left = [], list(range(len(rules)))
    while left:
        open_ = [r for r in found if not any(r.mask >> i & 1 for i in order)]

        def rate(i: int) -> float:
            cost = sum(r[name] for r in open_ for name in sorted(needed(rules[i], have))) + sum(r.n for r in open_)  # a comparison costs about a nanosecond
            return -sum(r.n for r in open_ if r.mask >> i & 1) / max(cost, 1.0)

        best = min(left, key=lambda i: (rate(i), i))
        have |= needed(rules[best], have)
        order.append(best)
        left.remove(best)
    return [rules[i] for i in order]


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, order: list[Rule] | None = None) -> DataFrame:
    """doc_id, text, the metrics of COUNTS, base_failed, rejected_by (a rule's name, 'base' or null) and kept of every row.

    All metrics of COUNTS are wanted here, so the base is known first and the
    rules follow as a cascade. The base fails with under 50 words or if more
    than half of the words lie in repeated windows of three. A null or empty
    text has no words and fails it. Rows are judged one by one, so null or
    repeated doc_ids are no matter; an empty table gives an empty one; other
    columns aren't read. No shuffle.
    """
    order = order_rules(docs, rules, COUNTS) if order is None else order
    sheet = Sheet(docs.select("doc_id", "text"))
    for name in COUNTS:
        sheet.metric(name)
    base = " OR ".join(f"({rule.reject.format(**sheet.have)})" for rule in BASE)
    sheet.put("rejected", f"CASE WHEN {base} THEN 'base' END")
    verdict = sheet.cascade(order)
    counts = [F.col(sheet.have[c]).alias(c) for c in COUNTS]
    return sheet.df.select("doc_id", "text", *counts, F.expr(base).alias("base_failed"), F.col(verdict).alias("rejected_by"), F.col(verdict).isNull().alias("kept"))


def passing(docs: DataFrame, rules: tuple[Rule, ...] = BASE + RULES, order: list[Rule] | None = None) -> DataFrame:
    """The rows of docs that no rule rejects, with docs' own columns, whatever their names.

    Only verdicts are wanted, so the base's rules take their place in the
    cascade, and a document stops at its first rule. Defined for odd rows as
    judge() is.
    """
    order = order_rules(docs, rules) if order is None else order
    sheet = Sheet(docs)
    verdict = sheet.cascade(order)
    return sheet.df.filter(F.col(verdict).isNull()).select(*docs.columns)
