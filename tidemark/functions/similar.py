"""Pairs of rows whose sets of tokens are alike, found through their rarest tokens.

Tokens are ordered by the number of rows that have them. Two sets that reach a
similarity share a token among the first few of both (the prefix filter), and
their sizes lie within a bound; so only prefixes are joined, and frequent tokens
are hardly ever in one. Where one is in very many prefixes, its rows are dealt
into a grid of groups of bounded size. A pair comes up once, at the first token
that both prefixes share: nothing has to be made distinct.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.skew import left_join_by_key
from tidemark.session import materialize, tidy

#: Rows of one side that a token may bring to one task, at least; more where the thousandth part of all is more, so at most a thousand tokens of a side are dealt out.
HOT, HEAVY = 10_000, 1000


@dataclass(frozen=True)
class Likeness:
    """A similarity of sets and the least that counts. share: of its own tokens, a set shares at least so many with any set that reaches it."""

    name: str
    least: float

    @property
    def share(self) -> float:
        return {"any": 0.0, "jaccard": self.least, "dice": self.least / (2 - self.least)}[self.name]

    def score(self, both: Column, m: Column, n: Column) -> Column:
        """Of sets of m and n tokens with `both` in common."""
        return both / (m + n - both) if self.name == "jaccard" else 2.0 * both / (m + n)


def _up(x: Column) -> Column:
    """The next whole number; what is whole but for rounding stays."""
    return F.ceil(x - 1e-9)


def _ordered(rows: DataFrame, counts: DataFrame, total: int) -> DataFrame:
    """(uid, t): each set as its tokens with their counts, rarest first."""
    met = left_join_by_key(rows.select("uid", F.explode("w").alias("w")), counts, ["w"], "f", total)
    return met.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("f", "w"))).alias("t"))


def _prefixes(rows: DataFrame, ordered: DataFrame, like: Likeness, side: str) -> DataFrame:
    """A row for each token of a set's prefix."""
    n = F.size("t")
    length = n - F.greatest(F.lit(1), _up(n * like.share)) + 1
    sets = rows.join(ordered, "uid").select(F.col("uid").alias(f"{side}_uid"), F.col("row").alias(f"{side}_row"), F.transform("t", lambda x: x["w"]).alias(f"{side}_t"), F.transform(F.slice("t", 1, length), lambda x: x["w"]).alias(f"{side}_p"))
    return sets.select("*", F.explode(f"{side}_p").alias("w"))


def _dealt(rows: DataFrame, hot: DataFrame, side: str, own: str, other: str) -> DataFrame:
    """rows with the place (a, b) in its token's grid: its own part by its uid, the other side's parts all."""
    parts = lambda c: F.coalesce(F.col(c), F.lit(1))
    met = rows.join(F.broadcast(hot), "w", "left")
    mine, theirs = F.pmod(F.xxhash64(f"{side}_uid"), parts(own)).cast("int"), F.explode(F.sequence(F.lit(0), (parts(other) - 1).cast("int")))
    return met.withColumn(own.removeprefix("parts_"), mine).withColumn(other.removeprefix("parts_"), theirs).drop("parts_a", "parts_b")


def pairs(left: DataFrame, right: DataFrame, left_tokens: Column, right_tokens: Column, like: Likeness, hot: int = HOT) -> DataFrame:
    """Columns of left and right (which share no name) and score, for each pair of rows that reaches the similarity; with "any", for each that shares a token.

    Null or empty sets pair with nothing. Repeated tokens count once, repeated
    rows each. What is broadcast are the tokens dealt out, at most 2,000.
    """
    spark = left.sparkSession
    with tidy(spark, "prefixes-left", "prefixes-right", "grid"):
        sides = []
        for df, tokens, name in ((left, left_tokens, "left"), (right, right_tokens, "right")):
            rows = df.select(F.monotonically_increasing_id().alias("uid"), F.struct(*df.columns).alias("row"), F.array_distinct(F.filter(tokens, lambda w: w.isNotNull())).alias("w"))
            sides.append(materialize(rows.filter("size(w) > 0"), name))
        tokens = sides[0].select(F.explode("w").alias("w")).unionByName(sides[1].select(F.explode("w").alias("w")))
        counts = materialize(tokens.groupBy("w").agg(F.count(F.lit(1)).alias("f")), "counts")
        total = counts.agg(F.coalesce(F.sum("f"), F.lit(0))).first()[0]
        l, r = (materialize(_prefixes(rows, _ordered(rows, counts, total), like, s), f"prefixes-{name}") for rows, s, name in zip(sides, "lr", ("left", "right"), strict=True))
        parts = []
        for p, x in ((l, "a"), (r, "b")):
            limit = max(hot, p.count() // HEAVY)
            parts.append(p.groupBy("w").agg(F.ceil(F.count(F.lit(1)) / limit).cast("int").alias(f"parts_{x}")).filter(F.col(f"parts_{x}") > 1))
        grid = materialize(parts[0].join(parts[1], "w", "full"), "grid")
        crowded = not grid.isEmpty()
    key = ["w"]
    if crowded:
        l, r, key = _dealt(l, grid, "l", "parts_a", "parts_b"), _dealt(r, grid, "r", "parts_b", "parts_a"), ["w", "a", "b"]
    m, n = F.size("l_t"), F.size("r_t")
    fits = (F.greatest(m, n) * F.lit(like.share) <= F.least(m, n) + 1e-9) if like.share else F.lit(True)
    met = l.join(r, key).filter(fits & (F.element_at(F.array_intersect("l_p", "r_p"), 1) == F.col("w")))
    out = met.withColumn("score", like.score(F.size(F.array_intersect("l_t", "r_t")), m, n) if like.name != "any" else F.lit(1.0)).filter(F.col("score") >= like.least - 1e-12)
    return out.select("l_row.*", "r_row.*", "score")
