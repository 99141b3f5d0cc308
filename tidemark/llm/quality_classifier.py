"""Quality classifier with site posteriors: hierarchical empirical Bayes.

A logistic model on hashed words, hashed character trigrams and a few shape
ratios gives each document's own evidence. Its probabilities, summed over all
documents of a host and of each path of it, give beta-binomial posteriors; a
sparse path leans on its host and a sparse host on the global prior, with
strengths estimated by moments from the grouped sums. A document's own
probability is taken out of the sums before they speak about it. The verdict
adds the log-odds of the site against the prior, within bounds, to the
document's own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.skew import left_join_by_key
from tidemark.session import materialize, ship, tidied

from .encoder import give_back, slices

FEATURES = ("symbols", "pipes", "shouts", "capitals", "digits", "word_length", "distinct", "log_words", "line_words")
#: Bins of words and of character trigrams.
WORDS, TRIGRAMS = 256, 256
#: Labelled documents to fit on, at most: those whose doc_ids hash lowest.
MOST_LABELS = 10_000


def features(docs: DataFrame) -> DataFrame:
    """docs with one double column for each of FEATURES; null text counts as empty."""
    t = "coalesce(text, '')"
    d = docs.withColumn("_w", F.expr(f"split({t}, '[\\\\x20\\\\x09-\\\\x0D]+')")).withColumn("_n", F.expr("cast(size(_w) as double)"))

    def share(pattern: str) -> Column:
        return (F.octet_length(F.expr(t)) - F.octet_length(F.regexp_replace(F.expr(t), pattern, ""))) / F.col("_n")

    return d.withColumns({
        "symbols": F.least(share("[#*$%&<>]"), F.lit(3.0)),
        "pipes": F.least(share(r"\|"), F.lit(1.0)),
        "shouts": F.least(share("!"), F.lit(2.0)),
        "capitals": F.least(share("[A-Z]"), F.lit(6.0)),
        "digits": F.least(share("[0-9]"), F.lit(3.0)),
        "word_length": F.least(F.length(F.expr(t)) / F.col("_n"), F.lit(30.0)),
        "distinct": F.expr("size(array_distinct(_w))") / F.sqrt("_n"),
        "log_words": F.log1p("_n"),
        "line_words": F.log1p(F.col("_n") / (1 + F.octet_length(F.expr(t)) - F.octet_length(F.regexp_replace(F.expr(t), "\n", "")))),
    }).drop("_w", "_n")


class Bags:
    """Words of some texts, each distinct word once, with its hashed features."""

    def __init__(self, texts: pa.Array):
        import xxhash

        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        self.ends = split.offsets.to_numpy().astype(np.int64) - split.offsets[0].as_py()
        coded = split.flatten().dictionary_encode()
        self.at = coded.indices.to_numpy(zero_copy_only=False)
        words = [w.encode() for w in coded.dictionary.to_pylist()]
        self.bin = np.fromiter((xxhash.xxh3_64_intdigest(w) % WORDS for w in words), np.int64, len(words))
        self.full = np.fromiter(map(len, words), np.int64, len(words)) > 0
        data = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint64)
        space = data == 32
        at = np.flatnonzero(~space)  # the middle of each trigram; a word's edges count as spaces
        self.owner = (np.cumsum(space) - 1)[at]
        key = (data[at - 1] | data[at] << np.uint64(8) | data[at + 1] << np.uint64(16)) * np.uint64(0x9E3779B97F4A7C15)
        self.trigram = (key >> np.uint64(40)).astype(np.int64) % TRIGRAMS
        self.trigrams = np.bincount(self.owner, minlength=len(words))

    def total(self, of_word: np.ndarray) -> np.ndarray:
        """Of each text, the sum of its words' values."""
        run = np.append(0.0, np.cumsum(of_word[self.at]))
        return run[self.ends[1:]] - run[self.ends[:-1]]

    def vectors(self) -> np.ndarray:
        """A row of shares for each text: of its words by bin, then of its trigrams by bin."""
        n, k = len(self.ends) - 1, len(self.bin)
        text = np.repeat(np.arange(n), np.diff(self.ends))
        word = np.bincount(text * WORDS + self.bin[self.at], self.full[self.at], n * WORDS).reshape(n, WORDS)
        tri = np.zeros((n, TRIGRAMS))
        for i in range(n):
            often = np.bincount(self.at[self.ends[i] : self.ends[i + 1]], minlength=k)
            tri[i] = np.bincount(self.trigram, often[self.owner], TRIGRAMS)
        return np.hstack([x / np.maximum(x.sum(1, keepdims=True), 1) for x in (word, tri)])

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """vectors() @ weights, by one number for each distinct word."""
        words = self.total(np.where(self.full, weights[: WORDS][self.bin], 0.0)) / np.maximum(self.total(self.full.astype(float)), 1)
        tri = np.bincount(self.owner, weights[WORDS:][self.trigram], minlength=len(self.bin))
        return words + self.total(tri) / np.maximum(self.total(self.trigrams.astype(float)), 1)


@dataclass(frozen=True)
class Model:
    """Weights of WORDS word bins, TRIGRAMS trigram bins and FEATURES, and the bias."""

    bins: np.ndarray
    shape: np.ndarray
    bias: float

    def own(self, texts: pa.Array, shape: np.ndarray) -> np.ndarray:
        """Log-odds of each text, within 12 either way."""
        return np.clip(Bags(texts).scores(self.bins) + shape @ self.shape + self.bias, -12.0, 12.0)


def _vectors(batches) -> Iterator:
    for batch in batches:
        for piece in slices(batch, "text", 64, 1 << 20):
            shape = np.column_stack([piece.column(c).to_numpy() for c in FEATURES])
            rows = np.hstack([Bags(piece.column("text")).vectors(), shape]).astype("<f4")
            yield pa.RecordBatch.from_arrays([piece.column("_id"), piece.column("_y"), pa.array([r.tobytes() for r in rows], pa.binary())], names=["_id", "_y", "x"])


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELS, ridge: float = 10.0, rounds: int = 12) -> Model:
    """A ridge logistic regression by Newton steps, fitted on at most `most` labelled documents (rows that lack a label don't count).

    What comes to the driver is one vector of 2 KB a labelled doc_id, `most` of
    them at most; of rows with one doc_id, the one whose text has the smallest
    hash counts, so the same rows give the same model however they are dealt.
    With labels of one kind only, or none, the model is that kind's smoothed
    log-odds.
    """
    ship(docs.sparkSession)
    chosen = labels.select("doc_id", F.col("quality").cast("double").alias("_y")).where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.max("_y").alias("_y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    met = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.max("_y").alias("_y"), F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("r"))
    rows = features(met.select("doc_id", "_y", "r.text")).select(F.col("doc_id").alias("_id"), "_y", "text", *FEATURES)
    found = rows.mapInArrow(_vectors, "_id long, _y double, x binary").collect()
    once = {r._id: (r._y, bytes(r.x)) for r in sorted(found, key=lambda r: r._id)}
    width = WORDS + TRIGRAMS + len(FEATURES)
    y = np.array([v[0] for v in once.values()])
    if len(set(y.tolist())) < 2:
        return Model(np.zeros(WORDS + TRIGRAMS), np.zeros(len(FEATURES)), float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))))
    x = np.frombuffer(b"".join(v[1] for v in once.values()), "<f4").reshape(-1, width).astype(float)
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w, penalty = np.zeros(width + 1), np.append(np.full(width, ridge), 1e-6)
    penalty[WORDS + TRIGRAMS : width] = 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), z.T @ (y - p) - penalty * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    weights = w[:-1] / scale
    return Model(weights[: WORDS + TRIGRAMS], weights[WORDS + TRIGRAMS :], float(w[-1] - weights @ mean))


def _own(model: Model):
    def run(batches) -> Iterator:
        for batch in batches:
            for piece in slices(batch, "text"):
                own = model.own(piece.column("text"), np.column_stack([piece.column(c).to_numpy() for c in FEATURES]))
                p = 1 / (1 + np.exp(-own))
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in ("uid", "doc_id", "host", "path")), pa.array(own), pa.array(p)], names=["uid", "doc_id", "host", "path", "own", "p"])
        give_back()

    return run


def _strength(n: Column, s: Column, prior: Column) -> Column:
    """Moment estimate of a beta prior's strength from groups (n, s) around prior; between 1 and 10,000."""
    groups = F.sum(F.lit(1.0))
    within = F.sum(s * (1 - s / n)) / F.greatest(F.sum(n) - groups, F.lit(1.0))
    between = F.sum(n * F.pow(s / n - prior, 2)) / F.greatest(groups, F.lit(1.0))
    mean_n = F.sum(n) / groups
    extra = F.greatest((between - within) / mean_n, F.lit(1e-6))
    return F.greatest(F.lit(1.0), F.least(F.lit(10_000.0), within / extra))


@dataclass(frozen=True)
class Strengths:
    prior: float
    host: float
    path: float


def site_sums(scores: DataFrame) -> tuple[DataFrame, Strengths]:
    """(host, path, n, s, host_n, host_s): rows and sums of p of each path and of its host, from scores (host, path, p); and the priors' strengths."""
    paths = materialize(scores.groupBy("host", "path").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("p").alias("s")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s"))
    both = materialize(paths.join(hosts, "host"), "sites")
    total = paths.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    if not total.n:
        return both, Strengths(0.5, 1.0, 1.0)
    prior = (total.s + 0.5) / (total.n + 1)
    k_host = hosts.agg(_strength(F.col("host_n"), F.col("host_s"), F.lit(prior)).alias("k")).first().k
    host_mean = (F.col("host_s") + k_host * prior) / (F.col("host_n") + k_host)
    k_path = both.agg(_strength(F.col("n"), F.col("s"), host_mean).alias("k")).first().k
    return both, Strengths(prior, k_host, k_path)


def site_shift(k: Strengths, rows: int = 0, p: Column | None = None) -> Column:
    """Log-odds of a path's posterior mean against the prior, from site sums without `rows` rows whose p is given."""
    p = F.lit(0.0) if p is None else p
    host = (F.greatest(F.col("host_s") - p, F.lit(0.0)) + k.host * k.prior) / (F.col("host_n") - rows + k.host)
    mean = (F.greatest(F.col("s") - p, F.lit(0.0)) + k.path * host) / (F.col("n") - rows + k.path)
    return F.log(mean / (1 - mean)) - float(np.log(k.prior / (1 - k.prior)))


def site_posteriors(scores: DataFrame) -> DataFrame:
    """(host, path, n, shift) of every site, from scores (host, path, p) of all its rows."""
    both, k = site_sums(scores)
    return both.select("host", "path", "n", site_shift(k).alias("shift"))


@tidied("scores", "sites")
def classify(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", threshold: float = 0.5, most_shift: float = 2.0, most: int = MOST_LABELS, row: str | None = None) -> DataFrame:
    """doc_id, own (log-odds of the text alone), shift (of its site without itself, within +-most_shift), score (probability) and kept of every row.

    host and path name the columns that say where a document comes from; nulls
    are a site of their own. A null text counts as empty. Null and repeated
    doc_ids stay rows of their own. An empty table gives an empty one. Site
    posteriors cover all rows; a host with a large share of them meets its
    documents by a broadcast of bounded size. row names a column of longs of
    which each row has its own; the result then has it too, as uid.
    """
    ship(docs.sparkSession)
    model = fit(docs, labels, most)
    where = [F.coalesce(F.col(c).cast("string"), F.lit("\x00none")).alias(a) for c, a in ((host, "host"), (path, "path"))]
    uid = (F.col(row) if row else F.lit(0)).cast("long").alias("uid")
    shapes = features(docs.select(uid, F.col("doc_id").cast("long").alias("doc_id"), "text", *where)).select("uid", "doc_id", "host", "path", "text", *FEATURES)
    rows = materialize(shapes.mapInArrow(_own(model), "uid long, doc_id long, host string, path string, own double, p double"), "scores")
    sites, k = site_sums(rows)
    met = left_join_by_key(rows, sites, ["host", "path"], "n", rows.count())
    shift = F.greatest(F.lit(-most_shift), F.least(F.lit(most_shift), F.coalesce(site_shift(k, 1, F.col("p")), F.lit(0.0))))
    out = met.select(*["uid"] * bool(row), "doc_id", "own", shift.alias("shift")).withColumn("score", F.round(1 / (1 + F.exp(-(F.col("own") + F.col("shift")))), 9))
    return out.withColumn("kept", F.col("score") >= threshold)
