"""Exact deduplication with DataFrame operations only.

Rows are grouped by a 128-bit hash of the normalised text, and then bytes are
compared: the texts of rows whose hash occurs twice or more are grouped by
(hash, text), so copies meet as one row a task. Texts that only share hashes
are told apart there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.skew import left_join_by_key
from tidemark.session import materialize, tidied

from .bitmaps import bitmaps, bits_for, may_have

WHITE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Each run of white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def hash128(text: Column) -> Column:
    return F.unhex(F.md5(F.encode(text, "UTF-8")))


@tidied("keys", "clash", "groups", "collided")
def exact_groups(docs: DataFrame, hash_: Callable[[Column], Column] = hash128, row: str | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of docs (doc_id, text).

    Of rows with equal normalised text, the one with the smallest doc_id is
    kept; rows with a null doc_id come after all others; of rows that agree in
    doc_id too, exactly one is kept. A null text equals the empty text. An
    empty table gives an empty one; other columns aren't read. Shuffled: one
    short row a document, and the texts of documents whose hash repeats, each
    once a task. hash_ maps the normalised text to the group's hash; a weak one
    only costs time. row names a column of stored longs of which each row has
    its own; the result then has it too, as uid.
    """
    uid = [F.col(row).alias("uid")] if row else []
    texts = docs.select("doc_id", *uid, normalised(F.col("text")).alias("norm"))
    sha = F.sha2(F.encode("norm", "UTF-8"), 256)
    rows = materialize(texts.select("doc_id", hash_(F.col("norm")).alias("h"), sha.alias("s"), F.col("uid") if row else F.monotonically_increasing_id().alias("uid")), "keys")
    total = rows.count()
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")).alias("first")
    repeated = materialize(rows.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h"), "repeated")
    # bytes: one row for each (hash, text); two rows for one (hash, digest) are a collision
    bits = bits_for(repeated.count())
    meet = may_have(texts.withColumn("h", hash_(F.col("norm"))), "h", bitmaps(repeated, "h", bits), bits).groupBy("h", "norm").agg(F.count(F.lit(1)).alias("n"))
    clash = materialize(meet.groupBy("h", sha.alias("s")).agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("h", "s"), "clash")
    groups = rows.groupBy("h", "s").agg(F.count(F.lit(1)).alias("group_size"), first).filter("group_size > 1")
    collided = not clash.isEmpty()
    if collided:
        groups = groups.join(clash, ["h", "s"], "left_anti")
    groups = materialize(groups, "groups")
    plain = rows.join(clash, ["h", "s"], "left_anti") if collided else rows
    out = left_join_by_key(plain, groups, ["h", "s"], "group_size", total)
    if collided:
        out = out.unionByName(_apart(texts.withColumns({"h": hash_(F.col("norm")), "s": sha} | ({} if row else {"uid": -1 - F.monotonically_increasing_id()})), clash).select(*out.columns))
    return out.select(
        *["uid"] * bool(row),
        "doc_id",
        F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("first").isNull() | (F.col("first.uid") == F.col("uid"))).alias("kept"),
        F.col("s").alias("text_sha256"),
    )


def _apart(texts: DataFrame, clash: DataFrame) -> DataFrame:
    """Rows whose hash and digest belong to several texts, grouped by the text itself."""
    same = Window.partitionBy("h", "norm")
    rows = materialize(texts.join(clash, ["h", "s"], "left_semi"), "collided")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")).over(same)
    return rows.withColumns({"group_size": F.count(F.lit(1)).over(same), "first": first}).drop("norm")
