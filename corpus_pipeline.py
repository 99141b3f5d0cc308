"""Corpus preparation in five stages, from documents to packed sequences.

Each stage is (spark, docs, sf_dir) -> DataFrame: it takes every row that its
predecessor kept, and all but the last return the columns of documents. A
stage that drops rows numbers them in a written table, works out the numbers to
drop, and takes them out with one anti join, so each row goes or stays by its
own verdict, whatever its doc_id; the rules judge row by row and need none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, ngram_join, packing, quality_classifier, quality_rules
from tidemark.session import materialize, remove, scratch, tidy


ROW = "_pipeline_row"


def _kept(docs: DataFrame, verdicts: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows of docs without those for which verdicts (uid, kept) says that they aren't kept."""
    rows = materialize(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows")
    with tidy(docs.sparkSession, "dropped"):
        dropped = materialize(verdicts(rows).filter("NOT kept").select(F.col("uid").alias(ROW)), "dropped")
    return rows.join(dropped, ROW, "left_anti").select(*docs.columns)


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _kept(docs, lambda rows: quality_classifier.classify(rows, labels, row=ROW))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.passing(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text, one stays: that with the smallest doc_id."""
    return _kept(docs, lambda rows: exact_dedup.exact_groups(rows, row=ROW))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that n-gram links connect, one stays: that with the smallest doc_id; without doc_id, a document links with nothing."""
    return _kept(docs, lambda rows: ngram_join.ngram_components(rows, row=ROW))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents left, as pieces of sequences."""
    return packing.pack(docs)


STAGES = [("quality classifier", classify), ("quality rules", rules), ("exact dedup", exact), ("n-gram Jaccard join", near), ("packing", pack)]

#: The classifier and the packing have no SQL form; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written and read again, so lineage stays short and nothing is worked out twice.

    What a stage leaves goes as soon as its result is written, and that as soon
    as the next stage's is; in the end there is only what packing reads.
    """
    docs, former = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        label = name.replace(" ", "-")
        with tidy(spark, label):
            path = scratch(spark, label)
            kept = stage(spark, docs, sf_dir)
            kept.write.option("compression", "zstd").parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if former is not None:
            remove(spark, former)
        former = path.rpartition("/")[0]
    return STAGES[-1][1](spark, docs, sf_dir)
