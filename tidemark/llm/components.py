"""Connected components of links between long ids, by repeated hooking in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize, tidied


@tidied("labels")
def components(links: DataFrame, most: int = 60) -> DataFrame:
    """(id, label) for every id of links (a, b): label is the smallest id of its component.

    Every round hooks each id to its smallest neighbour below it, that one's
    other neighbours likewise, and jumps to grandparents; it ends when every id
    points at a root. Each round is written to the shared folder, so lineage
    stays short. Nothing is collected but counts.
    """
    edges = materialize(links.filter("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("r")).distinct(), "links")
    for _ in range(most):
        best = edges.groupBy("v").agg(F.min("r").alias("m"), F.count(F.lit(1)).alias("k"))
        up = best.select(F.col("v").alias("m"), F.col("m").alias("g"))
        hooked = edges.join(best, "v")
        jumped = best.join(up, "m", "left").select("v", F.coalesce("g", "m").alias("r"), (F.col("g").isNotNull() | (F.col("k") > 1)).alias("open"))
        aside = hooked.filter("r <> m").select(F.col("r").alias("v"), F.col("m").alias("r"), F.lit(True).alias("open"))
        new = materialize(jumped.unionByName(aside).groupBy("v", "r").agg(F.max("open").alias("open")), "round")
        edges = new.select("v", "r")
        if new.filter("open").isEmpty():
            break
    else:
        raise RuntimeError(f"components aren't settled after {most} rounds")
    roots = edges.select(F.col("r").alias("id")).distinct().withColumn("label", F.col("id"))
    return materialize(edges.select(F.col("v").alias("id"), F.col("r").alias("label")).unionByName(roots), "labels")
