"""Positions and running sums over a whole table, by ranges that are worked out apart and shifted by what lies before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize, partitions


def numbered(df: DataFrame, order: list[Column | str], ranges: int = 64, weight: Column | None = None) -> DataFrame:
    """df with _at, each row's place in the order from 0, or with a weight the sum of the weights before it.

    Rows that agree in the order are placed in any order. Rows are dealt into
    ranges of the order and written with their range, as another run of the
    same plan may sample other borders; one row a range is all that one task
    sees of the whole.
    """
    own = F.lit(1).cast("long") if weight is None else F.coalesce(weight.cast("double"), F.lit(0.0))
    ranged = df.withColumn("_own", own).repartitionByRange(max(ranges, partitions(df.sparkSession)), *order).sortWithinPartitions(*order)
    ranged = materialize(ranged.withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}), "ranged")
    zero = F.lit(0).cast("long") if weight is None else F.lit(0.0)
    lower = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = ranged.groupBy("_part").agg(F.sum("_own").alias("_sum")).select("_part", F.coalesce(F.sum("_sum").over(lower), zero).alias("_before"))
    within = Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    met = ranged.withColumn("_at", F.coalesce(F.sum("_own").over(within), zero)).join(F.broadcast(before), "_part")
    return met.withColumn("_at", F.col("_at") + F.col("_before")).select(*df.columns, "_at")
