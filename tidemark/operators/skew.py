"""Joins that keep one key with a large share of the rows out of a single task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is heavy if it holds more than one in HEAVY of the rows; so at most HEAVY keys are heavy, which bounds the broadcast.
HEAVY = 1000


def left_join_by_key(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """rows LEFT JOIN groups ON keys (null-safe keys aren't matched).

    groups has one row a key and, in the column `size`, the number of rows of
    that key. Keys with more than total / HEAVY rows (HEAVY of them at most)
    go by broadcast and aren't shuffled; the others meet in a shuffled join in
    which no key is large.
    """
    limit = total / HEAVY
    heavy = F.broadcast(groups.filter(F.col(size) > limit))
    light = groups.filter(F.col(size) <= limit)
    hot = rows.join(heavy, keys, "inner")
    cold = rows.join(heavy.select(*keys), keys, "left_anti").join(light, keys, "left")
    return hot.unionByName(cold.select(*hot.columns))
