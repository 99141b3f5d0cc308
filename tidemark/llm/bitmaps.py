"""A bitmap filter of bounded size: which rows may have a key of a given set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits a key, and bits at most: what is broadcast is 64 MB at most, whatever the input. Beyond some 30 million keys more rows pass that have no key; none is lost.
PER_KEY, MOST_BITS = 16, 1 << 29


def bits_for(keys: int) -> int:
    """A power of two for so many keys."""
    return min(MOST_BITS, 1 << max(15, (PER_KEY * max(1, keys) - 1).bit_length()))


def _at(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits)) + 1


def bitmaps(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """Bitmaps (bucket, bits) with a bit for each key; bits / 32768 rows at most."""
    at = keys.select(_at(F.col(key), bits).alias("at"))
    return at.groupBy(F.bitmap_bucket_number("at").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("_bits"))


def may_have(rows: DataFrame, key: str, maps: DataFrame, bits: int) -> DataFrame:
    """Rows whose bit is set: all with a key of the set, and a few others."""
    at = _at(F.col(key), bits)
    met = rows.withColumns({"_bucket": F.bitmap_bucket_number(at), "_bit": F.bitmap_bit_position(at)}).join(F.broadcast(maps), "_bucket")
    byte = "cast(conv(hex(substring(_bits, cast(_bit div 8 as int) + 1, 1)), 16, 10) as int)"
    return met.filter(f"shiftright({byte}, cast(_bit % 8 as int)) & 1 = 1").drop("_bucket", "_bit", "_bits")
