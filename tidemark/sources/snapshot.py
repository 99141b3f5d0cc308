"""Kept results: snapshots with an expiry, the last good one for when a read fails, and a value that is made once."""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException

from tidemark.session import remove

T = TypeVar("T")


class Snapshots:
    """Parquet snapshots below a folder. fresh() recomputes after `ttl` seconds; on failure the last good snapshot serves for `good` seconds. Empty results aren't kept.

    At most `most` names are kept; the one that came first goes, with its
    files. Of a name the last two snapshots stay, so a result that was handed
    out can be read until the name has been made again twice. Files of another
    instance are left alone.
    """

    def __init__(self, spark: SparkSession, folder: str, ttl: float = 300, good: float = 86_400, most: int = 500):
        if most < 1:
            raise ValueError("at least one snapshot must be kept")
        self.spark, self.folder, self.ttl, self.good, self.most = spark, folder.rstrip("/"), ttl, good, most
        self.made: dict[str, list[tuple[float, str]]] = {}

    def fresh(self, name: str, make: Callable[[], DataFrame], now: float) -> DataFrame:
        at, path = self.made[name][-1] if name in self.made else (None, "")
        if at is not None and now < at + self.ttl:
            return self.spark.read.parquet(path)
        try:
            df = make()
            new = f"{self.folder}/{name}-{now:.3f}"
            df.write.mode("overwrite").parquet(new)
            out = self.spark.read.parquet(new)
            if not out.isEmpty():
                self._keep(name, now, new)
            return out
        except (AnalysisException, OSError, RuntimeError):
            if at is not None and now < at + self.good:
                return self.spark.read.parquet(path)
            raise

    def _keep(self, name: str, now: float, path: str) -> None:
        kept = self.made.setdefault(name, [])
        gone = [p for _, p in kept[:-1] if p != path]
        kept[:] = [x for x in kept[-1:] if x[1] != path] + [(now, path)]
        while len(self.made) > self.most:
            gone += [p for _, p in self.made.pop(next(iter(self.made)))]
        for p in gone:
            remove(self.spark, p)


class Memo:
    """A value that is made once, on the driver. While making it fails, whatever fails, the default serves, and it is tried again `cooldown` seconds after the last failure at the earliest."""

    def __init__(self, make: Callable[[], T], default: T, cooldown: float = 60):
        self.make, self.default, self.cooldown = make, default, cooldown
        self.done, self.value, self.failed_at = False, default, None

    def get(self, now: float) -> T:
        if not self.done and (self.failed_at is None or now >= self.failed_at + self.cooldown):
            try:
                self.value, self.done = self.make(), True
            except Exception:  # noqa: BLE001  the default serves, and a later call tries again
                self.failed_at = now
        return self.value
