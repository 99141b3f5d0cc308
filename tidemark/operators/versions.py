"""Tables in numbered versions: readers pin one, writers make the next, and a version is there whole or not at all.

A table is a folder with data/<name>/_b=<bucket>/ and versions/<number>.json. A
version names, for each bucket, the folder of data that holds it; a commit
writes the buckets that change into a folder of its own and then makes its
version file in one step that fails if another writer was first. So a reader
never sees half a commit, a writer lost at any point leaves only files that no
version names, and nothing has to be recovered. A batch commits its number with
its rows, so a batch that is run again does nothing.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.session import remove

PLACE = "_b"


class Conflict(RuntimeError):
    """Another writer made the next version first."""


class Table:
    """The table at path, whose rows are dealt into `buckets` by the hash of its key columns; buckets and key are fixed by its first version."""

    def __init__(self, spark: SparkSession, path: str, key: list[str], buckets: int = 16):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        self.fs = spark._jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))

    def _list(self, folder: str) -> list:
        at = self._at(folder)
        return list(self.fs.listStatus(at)) if self.fs.exists(at) else []

    def versions(self) -> list[int]:
        """Numbers of all versions that are there, ascending."""
        names = [s.getPath().getName() for s in self._list("versions")]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def manifest(self, version: int | None = None) -> dict:
        """What a version consists of; without a number, the last one; of an absent table, that of version 0, which is empty."""
        version = version if version is not None else max(self.versions(), default=0)
        if version == 0:
            return {"version": 0, "schema": None, "buckets": {}, "batches": {}, "count": self.buckets}
        stream = self.fs.open(self._at("versions", f"{version:020d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def read(self, version: int | None = None, buckets: list[int] | None = None) -> DataFrame | None:
        """Rows of a version, only of some buckets if they are named; None if the table has none yet."""
        m = self.manifest(version)
        if m["schema"] is None:
            return None
        schema = StructType.fromJson(m["schema"])
        folders = [f"{self.path}/data/{name}/{PLACE}={b}" for b, name in m["buckets"].items() if buckets is None or int(b) in buckets]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def placed(self, df: DataFrame) -> DataFrame:
        """df with the bucket of each row."""
        count = self.manifest()["count"]
        return df.withColumn(PLACE, F.pmod(F.xxhash64(*self.key), F.lit(count)).cast("int"))

    def _publish(self, manifest: dict) -> None:
        final = self._at("versions", f"{manifest['version']:020d}.json")
        draft = self._at("versions", f".{uuid.uuid4().hex}")
        out = self.fs.create(draft, True)
        out.write(json.dumps(manifest).encode())
        out.close()
        try:
            if self.fs.getScheme() == "file":  # a rename would replace the other writer's file there; a link doesn't
                os.link(draft.toUri().getPath(), final.toUri().getPath())
            elif self.fs.exists(final) or not self.fs.rename(draft, final):
                raise FileExistsError
        except FileExistsError:
            raise Conflict(f"version {manifest['version']} of {self.path} is there already") from None
        finally:
            self.fs.delete(draft, False)

    def commit(self, rows: DataFrame, base: dict, replaced: list[int], batch: tuple[str, int] | None = None) -> int:
        """Makes the version after `base` (a manifest), in which the buckets replaced, and those that rows (placed()) has rows of, hold those rows and nothing else. Raises Conflict if that version is there."""
        name = uuid.uuid4().hex
        folder = f"{self.path}/data/{name}"
        rows.withColumn("_p", F.col(PLACE)).drop(PLACE).withColumnRenamed("_p", PLACE).repartition(PLACE).write.partitionBy(PLACE).option("compression", "zstd").parquet(folder)
        made = [s.getPath().getName().removeprefix(f"{PLACE}=") for s in self._list(f"data/{name}") if s.isDirectory() and s.getPath().getName().startswith(f"{PLACE}=")]
        schema = StructType([f for f in rows.schema.fields if f.name != PLACE])
        number = base["version"] + 1
        kept = {b: f for b, f in base["buckets"].items() if int(b) not in replaced}
        try:
            self._publish({"version": number, "schema": json.loads(schema.json()), "buckets": kept | dict.fromkeys(made, name), "batches": base["batches"] | (dict([batch]) if batch else {}), "count": base["count"]})
        except Conflict:
            remove(self.spark, folder)
            raise
        return number

    def update(self, changed: DataFrame, merge: Callable[[DataFrame | None, DataFrame], DataFrame], batch: tuple[str, int] | None = None, tries: int = 20) -> int | None:
        """Commits merge(stored rows of the buckets that `changed` meets, changed), again on top of the other writer's version after a conflict.

        None, and nothing done, if the batch's number was committed before or
        `changed` is empty. `changed` is read several times: it should be a
        written table.
        """
        for _ in range(tries):
            base = self.manifest()
            if batch is not None and base["batches"].get(batch[0], -1) >= batch[1]:
                return None
            placed = self.placed(changed)
            met = [r[0] for r in placed.select(PLACE).distinct().collect()]  # at most as many numbers as there are buckets
            if not met:
                return None
            try:
                return self.commit(self.placed(merge(self.read(base["version"], met), changed)), base, met, batch)
            except Conflict:
                continue
        raise Conflict(f"{self.path}: other writers were first {tries} times")

    def clean(self, now: float, grace: float = 3600) -> list[str]:
        """Deletes versions that another has followed for `grace` seconds, and data that no version left names and that is as old. now in seconds since 1970. What was deleted."""
        files = sorted((s for s in self._list("versions") if s.getPath().getName().endswith(".json") and not s.getPath().getName().startswith(".")), key=lambda s: s.getPath().getName())
        gone = [a for a, b in zip(files, files[1:], strict=False) if b.getModificationTime() / 1000 + grace <= now]
        used = {name for s in files if s not in gone for name in self.manifest(int(s.getPath().getName().removesuffix(".json")))["buckets"].values()}
        gone += [s for s in self._list("data") if s.getPath().getName() not in used and s.getModificationTime() / 1000 + grace <= now]
        for s in gone:
            self.fs.delete(s.getPath(), True)
        return [s.getPath().getName() for s in gone]
