"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import re
import tempfile
import threading
import uuid
from contextlib import contextmanager
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def build_session(master: str = "local[8]", app: str = "tidemark", **conf: str) -> SparkSession:
    """A UTC session with AQE, for local runs; a cluster brings its own."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package where it isn't installed, and, where the session sets no bound, hands them rows by 4 MB."""
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, str(4 << 20))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, on a local master, one of our own where it is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = os.environ.get("TIDEMARK_WORK")
        if not base:
            if not re.match(r"local(\[|$)", spark.sparkContext.master):
                raise RuntimeError("spark.checkpoint.dir is unset: driver and executors need a folder that they share")
            base = os.environ["TIDEMARK_WORK"] = f"file://{tempfile.mkdtemp(prefix='tidemark-')}"
    return base.rstrip("/")


class _Made(threading.local):
    """Of a thread: folders made inside each open tidy(), with the name of what they hold."""

    def __init__(self):
        self.open: list[list[tuple[str, str]]] = []


_made = _Made()


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; a tidy() around it deletes it unless told otherwise."""
    folder = f"{shared_dir(spark)}/tidemark-{uuid.uuid4().hex[:12]}"
    for made in _made.open[-1:]:
        made.append((folder, name))
    return f"{folder}/{name}"


def remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def tidy(spark: SparkSession, *keep: str):
    """Deletes at the end what scratch() and materialize() have made inside, but for names in keep, which go to the tidy() around it, if any.

    What leaves must read no table but those.
    """
    _made.open.append([])
    try:
        yield
    finally:
        for folder, name in _made.open.pop():
            if name not in keep:
                remove(spark, folder)
            elif _made.open:
                _made.open[-1].append((folder, name))


def tidied(*keep: str):
    """For a function of a DataFrame: tidy() around each call."""

    def wrap(f):
        @wraps(f)
        def call(df, *a, **b):
            with tidy(df.sparkSession, *keep):
                return f(df, *a, **b)

        return call

    return wrap


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Writes df to the shared folder and reads it back: cuts lineage, and survives a lost executor."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
