"""Captured pages in folders, as a Python data source for batches and streams.

    <folder>/<source>/<sequence>-<first page>-<last page>-<name>.jsonl

A file holds pages of one source, a JSON object a line: page_id, url, status,
html. Its name says which pages it holds and when it came, so a filter on source
or page_id leaves whole files out without opening them, and a stream's offset is
a sequence number. A line that can't be read is a page without a status, with
the reason in `fault`; it costs no other line.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from tidemark.session import partitions, ship

SCHEMA = "source string, page_id long, url string, status int, html string, fault string"
_NAME = re.compile(r"(\d+)-(-?\d+)-(-?\d+)-[0-9a-f]+\.jsonl")
#: Rows of one Arrow batch end with the page that reaches so many bytes.
BATCH_BYTES = 4 << 20


class Captured(InputPartition):
    """One file: where it lies, its source, its sequence number and its first and last page."""

    def __init__(self, path: str, source: str, sequence: int, low: int, high: int):
        self.path, self.source, self.sequence, self.low, self.high = path, source, sequence, low, high


def listed(folder: str) -> list[Captured]:
    """All files of a folder, in order of sequence; names that aren't of this form don't count."""
    from pyarrow import fs as pafs

    fs, root = pafs.FileSystem.from_uri(folder)
    found = []
    for info in fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True)):
        if info.is_file and (m := _NAME.fullmatch(info.base_name)):
            found.append(Captured(info.path, unquote(info.path.rsplit("/", 2)[1]), *map(int, m.groups())))
    return sorted(found, key=lambda c: (c.sequence, c.path))


def page_of(line: bytes) -> tuple[int | None, str | None, int | None, str | None, str | None]:
    """(page_id, url, status, html, fault) of a line."""
    try:
        o = json.loads(line)
        page, url, status, html = o["page_id"], o.get("url"), o.get("status"), o.get("html")
        if isinstance(page, bool) or not isinstance(page, int) or not -(2**63) <= page < 2**63:
            raise ValueError("page_id isn't a number")
        for value, kind in ((url, str), (html, str), (status, int)):
            if value is not None and not isinstance(value, kind):
                raise ValueError(f"{value!r} isn't {kind.__name__}"[:200])
            if isinstance(value, str):
                value.encode()  # half a surrogate pair is no text
        return page, url, None if status is None else status if abs(status) < 2**31 else -1, html, None
    except Exception as error:  # noqa: BLE001  whatever is wrong with a page, the others are read
        return None, None, None, None, f"{type(error).__name__}: {error}"[:300]


def _rows(folder: str, part: Captured) -> Iterator:
    import pyarrow as pa
    from pyarrow import fs as pafs

    fs, _ = pafs.FileSystem.from_uri(folder)
    kinds = (pa.string(), pa.int64(), pa.string(), pa.int32(), pa.string(), pa.string())
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    rows, size = [], 0

    def batch_of():
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    with fs.open_input_stream(part.path, compression=None) as stream:
        import io

        for line in io.BufferedReader(stream, 1 << 20):
            if not line.strip():
                continue
            rows.append((part.source, *page_of(line)))
            size += len(line)
            if size >= BATCH_BYTES:
                yield batch_of()
                rows, size = [], 0
    if rows:
        yield batch_of()


class _Reader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder
        self.sources: set[str] | None = None
        self.low, self.high = -(2**63), 2**63 - 1

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes what files' names decide; all filters are applied to rows again, as a file holds more pages than asked for."""
        for f in filters:
            column, value = getattr(f, "attribute", None), getattr(f, "value", None)
            if column == ("source",) and isinstance(f, (EqualTo, In)):
                wanted = {value} if isinstance(f, EqualTo) else set(value)
                self.sources = wanted if self.sources is None else self.sources & wanted
            elif column == ("page_id",) and isinstance(value, int):
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    self.low = max(self.low, value + isinstance(f, GreaterThan))
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    self.high = min(self.high, value - isinstance(f, LessThan))
            yield f

    def partitions(self) -> list[Captured]:
        return [c for c in listed(self.folder) if (self.sources is None or c.source in self.sources) and c.high >= self.low and c.low <= self.high]

    def read(self, partition: Captured | None) -> Iterator:
        if partition is not None:
            yield from _rows(self.folder, partition)


class _Stream(DataSourceStreamReader):
    def __init__(self, folder: str):
        self.folder = folder

    def initialOffset(self) -> dict:
        return {"sequence": -1}

    def latestOffset(self) -> dict:
        return {"sequence": max((c.sequence for c in listed(self.folder)), default=-1)}

    def partitions(self, start: dict, end: dict) -> list[Captured]:
        return [c for c in listed(self.folder) if start["sequence"] < c.sequence <= end["sequence"]]

    def read(self, partition: Captured) -> Iterator:
        yield from _rows(self.folder, partition)


class Captures(DataSource):
    """spark.read.format("captures").load(folder), and readStream likewise, once register() has been called."""

    @classmethod
    def name(cls) -> str:
        return "captures"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"])

    def streamReader(self, schema) -> _Stream:
        return _Stream(self.options["path"])


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Captures)


def write(captures: DataFrame, folder: str, sequence: int) -> int:
    """Writes captures (source, page_id, url, status, html) below the folder, all with one sequence number, greater than those before; the number of files.

    A task writes under names of its own and renames, so a repeated task may
    leave the same pages in a second file only if it was lost after a rename:
    readers then see rows twice, which the upsert's key takes out. Rows without
    source or page_id are refused.
    """
    ship(captures.sparkSession)

    def run(batches) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs as pafs

        fs, root = pafs.FileSystem.from_uri(folder)
        open_: dict[str, list] = {}  # of each source: stream, draft, first and last page
        for batch in batches:
            for source, page, url, status, html in zip(*(batch.column(c).to_pylist() for c in ("source", "page_id", "url", "status", "html")), strict=True):
                if source is None or page is None:
                    raise ValueError("a capture needs a source and a page_id")
                if source not in open_:
                    at = f"{root}/{quote(source, safe='')}"
                    fs.create_dir(at, recursive=True)
                    draft = f"{at}/.{uuid.uuid4().hex}"
                    open_[source] = [fs.open_output_stream(draft, compression=None), draft, page, page]
                file = open_[source]
                file[0].write(json.dumps({"page_id": page, "url": url, "status": status, "html": html}).encode() + b"\n")
                file[2], file[3] = min(file[2], page), max(file[3], page)
        for stream, draft, low, high in open_.values():
            stream.close()
            fs.move(draft, f"{draft.rpartition('/')[0]}/{sequence:012d}-{low}-{high}-{uuid.uuid4().hex[:12]}.jsonl")
        yield pa.RecordBatch.from_pydict({"files": pa.array([len(open_)], pa.int32())})

    rows = captures.select("source", F.col("page_id").cast("long").alias("page_id"), "url", F.col("status").cast("int").alias("status"), "html")
    dealt = rows.repartitionByRange(partitions(captures.sparkSession), "source", "page_id")
    return dealt.mapInArrow(run, "files int").agg(F.coalesce(F.sum("files"), F.lit(0))).first()[0]
