"""Dictionary-compressed WARC files: a Zstandard dictionary in a leading skippable frame, then one frame for each record."""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.skew import left_join_by_key
from tidemark.session import materialize, ship, tidied

from .dictionaries import train
from .encoder import slices

#: The skippable frame of a WARC dictionary and the revisit profile.
DICTIONARY_FRAME = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
TRAIN_BYTES = 4 << 20
SCHEMA = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def _header(value: str) -> str:
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """A response record, or a revisit record (HTTP headers only) if refers_to is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_header(url)}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += [f"WARC-Payload-Digest: sha1:{digest(payload)}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _writer(path: str, date: str, level: int):
    def write(batches) -> Iterator:
        import pyarrow as pa
        import zstandard
        from pyarrow import fs as pafs
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        fs, out = pafs.FileSystem.from_uri(path)
        fs.create_dir(out, recursive=True)
        mine, final = f"{out}/.part-{part:06d}-{uuid.uuid4().hex}", f"part-{part:06d}.warc.zst"
        f = zip_ = None
        held: list[bytes] = []
        size = count = 0

        def begin():
            dictionary = train(held)
            stream = fs.open_output_stream(mine, compression=None)
            stream.write(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary)
            z = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
            for r in held:
                stream.write(z.compress(r))
            held.clear()
            return stream, z

        for batch in batches:
            for piece in slices(batch, "html"):
                for page_id, url, html, refers_to in zip(*(piece.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to")), strict=True):
                    r = record(page_id, url, (html or "").encode(), refers_to, date)
                    count += 1
                    if f is not None:
                        f.write(zip_.compress(r))
                        continue
                    held.append(r)
                    size += len(r)
                    if size >= TRAIN_BYTES:
                        f, zip_ = begin()
        if count:
            if f is None:
                f, zip_ = begin()
            f.close()
            fs.move(mine, f"{out}/{final}")  # a repeated task writes the same file again
            yield pa.RecordBatch.from_pydict({"file": pa.array([final], pa.string()), "records": pa.array([count], pa.int64())})

    return write


def revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """(page_id, digest, refers_to) of the pages whose payload a page with a larger page_id has too."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = materialize(pages.select("page_id", F.sha1(payload).alias("digest"), F.md5(payload).alias("other"), F.octet_length(payload).alias("size")).filter(F.col("page_id").isNotNull() & (F.col("size") >= least)), "payloads")
    keys = ["digest", "other", "size"]
    groups = rows.groupBy(*keys).agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = left_join_by_key(rows, materialize(groups, "groups"), keys, "n", rows.count())
    return materialize(met.filter("page_id < refers_to").select("page_id", "digest", "refers_to").distinct(), "revisits")


@tidied()
def write_archive(pages: DataFrame, path: str, least: int = 0, date: str = "2024-01-01T00:00:00Z", level: int = 3) -> list[tuple[str, int]]:
    """Writes page_id, url and html of pages as WARC files at path; (file, records) of each.

    Of equal payloads of at least `least` bytes, the rows with the largest
    page_id are responses and the others revisits that refer to it; all smaller
    ones are responses. A null html is an empty payload. Rows with a null
    page_id are responses that nothing refers to. Rows with the same page_id
    are records of their own. An empty table has no file. Each file's
    dictionary is trained on its own first records (4 MB, or one record, cut
    into short samples), however few or large they are.
    """
    spark = pages.sparkSession
    ship(spark)
    again = revisits(pages, least)
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", "html", F.sha1(payload).alias("digest")).join(again, ["page_id", "digest"], "left")
    done = rows.select("page_id", "url", "html", "refers_to").mapInArrow(_writer(path, date, level), "file string, records long").collect()
    return sorted((r.file, r.records) for r in done)


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an open file of this format."""
    import zstandard

    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICTIONARY_FRAME:
        raise ValueError("no dictionary frame at the start")
    dictionary = stream.read(size)
    unzip = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    text = io.BufferedReader(unzip.stream_reader(stream, read_across_frames=True), 1 << 20)
    while line := text.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"not the start of a record: {line[:40]!r}")
        headers = {}
        while (line := text.readline()) not in (b"\r\n", b""):
            k, _, v = line.decode().partition(":")
            headers[k] = v.strip()
        n = int(headers["Content-Length"])
        block = text.read(n)
        if len(block) != n or text.read(4) != b"\r\n\r\n":
            raise ValueError("a record ends early")
        yield headers, block


def _number(urn: str | None) -> int | None:
    value = (urn or "").rpartition(":")[2].rstrip(">")
    return int(value) if value.lstrip("-").isdigit() else None


def _reader(path: str):
    def read(batches) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs as pafs

        fs, out = pafs.FileSystem.from_uri(path)
        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        names = [c.split()[0] for c in SCHEMA.split(", ")]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            for file in batch.column("file").to_pylist():
                with fs.open_input_stream(f"{out}/{file}", compression=None) as stream:
                    rows, size = [], 0
                    for h, block in read_records(stream):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        length = int(http.rpartition(b"Content-Length: ")[2])
                        named = h["WARC-Payload-Digest"].removeprefix("sha1:")
                        if h["WARC-Type"] == "response" and (len(payload) != length or digest(payload) != named):
                            raise ValueError(f"{h['WARC-Record-ID']}: the payload isn't what was archived")
                        rows.append((_number(h["WARC-Record-ID"]), h.get("WARC-Target-URI"), h["WARC-Type"], _number(h.get("WARC-Refers-To")), length, named, payload if h["WARC-Type"] == "response" else None))
                        size += len(payload)
                        if len(rows) >= 1000 or size >= 8 << 20:
                            yield batch_of(rows)
                            rows, size = [], 0
                    if rows:
                        yield batch_of(rows)

    return read


def read_archive(spark: SparkSession, path: str, files: list[tuple[str, int]]) -> DataFrame:
    """Every record: page_id, url, record_type, refers_to, payload_bytes and payload_digest (of the full payload), payload (null for revisits)."""
    ship(spark)
    names = spark.createDataFrame([(f,) for f, _ in files], "file string")
    if files:
        names = names.repartitionByRange(len(files), "file")
    return names.mapInArrow(_reader(path), SCHEMA)
