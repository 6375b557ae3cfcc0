"""WARC archives as seekable Zstandard bundles.

Records are grouped into independently compressed frames; a skippable frame at
the end holds the seek table (compressed and plain size of every frame) in the
published seekable format.  The index maps each record to its archive, frame
and offset inside the plain frame, so one record costs one frame.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from typing import Any, BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from natspark.llm.common import materialize
from natspark.session import scratch_path

# Fixed values of the formats.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX_SCHEMA = ("page_id long, archive string, frame int, frame_at long, frame_bytes long, "
                "record_at long, record_bytes long")
# Fixed value: so many payloads, those with most pages, meet their pages by a broadcast.
HOT_PAYLOADS = 256
RECORD_SCHEMA = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
                 "refers_to long, payload binary")


def filesystem(uri: str):
    """(file system, path) of a folder that all executors share."""
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = uri[5:]
    return fs.FileSystem.from_uri(uri)


# -------------------------------------------------------------------- one file

class SeekableWriter:
    """Frames of whole records, then the seek table."""

    def __init__(self, out: BinaryIO, frame_bytes: int, level: int):
        import zstandard

        self.out, self.frame_bytes = out, frame_bytes
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.parts: list[bytes] = []
        self.plain = 0
        self.at = 0
        self.sizes: list[tuple[int, int]] = []

    def add(self, record: bytes) -> tuple[int, int]:
        """Frame number and offset in it; a frame closes once it is full, so
        a longer record is a frame of its own at most with what came before."""
        place = len(self.sizes), self.plain
        self.parts.append(record)
        self.plain += len(record)
        return place

    def full(self) -> bool:
        return self.plain >= self.frame_bytes

    def end_frame(self) -> tuple[int, int]:
        """Writes the frame; its offset in the file and its size."""
        packed = self.zstd.compress(b"".join(self.parts))
        self.out.write(packed)
        self.sizes.append((len(packed), self.plain))
        place = self.at, len(packed)
        self.at += len(packed)
        self.parts, self.plain = [], 0
        return place

    def close(self) -> None:
        table = b"".join(struct.pack("<II", *s) for s in self.sizes)
        footer = struct.pack("<IBI", len(self.sizes), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table) + len(footer)) + table + footer)
        self.out.close()


def seek_table(file: BinaryIO, size: int) -> list[tuple[int, int, int]]:
    """(offset, compressed size, plain size) of each frame, from the footer."""
    file.seek(size - 9)
    n, flags, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    width = 12 if flags & 0x80 else 8
    file.seek(size - 9 - n * width)
    raw = file.read(n * width)
    out, at = [], 0
    for i in range(n):
        packed, plain = struct.unpack_from("<II", raw, i * width)
        out.append((at, packed, plain))
        at += packed
    return out


def read_frame(file: BinaryIO, at: int, packed: int) -> bytes:
    import zstandard

    file.seek(at)
    return zstandard.ZstdDecompressor().decompress(file.read(packed))


# --------------------------------------------------------------------- records

def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_urn(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def _value(text: str) -> str:
    """A header value: line breaks can't stand in it."""
    return text.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
                 date: str) -> bytes:
    """A response with its payload, or a revisit without; both state the HTTP
    length of the payload and its digest."""
    digest = digest32(payload)
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {record_urn(page_id, digest)}", f"WARC-Date: {date}",
            f"WARC-Payload-Digest: sha1:{digest}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url is not None:
        head.append(f"WARC-Target-URI: {_value(url)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {record_urn(refers_to, digest)}", f"X-Refers-To-Page-ID: {refers_to}",
                 f"WARC-Profile: {REVISIT_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode().split("\r\n")[1:]
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}


def parse_records(frame: bytes) -> Iterator[dict[str, Any]]:
    """The records of a plain frame; a response's payload must have the length
    and the digest that its headers state."""
    at = 0
    while at < len(frame):
        body = frame.index(b"\r\n\r\n", at) + 4
        head = _headers(frame[at:body - 4])
        end = body + int(head["content-length"])
        content = frame.index(b"\r\n\r\n", body) + 4
        length = int(_headers(frame[body:content - 4])["content-length"])
        digest = head["warc-payload-digest"].removeprefix("sha1:")
        payload = frame[content:end] if head["warc-type"] == "response" else None
        if payload is not None and (len(payload) != length or digest32(payload) != digest):
            raise ValueError(f"record {head['warc-record-id']} is damaged")
        page, refers = head.get("x-page-id"), head.get("x-refers-to-page-id")
        url = head.get("warc-target-uri")
        if url is not None:
            url = url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
        yield {"page_id": None if page is None else int(page), "url": url, "payload_bytes": length,
               "payload_digest": digest, "record_type": head["warc-type"],
               "refers_to": None if refers is None else int(refers), "payload": payload}
        at = end + 4


# ----------------------------------------------------------------- Spark steps

def with_revisits(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html",
                  url_col: str = "url", min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, refers_to): of the pages with equal payloads of
    at least ``min_bytes`` the smallest id is a response and the others refer
    to it.  Rows that repeat the smallest id are responses too; a null id is
    larger than all others, and null ids alone are all responses."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    rows = rows.withColumn("sha", F.sha1(F.col("payload").cast("binary")))
    several = (rows.where(F.octet_length("payload") >= min_bytes).groupBy("sha")
               .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null"))
    several = materialize(several, "warc-first")
    # The payloads with most pages meet their pages by a broadcast of a stated
    # number of rows and cross no shuffle; no other has a large share of all.
    hot = F.broadcast(materialize(several.orderBy(F.desc("n"), "sha").limit(HOT_PAYLOADS).select("sha", "first"), "warc-hot"))
    others = several.select("sha", "first").join(hot, "sha", "left_anti")
    met = (rows.join(hot, "sha")
           .unionByName(rows.join(hot, "sha", "left_anti").join(others, "sha", "left")))
    return met.select("page_id", "url", "payload",
                      F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))


def write_archives(records: DataFrame, folder: str, frame_bytes: int = 1 << 20, level: int = 3,
                   date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write (page_id, url, payload, refers_to) rows, an archive per task, and
    return the index of the records.

    An archive's name holds the task attempt, and the index names the archives
    of the attempts that succeeded: a repeated task can't mix with the first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ctx = TaskContext.get()
        fs, base = filesystem(folder)
        path = f"{base}/part-{ctx.partitionId():06d}-{ctx.taskAttemptId()}.warc.zst"
        writer, frame = None, []

        def finish() -> pa.RecordBatch:
            at, size = writer.end_frame()
            cols = [pa.array([r[0] for r in frame], pa.int64()), pa.array([path] * len(frame)),
                    pa.array([r[1] for r in frame], pa.int32()), pa.array([at] * len(frame), pa.int64()),
                    pa.array([size] * len(frame), pa.int64()), pa.array([r[2] for r in frame], pa.int64()),
                    pa.array([r[3] for r in frame], pa.int64())]
            frame.clear()
            return pa.RecordBatch.from_arrays(cols, ["page_id", "archive", "frame", "frame_at", "frame_bytes",
                                                     "record_at", "record_bytes"])

        for b in batches:
            for i in range(b.num_rows):
                page, url, payload, refers = (b.column(c)[i].as_py() for c in range(4))
                if writer is None:
                    fs.create_dir(base, recursive=True)
                    writer = SeekableWriter(fs.open_output_stream(path, compression=None), frame_bytes, level)
                record = build_record(page, url, payload.encode(), refers, date)
                frame.append((page, *writer.add(record), len(record)))
                if writer.full():
                    yield finish()
        if writer is not None:
            if frame:
                yield finish()
            writer.close()

    return materialize(records.mapInArrow(run, INDEX_SCHEMA), "warc-index")


def read_archives(index: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """All records of the archives that ``index`` names, frame by frame
    through each archive's own seek table."""
    archives = index.select("archive").distinct()
    n = max(1, archives.count())
    schema = RECORD_SCHEMA if with_payload else RECORD_SCHEMA.rpartition(",")[0]
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = filesystem(folder)
        kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "payload": pa.binary()}
        for b in batches:
            for path in b.column(0).to_pylist():
                with fs.open_input_file(path) as file:
                    for at, packed, _ in seek_table(file, file.size()):
                        rows = list(parse_records(read_frame(file, at, packed)))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([r[n] for r in rows], kinds.get(n, pa.string())) for n in names], names)

    # a stated number, so that few small names aren't gathered into one task
    return archives.repartition(n).mapInArrow(run, schema)


def fetch(index: DataFrame, folder: str) -> DataFrame:
    """The records of the given index rows only: each reads its one frame."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = filesystem(folder)
        names = [f.split()[0] for f in RECORD_SCHEMA.split(", ")]
        kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "payload": pa.binary()}
        for b in batches:
            for r in b.to_pylist():
                with fs.open_input_file(r["archive"]) as file:
                    frame = read_frame(file, r["frame_at"], r["frame_bytes"])
                got = next(parse_records(frame[r["record_at"]:r["record_at"] + r["record_bytes"]]))
                yield pa.RecordBatch.from_arrays([pa.array([got[n]], kinds.get(n, pa.string())) for n in names], names)

    return index.mapInArrow(run, RECORD_SCHEMA)


def bundle(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", url_col: str = "url",
           min_bytes: int = 0, folder: str | None = None) -> tuple[DataFrame, str]:
    """Write one record per row of ``pages``; (index, folder).

    A null payload is empty.  The folder is a new one below the shared
    checkpoint folder unless given.  An empty table writes no archive.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    return write_archives(with_revisits(pages, id_col, payload_col, url_col, min_bytes), folder), folder
