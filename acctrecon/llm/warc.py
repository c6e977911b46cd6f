"""WARC archives as seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each with some whole WARC
records, and a footer: the seek table of the public seekable format, in a
skippable frame.  A record's place is its bundle, its frame and its offset in
the decompressed frame, so a reader seeks to one frame and decodes no other.

Bundles are written by the tasks, under names that no other attempt uses; the
index (a table) names the files that count, so a task that is run again does
no harm.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctrecon.llm.common import batches, cut, new_folder, rows_of, utf8
from acctrecon.plans.cut import remove_at_exit

#: Equal payloads of fewer bytes are stored each on its own.
REVISIT_BYTES = 1000
#: Decompressed bytes after which a frame, and written ones after which a
#: bundle, is closed.
FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 64 << 20
LEVEL = 3
#: Compressed bytes that a task reads, about.
READ_BYTES = 16 << 20
# Fixed values of the seekable format.
_SKIPPABLE = 0x184D2A5E
_SEEKABLE = 0x8F92EAB1
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_INDEX = "page_id long, bundle string, frame int, frame_at long, frame_bytes long, offset long, length long"


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """A WARC record; a revisit (refers_to given) has no payload."""
    revisit = refers_to is not None
    block = b"" if revisit else _HTTP + payload
    uri = "".join(c for c in (url or "") if c not in "\r\n")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {uri}",
            f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of the records of a decompressed frame."""
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        head = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
        stop = end + 4 + int(head["Content-Length"])
        yield at, head, data[end + 4:stop]
        at = stop + 4


class BundleWriter:
    """Frames and the seek table of one file."""

    def __init__(self, stream):
        self.stream, self.zip = stream, zstandard.ZstdCompressor(level=LEVEL)
        self.frames: list[tuple[int, int]] = []
        self.held, self.at = io.BytesIO(), 0

    def add(self, data: bytes) -> tuple[int, int]:
        """(frame, offset) of the record; close the frame when it is full."""
        place = len(self.frames), self.held.tell()
        self.held.write(data)
        return place

    def flush(self) -> tuple[int, int] | None:
        """Write the frame at hand: its place in the file and its size."""
        raw = self.held.getvalue()
        if not raw:
            return None
        packed = self.zip.compress(raw)
        self.stream.write(packed)
        self.frames.append((len(packed), len(raw)))
        self.held, self.at = io.BytesIO(), self.at + len(packed)
        return self.at - len(packed), len(packed)

    def close(self) -> None:
        entries = b"".join(struct.pack("<II", *f) for f in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, _SEEKABLE)
        self.stream.write(struct.pack("<II", _SKIPPABLE, len(entries) + len(footer)) + entries + footer)
        self.stream.close()


def seek_table(stream, size: int) -> list[tuple[int, int, int]]:
    """(place, compressed, decompressed size) of each frame, from the footer."""
    stream.seek(size - 9)
    n, _, magic = struct.unpack("<IBI", stream.read(9))
    if magic != _SEEKABLE:
        raise ValueError("not a seekable bundle")
    stream.seek(size - 9 - 8 * n)
    out, at = [], 0
    for packed, raw in struct.iter_unpack("<II", stream.read(8 * n)):
        out.append((at, packed, raw))
        at += packed
    return out


def _open(uri: str):
    store, path = fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith(("file:", "/")) else f"/{uri}")
    return store, path


def revisits(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, digest, bytes, refers_to) of the payloads of a page that
    another one stores; a page_id can have several payloads."""
    body = utf8("html")
    digests = cut(pages.where("page_id is not null").select("page_id", F.sha1(body).alias("digest"),
                                                            F.octet_length(body).alias("bytes"))
                  .where(F.col("bytes") >= least), "digests")
    stored = cut(digests.groupBy("digest", "bytes").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
                 .where("n > 1").select(F.col("digest").alias("_g"), F.col("bytes").alias("_b"), "refers_to"), "stored")
    return (digests.join(stored, (F.col("digest") == F.col("_g")) & (F.col("bytes") == F.col("_b")))
            .where("page_id <> refers_to").select("page_id", "digest", "bytes", "refers_to").distinct())


def write_archive(pages: DataFrame, folder: str, *, least: int = REVISIT_BYTES, frame_bytes: int = FRAME_BYTES,
                  bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to bundles in ``folder``; the
    index, a row for each record, kept as a table in the shared folder.

    Null html is an empty payload, null urls are empty.  Rows that repeat a
    page_id have a record each; those of the stored page are responses.  A
    page without an id is always a response.  Other columns are not read.
    """
    again = cut(revisits(pages, least), "revisits")
    body = utf8("html")
    rows = (pages.select(F.col("page_id").cast("long"), "url", body.alias("payload"), F.sha1(body).alias("digest"),
                         F.octet_length(body).alias("bytes"))
            .join(again.select(F.col("page_id").alias("_p"), F.col("digest").alias("_g"), F.col("bytes").alias("_b"),
                               F.col("refers_to").cast("long")),
                  (F.col("page_id") == F.col("_p")) & (F.col("digest") == F.col("_g"))
                  & (F.col("bytes") == F.col("_b")), "left")
            .select("page_id", "url", "payload", "digest", "refers_to"))
    schema = pa.schema([("page_id", pa.int64()), ("bundle", pa.string()), ("frame", pa.int32()),
                        ("frame_at", pa.int64()), ("frame_bytes", pa.int64()), ("offset", pa.int64()),
                        ("length", pa.int64())])

    def run(stream):
        yield from batches(write_bundles(rows_of(stream), folder, frame_bytes, bundle_bytes), schema)

    return cut(rows.mapInArrow(run, _INDEX), "index")


def write_bundles(rows, folder: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> Iterator[tuple]:
    task = TaskContext.get()
    part = task.partitionId() if task else 0
    store, path = _open(folder)
    store.create_dir(path, recursive=True)
    out = waiting = name = None

    def flushed():
        if placed := out.flush():
            yield from ((page, name, frame, *placed, offset, length) for page, frame, offset, length in waiting)
            waiting.clear()

    for page, url, payload, digest, refers_to in rows:
        if out is None:
            name = f"pages-{part:06d}-{uuid.uuid4().hex}.warc.zst"
            out, waiting = BundleWriter(store.open_output_stream(f"{path}/{name}", compression=None)), []
        data = record(page, url, payload, digest, refers_to)
        waiting.append((page, *out.add(data), len(data)))
        if out.held.tell() >= frame_bytes:
            yield from flushed()
            if out.at >= bundle_bytes:
                out.close()
                out = None
    if out is not None:
        yield from flushed()
        out.close()


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that ``index`` (all or some of its rows) names: page_id,
    url, record_type, refers_to, payload, payload_bytes, payload_digest.  Only
    the frames that hold them are read.  A revisit's payload is null."""
    frames = cut(index.groupBy("bundle", "frame", "frame_at", "frame_bytes")
                 .agg(F.sort_array(F.collect_list("offset")).alias("offsets")), "frames")
    # tasks by the bytes that they read, not by those of the index; frames of
    # one bundle side by side, so that a task opens few files
    tasks = max(1, -(-(frames.agg(F.sum("frame_bytes")).first()[0] or 0) // READ_BYTES))
    frames = frames.repartitionByRange(tasks, "bundle", "frame_at").sortWithinPartitions("bundle", "frame_at")
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.int64()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string())])

    def run(stream):
        unzip = zstandard.ZstdDecompressor()
        store, path = _open(folder)

        def rows():
            name = f = table = None
            try:
                for bundle, frame, at, size, offsets in rows_of(stream):
                    if bundle != name:
                        if f is not None:
                            f.close()
                        name, f = bundle, store.open_input_file(f"{path}/{bundle}")
                        table = seek_table(f, f.size())
                    place, packed, raw = table[frame]
                    if (place, packed) != (at, size):
                        raise ValueError(f"index and seek table of {path}/{bundle} differ")
                    f.seek(place)
                    data = unzip.decompress(f.read(packed), max_output_size=raw)
                    wanted = set(offsets)
                    for offset, head, block in parse(data):
                        if offset in wanted:
                            yield _row(head, block)
            finally:
                if f is not None:
                    f.close()

        yield from batches(rows(), schema, lambda r: len(r[4] or b"") + 256)

    return frames.mapInArrow(run, "page_id long, url string, record_type string, refers_to long, payload binary, "
                                  "payload_bytes long, payload_digest string")


def _row(head: dict[str, str], block: bytes) -> tuple:
    number = lambda x: int(n) if (n := x.removeprefix("<urn:page:").rstrip(">")) else None
    page, digest = number(head["WARC-Record-ID"]), head["WARC-Payload-Digest"].removeprefix("sha1:")
    if head["WARC-Type"] == "revisit":
        return (page, head["WARC-Target-URI"], "revisit", number(head["WARC-Refers-To"]), None,
                int(head["X-Payload-Length"]), digest)
    payload = block[len(_HTTP):]
    found = hashlib.sha1(payload).hexdigest()
    if found != digest:
        raise ValueError(f"the payload of page {page} does not have its digest")
    return page, head["WARC-Target-URI"], "response", None, payload, len(payload), found


def archive_round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write all pages, then read all records back from the bundles.  Bundles
    in a folder of this function's own go when the session ends."""
    own = folder is None
    folder = folder or new_folder(pages.sparkSession, "warc")
    index = write_archive(pages, folder)
    if own:
        remove_at_exit(pages.sparkSession, folder)
    return read_records(index, folder)
