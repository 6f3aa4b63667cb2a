"""WARC archives as seekable Zstandard bundles.

Each task writes its records into bundles: files of independent Zstandard frames of about
``frame_bytes``, followed by a skippable frame with the seek table of the frames (the seekable
format: sizes of each frame, then a fixed footer). A map from record identifiers to
(bundle, frame, offset in the frame, length) comes with them as a table. One record is read by
its frame alone; the whole archive by Spark's binary file reader, bundle by bundle, each of
about ``bundle_bytes``.

Of records with equal payloads of ``least_bytes`` or more, the one with the smallest page_id is a
response and the others are revisits of it. The smallest page_id of each digest is aggregated
with a map-side combine and joined back, so a payload of a third of all pages is one row
per task and its join partition can be split.

Bundles are written through pyarrow's file systems, under a name with the task attempt, and
the table of records is written by Spark: it names only bundles of attempts that ended
well, so a lost executor leaves a file that nothing refers to.

Defined cases: a null html is an empty payload; a null url is ``urn:page:`` with the id; a page
without page_id is a response; repeated rows with the smallest page_id are all
responses; control characters in a url are percent-coded; an empty table gives no bundle and
no row. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyrill.llm.storage import materialize, remember
from keyrill.session import work_dir

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 32 << 20
LEVEL = 3

# Fixed values of the seekable Zstandard format.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1

DATE = "1970-01-01T00:00:00Z"
PLACES = "page_id long, bundle string, frame int, offset long, length long"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(identifier: str) -> int | None:
    number = identifier.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, digest: str | None = None) -> bytes:
    """A response with its payload, or a revisit with the headers only."""
    revisit = refers_to is not None
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else record_id(page_id)[1:-1]
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest or digest_of(payload)}",
    ]
    if revisit:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(refers_to)}",
        ]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(data: bytes, at: int) -> tuple[dict[str, str], int]:
    """Header fields from ``at``, after a first line, and where their block begins."""
    end = data.index(b"\r\n\r\n", at)
    fields = (line.split(": ", 1) for line in data[at:end].decode().split("\r\n")[1:])
    return {name.lower(): value for name, value in fields}, end + 4


def read_record(data: bytes, at: int = 0) -> tuple[dict, int]:
    """The record at ``at`` and where the next one begins; the digest is computed anew where there is a payload."""
    fields, begin = _headers(data, at)
    end = begin + int(fields["content-length"])
    http, body = _headers(data, begin)
    kind = fields["warc-type"]
    stated = fields["warc-payload-digest"].removeprefix("sha1:")
    found = {
        "page_id": page_of(fields["warc-record-id"]),
        "url": fields["warc-target-uri"],
        "record_type": kind,
        "payload_bytes": int(http["content-length"]),
        "payload_digest": stated,
        "refers_to": page_of(fields["warc-refers-to"]) if kind == "revisit" else None,
        "payload": None,
    }
    if kind == "response":
        payload = data[body:end]
        if len(payload) != found["payload_bytes"] or digest_of(payload) != stated:
            raise ValueError(f"payload of {fields['warc-record-id']} does not match its header")
        found["payload"] = payload
    return found, end + 4


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The skippable frame that lists (compressed, whole) sizes of the frames before it."""
    entries = b"".join(struct.pack("<II", *f) for f in frames)
    footer = struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer


def read_seek_table(tail: bytes) -> list[tuple[int, int]]:
    """Frame sizes from the end of a bundle; ``tail`` must hold the whole table."""
    number, flags, magic = struct.unpack("<IBI", tail[-9:])
    if magic != SEEKABLE or flags & 0x7F:
        raise ValueError("no seek table at the end of the bundle")
    width = 12 if flags & 0x80 else 8
    start = len(tail) - 9 - number * width
    return [struct.unpack_from("<II", tail, start + i * width) for i in range(number)]


def _file_system(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), path
    return pyarrow.fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))


class Bundle:
    """A bundle being written: records go into the open frame, full frames to the file."""

    def __init__(self, folder: str, name: str, frame_bytes: int, level: int):
        self.files, root = _file_system(folder)
        self.files.create_dir(root, recursive=True)
        self.name, self.path = name, f"{root}/{name}"
        self.out = self.files.open_output_stream(self.path, compression=None)
        self.compressor = zstandard.ZstdCompressor(level=level)
        self.frame_bytes, self.frames, self.open, self.size, self.written = frame_bytes, [], [], 0, 0

    def add(self, data: bytes) -> tuple[int, int]:
        """Frame number and offset of a record."""
        if self.size and self.size + len(data) > self.frame_bytes:
            self.flush()
        at = len(self.frames), self.size
        self.open.append(data)
        self.size += len(data)
        return at

    def flush(self) -> None:
        if self.size:
            packed = self.compressor.compress(b"".join(self.open))
            self.out.write(packed)
            self.frames.append((len(packed), self.size))
            self.written += len(packed)
            self.open, self.size = [], 0

    def close(self) -> None:
        self.flush()
        self.out.write(seek_table(self.frames))
        self.out.close()


def _write(folder: str, frame_bytes: int, bundle_bytes: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        bundle, number = None, 0
        for batch in batches:
            rows = []
            for page in range(batch.num_rows):
                page_id, url, html, first, sha1 = (batch.column(i)[page].as_py() for i in range(5))
                if bundle is not None and bundle.written + bundle.size >= bundle_bytes:
                    bundle.close()
                    bundle, number = None, number + 1
                if bundle is None:
                    bundle = Bundle(folder, f"{name}-{number}.warc.zst", frame_bytes, level)
                refers_to = first if first is not None and first != page_id and page_id is not None else None
                data = record(page_id, url, (html or "").encode(), refers_to, base64.b32encode(bytes.fromhex(sha1)).decode())
                rows.append((page_id, bundle.name, *bundle.add(data), len(data)))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["page_id", "bundle", "frame", "offset", "length"],
            )
        if bundle is not None:
            bundle.close()

    return run


def write(
    pages: DataFrame, folder: str, least_bytes: int = 0,
    frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, level: int = LEVEL,
) -> DataFrame:
    """Write ``pages`` as bundles under ``folder``; gives the place of every record."""
    html = F.coalesce("html", F.lit(""))
    hashed = pages.select(
        F.col("page_id").cast("long"), "url", "html", F.sha1(html.cast("binary")).alias("sha1"),
        F.octet_length(html).cast("long").alias("size"),
    )
    shared = (
        hashed.filter(F.col("size") >= least_bytes).groupBy("sha1", "size")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1").select("sha1", "size", "first")
    )
    marked = hashed.join(shared, ["sha1", "size"], "left").select("page_id", "url", "html", "first", "sha1")
    return materialize(marked.mapInArrow(_write(folder, frame_bytes, bundle_bytes, level), PLACES), "warc-places")


def _frames(data: bytes) -> Iterator[bytes]:
    expander = zstandard.ZstdDecompressor()
    at = 0
    for packed, whole in read_seek_table(data):
        yield expander.decompress(data[at : at + packed], max_output_size=whole)
        at += packed


def _read(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                for frame in _frames(content.as_py()):
                    found, at = [], 0
                    while at < len(frame):
                        one, at = read_record(frame, at)
                        found.append(one)
                    yield _as_batch(found, with_payload)

    return run


def _as_batch(found: list[dict], with_payload: bool) -> pa.RecordBatch:
    kinds = {
        "page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
        "record_type": pa.string(), "refers_to": pa.int64(),
    }
    if with_payload:
        kinds |= {"url": pa.string(), "payload": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([f[n] for f in found], k) for n, k in kinds.items()], names=list(kinds))


def read(places: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """All records of the bundles named in ``places``."""
    spark = places.sparkSession
    named = places.select("bundle").distinct()
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    whole = files.select(F.substring_index("path", "/", -1).alias("bundle"), "content").join(named, "bundle", "left_semi")
    return whole.select("content").mapInArrow(_read(with_payload), RECORD + ", url string, payload binary" * with_payload)


def _fetch(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _file_system(folder)
        expander = zstandard.ZstdDecompressor()
        tables: dict[str, list[tuple[int, int]]] = {}
        for batch in batches:
            found = []
            for place in batch.to_pylist():
                with files.open_input_file(f"{root}/{place['bundle']}") as f:
                    if place["bundle"] not in tables:
                        f.seek(f.size() - 9)
                        number = struct.unpack("<I", f.read(4))[0]
                        f.seek(f.size() - 9 - 12 * number if 9 + 12 * number < f.size() else 0)
                        tables[place["bundle"]] = read_seek_table(f.read())
                    frames = tables[place["bundle"]]
                    packed, whole = frames[place["frame"]]
                    f.seek(sum(p for p, _ in frames[: place["frame"]]))
                    frame = expander.decompress(f.read(packed), max_output_size=whole)
                found.append(read_record(frame, place["offset"])[0])
            yield _as_batch(found, True)

    return run


def fetch(places: DataFrame, folder: str) -> DataFrame:
    """The records at ``places`` (a part of the table of ``write``), each read by its frame alone."""
    return places.mapInArrow(_fetch(folder), RECORD + ", url string, payload binary")


def warc_digest(pages: DataFrame) -> DataFrame:
    """Write all pages into an archive in the shared folder and read every record back."""
    spark = pages.sparkSession
    folder = work_dir(spark, "warc")
    remember(spark, folder)
    places = write(pages, folder)
    if places.limit(1).count() == 0:
        return spark.createDataFrame([], RECORD)
    return read(places, folder)
