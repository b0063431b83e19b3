"""WARC archives: write them, normalise whole-file gzip streams, read them back by offset.

A crawler's archive that was compressed as one gzip stream can only be read from its start. The
normaliser inflates such a file once, as a stream, rewrites each record as a gzip member of its own,
and writes a sidecar index of offsets, so that any record can be read by itself. One task works on
one archive; a record is held in pieces, never whole.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitefold.session import fresh_path, materialize

#: Bytes read, inflated or written at once.
PIECE = 1 << 20
#: Payloads of fewer bytes are never recorded as revisits.
MIN_REVISIT_BYTES = 0
#: Date of every record; nothing reads the clock.
DATE = "1970-01-01T00:00:00Z"

#: Fixed values of the WARC format.
_VERSION = b"WARC/1.0"
_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = b"urn:page:"

ARCHIVES = "path string, n_records long"
INDEX = (
    "path string, offset long, length long, record_id string, record_type string, target_uri string, "
    "payload_digest string, content_length long, error string"
)
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _file_system(path: str):
    """The file system of a path all executors can reach, and the path in it."""
    from pyarrow import fs

    uri = path if re.match(r"[a-z0-9]+:/", path) else f"file://{path}"
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def _create(path: str):
    system, name = _file_system(path)
    system.create_dir(name.rpartition("/")[0], recursive=True)
    return system.open_output_stream(name, compression=None)


# --- writing -----------------------------------------------------------------------------------


def _escape(value: str) -> bytes:
    """A header value: control characters and % as %XX."""
    return re.sub(r"[\x00-\x1f\x7f%]", lambda m: f"%{ord(m[0]):02X}", value).encode("utf-8", "replace")


def record(page_id: int | None, url: str | None, payload: bytes, original: int | None) -> Iterator[bytes]:
    """The pieces of a page's record; a revisit of page ``original``, if that is given."""
    http = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
        + str(len(payload)).encode() + b"\r\n\r\n"
    )
    kind = b"response" if original is None else b"revisit"
    own = b"" if page_id is None else str(page_id).encode()
    size = len(http) + (len(payload) if original is None else 0)
    lines = [
        _VERSION, b"WARC-Type: " + kind, b"WARC-Record-ID: <" + _ID + own + b">", b"WARC-Date: " + DATE.encode(),
        b"Content-Type: application/http; msgtype=response",
        b"WARC-Payload-Digest: sha1:" + digest32(payload).encode(),
    ]
    if url is not None:
        lines.append(b"WARC-Target-URI: " + _escape(url))
    if original is not None:
        lines += [b"WARC-Profile: " + _PROFILE, b"WARC-Refers-To: <" + _ID + str(original).encode() + b">"]
    lines.append(b"Content-Length: " + str(size).encode())
    yield b"\r\n".join(lines) + b"\r\n\r\n" + http
    if original is None:
        yield payload
    yield b"\r\n\r\n"


def first_of_equal(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``pages`` (page_id, url, html) with ``original``: the page whose payload a page repeats, or null.

    Payloads are equal when their SHA-1 and length are. All rows with the smallest id of a group are
    responses, also when a row is repeated; a null id comes after all others.
    """
    text = F.coalesce(F.col("html"), F.lit(""))
    keyed = pages.select("page_id", "url", "html", F.sha1(text.cast("binary")).alias("sha1"),
                         F.octet_length(text).cast("long").alias("size"))
    firsts = keyed.where(F.col("size") >= min_bytes).groupBy("sha1", "size").agg(
        F.min("page_id").alias("first_id")
    )
    joined = keyed.join(firsts, ["sha1", "size"], "left")
    repeats = F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("page_id"))
    return joined.select("page_id", "url", "html", F.when(repeats, F.col("first_id")).alias("original"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write the pages as archives of one gzip stream each, one per task; returns (path, n_records).

    The name holds the task's attempt, so an attempt that was lost leaves a file nobody names.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        path = f"{folder}/part-{context.partitionId():06d}-{context.taskAttemptId()}.warc.gz"
        out, packer, count = None, None, 0
        for batch in batches:
            for page, url, html, original in zip(*(batch.column(i) for i in range(4)), strict=True):
                if out is None:
                    out, packer = _create(path), zlib.compressobj(6, zlib.DEFLATED, 31)
                payload = (html.as_py() or "").encode("utf-8", "surrogatepass")
                for piece in record(page.as_py(), url.as_py(), payload, original.as_py()):
                    out.write(packer.compress(piece))
                count += 1
        if out is not None:
            out.write(packer.flush())
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "n_records": [count]})

    rows = pages.select(F.col("page_id").cast("long"), "url", "html", F.col("original").cast("long"))
    return materialize(rows.mapInArrow(write, ARCHIVES), "warc-archives")


# --- the normaliser ----------------------------------------------------------------------------


class _Inflated:
    """Reads a gzip file of one or more members as one stream of bytes."""

    def __init__(self, source) -> None:
        self.source, self.inflater, self.ended = source, zlib.decompressobj(31), False
        self.buffer, self.at = b"", 0  # what lies behind ``at`` is unread

    def _fill(self) -> bool:
        """Add up to one piece to the unread bytes; False at the end of the file."""
        while not self.ended:
            raw = self.inflater.unused_data if self.inflater.eof else self.inflater.unconsumed_tail
            if not raw:
                raw = self.source.read(PIECE)
                if not raw and not self.inflater.eof:
                    raise EOFError("the gzip stream is cut short")
            if not raw:
                self.ended = True
                break
            if self.inflater.eof:
                self.inflater = zlib.decompressobj(31)
            if got := self.inflater.decompress(raw, PIECE):
                self.buffer, self.at = self.buffer[self.at :] + got, 0
                return True
        return False

    def header(self) -> bytes | None:
        """Up to and with the next blank line, however long (an address has no bound); None at the end."""
        seen = 0
        while (end := self.buffer.find(b"\r\n\r\n", self.at + seen)) < 0:
            seen = max(0, len(self.buffer) - self.at - 3)
            if seen > PIECE and not self.buffer.startswith(b"WARC/", self.at):
                raise ValueError("a record header without an end")
            if not self._fill():
                if self.buffer[self.at :].strip():
                    raise EOFError("a record header is cut short")
                return None
        head, self.at = self.buffer[self.at : end + 4], end + 4
        return head

    def pieces(self, size: int) -> Iterator[bytes]:
        while size:
            if self.at == len(self.buffer) and not self._fill():
                raise EOFError("a record is cut short")
            piece = self.buffer[self.at : self.at + size]
            self.at += len(piece)
            size -= len(piece)
            yield piece


def parse_header(head: bytes) -> dict[str, str]:
    """Field names in lower case; the first of repeated fields counts."""
    lines = head.decode("utf-8", "replace").strip("\r\n").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if colon:
            fields.setdefault(name.strip().lower(), value.strip())
    return fields


def normalise_file(source, sink, path: str) -> Iterator[dict]:
    """Rewrite one archive record by record; yields index rows. A damaged rest gives one row with the error."""
    stream, offset = _Inflated(source), 0
    while True:
        try:
            head = stream.header()
            if head is None:
                return
            fields = parse_header(head)
            size = int(fields["content-length"])
            packer, length = zlib.compressobj(6, zlib.DEFLATED, 31), 0
            length += sink.write(packer.compress(head))
            for piece in stream.pieces(size):
                length += sink.write(packer.compress(piece))
            for piece in stream.pieces(4):
                length += sink.write(packer.compress(piece))
            length += sink.write(packer.flush())
        except (EOFError, ValueError, KeyError, zlib.error) as failure:
            yield {"path": path, "offset": offset, "error": f"{type(failure).__name__}: {failure}"}
            return
        yield {
            "path": path, "offset": offset, "length": length,
            "record_id": fields.get("warc-record-id", "").strip("<>"), "record_type": fields.get("warc-type"),
            "target_uri": fields.get("warc-target-uri"),
            "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
            "content_length": size, "error": None,
        }
        offset += length


_INDEX_ARROW = pa.schema([
    ("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("record_id", pa.string()),
    ("record_type", pa.string()), ("target_uri", pa.string()), ("payload_digest", pa.string()),
    ("content_length", pa.int64()), ("error", pa.string()),
])


class _Counting:
    def __init__(self, sink) -> None:
        self.sink = sink

    def write(self, data: bytes) -> int:
        if data:
            self.sink.write(data)
        return len(data)


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite the archives named in column ``path`` below ``folder``; returns the offset index.

    Next to each new archive lies its index as JSON lines (``.idx``). Rows whose ``error`` is not null
    mark where an archive was damaged; the records before it are kept.
    """

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for name in batch.column(0).to_pylist():
                stem = name.rpartition("/")[2].removesuffix(".warc.gz")
                path = f"{folder}/{stem}-{attempt}.warc.gz"
                system, at = _file_system(name)
                with system.open_input_stream(at, compression=None) as source, _create(path) as sink, _create(f"{path}.idx") as side:
                    rows = []
                    for row in normalise_file(source, _Counting(sink), path):
                        side.write(json.dumps(row).encode() + b"\n")
                        rows.append(row)
                        if len(rows) == 4096:
                            yield pa.RecordBatch.from_pylist(rows, _INDEX_ARROW)
                            rows = []
                    yield pa.RecordBatch.from_pylist(rows, _INDEX_ARROW)

    paths = archives.select("path")
    spread = paths.repartition(max(1, paths.count()), "path")
    return materialize(spread.mapInArrow(rewrite, INDEX), "warc-index")


# --- reading -----------------------------------------------------------------------------------


def read_member(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one member."""
    raw = zlib.decompress(data, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = parse_header(head)
    return fields, rest[: int(fields["content-length"])]


def _row(fields: dict[str, str], block: bytes) -> dict:
    def page(name: str) -> int | None:
        text = fields.get(name, "").strip("<>").removeprefix(_ID.decode())
        return int(text) if text else None

    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = fields["warc-type"] == "revisit"
    if revisit:
        size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
        digest = fields["warc-payload-digest"].removeprefix("sha1:")
    else:
        size, digest = len(payload), digest32(payload)
    return {
        "page_id": page("warc-record-id"), "payload_bytes": size, "payload_digest": digest,
        "record_type": fields["warc-type"], "refers_to": page("warc-refers-to") if revisit else None,
    }


def read_records(index: DataFrame) -> DataFrame:
    """Read every indexed record by its offset: page, payload size and digest, type, page it repeats."""
    schema = pa.schema([
        ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source = None, None
        try:
            for batch in batches:
                rows = []
                for path, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if path != name:
                        if source is not None:
                            source.close()
                        system, at = _file_system(path)
                        name, source = path, system.open_input_file(at)
                    rows.append(_row(*read_member(source.read_at(length, offset))))
                yield pa.RecordBatch.from_pylist(rows, schema)
        finally:
            if source is not None:
                source.close()

    spark = index.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        index.where(F.col("error").isNull())
        .select("path", "offset", "length")
        .repartitionByRange(parts, "path", "offset")
        .sortWithinPartitions("path", "offset")
    )
    return ordered.mapInArrow(read, RECORDS)


def archive_and_read(spark: SparkSession, pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write the pages as monolithic archives, normalise them, and read each record back by its offset.

    Null html is an empty payload, a null url leaves the address out, a null id stays null. Columns
    other than page_id, url and html are not read. No rows give no archive and no record. Fails when an
    archive is damaged or a record is missing.
    """
    folder = fresh_path(spark, "warc")
    archives = write_archives(first_of_equal(pages, min_bytes), f"{folder}/raw")
    index = normalise(archives, f"{folder}/members")
    check_whole(archives, index)
    return read_records(index)


def check_whole(archives: DataFrame, index: DataFrame) -> None:
    """Raise if the index names a damaged archive or has another number of records than were written."""
    written = archives.agg(F.sum("n_records")).first()[0] or 0
    damage = F.when(F.col("error").isNotNull(), F.concat_ws(": ", "path", "error"))
    found, failure = index.agg(F.count_if(F.col("error").isNull()), F.min(damage)).first()
    if failure is not None or found != written:
        raise RuntimeError(f"{found} of {written} records are in the index; first damage: {failure}")
