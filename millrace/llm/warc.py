"""WARC archives with a Zstandard dictionary, and reading them back.

An archive begins with a skippable frame that holds the dictionary, built from the archive's own first
records, and goes on with one compressed frame per record. Records with the payload of another one are
revisits without a payload of their own.
"""

from __future__ import annotations

import base64
import io
import struct
import uuid
from hashlib import sha1

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import column, file_system, write_file
from millrace.workspace import new_dir, written

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEVEL = 3
# The dictionary comes from an archive's first records, at most so many and of so many bytes in all.
SAMPLE_RECORDS, SAMPLE_BYTES = 500, 2 << 20
DICTIONARY_BYTES = 48 * 1024
# Smaller payloads are all stored as responses.
LEAST_BYTES = 0
DATE = "2000-01-01T00:00:00Z"

Page = tuple[int | None, str | None, bytes, int | None]


def digest_of(payload: bytes) -> str:
    return base64.b32encode(sha1(payload).digest()).decode()


def _clean(value: str) -> str:
    """A header value on one line of ASCII."""
    return "".join(c if " " < c < "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record(page: Page, date: str = DATE) -> bytes:
    """One WARC record; ``page`` is its id, address, payload and the id it revisits, if any."""
    number, url, payload, refers = page
    revisit = refers is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"page:{number}")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{name}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
    ]
    if number is not None:
        head.append(f"WARC-Page-ID: {number}")
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    if revisit:
        other = uuid.uuid5(uuid.NAMESPACE_URL, f"page:{refers}")
        head += [f"WARC-Profile: {IDENTICAL}", f"WARC-Refers-To: <urn:uuid:{other}>", f"WARC-Refers-To-Page-ID: {refers}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def build_dictionary(records: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary for records like these; of too few to learn from, their own bytes."""
    total = sum(map(len, records))
    if len(records) >= 16:
        try:
            size = min(size, max(1024, total // 16))
            return zstandard.train_dictionary(size, records, k=256, d=8).as_bytes()
        except zstandard.ZstdError:
            pass
    return b"".join(records)[:size]


class ArchiveWriter:
    """Writes records to an open file; the first ones wait until the dictionary is built from them."""

    def __init__(self, stream, date: str = DATE) -> None:
        self.stream, self.date = stream, date
        self.waiting: list[bytes] = []
        self.held = 0
        self.pack = None
        self.records = 0

    def add(self, page: Page) -> None:
        raw = record(page, self.date)
        self.records += 1
        if self.pack is None:
            self.waiting.append(raw)
            self.held += len(raw)
            if len(self.waiting) >= SAMPLE_RECORDS or self.held >= SAMPLE_BYTES:
                self._begin()
        else:
            self.stream.write(self.pack.compress(raw))

    def _begin(self) -> None:
        dictionary = build_dictionary(self.waiting)
        self.stream.write(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary)
        shared = zstandard.ZstdCompressionDict(dictionary)
        self.pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_checksum=True)
        for raw in self.waiting:
            self.stream.write(self.pack.compress(raw))
        self.waiting = []

    def close(self) -> None:
        if self.pack is None:
            self._begin()


def read_archive(stream):
    """Records of an open archive in order: headers (names in lower case) and block."""
    frame, size = struct.unpack("<II", stream.read(8))
    if frame != DICTIONARY_FRAME:
        raise ValueError("the archive does not begin with a dictionary")
    shared = zstandard.ZstdCompressionDict(stream.read(size))
    unpack = zstandard.ZstdDecompressor(dict_data=shared)
    with unpack.stream_reader(stream, read_across_frames=True) as raw:
        reader = io.BufferedReader(raw, 1 << 16)
        while version := reader.readline():
            if version != b"WARC/1.1\r\n":
                raise ValueError("a record does not begin where the one before it ends")
            headers = {}
            while (line := reader.readline()) not in (b"\r\n", b""):
                name, _, value = line.decode().partition(":")
                headers[name.lower()] = value.strip()
            block = reader.read(int(headers["content-length"]))
            if reader.read(4) != b"\r\n\r\n":
                raise ValueError("a record is cut off")
            yield headers, block


def referred(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``pages`` (id, url, html) with ``refers_to``: the smallest id of a page with an equal payload if
    that is another id and the payload has at least ``least_bytes``, else null."""
    marked = pages.withColumns({"digest": F.sha1("html"), "size": F.octet_length("html")})
    firsts = marked.where(F.col("size") >= least_bytes).groupBy("digest", "size").agg(F.min("id").alias("first"))
    # Written, so that the rows of a frequent payload can be split over tasks in the join.
    firsts = written(firsts, "warc-first")
    other = F.when(F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")), F.col("first"))
    return marked.join(firsts, ["digest", "size"], "left").select("id", "url", "html", other.alias("refers_to"))


def write_archives(
    df: DataFrame,
    folder: str | None = None,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_bytes: int = LEAST_BYTES,
    date: str = DATE,
) -> tuple[str, list[str]]:
    """Write a record per row; the folder and the names of its archives, one per task that had rows.

    The payload is the html in UTF-8, null counting as empty. Of pages with equal payloads those with the
    smallest id are responses, and others revisit it; with ids missing from all, all are responses, and a
    row without an id revisits one that has it. A null url is left out of the record. Other columns are
    ignored. An empty table gives no archives.
    """
    folder = folder or new_dir(df.sparkSession, "warc")
    token = uuid.uuid4().hex
    pages = df.select(
        column(key).cast("bigint").alias("id"),
        column(url).cast("string").alias("url"),
        F.coalesce(column(html), F.lit("")).alias("html"),
    )

    def write(batches):
        context = TaskContext.get()
        rows = (
            (number, address, text.as_buffer().to_pybytes(), refers)
            for batch in batches
            for number, address, text, refers in zip(
                batch.column(0).to_pylist(),
                batch.column(1).to_pylist(),
                batch.column(2).cast(pa.binary()),
                batch.column(3).to_pylist(),
                strict=True,
            )
        )
        first = next(rows, None)
        if first is None:
            return

        def fill(stream):
            archive = ArchiveWriter(stream, date)
            archive.add(first)
            for page in rows:
                archive.add(page)
            archive.close()
            return archive.records

        name = f"part-{context.partitionId():05d}.warc.zst"
        count = write_file(folder, name, f"{context.taskAttemptId()}-{token}", fill)
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([count], pa.int64())], ["name", "records"])

    # One row per archive.
    found = referred(pages, least_bytes).mapInArrow(write, "name string, records bigint").collect()
    return folder, sorted(r.name for r in found)


def read_archives(spark: SparkSession, folder: str, names: list[str], payloads: bool = False) -> DataFrame:
    """A row per record of the archives: ``page_id``, ``payload_bytes``, ``payload_digest`` (both of the
    full payload, also of revisits), ``record_type``, ``refers_to``, and with ``payloads`` the ``url`` and
    ``payload`` (null for revisits). A response whose payload does not have its digest is an error."""
    schema = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    fields = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    if payloads:
        schema += ", url string, payload binary"
        fields += ["url", "payload"]
        kinds += [pa.string(), pa.binary()]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(values, kind) for values, kind in zip(zip(*rows, strict=True), kinds, strict=True)], fields
        )

    def number(headers, name):
        return int(headers[name]) if name in headers else None

    def read(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                files, root = file_system(folder)
                rows, held = [], 0
                with files.open_input_stream(f"{root}/{name}", compression=None, buffer_size=1 << 20) as stream:
                    for headers, block in read_archive(stream):
                        kind = headers["warc-type"]
                        head, _, payload = block.partition(b"\r\n\r\n")
                        size = int(head.rsplit(b"Content-Length:", 1)[1])
                        digest = headers["warc-payload-digest"].removeprefix("sha1:")
                        if kind == "response" and (len(payload) != size or digest_of(payload) != digest):
                            raise ValueError("a payload does not have its digest")
                        row = [
                            number(headers, "warc-page-id"),
                            size,
                            digest,
                            kind,
                            number(headers, "warc-refers-to-page-id"),
                        ]
                        if payloads:
                            row += [headers.get("warc-target-uri"), payload if kind == "response" else None]
                            held += len(payload)
                        rows.append(row)
                        if len(rows) >= 10_000 or held > 1 << 24:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    listed = spark.createDataFrame([(n,) for n in names], "name string")
    return listed.repartition(max(1, len(names))).mapInArrow(read, schema)
