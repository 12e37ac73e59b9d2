"""Header lines of CSV files, read from the beginning of each file only."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of a file that are read first, and again as many as were read while they hold no whole line.
HEAD_BYTES = 64 * 1024
# What Spark's readers call a store, and what Arrow calls it.
ARROW_NAMES = {"": "file", "file": "file", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "hdfs": "hdfs"}
BYTE_ORDER_MARK = b"\xef\xbb\xbf"


def header_names(line: str, sep: str) -> tuple[str, ...]:
    """Column names of a header line; a column without a name is called by its number, as Spark does."""
    names = tuple(n if n else f"_c{k}" for k, n in enumerate(next(csv.reader([line], delimiter=sep))))
    if len({n.lower() for n in names}) < len(names):
        raise ValueError(f"the header {names} repeats a column")
    return names


def with_headers(files: DataFrame) -> DataFrame:
    """Of ``files`` (column ``path``) the ``header``: the first line that is not blank, null without one.

    Tasks read the first bytes of each file. ``opened`` is false for files in a store that tasks cannot open
    by themselves; ``scanned_headers`` finds theirs.
    """
    return files.select("path").mapInArrow(_read_heads, "path string, header string, opened boolean")


def scanned_headers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path`` and ``header`` of files by a scan of their text, wherever Spark can read them."""
    # Spark names the files of a scan by their URI.
    uris = [(p, spark._jvm.org.apache.hadoop.fs.Path(p).toUri().toString()) for p in paths]
    named = spark.createDataFrame(uris, "path string, uri string")
    found = spark.read.text([plain(p) for p in paths])
    lines = found.select("value", "_metadata.file_path", "_metadata.file_block_start")
    first = (
        lines.where("file_block_start = 0 AND trim(value) <> ''")
        .withColumn("at", F.monotonically_increasing_id())
        .groupBy("file_path")
        .agg(F.min_by("value", "at").alias("header"))
    )
    return named.join(first, F.col("uri") == F.col("file_path"), "left").select("path", "header")


def plain(path: str) -> str:
    """A file's name as a reader takes it that would otherwise see a pattern in it."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _read_heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    stores: dict[tuple[str, str], object] = {}
    for batch in batches:
        paths = batch.column(0).to_pylist()
        heads = [_head(path, stores) for path in paths]
        yield pa.RecordBatch.from_arrays(
            [pa.array(paths, pa.string()), pa.array([h for h, _ in heads], pa.string()), pa.array([o for _, o in heads])],
            ["path", "header", "opened"],
        )


def _head(path: str, stores: dict) -> tuple[str | None, bool]:
    """The header of a file, and whether the file could be opened."""
    from pyarrow import fs

    # Names are as the file system has them, not encoded.
    scheme, host, inside = re.fullmatch(r"(?s)(?:([A-Za-z][\w+.-]*):)?(?://([^/]*))?(.*)", path).groups()
    store = ARROW_NAMES.get((scheme or "").lower())
    if store is None:
        return None, False
    try:
        own = stores.get((store, host))
        if own is None:
            own = fs.LocalFileSystem() if store == "file" else fs.FileSystem.from_uri(f"{store}://{host or ''}/")[0]
            stores[store, host] = own
        with own.open_input_file(inside if store in ("file", "hdfs") else f"{host}{inside}") as file:
            return first_line(file), True
    except (OSError, pa.ArrowException, ImportError):
        return None, False


def first_line(file) -> str | None:
    """The first line of an open file that is not blank; lines end as they do for Spark's text reader."""
    size, read = file.size(), 0
    raw = b""
    while True:
        raw += file.read_at(min(max(HEAD_BYTES, read), size - read), read)
        read = len(raw)
        whole = raw.removeprefix(BYTE_ORDER_MARK)
        lines = whole.replace(b"\r\n", b"\n").replace(b"\r", b"\n").split(b"\n")
        # A line end that the last byte may only begin is no matter, as blank lines are passed over.
        for line in lines if read == size else lines[:-1]:
            # Blank is what holds nothing above the space.
            if line.strip(bytes(range(33))):
                return line.decode("utf-8", "replace")
        if read == size:
            return None
