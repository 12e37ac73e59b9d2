"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import os
import string
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.workspace import written

# Texts are taken from an Arrow batch in runs of about so many characters, which bounds a task's memory.
CHUNK_CHARS = 1 << 20
ASCII_LETTERS = string.ascii_letters.encode()
ASCII_SIGNS = (string.digits + string.punctuation).encode()


def column(name: str):
    """A top-level column by its exact name, dots and back-ticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(df: DataFrame, base: str) -> str:
    """``base``, extended until no column of ``df`` has that name in any case."""
    taken = {name.lower() for name in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def chunks(texts: pa.Array, max_chars: int = CHUNK_CHARS) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts with the row each starts at; null is the empty text."""
    start, size, run = 0, 0, []
    for value in texts:
        text = value.as_py() or ""
        if run and size + len(text) > max_chars:
            yield start, run
            start, size, run = start + len(run), 0, []
        run.append(text)
        size += len(text)
    if run:
        yield start, run


def hash_sample(df: DataFrame, names: list[str], limit: int) -> DataFrame:
    """At most ``limit`` rows of ``df``: those with the smallest hash of the columns ``names``.

    Rows far above the bound that this needs are left out first: about four times the limit of the
    counted rows stay. So what tasks hand on for the final choice does not grow with the table.
    """
    mark = F.xxhash64(*[column(n) for n in names])
    share = 4 * limit / max(1, df.count())
    if share < 1:
        df = df.where(mark < int(share * 2.0**64) - (1 << 63))
    return df.orderBy(mark, *[column(n) for n in names]).limit(limit)


def numbered(df: DataFrame, order: list, name: str, deal: list | None = None) -> DataFrame:
    """``df`` with each row's number from 0 in ``order``, which must tell all rows apart.

    Rows are dealt by ranges of the order, numbered within a range and written to the shared folder; the
    driver gets a count per range. So no task sees more than its range. ``deal`` is a coarser form of the
    order for dealing, where Spark should not sample the whole values of ``order`` for the bounds.
    """
    at, part, before = (free_name(df, base) for base in ("_at", "_part", "_before"))
    # The number that Spark gives holds the partition from bit 33 on and the place in it below.
    sorted_rows = df.repartitionByRange(*(deal or order)).sortWithinPartitions(*order)
    rows = written(sorted_rows.withColumn(at, F.monotonically_increasing_id()), "numbered")
    rows = rows.withColumn(part, F.shiftright(at, 33))
    total, offsets = 0, []
    for own, n in sorted(map(tuple, rows.groupBy(part).agg(F.count("*")).collect())):
        offsets.append((own, total))
        total += n
    table = df.sparkSession.createDataFrame(offsets, f"{part} bigint, {before} bigint")
    number = F.col(before) + F.col(at).bitwiseAND((1 << 33) - 1)
    return rows.join(F.broadcast(table), part).withColumn(name, number).drop(at, part, before)


def cuts_between(*pairs: tuple[bytes, bytes]) -> np.ndarray:
    """A table for ``cut_segments``: cut between each byte of a pair's first and each of its second."""
    table = np.zeros((256, 256), bool)
    for first, second in pairs:
        table[np.ix_(list(first), list(second))] = True
    return table.ravel()


def cut_segments(
    texts: list[str], cuts: np.ndarray, lower: bool = False, drop: bytes = b""
) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Cut texts in columns, between the bytes that ``cuts`` tells; with ``lower``, A-Z in lower case.

    The distinct segments, the number of the segment at each place of all texts in a row, and the place
    at which each text begins (and the last one ends). Segments that begin with a byte of ``drop`` have no place.
    """
    column = pa.array(texts, pa.large_string())
    if lower:
        column = pc.ascii_lower(column)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(texts) + 1, 8 * column.offset)
    size = int(offsets[-1])
    data = data if size else pa.py_buffer(b"")
    raw = np.frombuffer(data, np.uint8, size)
    marks = np.zeros(size + 1, bool)
    marks[1:-1] = cuts[(raw[:-1].astype(np.uint16) << 8) | raw[1:]]
    marks[offsets] = True
    at = np.flatnonzero(marks)
    begins = np.searchsorted(at, offsets)
    # The segments stay where they are in the column's bytes.
    coded = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), data).dictionary_encode()
    numbers = coded.indices.to_numpy()
    if drop:
        kept = ~np.isin(np.arange(256), list(drop))[raw[at[:-1]]]
        numbers, begins = numbers[kept], np.concatenate([[0], np.cumsum(kept)])[begins]
    return coded.dictionary.to_numpy(zero_copy_only=False).tolist(), numbers, begins


def put_together(parts: list[bytes], numbers: np.ndarray, begins: np.ndarray, unit: int = 1) -> list[memoryview]:
    """Of each text the joined parts of its segments; every part's size is a multiple of ``unit``."""
    kind = np.dtype(f"V{unit}") if unit not in (1, 2, 4, 8) else np.dtype(f"u{unit}")
    flat = np.frombuffer(b"".join(parts), kind)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // unit
    starts = np.cumsum(sizes) - sizes
    own = sizes[numbers]
    ends = np.concatenate([[0], np.cumsum(own)])
    whole = flat[np.repeat(starts[numbers] - ends[:-1], own) + np.arange(ends[-1])]
    view = memoryview(np.ascontiguousarray(whole)).cast("B")
    at = (ends[begins] * unit).tolist()
    return [view[a:b] for a, b in zip(at, at[1:], strict=False)]


_owner: list[Callable[[], None] | str] = ["", lambda: None]


def claim(name: str, forget: Callable[[], None]) -> None:
    """Say that this Python worker now works for the operator ``name``, which remembers things between tasks.

    A worker serves many stages one after another; what the operator before it remembers is forgotten, and
    freed memory goes back to the system. ``forget`` is called when the next one claims the worker."""
    if _owner[0] == name:
        return
    _owner[1]()
    _owner[:] = [name, forget]
    give_back()


def give_back() -> None:
    """Return freed memory to the system, where the C library can do that."""
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: StructType | str
) -> DataFrame:
    """Apply ``function`` to each Arrow batch of ``df``. A task's freed memory does not stay with its worker."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from function(batch)
        give_back()

    return df.mapInArrow(run, schema)


def show_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    Workers on other machines need it installed or shipped (``--py-files``); there this does nothing.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system that ``uri`` belongs to and the path in it, for use inside tasks.

    A plain path and ``file:`` are the local view of a shared mount; other schemes are opened by
    Arrow (``s3a`` and ``s3n`` as ``s3``).
    """
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return pafs.LocalFileSystem(), unquote(parts.path)
    if parts.scheme in ("s3a", "s3n"):
        uri = "s3" + uri[len(parts.scheme) :]
    return pafs.FileSystem.from_uri(uri)


def write_file(folder: str, name: str, attempt: str, fill: Callable[[object], object]) -> object:
    """Write ``folder/name`` in one step: ``fill`` gets an open file of the attempt's own, which is
    then moved into place. A repeated attempt replaces the file by the same content."""
    files, root = file_system(folder)
    files.create_dir(root, recursive=True)
    mine = f"{root}/_{name}.{attempt}"
    with files.open_output_stream(mine, compression=None) as stream:
        result = fill(stream)
    files.move(mine, f"{root}/{name}")
    return result

