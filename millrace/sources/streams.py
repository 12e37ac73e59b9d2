"""Streaming sources: files, tables and change feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.operators.changes import CHANGE_COLUMNS
from millrace.sources.formats import FormatSpec


# Spark forgets files that are older than the newest by this much, and would never load them.
# Long enough for any file, so the driver remembers all names.
KEEP_ALL = "36500d"


def stream_files(
    spark: SparkSession,
    path: str,
    spec: FormatSpec,
    schema: StructType,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = None,
) -> DataFrame:
    """New files ``*.<format>`` anywhere under ``path``; the checkpoint remembers those seen.

    Files count as new by name, however old they are. The driver keeps the names of all files of
    the folder, so a lasting one should be emptied now and then (``cleanSource`` of the reader).
    The two limits (at most one of them) bound a micro-batch, for a first run over a large
    backlog.
    """
    reader = spark.readStream.format(spec.fmt).schema(schema).options(**spec.reader_options())
    reader = reader.option("maxFileAge", KEEP_ALL)
    return _limited(reader, max_files_per_trigger, max_bytes_per_trigger).load(path)


def stream_file_names(
    spark: SparkSession,
    path: str,
    spec: FormatSpec,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = None,
) -> DataFrame:
    """The new files that ``stream_files`` would read, without their content: ``path``, ``modified`` (in
    milliseconds) and ``length``."""
    found = spec.reader_options()
    reader = spark.readStream.format("binaryFile").schema(
        "path string, modificationTime timestamp, length bigint, content binary"
    )
    reader = reader.options(
        pathGlobFilter=found["pathGlobFilter"], recursiveFileLookup="true", maxFileAge=KEEP_ALL
    )
    files = _limited(reader, max_files_per_trigger, max_bytes_per_trigger).load(path)
    return files.select("path", F.unix_millis("modificationTime").alias("modified"), "length")


def stream_table(
    spark: SparkSession,
    table: str,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = None,
) -> DataFrame:
    """Rows added to a table. A rewritten file arrives again, with rows that did not change."""
    return _limited(spark.readStream, max_files_per_trigger, max_bytes_per_trigger).table(table)


def stream_changes(
    spark: SparkSession,
    table: str | None = None,
    path: str | None = None,
    schema: StructType | None = None,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = None,
) -> DataFrame:
    """A change feed kept as a table, or as parquet files under ``path`` with their ``schema``.

    The feed must carry ``_change_type``, ``_commit_version`` and ``_commit_timestamp``.
    """
    if (table is None) == (path is None):
        raise ValueError("give either a table or a path")
    if table is not None:
        feed = stream_table(spark, table, max_files_per_trigger, max_bytes_per_trigger)
    else:
        if schema is None:
            raise ValueError("a change feed read from a path needs its schema")
        feed = stream_files(
            spark, path, FormatSpec("parquet"), schema, max_files_per_trigger, max_bytes_per_trigger
        )
    missing = [c for c in CHANGE_COLUMNS if c not in feed.columns]
    if missing:
        raise ValueError(f"not a change feed, it lacks {missing}")
    return feed


def _limited(reader, files: int | None, size: str | None):
    if files is not None and size is not None:
        raise ValueError("limit a micro-batch by files or by bytes, not both")
    if files is not None:
        reader = reader.option("maxFilesPerTrigger", files)
    if size is not None:
        reader = reader.option("maxBytesPerTrigger", size)
    return reader
