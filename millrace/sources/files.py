"""Batch scans of CSV and text files."""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

PathLike = str | Path | Sequence[str | Path]


def path_list(paths: PathLike) -> list[str]:
    """Paths, directories or globs as strings; URIs should be given as ``str``."""
    given = [paths] if isinstance(paths, str | Path) else paths
    return [p.as_posix() if isinstance(p, Path) else p for p in given]


def scan_csv(
    spark: SparkSession,
    paths: PathLike,
    schema: StructType | str | None = None,
    header: bool = True,
    sep: str = ",",
) -> DataFrame:
    """Rows of CSV files, which stay splittable.

    With ``schema`` the columns are typed by position and a field that does not parse is NULL; a
    header that names other columns, or these in another order, is an error.
    Without it every column is a string named by the header; nothing is inferred, so the data
    is read once. An empty field is NULL.
    """
    reader = spark.read.format("csv").options(header=header, sep=sep)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", not header)
    return reader.load(path_list(paths))


def scan_text(
    spark: SparkSession,
    paths: PathLike,
    line_sep: str | None = "\n",
    name_filter: str | None = "*.txt",
    recursive: bool = True,
) -> DataFrame:
    """One row ``value`` per line of the files whose name matches ``name_filter``.

    ``line_sep=None`` accepts every usual line ending; ``name_filter=None`` takes every file.
    """
    reader = spark.read.format("text").option("recursiveFileLookup", recursive)
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    if name_filter is not None:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.load(path_list(paths))
