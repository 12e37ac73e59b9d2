"""Batch loading of files into catalog tables."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, DataType, MapType, StructField, StructType

from millrace.functions.columns import quoted
from millrace.sources.files import PathLike, scan_csv, scan_text

# Layer database to its folder. The ``clean`` layer lives in ``silver``.
LAYERS = {"bronze": "bronze", "clean": "silver"}


def qualified(database: str, table: str, catalog: str = "spark_catalog") -> str:
    """Three-part table name with every part quoted; parts already in backticks stay."""
    return ".".join(_part(part) for part in (catalog, database, table))


def ensure_layers(spark: SparkSession, root: str, layers: Mapping[str, str] = LAYERS) -> None:
    """Create the layer databases that do not exist yet, each in its folder under ``root``."""
    for database, folder in layers.items():
        location = f"{root.rstrip('/')}/{folder}".replace("'", "\\'")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_part(database)} LOCATION '{location}'")


# Streams write each batch to a folder of its own inside the table's.
FOLDERS = {"recursiveFileLookup": "true"}


def write_table(df: DataFrame, table: str, mode: str = "append", fmt: str = "parquet") -> None:
    """Write to a managed table, created on first use. Streams may append to the same table."""
    df.write.mode(mode).format(fmt).options(**FOLDERS).saveAsTable(table)


def ensure_table(spark: SparkSession, table: str, schema: StructType) -> str:
    """Create the table if need be, with folders inside its own read too; returns its location."""
    if not spark.catalog.tableExists(table):
        spark.createDataFrame([], schema).write.format("parquet").options(**FOLDERS).saveAsTable(table)
    detail = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    found = {r.col_name: r.data_type for r in detail}
    if "recursiveFileLookup=true" not in (found.get("Storage Properties") or "").replace(" ", ""):
        pairs = ", ".join(f"'{k}' = '{v}'" for k, v in FOLDERS.items())
        spark.sql(f"ALTER TABLE {table} SET SERDEPROPERTIES ({pairs})")
    return found["Location"]


def add_missing_columns(spark: SparkSession, table: str, schema: StructType) -> None:
    """Give an existing table the columns of ``schema`` it lacks; they are NULL in its rows.

    A column whose type has become wider inside (a struct with more fields) cannot be changed in
    such a table, so that is an error rather than a loss of the new fields.
    """
    if not spark.catalog.tableExists(table):
        return
    there = spark.table(table).schema
    present = there.names
    for field in schema:
        if field.name in present and _fields(field.dataType) - _fields(there[field.name].dataType):
            raise ValueError(
                f"column {field.name} of {table} is {there[field.name].dataType.simpleString()} and "
                f"cannot become {field.dataType.simpleString()}"
            )
    missing = StructType([StructField(f.name, f.dataType) for f in schema if f.name not in present])
    if missing.fields:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({missing.toDDL()})")


def load_batch(
    spark: SparkSession,
    file_type: str,
    paths: PathLike,
    database: str,
    table: str,
    schema: StructType | str | None = None,
    mode: str = "append",
    catalog: str = "spark_catalog",
    **scan_options: Any,
) -> str:
    """Load ``csv`` or ``text`` files into a table and return its full name.

    ``scan_options`` go to the scan of that file type.
    """
    match file_type:
        case "csv":
            rows = scan_csv(spark, paths, schema, **scan_options)
        case "text":
            rows = scan_text(spark, paths, **scan_options)
        case _:
            raise NotImplementedError(f"no batch load for files of type {file_type!r}")
    full_name = qualified(database, table, catalog)
    write_table(rows, full_name, mode)
    return full_name


def _fields(kind: DataType, at: str = "") -> set[str]:
    """Paths of all fields inside a type."""
    match kind:
        case StructType():
            return {at + f.name for f in kind} | {
                p for f in kind for p in _fields(f.dataType, f"{at}{f.name}.")
            }
        case ArrayType():
            return _fields(kind.elementType, f"{at}[].")
        case MapType():
            return _fields(kind.valueType, f"{at}{{}}.")
    return set()


def _part(part: str) -> str:
    return part if len(part) > 1 and part[0] == part[-1] == "`" else quoted(part)
