"""Declared schemas and schemas pinned per target."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import storage
from millrace.functions.columns import name
from millrace.sources.files import PathLike, path_list
from millrace.sources.formats import FormatSpec
from millrace.sources.headers import header_names, plain, scanned_headers, with_headers
from millrace.workspace import new_dir

LEDGER = "path string, modified bigint, length bigint, portion int, header string"
# Names of arriving files that the driver holds at once; more are read and written a portion at a time.
FILES_AT_ONCE = 5_000

# Type names of a column list. The decimal has no parameters.
TYPE_NAMES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "integer": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "decimal": T.DecimalType(10, 2),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
    "binary": T.BinaryType(),
}

# Fixed value. The payload column of a message envelope: binary, so that base64 text in JSON is decoded.
ENVELOPE_HINTS: dict[str, str] = {"value": "binary"}


def struct_from_columns(columns: Iterable[tuple[str, str]]) -> T.StructType:
    """Schema of nullable columns from (name, type name) pairs.

    Type names are case-insensitive; one that is not in ``TYPE_NAMES`` means string.
    """
    schema = T.StructType()
    for column, type_name in columns:
        schema.add(column, TYPE_NAMES.get(type_name.lower(), T.StringType()))
    return schema


def pin_schema(
    spark: SparkSession,
    path: PathLike,
    spec: FormatSpec,
    location: str,
    hints: Mapping[str, str] = ENVELOPE_HINTS,
    infer_types: bool = False,
    evolve: bool = True,
) -> T.StructType:
    """The schema of the files under ``path``, kept at ``location``.

    All matching files are looked at, so no column is missed. Columns that are not pinned yet are
    added, and so are new fields of structs at any depth; a value's type never changes. Without
    ``evolve`` a pinned schema is returned as it is and no file is looked at.

    Columns of formats without types are strings, as no value can fail to parse later;
    ``infer_types`` makes Spark choose types instead. ``hints`` sets the types (as DDL) of single
    columns. For JSON, where a file need not show all its columns, those not found are added.
    """
    pinned = stored_schema(spark, location)
    if pinned is not None and not evolve:
        return pinned
    schema = extended_schema(spark, path, spec, pinned, hints, infer_types)
    if schema != pinned:
        store_schema(spark, schema, location)
    return schema


def extended_schema(
    spark: SparkSession,
    path: PathLike,
    spec: FormatSpec,
    pinned: T.StructType | None,
    hints: Mapping[str, str] = ENVELOPE_HINTS,
    infer_types: bool = False,
) -> T.StructType:
    """``pinned`` with what the files under ``path`` add; see ``pin_schema``."""
    files = file_names(spark, path, spec)
    return Arrived.of(files, spec, new_dir(spark, "found-files")).schema(pinned, hints, infer_types)


def file_names(spark: SparkSession, path: PathLike, spec: FormatSpec) -> DataFrame:
    """``path``, ``modified`` and ``length`` of every matching file; no content is read."""
    options = {k: v for k, v in spec.reader_options().items() if k in ("pathGlobFilter", "recursiveFileLookup")}
    found = spark.read.format("binaryFile").options(**options).load(path_list(path))
    return found.select("path", F.unix_millis("modificationTime").alias("modified"), "length")


@dataclass(frozen=True)
class Arrived:
    """Files to be loaded together, as a table: ``path``, ``modified``, ``length``, ``header`` (of CSV files
    with one) and ``portion``.

    Names stay in the table; the driver takes them a portion at a time, to hand them to a reader.
    """

    spark: SparkSession
    spec: FormatSpec
    files: DataFrame
    portions: int

    @classmethod
    def of(cls, names: DataFrame, spec: FormatSpec, folder: str, at_once: int = FILES_AT_ONCE) -> Arrived:
        """The files of ``names``, with the headers of CSV files that have one, written to ``folder``.

        What a completed earlier run wrote there counts, so that the portions stay the same.
        """
        spark = names.sparkSession
        if not storage.exists(spark, f"{folder}/_SUCCESS"):
            portions = max(1, -(-names.count() // at_once))
            portion = F.pmod(F.xxhash64("path"), F.lit(portions)).cast("int")
            found = names.select("path", "modified", "length", portion.alias("portion"))
            headers = None
            if has_header(spec):
                with_headers(names).write.mode("overwrite").parquet(f"{folder}-headers")
                tried = spark.read.parquet(f"{folder}-headers")
                headers = tried.where("opened").select("path", "header")
                closed = tried.where("NOT opened")
                for number in range(portions) if not closed.isEmpty() else ():
                    if paths := [r.path for r in closed.where(portion == number).select("path").collect()]:
                        headers = headers.unionByName(scanned_headers(spark, paths))
            if headers is None:
                found = found.withColumn("header", F.lit(None).cast("string"))
            else:
                found = found.join(headers, "path")
            found.repartition("portion").write.mode("overwrite").parquet(folder)
        files = spark.read.schema(LEDGER).parquet(folder)
        last = files.agg(F.max("portion")).first()[0]
        return cls(spark, spec, files, 0 if last is None else last + 1)

    def portion(self, number: int) -> dict[str | None, list[str]]:
        """Names of one portion by header, in order; a CSV file without any line has no rows and is left out."""
        groups: dict[str | None, list[str]] = {}
        for row in self.files.where(F.col("portion") == number).collect():
            if row.header is not None or not has_header(self.spec):
                groups.setdefault(row.header, []).append(row.path)
        return {header: sorted(groups[header]) for header in sorted(groups, key=lambda h: min(groups[h]))}

    def schema(
        self,
        pinned: T.StructType | None,
        hints: Mapping[str, str] = ENVELOPE_HINTS,
        infer_types: bool = False,
    ) -> T.StructType:
        """``pinned`` with what all these files add; see ``pin_schema``."""
        spec = self.spec
        found = T.StructType()
        if has_header(spec) and not infer_types:
            # The headers say all; they come in the order of their first files.
            first = self.files.where("header IS NOT NULL").groupBy("header").agg(F.min("path").alias("path"))
            for row in sorted(first.collect(), key=lambda r: r.path):
                own = [T.StructField(c, T.StringType()) for c in header_names(row.header, spec.options["sep"])]
                found = merged_type(found, T.StructType(own))
        else:
            reader = self.spark.read.format(spec.fmt).options(**spec.reader_options())
            match spec.fmt:
                case "json":
                    reader = reader.option("primitivesAsString", not infer_types)
                case "csv":
                    reader = reader.option("inferSchema", infer_types)
                case "parquet":
                    reader = reader.option("mergeSchema", True)
            for number in range(self.portions):
                for header, paths in self.portion(number).items():
                    if header is not None:
                        header_names(header, spec.options["sep"])
                    found = merged_type(found, load_files(reader, paths).schema)
        hinted = {c: T.DataType.fromDDL(ddl) for c, ddl in hints.items()}
        columns = {f.name: hinted.get(f.name, f.dataType) for f in found}
        if spec.fmt == "json":
            columns |= hinted
        found = T.StructType([T.StructField(c, t, True) for c, t in columns.items()])
        return found if pinned is None else merged_type(pinned, found)

    def rows(self, number: int, schema: T.StructType) -> DataFrame:
        """Rows of one portion with the columns of ``schema``; CSV files with a header are read by name."""
        reader = self.spark.read.format(self.spec.fmt).options(**self.spec.reader_options())
        parts = []
        for header, paths in self.portion(number).items():
            if header is None:
                parts.append(load_files(reader.schema(schema), paths))
                continue
            names = header_names(header, self.spec.options["sep"])
            own = T.StructType([schema[c] if c in schema.names else T.StructField(c, T.StringType()) for c in names])
            parts.append(
                load_files(reader.schema(own), paths).select(
                    *[
                        name(f.name) if f.name in names else F.lit(None).cast(f.dataType).alias(f.name)
                        for f in schema
                    ]
                )
            )
        return reduce(DataFrame.unionAll, parts) if parts else self.spark.createDataFrame([], schema)


LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def load_files(reader: DataFrameReader, paths: list[str]) -> DataFrame:
    """The files of these names. Spark looks each of them up first, by default in a task of its own."""
    spark = reader._spark
    before = int(spark.conf.get(LISTING_TASKS))
    spark.conf.set(LISTING_TASKS, min(before, 4 * spark.sparkContext.defaultParallelism))
    try:
        return reader.load([plain(p) for p in paths])
    finally:
        spark.conf.set(LISTING_TASKS, before)


def has_header(spec: FormatSpec) -> bool:
    return spec.fmt == "csv" and bool(spec.options["header"])


def merged_type(old: T.DataType, new: T.DataType) -> T.DataType:
    """``old`` with the fields that only ``new`` has, inside structs, arrays and maps too."""
    match old, new:
        case T.StructType(), T.StructType():
            found = {f.name: f for f in new}
            kept = [
                T.StructField(f.name, merged_type(f.dataType, found[f.name].dataType), True)
                if f.name in found
                else f
                for f in old
            ]
            added = [T.StructField(f.name, f.dataType, True) for f in new if f.name not in old.names]
            return T.StructType([*kept, *added])
        case T.ArrayType(), T.ArrayType():
            return T.ArrayType(merged_type(old.elementType, new.elementType), True)
        case T.MapType(), T.MapType():
            return T.MapType(old.keyType, merged_type(old.valueType, new.valueType), True)
    return old


def store_schema(spark: SparkSession, schema: T.StructType, location: str) -> None:
    state = json.dumps({"schema": schema.jsonValue()})
    spark.createDataFrame([(state,)], "value string").coalesce(1).write.mode("overwrite").text(location)


def stored_schema(spark: SparkSession, location: str) -> T.StructType | None:
    """The schema kept at ``location``, if there is one."""
    try:
        stored = spark.read.text(location, wholetext=True).first()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = None
    return None if stored is None else T.StructType.fromJson(json.loads(stored.value)["schema"])
