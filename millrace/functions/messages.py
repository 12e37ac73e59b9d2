"""Decoding of message envelopes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions.columns import name


def decode_message(
    df: DataFrame, schema: StructType | str, value: str = "value", into: str = "message"
) -> DataFrame:
    """Add ``into``: the JSON text held in the binary or string column ``value``, as a struct.

    Parsing is permissive: a bad field is NULL, text that is not JSON gives a struct of NULLs,
    and a NULL value gives NULL. Catalyst prunes the parsed fields to those used later.
    """
    return df.withColumn(into, F.from_json(name(value).cast("string"), schema))
