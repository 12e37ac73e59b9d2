"""Shared scratch storage and the size check that guards every broadcast."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import storage

# A side is broadcast only after both of these limits were measured to hold.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32 * 1024 * 1024


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. A session without it uses its checkpoint
    folder or, if it is local and has none, a folder beside its warehouse.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "-shared"


def new_dir(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has used before."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    made = _made.get()
    if made is not None:
        made.append(path)
    return path


_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate data of everything called inside, at the end.

    Results that read it must be written or collected inside. Without a scope it stays.
    """
    made: list[str] = []
    outer = _made.set(made)
    try:
        yield
    finally:
        _made.reset(outer)
        for path in made:
            storage.delete(spark, path)


def written(df: DataFrame, label: str) -> DataFrame:
    """Run ``df`` once, keep its rows in the shared folder and read them back.

    The copy survives the loss of executors, and reading it never repeats the work behind it.
    """
    path = new_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measure ``df``: true when its rows and its bytes (as JSON text) are within the limits."""
    if df.count() > max_rows:
        return False
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0]
    return (size or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a measured-small side for broadcast; leave any other side to a shuffled join.

    A shuffled join with a hot key is split at run time by adaptive skew-join handling, which
    covers the left, semi and anti joins used here.
    """
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df
