"""Paths, stop and reset of streaming jobs."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from millrace import storage


@dataclass(frozen=True)
class TargetPaths:
    """Progress and schema folders of one target table: ``<root>/<database>/<table>``."""

    checkpoint: str
    schema: str

    @classmethod
    def under(
        cls, checkpoint_root: str, schema_root: str, database: str, table: str
    ) -> TargetPaths:
        tail = f"{database.strip('`')}/{table.strip('`')}"
        return cls(f"{checkpoint_root.rstrip('/')}/{tail}", f"{schema_root.rstrip('/')}/{tail}")

    def create_checkpoint(self, spark: SparkSession) -> None:
        storage.make_dir(spark, self.checkpoint)

    def delete_checkpoint(self, spark: SparkSession) -> None:
        """Forget the progress: the next run reads all input again."""
        storage.delete(spark, self.checkpoint)

    def delete_schema(self, spark: SparkSession) -> None:
        """Forget the pinned schema: the next run finds it anew."""
        storage.delete(spark, self.schema)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps in its checkpoint, the same in every run."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata", wholetext=True).first().value)["id"]


def reset(spark: SparkSession, table: str, paths: TargetPaths) -> None:
    """Drop the table and forget its progress and schema, so that a rerun starts from nothing."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    paths.delete_checkpoint(spark)
    paths.delete_schema(spark)


def stop(query: StreamingQuery | None) -> bool:
    """Stop a running query; false when there was nothing to stop."""
    if query is None or not query.isActive:
        return False
    query.stop()
    return True
