"""A keyed table kept up to date from a stream, as a base and a log of changes.

Each micro-batch writes only its own reduced rows, so its cost does not depend on the size of the
table. Reading joins the log into the base; ``compact`` folds the log into a new base. Folders:

    <root>/base/upto=<batch id>    the table after that batch (-1: before the first)
    <root>/log/_batch_id=<id>      the latest row per key of one micro-batch

A log too large to broadcast makes every reading shuffle the base. A base kept in ``buckets`` by
key avoids that: then only the log is shuffled, to the buckets, also when compacting.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from millrace import storage
from millrace.functions.columns import columns_of, matches, name, quoted
from millrace.operators.changes import DELETE, latest_per_key
from millrace.operators.merge import join_by_key, repeated_keys, replace_keys
from millrace.streaming.jobs import stream_id

BEFORE_FIRST_BATCH = -1
RESERVED = {"_batch_id", "_change_type"}


@dataclass(frozen=True)
class MergeTarget:
    """The table under ``root``: its columns, its keys and the order of rows within a batch.

    The latest row per key of a batch replaces or adds that key; with ``delete`` the stream is a
    change feed, whose ``delete`` rows remove their key. Between batches the last one wins, even
    if its row is older. With ``order_guard`` the greatest ``order_by`` columns win there too,
    which then must be columns of the table; batches only break ties.

    ``buckets`` should be at least ``spark.sql.shuffle.partitions``, or Spark prefers to shuffle.
    """

    spark: SparkSession
    root: str
    schema: StructType
    keys: tuple[str, ...]
    order_by: tuple[str, ...]
    delete: bool = False
    order_guard: bool = False
    buckets: int | None = None

    @classmethod
    def open(
        cls,
        spark: SparkSession,
        root: str,
        keys: str | list[str],
        order_by: str | list[str],
        schema: StructType | None = None,
        base: DataFrame | None = None,
        delete: bool = False,
        order_guard: bool = False,
        buckets: int | None = None,
    ) -> MergeTarget:
        """The target under ``root``, created on first use from ``base`` or empty from ``schema``.

        An initial ``base`` is checked to have one row per key. An existing target keeps its own.
        """
        if base is None and schema is None:
            raise ValueError("give the schema of the table or its initial rows")
        taken = sorted(RESERVED.intersection((schema or base.schema).names))
        if taken:
            raise ValueError(f"the log needs the column names {taken} for itself")
        most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
        if buckets is not None and not 0 < buckets <= most:
            raise ValueError(f"Spark takes 1 to {most} buckets, not {buckets}")
        columns = StructType(list((schema or base.schema).fields))
        target = cls(
            spark, root.rstrip("/"), columns, tuple(columns_of(keys)), tuple(columns_of(order_by)),
            delete, order_guard, buckets,
        )
        target._create(base)
        return target

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Log one micro-batch. Replaying it overwrites its own folder and nothing else."""
        latest = latest_per_key(batch, list(self.keys), list(self.order_by), self.delete)
        kind = ["_change_type"] if self.delete else []
        latest.select(
            *[name(f.name).cast(f.dataType).alias(f.name) for f in self.schema], *kind
        ).write.mode("overwrite").parquet(self._log_path(batch_id))

    def snapshot(self) -> DataFrame:
        """The table now."""
        base_id = self._base_id()
        return self._merged(base_id, self._logged(base_id))

    def publish(self, table: str) -> None:
        """Give the table after the last ``compact`` a name in the catalog, or move the name there.

        Readers and streams of the name see the base as it was compacted, not the log after it.
        """
        path = self._base_path(self._base_id()).replace("'", "\\'")
        if self.spark.catalog.tableExists(table):
            there = [(f.name, f.dataType) for f in self.spark.table(table).schema]
            if there != [(f.name, f.dataType) for f in self.schema]:
                raise ValueError(f"{table} exists with other columns")
            self.spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        else:
            columns = StructType([StructField(f.name, f.dataType) for f in self.schema]).toDDL()
            self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet LOCATION '{path}'")
        self.spark.catalog.refreshTable(table)

    def bind(self, stream: str) -> None:
        """Keep the id of the stream that feeds the table, and refuse any other one."""
        path = f"{self.root}/stream"
        if storage.exists(self.spark, f"{path}/_SUCCESS"):
            known = self.spark.read.text(path).first().value
            if known != stream:
                raise ValueError(f"{self.root} is fed by the stream {known}, not by {stream}")
            return
        self.spark.createDataFrame([(stream,)], "value string").coalesce(1).write.mode("overwrite").text(path)

    def _merged(self, base_id: int, batch_ids: list[int]) -> DataFrame:
        base, log = self._base(base_id), self._log(batch_ids)
        keys, bucketed = list(self.keys), self.buckets is not None
        if self.order_guard:
            changed = self._not_stale(
                latest_per_key(log, keys, [*self.order_by, "_batch_id"]), base
            )
            arriving = self._rows(changed)
        else:
            changed = log
            arriving = self._rows(latest_per_key(log, keys, "_batch_id"))
        if bucketed:
            # One task per bucket, so that compacting adds one file to each bucket.
            arriving = arriving.repartition(self.buckets, *self._key_columns())
        return replace_keys(base, changed, arriving, keys, bucketed)

    def is_fed(self) -> bool:
        """Whether a stream has logged a batch here."""
        return max(*self._ids("log", "_batch_id"), self._base_id(), BEFORE_FIRST_BATCH) >= 0

    def compact(self) -> int:
        """Write the table after the last logged batch as the next base; returns that batch's id.

        Nothing that a reader may be using is changed. Batches logged meanwhile stay in the log.
        The whole base is written anew, however short the log: on a large table, compact only when
        the log has grown to a fair share of it.
        """
        if self.order_guard and self.delete:
            raise ValueError("the log must keep deletes while older rows may still arrive")
        base_id = self._base_id()
        batch_ids = self._logged(base_id)
        if batch_ids:
            self._write_base(self._merged(base_id, batch_ids), batch_ids[-1])
        return max([base_id, *batch_ids])

    def drop_folded(self) -> None:
        """Delete earlier bases and the log folded into the current one.

        Snapshots taken before the last ``compact`` can no longer be read.
        """
        base_id = self._base_id()
        for batch_id in self._ids(self._base_folder, "upto"):
            if batch_id < base_id:
                self._drop_base(batch_id)
        for batch_id in self._ids("log", "_batch_id"):
            if BEFORE_FIRST_BATCH < batch_id <= base_id:
                storage.delete(self.spark, self._log_path(batch_id))

    def remove(self, checkpoint: str) -> None:
        """Delete the table with its log, and the progress of the stream that feeds it.

        They go together: without its checkpoint a stream numbers its batches from 0 again.
        """
        for batch_id in self._ids(self._base_folder, "upto"):
            self._drop_base(batch_id)
        storage.delete(self.spark, checkpoint)
        storage.delete(self.spark, self.root)

    def _not_stale(self, newest: DataFrame, base: DataFrame) -> DataFrame:
        """Rows of ``newest`` that the base has no greater order for. Their keys are unique."""
        pairs = [(k, f"_key_{i}") for i, k in enumerate(self.keys)]
        change = newest.select(
            *[name(k).alias(r) for k, r in pairs],
            F.struct(*[name(c) for c in self.order_by]).alias("_order"),
        )
        in_base = F.struct(*[name(c) for c in self.order_by])
        both = join_by_key(base, change, pairs, "inner", self.buckets is not None)
        stale = both.filter(in_base > F.col("_order")).select(*[r for _, r in pairs])
        return newest.join(stale, matches(newest, stale, pairs), "left_anti")

    def _rows(self, latest: DataFrame) -> DataFrame:
        if self.delete:
            latest = latest.filter(~F.col("_change_type").eqNullSafe(DELETE))
        return latest.select(*[name(c) for c in self.schema.names])

    def _log_schema(self) -> StructType:
        columns = StructType(list(self.schema.fields))
        return columns.add("_change_type", StringType()) if self.delete else columns

    def _log_path(self, batch_id: int) -> str:
        return f"{self.root}/log/_batch_id={batch_id}"

    def _log(self, batch_ids: list[int]) -> DataFrame:
        """The given batches; other folders are not even listed."""
        paths = [self._log_path(b) for b in batch_ids or [BEFORE_FIRST_BATCH]]
        columns = self._log_schema().add("_batch_id", LongType())
        reader = self.spark.read.schema(columns).option("basePath", f"{self.root}/log")
        return reader.parquet(*paths)

    def _key_columns(self) -> list[Column]:
        return [name(k) for k in self.keys]

    def _create(self, base: DataFrame | None) -> None:
        spark, root = self.spark, self.root
        storage.make_dir(spark, root)
        for folder in storage.folder_names(spark, root):
            if folder.startswith("base") and folder != self._base_folder:
                raise ValueError(f"the table is kept in {folder}, not in {self._base_folder}")
        empty_log = self._log_path(BEFORE_FIRST_BATCH)
        if not storage.exists(spark, f"{empty_log}/_SUCCESS"):
            spark.createDataFrame([], self._log_schema()).write.mode("overwrite").parquet(empty_log)
        if storage.exists(spark, f"{root}/{self._base_folder}") and self._bases():
            return
        if base is None:
            base = spark.createDataFrame([], self.schema)
        else:
            if repeated_keys(base, self.keys)[1]:
                raise ValueError(f"the initial rows repeat a key {list(self.keys)}")
            if self.buckets is not None:
                base = base.repartition(self.buckets, *self._key_columns())
        self._write_base(base, BEFORE_FIRST_BATCH)

    @property
    def _base_folder(self) -> str:
        return "base" if self.buckets is None else f"base-buckets={self.buckets}"

    def _base_path(self, batch_id: int) -> str:
        return f"{self.root}/{self._base_folder}/upto={batch_id}"

    def _base_table(self, batch_id: int) -> str:
        """Buckets are known to Spark only for catalog tables, so each base is one."""
        return f"millrace_{hashlib.md5(self.root.encode()).hexdigest()}_{batch_id + 1}"

    def _write_base(self, rows: DataFrame, batch_id: int) -> None:
        path = self._base_path(batch_id)
        writer = rows.write.mode("overwrite").format("parquet")
        if self.buckets is None:
            writer.save(path)
        else:
            writer.option("path", path).bucketBy(self.buckets, *self.keys).sortBy(
                *self.keys
            ).saveAsTable(self._base_table(batch_id))

    def _base(self, batch_id: int) -> DataFrame:
        path = self._base_path(batch_id)
        if self.buckets is None:
            return self.spark.read.schema(self.schema).parquet(path)
        columns = StructType([StructField(f.name, f.dataType) for f in self.schema]).toDDL()
        keys = ", ".join(quoted(k) for k in self.keys)
        table = self._base_table(batch_id)
        location = path.replace("'", "\\'")
        if self.spark.catalog.tableExists(table):
            # A lasting catalog may know the name from a folder that has been made anew since.
            known = [(f.name, f.dataType) for f in self.spark.table(table).schema]
            if known != [(f.name, f.dataType) for f in self.schema]:
                self.spark.sql(f"DROP TABLE {table}")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
            f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS "
            f"LOCATION '{location}'"
        )
        return self.spark.table(table)

    def _drop_base(self, batch_id: int) -> None:
        if self.buckets is not None:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._base_table(batch_id)}")
        storage.delete(self.spark, self._base_path(batch_id))

    def _ids(self, folder: str, label: str) -> list[int]:
        names = storage.folder_names(self.spark, f"{self.root}/{folder}")
        return [int(n.partition("=")[2]) for n in names if n.startswith(f"{label}=")]

    def _complete_ids(self, folder: str, label: str) -> list[int]:
        """Ids of completely written folders, by one listing."""
        names = storage.folders_with(self.spark, f"{self.root}/{folder}", "_SUCCESS")
        return [int(n.partition("=")[2]) for n in names if n.startswith(f"{label}=")]

    def _bases(self) -> list[int]:
        return self._complete_ids(self._base_folder, "upto")

    def _base_id(self) -> int:
        return max(self._bases())

    def _logged(self, after: int) -> list[int]:
        """Completely written batches later than ``after``."""
        return sorted(b for b in self._complete_ids("log", "_batch_id") if b > after)


def stream_merge(
    stream: DataFrame, target: MergeTarget, checkpoint: str, wait: bool = True
) -> StreamingQuery:
    """Merge everything the stream has now into ``target``, batch by batch, then stop.

    A batch that is run again after a failure has the same id and the same rows, so it has no
    further effect. The query handle is returned, after the input is used up if ``wait``.

    A target stays with its stream: another one, or the same without its checkpoint, would number
    its batches from 0 again, and they would overwrite logged ones.
    """
    if target.is_fed() and not storage.exists(target.spark, f"{checkpoint}/offsets"):
        raise ValueError(f"{target.root} was fed by a stream whose progress is not in {checkpoint}")
    if storage.exists(target.spark, f"{checkpoint}/metadata"):
        target.bind(stream_id(target.spark, checkpoint))

    def apply(batch: DataFrame, batch_id: int) -> None:
        target.bind(stream_id(target.spark, checkpoint))
        target.apply(batch, batch_id)

    query = (
        stream.writeStream.foreachBatch(apply)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    if wait:
        query.awaitTermination()
    return query
