"""Exactly-once loading of arriving files into a table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from millrace import storage
from millrace.functions.messages import decode_message
from millrace.plans.load import add_missing_columns, ensure_table, qualified
from millrace.sources.formats import FormatSpec
from millrace.sources.schemas import ENVELOPE_HINTS, FILES_AT_ONCE, Arrived, store_schema, stored_schema
from millrace.sources.streams import stream_file_names
from millrace.streaming.epochs import Epochs
from millrace.streaming.jobs import TargetPaths, stream_id


def ingest_files(
    spark: SparkSession,
    path: str,
    spec: FormatSpec,
    database: str,
    table: str,
    checkpoint_root: str,
    schema_root: str,
    message_schema: StructType | str | None = None,
    filter_expr: str | None = None,
    schema: StructType | None = None,
    hints: Mapping[str, str] = ENVELOPE_HINTS,
    infer_types: bool = False,
    evolve: bool = True,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = None,
    catalog: str = "spark_catalog",
    wait: bool = True,
    files_at_once: int = FILES_AT_ONCE,
    archive: str | None = None,
) -> StreamingQuery:
    """Append every file under ``path`` that was not loaded before, then stop.

    ``message_schema`` decodes the column ``value`` into ``message``; then ``filter_expr``, a SQL
    condition that may use ``message``, keeps the rows for which it is true. A failing cast in
    it fails the job, so write ``try_cast`` for data that is not trusted.

    Without ``schema`` it is found for exactly the files of each micro-batch and pinned; with
    ``evolve`` later files may add columns (see ``pin_schema``), and the table gets them too. A
    change that the table cannot take, such as new fields in a struct, fails the job before
    anything of that batch is written. CSV files with a header are read by column name; their
    headers are read from the beginnings of the files, and the files once. Finding the fields of
    JSON, or types, reads files a second time.

    The names of a batch's files are kept as a table in the checkpoint, not on the driver, which
    takes at most about ``files_at_once`` of them at a time. Such a portion is written to a folder
    of its own inside the table's, once: after a failure the batch goes on with the portions that
    lack. Batch loads may append to the same table.

    With ``archive``, a folder outside ``path``, loaded files are moved there when all input is
    used up, and before anything else is done if an earlier run did not come to it. What Spark
    remembers of them is then forgotten, so neither driver nor checkpoint grows with the files
    ever loaded; a file that arrives under an old name counts as new. Needs ``wait``.

    The query handle is returned, after the input is used up unless ``wait`` is false.
    """
    paths = TargetPaths.under(checkpoint_root, schema_root, database, table)
    full_name = qualified(database, table, catalog)
    epochs = Epochs(spark, paths.checkpoint)
    if archive is not None:
        if not wait:
            raise ValueError("files are archived at the end, so wait for it")
        epochs.check_outside(archive, path)
        epochs.retire(archive)
    checkpoint = epochs.current()

    def load(names: DataFrame, batch_id: int) -> None:
        session = names.sparkSession
        arrived = Arrived.of(names, spec, epochs.ledger(checkpoint, batch_id), files_at_once)
        columns = schema
        if columns is None:
            pinned = stored_schema(session, paths.schema)
            if pinned is None or evolve:
                columns = arrived.schema(pinned, hints, infer_types)
            else:
                columns = pinned

        def rows(portion: int) -> DataFrame:
            found = arrived.rows(portion, columns)
            if message_schema is not None:
                found = decode_message(found, message_schema)
            return found if filter_expr is None else found.filter(F.expr(filter_expr))

        # Files without any line and no known columns give no table.
        if arrived.portions and columns.fields:
            result = rows(0).schema
            add_missing_columns(session, full_name, result)
            location = ensure_table(session, full_name, result)
            if schema is None and columns != pinned:
                store_schema(session, columns, paths.schema)
            folder = f"{location.rstrip('/')}/ingested-{stream_id(session, checkpoint)}-{batch_id}"
            for portion in range(arrived.portions):
                part = f"{folder}/{portion}"
                if not storage.exists(session, f"{part}/_SUCCESS"):
                    rows(portion).write.mode("overwrite").parquet(part)
            # The stream runs in a session of its own; the caller's must see the new files too.
            spark.catalog.refreshTable(full_name)

    names = stream_file_names(spark, path, spec, max_files_per_trigger, max_bytes_per_trigger)
    query = (
        names.writeStream.foreachBatch(load)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    if wait:
        query.awaitTermination()
    if archive is not None:
        epochs.retire(archive)
    return query
