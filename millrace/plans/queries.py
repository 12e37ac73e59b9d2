"""The registered queries: every operator at work on the given tables.

Each takes a session and the folder of the tables and returns a DataFrame. Queries about files,
tables and streams first write their input from the given tables, whole, to the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import operators as op
from millrace.functions import decode_message, token_count, token_frequency
from millrace.plans.load import ensure_layers, load_batch, qualified, write_table
from millrace.sources import FormatSpec, scan_csv, scan_text, struct_from_columns
from millrace.sources import stream_changes, stream_table
from millrace.streaming import MergeTarget, TargetPaths, ingest_files, reset, stream_merge
from millrace.workspace import new_dir

CUSTOMER_COLUMNS = [
    ("c_custkey", "bigint"),
    ("c_name", "string"),
    ("c_nationkey", "int"),
    ("c_acctbal", "double"),
    ("c_mktsegment", "string"),
]
ORDER_COLUMNS = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
# Orders up to here are the initial load; those from 1996 on arrive (again) as changes.
LOADED_BEFORE = "o_orderdate < TIMESTAMP_NTZ '1997-01-01'"
CHANGED_SINCE = "o_orderdate >= TIMESTAMP_NTZ '1996-01-01'"
NOT_CHANGED = f"NOT ({CHANGED_SINCE})"
CANCELLED = "o_orderpriority = '5-LOW'"
# Events in the order in which their batches arrive: the newest days come first.
EVENT_BATCHES = (
    "ts >= TIMESTAMP_NTZ '2024-01-21'",
    "ts < TIMESTAMP_NTZ '2024-01-11'",
    "ts >= TIMESTAMP_NTZ '2024-01-11' AND ts < TIMESTAMP_NTZ '2024-01-21'",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def new_database(spark: SparkSession) -> str:
    """A database of its own for one run, stored in the shared folder."""
    root = new_dir(spark, "databases")
    database = "run_" + root.rpartition("-")[2]
    ensure_layers(spark, root, {database: "tables"})
    return database


# --- files and batch loads --------------------------------------------------------------------


def customer_csv(spark: SparkSession, sf_dir: str) -> str:
    folder = new_dir(spark, "customer-csv")
    as_they_are = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    table(spark, sf_dir, "customer").write.options(header=True, **as_they_are).csv(folder)
    return folder


def document_lines(spark: SparkSession, sf_dir: str) -> str:
    folder = new_dir(spark, "documents-text")
    table(spark, sf_dir, "documents").select("text").write.option("lineSep", "\n").text(folder)
    return folder


def csv_scan_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_csv(spark, customer_csv(spark, sf_dir) + "/part-*.csv")


def csv_scan_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = struct_from_columns(CUSTOMER_COLUMNS)
    return scan_csv(spark, customer_csv(spark, sf_dir), schema)


def text_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_text(spark, document_lines(spark, sf_dir))


def batch_load_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, database = customer_csv(spark, sf_dir), new_database(spark)
    for _ in range(2):
        loaded = load_batch(spark, "csv", files, database, "customer")
    return spark.table(loaded)


def batch_load_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = struct_from_columns(CUSTOMER_COLUMNS)
    files, database = customer_csv(spark, sf_dir), new_database(spark)
    return spark.table(load_batch(spark, "csv", files, database, "customer", schema))


def batch_load_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, database = document_lines(spark, sf_dir), new_database(spark)
    loaded = load_batch(spark, "text", files, database, "word_count", mode="overwrite")
    return token_count(spark.table(loaded))


# --- filters, groups, profiles ----------------------------------------------------------------


def range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return op.in_range(customers, "c_acctbal", 1000.0, 2000.0)


def compare_to_group_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    return op.compare_to_group_avg(parts, "p_brand", "p_size", avg_column="avg_v")


def compare_to_group_avg_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three groups only, the largest with half of all rows."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity"
    )
    return op.compare_to_group_avg(lines, "l_returnflag", "l_quantity", avg_column="avg_v")


def nth_highest(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    return op.nth_highest(parts, "p_brand", "p_size", 2)


def nth_highest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice"
    )
    return op.nth_highest(lines, "l_returnflag", "l_extendedprice", 3)


def lines_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines by a group that is NULL for a third of them, and with NULL values."""
    returned = F.col("l_returnflag") == "N"
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(~returned, F.col("l_suppkey")).alias("l_suppkey"),
        F.when(F.col("l_linenumber") != 1, F.col("l_quantity")).alias("l_quantity"),
    )


def group_avg_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way of many moderate groups."""
    lines = lines_with_nulls(spark, sf_dir)
    return op.compare_to_group_avg(lines, "l_suppkey", "l_quantity", "avg_v", broadcast_rows=0)


def group_avg_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way of many groups, of which the NULL group is taken for too large for one task."""
    lines = lines_with_nulls(spark, sf_dir)
    return op.compare_to_group_avg(
        lines, "l_suppkey", "l_quantity", "avg_v", broadcast_rows=0, hot_rows=lines.count() // 10
    )


def nth_highest_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way of groups too large for one task, by a floor under the value in question."""
    lines = lines_with_nulls(spark, sf_dir)
    return op.nth_highest(lines, "l_suppkey", "l_quantity", 3, hot_rows=lines.count() // 10)


def events_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = F.col("event_type") == "error"
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        F.when(F.col("event_type") != "click", F.col("ts")).alias("ts"),
        F.when(~failed, F.col("event_type")).alias("event_type"),
        F.when(F.col("event_type") != "view", F.col("value")).alias("value"),
        F.when(~failed, F.col("props")).alias("props"),
    )


def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.null_counts(events_with_nulls(spark, sf_dir))


def null_counts_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.null_counts(events_with_nulls(spark, sf_dir), prefix="cnt_")


# --- text and messages ------------------------------------------------------------------------


def document_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count(table(spark, sf_dir, "documents"), "text")


def document_token_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_frequency(table(spark, sf_dir, "documents"), "text", by="lang")


def decoded_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    envelopes = table(spark, sf_dir, "events").select(
        "event_id", F.col("event_type").alias("topic"), F.col("props").cast("binary").alias("value")
    )
    messages = decode_message(envelopes, "k bigint").filter("topic = 'click'")
    return messages.select("event_id", F.col("message.k").alias("k"))


# --- latest rows and merges -------------------------------------------------------------------


def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.latest_per_key(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"])


def change_feed_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last change of every order, from a feed of inserts, updates and deletes."""
    feed = order_changes(table(spark, sf_dir, "orders"))
    commits = feed[0].unionByName(feed[1]).unionByName(feed[2])
    return op.latest_per_key(commits, "o_orderkey", "o_orderdate", change_feed=True).select(
        "o_orderkey", "o_orderstatus", "_change_type"
    )


def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    target = orders.filter(LOADED_BEFORE).select(ORDER_COLUMNS)
    source = orders.filter(CHANGED_SINCE).withColumn("o_orderstatus", F.lit("U"))
    return op.merge(target, source, "o_orderkey", unique_target=True)


def merge_upsert_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    target = orders.filter(LOADED_BEFORE).select(ORDER_COLUMNS)
    source = (
        orders.filter(CHANGED_SINCE)
        .withColumn("o_orderstatus", F.lit("U"))
        .withColumn("_change_type", F.when(F.expr(CANCELLED), "delete").otherwise("update_postimage"))
    )
    return op.merge(target, source, "o_orderkey", delete=True, unique_target=True)


def merge_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target that repeats its keys: each line of an order takes the order's values."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_linestatus").alias("o_orderstatus"),
        F.col("l_extendedprice").alias("o_totalprice"),
        F.col("l_shipdate").alias("o_orderdate"),
    )
    orders = table(spark, sf_dir, "orders").select(ORDER_COLUMNS)
    changed = orders.filter(CHANGED_SINCE)
    # Earlier orders are in the target under keys of their own, some of them NULL.
    own_key = F.when(F.col("o_orderstatus") != "P", -F.col("o_orderkey") - 1)
    earlier = orders.filter(NOT_CHANGED).withColumn("o_orderkey", own_key)
    return op.merge(lines.unionByName(earlier), changed, "o_orderkey")


def merge_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and source with a NULL key; the source's row replaces all of the target's."""
    orders = table(spark, sf_dir, "orders").select(ORDER_COLUMNS)
    key = F.col("o_orderkey")
    target = orders.withColumn("o_orderkey", F.when(F.col("o_orderstatus") != "F", key))
    least = orders.agg(F.min("o_orderkey").alias("least"))
    source = orders.join(F.broadcast(least), key == F.col("least")).select(
        F.lit(None).cast("bigint").alias("o_orderkey"),
        F.lit("N").alias("o_orderstatus"), "o_totalprice", "o_orderdate",
    )
    return op.merge(target, source, "o_orderkey")


# --- streams ----------------------------------------------------------------------------------


def ingested_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes as JSON lines, loaded twice: the second run finds nothing new."""
    folder, database = new_dir(spark, "envelopes"), new_database(spark)
    table(spark, sf_dir, "events").select(
        F.col("event_type").alias("topic"),
        F.col("event_id").alias("offset"),
        F.base64(F.col("props").cast("binary")).alias("value"),
    ).write.json(f"{folder}/dump/first")
    state = new_dir(spark, "state")
    for _ in range(2):
        ingest_files(
            spark, folder, FormatSpec("json"), database, "clicks", f"{state}/checkpoints",
            f"{state}/schemas", message_schema="k bigint", filter_expr="topic = 'click'",
        )
    loaded = spark.table(qualified(database, "clicks"))
    return loaded.select(
        "topic", F.col("offset").cast("bigint").alias("offset"), F.col("message.k").alias("k")
    )


def ingested_csv_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files arriving in two folders between two runs of the same job."""
    folder, database = new_dir(spark, "arriving"), new_database(spark)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    open_orders = F.col("o_orderstatus") == "O"
    state = new_dir(spark, "state")
    for arrival, rows in (("one", orders.filter(open_orders)), ("two", orders.filter(~open_orders))):
        rows.write.option("header", True).csv(f"{folder}/{arrival}")
        ingest_files(
            spark, folder, FormatSpec("csv", {"header": True}), database, "orders",
            f"{state}/checkpoints", f"{state}/schemas", hints={"o_totalprice": "double"},
        )
    return spark.table(qualified(database, "orders"))


def ingested_after_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parquet files loaded, forgotten with their table, progress and schema, and loaded again.

    In between the files of the first run are replaced by others.
    """
    folder, database = new_dir(spark, "arriving"), new_database(spark)
    orders = table(spark, sf_dir, "orders").select(ORDER_COLUMNS)
    state = new_dir(spark, "state")
    roots = (f"{state}/checkpoints", f"{state}/schemas")
    name = qualified(database, "orders")
    for status in ("first", "second"):
        orders.withColumn("o_orderstatus", F.lit(status)).write.mode("overwrite").parquet(folder)
        reset(spark, name, TargetPaths.under(*roots, database, "orders"))
        ingest_files(
            spark, folder, FormatSpec("parquet"), database, "orders", *roots, hints={},
            max_files_per_trigger=1000,
        )
    return spark.table(name)


def set_age(spark: SparkSession, folder: str, days: int) -> None:
    """Date all files of a folder back."""
    location = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = location.getFileSystem(spark._jsc.hadoopConfiguration())
    for entry in files.listStatus(location):
        files.setTimes(entry.getPath(), entry.getModificationTime() - days * 86_400_000, -1)


def ingested_late_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that arrive second, are a month older, and bring a new column."""
    folder, database = new_dir(spark, "arriving"), new_database(spark)
    orders, state = table(spark, sf_dir, "orders"), new_dir(spark, "state")
    arrivals = [
        (orders.filter(NOT_CHANGED).select("o_orderkey", "o_orderstatus"), 0),
        (orders.filter(CHANGED_SINCE).select("o_orderkey", "o_orderstatus", "o_orderpriority"), 30),
    ]
    for number, (rows, days) in enumerate(arrivals):
        rows.write.parquet(f"{folder}/{number}")
        set_age(spark, f"{folder}/{number}", days)
        ingest_files(
            spark, folder, FormatSpec("parquet"), database, "orders", f"{state}/checkpoints",
            f"{state}/schemas", hints={},
        )
    return spark.table(qualified(database, "orders"))


def ingested_csv_evolving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files whose headers have moved, inserted and appended columns, with the usual hints."""
    folder, database = new_dir(spark, "arriving"), new_database(spark)
    orders, state = table(spark, sf_dir, "orders"), new_dir(spark, "state")
    arrivals = [
        ("F", ["o_orderkey", "o_orderstatus", "o_custkey"]),
        ("O", ["o_orderstatus", "o_custkey", "o_orderkey"]),
        ("P", ["o_orderkey", "o_orderpriority", "o_orderstatus", "o_custkey"]),
    ]
    for status, columns in arrivals:
        rows = orders.filter(F.col("o_orderstatus") == status).select(columns)
        rows.write.option("header", True).csv(f"{folder}/{status}")
        ingest_files(
            spark, folder, FormatSpec("csv", {"header": True}), database, "orders",
            f"{state}/checkpoints", f"{state}/schemas",
        )
    return spark.table(qualified(database, "orders"))


def ingested_and_archived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files with a header, arriving three times; each run archives what it has loaded, and forgets it."""
    folder, database = new_dir(spark, "arriving"), new_database(spark)
    orders, state = table(spark, sf_dir, "orders"), new_dir(spark, "state")
    for status in ("F", "O", "P"):
        rows = orders.filter(F.col("o_orderstatus") == status).select("o_orderkey", "o_orderstatus", "o_totalprice")
        rows.write.mode("append").option("header", True).csv(folder)
        ingest_files(
            spark, folder, FormatSpec("csv", {"header": True}), database, "orders", f"{state}/checkpoints",
            f"{state}/schemas", hints={"o_totalprice": "double"}, files_at_once=4, archive=f"{state}/archive",
        )
    return spark.table(qualified(database, "orders"))


def ingested_and_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables, each with half of the orders from a stream and half from a batch load."""
    database, state = new_database(spark), new_dir(spark, "state")
    orders = table(spark, sf_dir, "orders").select(ORDER_COLUMNS)
    folder = new_dir(spark, "arriving")
    orders.filter(CHANGED_SINCE).write.parquet(folder)
    found = []
    for first in ("batch", "stream"):
        name = qualified(database, f"{first}_first")
        steps = {
            "batch": lambda name=name: write_table(orders.filter(NOT_CHANGED), name),
            "stream": lambda first=first: ingest_files(
                spark, folder, FormatSpec("parquet"), database, f"{first}_first",
                f"{state}/checkpoints", f"{state}/schemas", hints={},
            ),
        }
        steps.pop(first)()
        next(iter(steps.values()))()
        found.append(spark.table(name).withColumn("first", F.lit(first)))
    return found[0].unionByName(found[1])


def ingested_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as messages with an array of their lines, loaded, decoded and taken apart again."""
    folder, database = new_dir(spark, "envelopes"), new_database(spark)
    state = new_dir(spark, "state")
    line = F.struct(
        F.col("l_partkey").alias("book_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("subtotal"),
    )
    messages = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(line).alias("books"))
    payload = F.to_json(F.struct(F.col("l_orderkey").alias("order_id"), "books"))
    messages.select(F.lit("orders").alias("topic"), F.base64(payload.cast("binary")).alias("value")).write.json(
        f"{folder}/dump"
    )
    ingest_files(
        spark, folder, FormatSpec("json"), database, "orders", f"{state}/checkpoints", f"{state}/schemas",
        message_schema="order_id bigint, books array<struct<book_id: bigint, quantity: double, subtotal: double>>",
    )
    loaded = spark.table(qualified(database, "orders"))
    books = loaded.select("message.order_id", F.explode("message.books").alias("book"))
    return books.select("order_id", "book.book_id", "book.quantity", "book.subtotal")


def stream_events(spark: SparkSession, sf_dir: str, order_guard: bool) -> DataFrame:
    events = table(spark, sf_dir, "events")
    arriving = qualified(new_database(spark), "events")
    state = new_dir(spark, "state")
    target = MergeTarget.open(
        spark, f"{state}/table", "user_id", ["ts", "event_id"], schema=events.schema,
        order_guard=order_guard,
    )
    for condition in EVENT_BATCHES:
        write_table(events.filter(condition), arriving)
        stream_merge(stream_table(spark, arriving), target, f"{state}/checkpoint")
    return target.snapshot()


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_events(spark, sf_dir, order_guard=False)


def stream_upsert_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_events(spark, sf_dir, order_guard=True)


def order_changes(orders: DataFrame) -> list[DataFrame]:
    """A change feed in three files: inserts; updates with both images; deletes.

    The last one also inserts and deletes keys that exist nowhere else.
    """

    def change(rows: DataFrame, kind: str, commit: int) -> DataFrame:
        return rows.select(
            *ORDER_COLUMNS,
            F.lit(kind).alias("_change_type"),
            F.lit(commit).cast("bigint").alias("_commit_version"),
            F.timestamp_seconds(F.lit(1_700_000_000 + commit)).alias("_commit_timestamp"),
        )

    changed = orders.filter(CHANGED_SINCE)
    updated = changed.withColumn("o_orderstatus", F.lit("U"))
    passing = orders.withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    return [
        change(orders, "insert", 1),
        change(changed, "update_preimage", 2).unionByName(change(updated, "update_postimage", 2)),
        change(orders.filter(CANCELLED), "delete", 3)
        .unionByName(change(passing, "insert", 3))
        .unionByName(change(passing, "delete", 4)),
    ]


def stream_upsert_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    folder, state = new_dir(spark, "feed"), new_dir(spark, "state")
    target = MergeTarget.open(
        spark, f"{state}/table", "o_orderkey", "o_orderdate",
        schema=orders.select(ORDER_COLUMNS).schema, delete=True,
    )
    for number, changes in enumerate(order_changes(orders)):
        changes.write.parquet(f"{folder}/{number}")
        feed = stream_changes(spark, path=folder, schema=changes.schema)
        stream_merge(feed, target, f"{state}/checkpoint")
    return target.snapshot()


def changed_orders(spark: SparkSession, sf_dir: str, buckets: int | None) -> MergeTarget:
    """Orders changed by a stream on top of an initial load."""
    orders = table(spark, sf_dir, "orders")
    arriving = qualified(new_database(spark), "orders")
    state = new_dir(spark, "state")
    target = MergeTarget.open(
        spark, f"{state}/table", "o_orderkey", "o_orderdate",
        base=orders.filter(LOADED_BEFORE).select(ORDER_COLUMNS), buckets=buckets,
    )
    write_table(
        orders.filter(CHANGED_SINCE).select(ORDER_COLUMNS).withColumn("o_orderstatus", F.lit("U")),
        arriving,
    )
    stream_merge(stream_table(spark, arriving), target, f"{state}/checkpoint")
    return target


def stream_upsert_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = changed_orders(spark, sf_dir, buckets=None)
    target.compact()
    return target.snapshot()


def stream_upsert_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged table under a name, read by SQL; the name follows the table to its next base."""
    target = changed_orders(spark, sf_dir, buckets=None)
    named = qualified(new_database(spark), "merged_orders")
    target.publish(named)
    target.compact()
    target.publish(named)
    return spark.sql(f"SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM {named}")


def stream_upsert_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    target = changed_orders(spark, sf_dir, buckets)
    target.compact()
    return target.snapshot()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "csv_scan_strings": csv_scan_strings,
    "csv_scan_typed": csv_scan_typed,
    "text_scan": text_scan,
    "batch_load_append": batch_load_append,
    "batch_load_typed": batch_load_typed,
    "batch_load_text": batch_load_text,
    "range_filter": range_filter,
    "compare_to_group_avg": compare_to_group_avg,
    "compare_to_group_avg_lines": compare_to_group_avg_lines,
    "nth_highest": nth_highest,
    "nth_highest_lines": nth_highest_lines,
    "group_avg_window": group_avg_window,
    "group_avg_hot": group_avg_hot,
    "nth_highest_hot": nth_highest_hot,
    "null_counts": null_counts,
    "null_counts_cast": null_counts_cast,
    "token_count": document_token_count,
    "token_frequency": document_token_frequency,
    "decode_message": decoded_messages,
    "latest_per_key": latest_per_key,
    "change_feed_latest": change_feed_latest,
    "merge_upsert": merge_upsert,
    "merge_upsert_delete": merge_upsert_delete,
    "merge_repeated_keys": merge_repeated_keys,
    "merge_null_keys": merge_null_keys,
    "ingest_files": ingested_files,
    "ingest_csv_files": ingested_csv_files,
    "ingest_after_reset": ingested_after_reset,
    "ingest_late_files": ingested_late_files,
    "ingest_csv_evolving": ingested_csv_evolving,
    "ingest_archived": ingested_and_archived,
    "ingest_and_batch": ingested_and_batch,
    "ingest_nested": ingested_nested,
    "stream_upsert": stream_upsert,
    "stream_upsert_guarded": stream_upsert_guarded,
    "stream_upsert_delete": stream_upsert_delete,
    "stream_upsert_compacted": stream_upsert_compacted,
    "stream_upsert_named": stream_upsert_named,
    "stream_upsert_bucketed": stream_upsert_bucketed,
}
