"""For each registered query the same result as DuckDB SQL over the given tables."""

from __future__ import annotations

CUSTOMER_STRINGS = """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment
FROM customer"""

CUSTOMER = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"

TOKENS = r"""
SELECT * FROM (SELECT lang, unnest(string_split_regex(text, ' ')) AS token FROM documents)
WHERE regexp_matches(token, '[a-zA-Z]')"""


def _group_avg(table: str, columns: str, group: str, value: str) -> str:
    return f"""
SELECT *, CASE WHEN {value} > avg_v THEN 'Higher'
               WHEN {value} IS NOT DISTINCT FROM avg_v THEN 'equal'
               ELSE 'lower' END AS comparision
FROM (SELECT {columns}, avg({value}) OVER (PARTITION BY {group}) AS avg_v FROM {table})"""


def _nth_highest(table: str, columns: str, group: str, value: str, n: int) -> str:
    return f"""
SELECT {columns} FROM {table}
QUALIFY dense_rank() OVER (PARTITION BY {group} ORDER BY {value} DESC NULLS LAST) = {n}"""


def _null_counts(prefix: str) -> str:
    columns = ("event_id", "user_id", "ts", "event_type", "value", "props")
    counts = ", ".join(f"count(*) - count({c}) AS {prefix}{c}" for c in columns)
    return f"""
SELECT {counts} FROM (
    SELECT event_id, user_id, CASE WHEN event_type <> 'click' THEN ts END AS ts,
           nullif(event_type, 'error') AS event_type,
           CASE WHEN event_type <> 'view' THEN value END AS value,
           CASE WHEN event_type <> 'error' THEN props END AS props
    FROM events)"""


LINES_WITH_NULLS = """(
    SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag <> 'N' THEN l_suppkey END AS l_suppkey,
           CASE WHEN l_linenumber <> 1 THEN l_quantity END AS l_quantity FROM lineitem)"""

MERGED_STATUS = """CASE WHEN o_orderdate >= TIMESTAMP '1996-01-01' THEN 'U' ELSE o_orderstatus END"""

MERGED = f"SELECT o_orderkey, {MERGED_STATUS} AS o_orderstatus, o_totalprice, o_orderdate FROM orders"

ORACLES: dict[str, str] = {
    "csv_scan_strings": CUSTOMER_STRINGS,
    "csv_scan_typed": CUSTOMER,
    "text_scan": "SELECT unnest(string_split(text, chr(10))) AS value FROM documents",
    "batch_load_append": f"{CUSTOMER_STRINGS} UNION ALL {CUSTOMER_STRINGS}",
    "batch_load_typed": CUSTOMER,
    "batch_load_text": """
SELECT count(*) AS n FROM (
    SELECT unnest(string_split_regex(value, ' ')) AS token
    FROM (SELECT unnest(string_split(text, chr(10))) AS value FROM documents))
WHERE regexp_matches(token, '[a-zA-Z]')""",
    "range_filter": """
SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal BETWEEN 1000 AND 2000""",
    "compare_to_group_avg": _group_avg("part", "p_partkey, p_brand, p_size", "p_brand", "p_size"),
    "compare_to_group_avg_lines": _group_avg(
        "lineitem", "l_orderkey, l_linenumber, l_returnflag, l_quantity", "l_returnflag", "l_quantity"
    ),
    "nth_highest": _nth_highest("part", "p_partkey, p_brand, p_size", "p_brand", "p_size", 2),
    "nth_highest_lines": _nth_highest(
        "lineitem",
        "l_orderkey, l_linenumber, l_returnflag, l_extendedprice",
        "l_returnflag",
        "l_extendedprice",
        3,
    ),
    "group_avg_window": _group_avg(LINES_WITH_NULLS, "*", "l_suppkey", "l_quantity"),
    "group_avg_hot": _group_avg(LINES_WITH_NULLS, "*", "l_suppkey", "l_quantity"),
    "nth_highest_hot": _nth_highest(LINES_WITH_NULLS, "*", "l_suppkey", "l_quantity", 3),
    "null_counts": _null_counts("null_cnt_"),
    "null_counts_cast": _null_counts("cnt_"),
    "token_count": f"SELECT count(*) AS n FROM ({TOKENS})",
    "token_frequency": f"SELECT lang, token, count(*) AS n FROM ({TOKENS}) GROUP BY lang, token",
    "decode_message": """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k
FROM events WHERE event_type = 'click'""",
    "latest_per_key": """
SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "change_feed_latest": """
SELECT o_orderkey,
       CASE WHEN o_orderpriority IS DISTINCT FROM '5-LOW' AND o_orderdate >= TIMESTAMP '1996-01-01'
            THEN 'U' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'delete'
            WHEN o_orderdate >= TIMESTAMP '1996-01-01' THEN 'update_postimage'
            ELSE 'insert' END AS _change_type
FROM orders
UNION ALL
SELECT -o_orderkey - 1, o_orderstatus, 'delete' FROM orders""",
    "merge_upsert": MERGED,
    "merge_upsert_delete": f"""
{MERGED} WHERE o_orderdate < TIMESTAMP '1996-01-01' OR o_orderpriority IS DISTINCT FROM '5-LOW'""",
    "merge_repeated_keys": """
WITH changes AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01')
SELECT l_orderkey AS o_orderkey,
       CASE WHEN o_orderkey IS NULL THEN l_linestatus ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderkey IS NULL THEN l_extendedprice ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderkey IS NULL THEN l_shipdate ELSE o_orderdate END AS o_orderdate
FROM lineitem LEFT JOIN changes ON l_orderkey = o_orderkey
UNION ALL
SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM changes
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
UNION ALL
SELECT CASE WHEN o_orderstatus <> 'P' THEN -o_orderkey - 1 END, o_orderstatus, o_totalprice, o_orderdate
FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'""",
    "merge_null_keys": """
WITH source AS (SELECT * FROM orders WHERE o_orderkey = (SELECT min(o_orderkey) FROM orders))
SELECT CASE WHEN o.o_orderstatus <> 'F' THEN o.o_orderkey END AS o_orderkey,
       CASE WHEN o.o_orderstatus <> 'F' THEN o.o_orderstatus ELSE 'N' END AS o_orderstatus,
       CASE WHEN o.o_orderstatus <> 'F' THEN o.o_totalprice ELSE s.o_totalprice END AS o_totalprice,
       CASE WHEN o.o_orderstatus <> 'F' THEN o.o_orderdate ELSE s.o_orderdate END AS o_orderdate
FROM orders o, source s""",
    "ingest_files": """
SELECT event_type AS topic, event_id AS "offset", CAST(json_extract(props, '$.k') AS BIGINT) AS k
FROM events WHERE event_type = 'click'""",
    "ingest_csv_files": """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, o_totalprice FROM orders""",
    "ingest_after_reset": """
SELECT o_orderkey, 'second' AS o_orderstatus, o_totalprice, o_orderdate FROM orders""",
    "ingest_late_files": """
SELECT o_orderkey, o_orderstatus,
       CASE WHEN o_orderdate >= TIMESTAMP '1996-01-01' THEN o_orderpriority END AS o_orderpriority
FROM orders""",
    "ingest_csv_evolving": """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, CAST(o_custkey AS VARCHAR) AS o_custkey,
       CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS o_orderpriority
FROM orders""",
    "ingest_archived": """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, o_totalprice FROM orders""",
    "ingest_and_batch": """
SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate, first
FROM orders, (VALUES ('batch'), ('stream')) AS arrivals(first)""",
    "ingest_nested": """
SELECT l_orderkey AS order_id, l_partkey AS book_id, l_quantity AS quantity, l_extendedprice AS subtotal
FROM lineitem""",
    "stream_upsert": """
SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY
    CASE WHEN ts >= TIMESTAMP '2024-01-21' THEN 0 WHEN ts < TIMESTAMP '2024-01-11' THEN 1 ELSE 2 END
    DESC, ts DESC, event_id DESC) = 1""",
    "stream_upsert_guarded": """
SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "stream_upsert_delete": f"{MERGED} WHERE o_orderpriority IS DISTINCT FROM '5-LOW'",
    "stream_upsert_compacted": MERGED,
    "stream_upsert_named": MERGED,
    "stream_upsert_bucketed": MERGED,
}
