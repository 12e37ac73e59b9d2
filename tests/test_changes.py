from conftest import executed_plan, rows
from hypothesis import given, settings as limits, strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import change_rows, latest_per_key

FEED = (
    "k int, s string, t int, "
    "_change_type string, _commit_version bigint, _commit_timestamp timestamp_ntz"
)


def test_latest_compares_columns_in_order(spark):
    df = spark.createDataFrame(
        [(1, 1, 9), (1, 2, 0), (1, 2, 5), (2, None, 7), (2, 0, 0), (None, 3, 3), (None, 4, 1)],
        "k int, a int, b int",
    )
    assert rows(latest_per_key(df, "k", ["a", "b"])) == [(None, 4, 1), (1, 2, 5), (2, 0, 0)]


def test_latest_when_every_order_value_is_null(spark):
    df = spark.createDataFrame([(1, None, "x")], "k int, a int, c string")
    assert rows(latest_per_key(df, "k", "a")) == [(1, None, "x")]


def test_latest_keeps_columns_and_types(spark):
    df = spark.createDataFrame([(1, "x", {"m": 1})], "`k.e` int, b string, c map<string,int>")
    latest = latest_per_key(df, "k.e", "b")
    assert latest.dtypes == df.dtypes
    assert rows(latest_per_key(df.limit(0), "k.e", "b")) == []


def test_change_rows_drop_old_images(spark):
    kinds = ["insert", "update_preimage", "update_postimage", "delete", None]
    df = spark.createDataFrame([(k,) for k in kinds], "_change_type string")
    assert rows(change_rows(df)) == [("delete",), ("insert",), ("update_postimage",)]


def test_change_feed_is_ordered_by_commit_first(spark):
    df = spark.createDataFrame(
        [
            (1, "old", 100, "insert", 1, None),
            (1, "new", 1, "update_postimage", 2, None),
            (1, "before", 900, "update_preimage", 3, None),
            (2, "a", 1, "insert", 5, None),
            (2, "b", 2, "insert", 5, None),
        ],
        FEED,
    )
    latest = latest_per_key(df, "k", "t", change_feed=True)
    assert rows(latest, "k", "s") == [(1, "new"), (2, "b")]


def test_rows_are_reduced_before_the_shuffle(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    plan = executed_plan(latest_per_key(events, "user_id", ["ts", "event_id"]))
    assert "partial_max_by" in plan and plan.count("Exchange") == 1


@limits(max_examples=10, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.one_of(st.none(), st.integers(0, 3)),
            st.one_of(st.none(), st.integers(0, 3)),
            st.one_of(st.none(), st.sampled_from("xyz")),
        ),
        min_size=1,
        max_size=30,
    )
)
def test_latest_equals_row_number(spark, data):
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(data)], "k int, a int, b string, id int")
    order = ["a", "b", "id"]
    newest_first = Window.partitionBy("k").orderBy(F.struct(*order).desc())
    expected = df.withColumn("rn", F.row_number().over(newest_first)).filter("rn = 1").drop("rn")
    assert rows(latest_per_key(df, "k", order)) == rows(expected)
