import pytest
from conftest import executed_plan, rows
from hypothesis import given, settings as limits, strategies as st
from pyspark.sql import functions as F

from millrace.operators import compare_to_group_avg, nth_highest

SCHEMA = "id int, g string, v int"


def numbered(spark, pairs, kind="int"):
    return spark.createDataFrame(
        [(i, g, v) for i, (g, v) in enumerate(pairs)], f"id int, g string, v {kind}"
    )


WAYS = [
    {},
    {"broadcast_rows": 0},
    {"broadcast_rows": 0, "hot_rows": 2},
    {"broadcast_rows": 0, "hot_rows": 0},
]


@pytest.mark.parametrize("way", WAYS)
def test_labels(spark, way):
    pairs = [("a", 1), ("a", 3), ("a", 2), ("a", None), ("b", None), (None, 5), (None, 7)]
    compared = compare_to_group_avg(numbered(spark, pairs), "g", "v", **way)
    assert compared.columns == ["id", "g", "v", "avg_v", "comparision"]
    assert rows(compared, "id", "avg_v", "comparision") == [
        (0, 2.0, "lower"),
        (1, 2.0, "Higher"),
        (2, 2.0, "equal"),
        (3, 2.0, "lower"),
        (4, None, "equal"),
        (5, 6.0, "lower"),
        (6, 6.0, "Higher"),
    ]


def test_average_of_no_rows(spark):
    assert rows(compare_to_group_avg(spark.createDataFrame([], SCHEMA), "g", "v")) == []


def test_several_group_columns(spark):
    df = spark.createDataFrame([(1, 1, 4), (1, 1, 6), (1, 2, 9)], "a int, b int, v int")
    compared = compare_to_group_avg(df, ["a", "b"], "v", avg_column="mean")
    assert rows(compared, "v", "mean") == [(4, 5.0), (6, 5.0), (9, 9.0)]


def test_few_groups_need_no_shuffle_of_the_rows(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_returnflag", "l_quantity")
    plan = executed_plan(compare_to_group_avg(lines, "l_returnflag", "l_quantity"))
    assert "BroadcastHashJoin" in plan
    assert "hashpartitioning" not in plan


def skewed_rows(spark, path):
    """120,000 rows in 2,001 groups; a third of them in the NULL group."""
    hot = F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 2000)
    spark.range(0, 120_000, 1, 8).select(
        hot.alias("g"), F.col("id").alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("t")
    ).write.parquet(str(path))
    return spark.read.parquet(str(path))


def is_whole(compared):
    nulls = compared.filter("g IS NULL").agg(F.count("v"), F.min("avg_v"), F.max("avg_v")).first()
    return compared.count() == 120_000 and nulls == (40_000, 59_998.5, 59_998.5)


def test_hot_group_stays_out_of_the_window(spark, tmp_path):
    df = skewed_rows(spark, tmp_path / "rows")
    compared = compare_to_group_avg(df, "g", "v", broadcast_rows=100, hot_rows=1000)
    plan = executed_plan(compared)
    assert "Window" in plan and plan.count("BroadcastHashJoin") == 3
    assert plan.count("Exchange hashpartitioning") == 1
    assert is_whole(compared)


def test_many_hot_groups_are_split(spark, settings, tmp_path):
    """Where even the hot groups were too many to broadcast, their join splits skewed tasks."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="16",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="50k",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )
    df = skewed_rows(spark, tmp_path / "rows")
    compared = compare_to_group_avg(df, "g", "v", broadcast_rows=0, hot_rows=1000)
    assert "SortMergeJoin(skew=true)" in executed_plan(compared)
    assert is_whole(compared)


@pytest.mark.parametrize("hot_rows", [1000, 2, 0])
def test_nth_with_ties_and_nulls(spark, hot_rows):
    pairs = [
        ("a", 9), ("a", 9), ("a", 8), ("a", 8), ("a", 7),
        ("b", 5), ("b", None), ("c", None), (None, 3), (None, 2), (None, None),
    ]
    df = numbered(spark, pairs)
    ids = {n: [r[0] for r in rows(nth_highest(df, "g", "v", n, ["id"], hot_rows))] for n in (1, 2, 3)}
    assert ids == {1: [0, 1, 5, 7, 8], 2: [2, 3, 6, 9], 3: [4, 10]}


def test_nth_keeps_the_asked_columns(spark):
    df = numbered(spark, [("a", 1), ("a", 2)])
    assert nth_highest(df, "g", "v", 1).columns == ["id", "g", "v"]
    assert nth_highest(df, "g", "v", 1, ["v"]).columns == ["v"]
    with pytest.raises(ValueError):
        nth_highest(df, "g", "v", 0)


def test_nth_of_no_rows(spark):
    assert rows(nth_highest(spark.createDataFrame([], SCHEMA), "g", "v", 1)) == []


def test_nth_limits_rows_before_the_shuffle(spark, sf_dir):
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_brand", "p_size")
    plan = executed_plan(nth_highest(parts, "p_brand", "p_size", 2))
    assert plan.count("WindowGroupLimit") == 2


def test_hot_groups_are_never_shuffled_by_group(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_returnflag", "l_tax")
    plan = executed_plan(nth_highest(lines, "l_returnflag", "l_tax", 2, hot_rows=100))
    assert "Window" not in plan and "hashpartitioning" not in plan


@limits(max_examples=12, deadline=None)
@given(
    pairs=st.lists(
        st.tuples(
            st.sampled_from(["a", "b", "c", None]),
            st.one_of(st.none(), st.integers(0, 6).map(float), st.sampled_from([-0.0, float("nan")])),
        ),
        max_size=40,
    ),
    n=st.integers(1, 4),
    hot_rows=st.integers(0, 12),
)
def test_hot_and_plain_ways_agree(spark, pairs, n, hot_rows):
    df = numbered(spark, pairs, "double")
    plain = rows(nth_highest(df, "g", "v", n, ["id"], hot_rows=1000))
    assert rows(nth_highest(df, "g", "v", n, ["id"], hot_rows)) == plain


def test_floor_prunes_only_lower_values(spark):
    """Far more distinct values than hash buckets."""
    df = spark.range(5000).select(
        (F.col("id") % 2).cast("string").alias("g"), F.col("id").alias("v")
    )
    for n in (1, 5, 40):
        hot = nth_highest(df, "g", "v", n, hot_rows=10)
        assert rows(hot) == [("0", 5000 - 2 * n), ("1", 5001 - 2 * n)]


CLASHING = "id int, g string, v int, avg_v string, _group_0 int, _bucket int, _rank int, _value int, _rows int"


@pytest.mark.parametrize("way", WAYS)
def test_columns_named_like_the_operators_own_average(spark, way):
    df = spark.createDataFrame([(n, "ab"[n % 2], n, "mine", 1, 2, 3, 4, 5) for n in range(8)], CLASHING)
    compared = compare_to_group_avg(df, "g", "v", **way)
    assert compared.columns == [c for c in df.columns if c != "avg_v"] + ["avg_v", "comparision"]
    assert rows(compared, "id", "avg_v") == [(n, 3.0 + n % 2) for n in range(8)]
    assert rows(compared.select("_group_0", "_bucket", "_rank", "_value", "_rows").distinct()) == [(1, 2, 3, 4, 5)]
    again = compare_to_group_avg(compared, "g", "v", **way)
    assert rows(again, "id", "avg_v", "comparision") == rows(compared, "id", "avg_v", "comparision")


@pytest.mark.parametrize("hot_rows", [100, 2, 0])
@pytest.mark.parametrize("n", [1, 2, 70])
def test_columns_named_like_the_operators_own_nth(spark, hot_rows, n):
    df = spark.createDataFrame([(k, "ab"[k % 2], k // 4, "mine", 1, 2, 3, 4, 5) for k in range(300)], CLASHING)
    found = nth_highest(df, "g", "v", n, hot_rows=hot_rows)
    assert found.columns == df.columns
    assert rows(found) == rows(df.filter(F.col("v") == 75 - n))
