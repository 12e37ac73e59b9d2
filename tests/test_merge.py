from importlib import import_module

import pytest
from conftest import executed_plan, rows
from hypothesis import given, settings as limits, strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import merge
from millrace.operators.merge import key_filter

TARGET = "k int, j string, v bigint"
SOURCE = "j string, k int, v int, extra int, _change_type string"


def frames(spark, target, source):
    return spark.createDataFrame(target, TARGET), spark.createDataFrame(source, SOURCE)


@pytest.mark.parametrize("unique_target", [False, True])
def test_upsert(spark, unique_target):
    target, source = frames(
        spark,
        [(1, "a", 10), (2, "a", 20), (None, "a", 30), (None, None, 40)],
        [("a", 2, 21, 0, None), ("a", None, 31, 0, None), (None, 1, 50, 0, None)],
    )
    merged = merge(target, source, ["k", "j"], unique_target=unique_target)
    assert merged.dtypes == target.dtypes
    assert rows(merged) == [
        (None, None, 40), (None, "a", 31), (1, None, 50), (1, "a", 10), (2, "a", 21),
    ]


@pytest.mark.parametrize("unique_target", [False, True])
def test_delete(spark, unique_target):
    target, source = frames(
        spark,
        [(1, "a", 10), (2, "b", 20), (None, "c", 30), (4, "d", 40)],
        [
            ("A", 1, 11, 0, "update_postimage"),
            ("B", 2, 21, 0, "delete"),
            ("C", None, 31, 0, "delete"),
            ("E", 5, 51, 0, "delete"),
            ("F", 6, 61, 0, "insert"),
        ],
    )
    merged = merge(target, source, "k", delete=True, unique_target=unique_target)
    assert rows(merged) == [(1, "A", 11), (4, "d", 40), (6, "F", 61)]


def test_repeated_target_keys_are_each_replaced(spark):
    target, source = frames(
        spark,
        [(1, "a", 1), (1, "b", 2), (2, "c", 3), (2, "d", 4), (None, "e", 5), (None, "f", 6)],
        [("x", 1, 9, 0, "insert"), ("y", 2, 9, 0, "delete"), ("z", None, 9, 0, "insert")],
    )
    assert rows(merge(target, source, "k", delete=True)) == [
        (None, "z", 9), (None, "z", 9), (1, "x", 9), (1, "x", 9),
    ]


@pytest.mark.parametrize("unique_target", [False, True])
def test_empty_sides(spark, unique_target):
    target, source = frames(spark, [(1, "a", 1)], [("b", 2, 2, 0, "insert")])
    assert rows(merge(target, source.limit(0), "k", unique_target=unique_target)) == [(1, "a", 1)]
    assert rows(merge(target.limit(0), source, "k", unique_target=unique_target)) == [(2, "b", 2)]


def test_source_must_have_the_columns(spark):
    target, source = frames(spark, [(1, "a", 1)], [("b", 2, 2, 0, "insert")])
    with pytest.raises(AnalysisException):
        merge(target, source.drop("v"), "k")
    with pytest.raises(ValueError):
        merge(target, source, [])


def test_two_sides_of_one_table(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    merged = merge(orders, orders.filter("o_totalprice > 100"), "o_orderkey")
    assert merged.count() == orders.count()


def test_small_source_leaves_the_target_unshuffled(spark, sf_dir, tmp_path):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    lines.limit(5).write.parquet(str(tmp_path / "few"))
    few = spark.read.parquet(str(tmp_path / "few"))
    plan = executed_plan(merge(lines, few, "l_orderkey", unique_target=True))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    plan = executed_plan(merge(lines, few, "l_orderkey"))
    assert "SortMergeJoin" not in plan


def test_hot_target_key_is_split(spark, settings, tmp_path):
    """A third of the target rows share the NULL key, and nothing may be broadcast."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="16",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="50k",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )
    hot = F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id"))
    text = F.sha2(F.col("id").cast("string"), 256)
    spark.range(0, 90_000, 1, 8).select(hot.alias("k"), text.alias("v")).write.parquet(
        str(tmp_path / "target")
    )
    spark.range(89_000, 91_000).select(
        F.when(F.col("id") < 90_999, F.col("id")).alias("k"), F.lit("new").alias("v")
    ).write.parquet(str(tmp_path / "source"))
    target = spark.read.parquet(str(tmp_path / "target"))
    merged = merge(target, spark.read.parquet(str(tmp_path / "source")), "k")
    assert executed_plan(merged).count("SortMergeJoin(skew=true)") >= 1
    counts = merged.groupBy("v").count().filter("v = 'new'").first()["count"]
    matched = sum(1 for i in range(89_000, 90_000) if i % 3)
    assert counts == 30_000 + 1_999
    assert merged.count() == 90_000 + 1_999 - matched


keys = st.one_of(st.none(), st.integers(0, 6))


@limits(max_examples=12, deadline=None)
@given(
    target=st.lists(st.tuples(keys, st.just("t"), st.integers(0, 9)), max_size=12),
    source=st.dictionaries(keys, st.tuples(st.integers(0, 9), st.sampled_from(["insert", "delete"]))),
    delete=st.booleans(),
)
def test_merge_equals_a_model(spark, target, source, delete):
    expected = []
    for k, j, v in target:
        if k not in source:
            expected.append((k, j, v))
        elif not (delete and source[k][1] == "delete"):
            expected.append((k, "s", source[k][0]))
    for k, (v, kind) in source.items():
        if k not in {t[0] for t in target} and not (delete and kind == "delete"):
            expected.append((k, "s", v))
    t, s = frames(spark, target, [("s", k, v, 0, kind) for k, (v, kind) in source.items()])
    sort = lambda found: sorted(found, key=str)
    assert sort(rows(merge(t, s, "k", delete=delete))) == sort(expected)
    if len({r[0] for r in target}) == len(target):
        assert sort(rows(merge(t, s, "k", delete, unique_target=True))) == sort(expected)


def test_source_that_repeats_a_key_is_refused(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(1, "b"), (1, "c")], "k int, v string")
    for unique_target in (False, True):
        with pytest.raises(ValueError, match="repeats a key"):
            merge(target, source, "k", unique_target=unique_target)


@pytest.mark.parametrize("unique_target", [False, True])
def test_columns_named_like_the_operators_own(spark, unique_target):
    schema = "k int, _gone int, _new int, _key_0 int, _row int"
    target = spark.createDataFrame([(1, 1, 1, 1, 1), (2, 2, 2, 2, 2)], schema)
    source = spark.createDataFrame([(2, 3, 3, 3, 3), (4, 4, 4, 4, 4)], schema)
    merged = merge(target, source, "k", unique_target=unique_target)
    assert rows(merged) == [(1, 1, 1, 1, 1), (2, 3, 3, 3, 3), (4, 4, 4, 4, 4)]


@pytest.mark.parametrize("unique_target", [False, True])
@pytest.mark.parametrize("key", ["_n", "_gone", "_new", "_key_0", "_row", "keys", "most", "a.b", "`x", "place", "word", "id"])
def test_key_of_any_name(spark, key, unique_target):
    schema = T.StructType().add(key, T.IntegerType()).add("v", T.StringType())
    target = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], schema)
    source = spark.createDataFrame([(None, "B"), (3, "C"), (4, "D")], schema)
    merged = merge(target, source, key, unique_target=unique_target)
    assert merged.columns == [key, "v"]
    assert rows(merged) == [(None, "B"), (1, "a"), (3, "C"), (4, "D")]


def test_filter_keeps_every_key_and_few_others(spark):
    odd = [(0.0, "a"), (-0.0, "b"), (float("nan"), "c"), (None, "d"), (1.5, None), (None, None)]
    changes = spark.createDataFrame(odd, "x double, y string")
    passes = key_filter(changes, ["x", "y"], 6)
    assert changes.filter(passes).count() == 6
    assert changes.withColumn("x", -F.col("x")).filter(passes).count() == 6 - 1
    many = spark.range(0, 40_000, 2).withColumn("y", F.lit("a"))
    passes = key_filter(many, ["id", "y"], 20_000)
    every = spark.range(200_000).withColumn("y", F.lit("a"))
    found = every.filter(passes)
    assert found.join(many, ["id", "y"], "left_semi").count() == 20_000
    assert found.count() < 20_000 + 0.05 * 180_000
    kept = every.filter(~passes)
    assert kept.count() + found.count() == 200_000


def test_filter_leaves_other_kinds_of_equality_alone(spark):
    changes = spark.createDataFrame([("A",)], "k string COLLATE UTF8_LCASE")
    assert key_filter(changes, ["k"], 1) is None
    target = spark.createDataFrame([("a",), ("b",)], "k string COLLATE UTF8_LCASE")
    assert rows(merge(target, changes, "k")) == [("A",), ("b",)]


@pytest.mark.parametrize("unique_target", [False, True])
def test_rows_that_the_filter_keeps_out_are_not_shuffled(spark, settings, tmp_path, unique_target):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    spark.range(100_000).select("id", F.lit("old").alias("v")).write.parquet(str(tmp_path / "target"))
    spark.range(99_500, 100_500).select("id", F.lit("new").alias("v")).write.parquet(str(tmp_path / "source"))
    target, source = (spark.read.parquet(str(tmp_path / n)) for n in ("target", "source"))
    merged = merge(target, source, "id", unique_target=unique_target)
    assert merged.groupBy("v").count().orderBy("v").collect() == [("new", 1000), ("old", 99_500)]
    assert merged.distinct().count() == 100_500
    # Both joins of the target lie behind the filter, which lets few of its rows through.
    assert target.filter(key_filter(source, ["id"], 1000)).count() < 10_000
    plan = executed_plan(merged)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan and "xxhash64" in plan


def test_filter_and_plain_form_are_the_same(spark, monkeypatch):
    schema = "k int, v string"
    target = spark.createDataFrame([(k % 50 if k % 7 else None, "t") for k in range(300)], schema)
    source = spark.createDataFrame([(k, "s") for k in [*range(30, 70), None]], schema)
    filtered = rows(merge(target, source, "k"))
    # The package's function of this name hides the module.
    monkeypatch.setattr(import_module("millrace.operators.merge"), "FILTER_KEYS", 0)
    assert rows(merge(target, source, "k")) == filtered
