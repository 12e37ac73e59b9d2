import pytest
from conftest import executed_plan, rows
from hypothesis import given, settings as limits, strategies as st
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from millrace import storage
from millrace.operators import latest_per_key, merge
from millrace.plans import qualified, write_table
from millrace.sources import stream_changes, stream_table
from millrace.streaming import MergeTarget, stream_merge
from millrace.workspace import new_dir

TABLE = "k int, t int, s string"
CHANGES = "_change_type string, _commit_version bigint, _commit_timestamp timestamp_ntz"


def schema_of(spark, ddl):
    return spark.createDataFrame([], ddl).schema


def open_target(spark, root, **options):
    if "base" not in options:
        options["schema"] = schema_of(spark, TABLE)
    return MergeTarget.open(spark, root, "k", ["t"], **options)


@pytest.fixture
def root(spark):
    return new_dir(spark, "target")


def test_last_batch_wins_and_replay_changes_nothing(spark, root):
    target = open_target(spark, root)
    assert rows(target.snapshot()) == []
    one = spark.createDataFrame([(1, 9, "a"), (1, 8, "b"), (None, 1, "n")], TABLE)
    two = spark.createDataFrame([(1, 2, "older"), (2, 1, "c"), (None, None, "m")], TABLE)
    target.apply(one, 0)
    assert rows(target.snapshot()) == [(None, 1, "n"), (1, 9, "a")]
    for _ in range(2):
        target.apply(two, 1)
        assert rows(target.snapshot()) == [(None, None, "m"), (1, 2, "older"), (2, 1, "c")]
    assert rows(target._merged(-1, [0])) == [(None, 1, "n"), (1, 9, "a")]


@pytest.mark.parametrize("buckets", [None, 4])
def test_order_guard(spark, root, buckets):
    target = open_target(spark, root, order_guard=True, buckets=buckets)
    target.apply(spark.createDataFrame([(1, 9, "newest"), (2, 1, "old")], TABLE), 0)
    target.apply(spark.createDataFrame([(1, 2, "older"), (2, 1, "same time")], TABLE), 1)
    assert rows(target.snapshot()) == [(1, 9, "newest"), (2, 1, "same time")]
    target.compact()
    target.apply(spark.createDataFrame([(1, 3, "older"), (2, 5, "new")], TABLE), 2)
    assert rows(target.snapshot()) == [(1, 9, "newest"), (2, 5, "new")]


def test_guarded_deletes_are_not_folded_away(spark, root):
    target = open_target(spark, root, order_guard=True, delete=True)
    with pytest.raises(ValueError):
        target.compact()


def change(spark, *changes):
    return spark.createDataFrame([(*c, None) for c in changes], f"{TABLE}, {CHANGES}")


def test_deletes(spark, root):
    base = spark.createDataFrame([(1, 0, "base"), (2, 0, "base"), (None, 0, "base")], TABLE)
    target = open_target(spark, root, base=base, delete=True)
    target.apply(
        change(
            spark,
            (1, 0, "x", "delete", 5),
            (None, 0, "x", "update_preimage", 5),
            (None, 0, "y", "update_postimage", 5),
            (7, 0, "x", "delete", 5),
            (8, 0, "x", "insert", 5),
            (8, 0, "x", "delete", 6),
        ),
        0,
    )
    assert rows(target.snapshot()) == [(None, 0, "y"), (2, 0, "base")]
    target.apply(change(spark, (1, 3, "again", "insert", 7), (2, 0, "z", "delete", 7)), 1)
    assert rows(target.snapshot()) == [(None, 0, "y"), (1, 3, "again")]


@pytest.mark.parametrize("buckets", [None, 4])
def test_compact(spark, root, buckets):
    base = spark.createDataFrame([(i, 0, "base") for i in range(20)] + [(None, 0, "base")], TABLE)
    target = open_target(spark, root, base=base, delete=True, buckets=buckets)
    expected = {r[0]: r for r in rows(base)}
    for batch in range(3):
        target.apply(
            change(
                spark,
                (batch, batch, "up", "update_postimage", batch),
                (batch + 10, 0, "", "delete", batch),
                (None, batch, "up", "update_postimage", batch),
            ),
            batch,
        )
        expected[batch] = (batch, batch, "up")
        expected[None] = (None, batch, "up")
        del expected[batch + 10]
        before = rows(target.snapshot())
        assert set(before) == set(expected.values()) and len(before) == len(expected)
        assert target.compact() == batch
        assert rows(target.snapshot()) == before
    assert target.compact() == 2
    reopened = open_target(spark, root, delete=True, buckets=buckets)
    assert rows(reopened.snapshot()) == before
    reopened.drop_folded()
    assert storage.folder_names(spark, f"{root}/log") == ["_batch_id=-1"]
    assert storage.folder_names(spark, f"{root}/{target._base_folder}") == ["upto=2"]
    assert rows(reopened.snapshot()) == before and reopened.compact() == 2
    again = open_target(spark, root, delete=True, buckets=buckets, base=base)
    again.apply(change(spark, (2, 9, "more", "update_postimage", 9)), 3)
    expected[2] = (2, 9, "more")
    assert set(rows(again.snapshot())) == set(expected.values())


def test_bucketed_base_is_not_shuffled(spark, root, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    base = spark.range(1000).selectExpr("cast(id AS int) AS k", "0 AS t", "'base' AS s")
    target = open_target(spark, root, base=base, buckets=4)
    target.apply(base.filter("k % 2 = 0").withColumn("s", F.lit("new")), 0)
    plan = executed_plan(target.snapshot())
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    beneath = plan[plan.index("SortMergeJoin"):plan.index("Bucketed: true")]
    assert "Exchange" not in beneath
    assert target.snapshot().filter("s = 'new'").count() == 500
    assert target.snapshot().count() == 1000


def test_small_log_is_broadcast(spark, root):
    base = spark.range(1000).selectExpr("cast(id AS int) AS k", "0 AS t", "'base' AS s")
    target = open_target(spark, root, base=base)
    target.apply(spark.createDataFrame([(1, 1, "x")], TABLE), 0)
    assert "BroadcastHashJoin" in executed_plan(target.snapshot())


def test_buckets_cannot_change(spark, root):
    open_target(spark, root, buckets=4)
    for other in (None, 8):
        with pytest.raises(ValueError):
            open_target(spark, root, buckets=other)


def test_repeated_keys_are_refused_at_the_start(spark, root):
    twice = spark.createDataFrame([(None, 1, "a"), (None, 2, "b")], TABLE)
    with pytest.raises(ValueError):
        open_target(spark, root, base=twice)
    with pytest.raises(ValueError):
        MergeTarget.open(spark, root, "k", "t")


def test_a_new_checkpoint_is_refused(spark, root, database):
    table = qualified(database, "upstream")
    write_table(spark.createDataFrame([(1, 1, "a")], TABLE), table)
    target = open_target(spark, root + "/table")
    stream_merge(stream_table(spark, table), target, root + "/checkpoint")
    for _ in range(2):
        with pytest.raises(ValueError, match="progress"):
            stream_merge(stream_table(spark, table), target, root + "/other")
        target.compact()
        target.drop_folded()
    stream_merge(stream_table(spark, table), target, root + "/checkpoint")
    assert rows(target.snapshot()) == [(1, 1, "a")]


@pytest.mark.parametrize("buckets", [None, 4])
def test_keys_of_several_columns_with_nulls(spark, root, buckets):
    ddl = "a int, b string, v int"
    base = [(1, "x", 0), (1, None, 0), (None, "x", 0), (None, None, 0), (2, "y", 0)]
    target = MergeTarget.open(
        spark, root, ["a", "b"], "v", base=spark.createDataFrame(base, ddl), buckets=buckets
    )
    news = [(1, None, 5), (None, None, 6), (None, "y", 7), (2, "y", 8)]
    target.apply(spark.createDataFrame(news, ddl), 0)
    expected = sorted([(1, "x", 0), (None, "x", 0), *news], key=str)
    assert sorted(rows(target.snapshot()), key=str) == expected
    target.compact()
    assert sorted(rows(target.snapshot()), key=str) == expected


def test_reserved_names_are_refused(spark, root):
    with pytest.raises(ValueError, match="_batch_id"):
        MergeTarget.open(spark, root, "k", "t", schema=schema_of(spark, "k int, t int, _batch_id int"))


@pytest.mark.parametrize("logged_before_the_failure", [True, False])
def test_a_failed_batch_is_replayed(spark, root, database, monkeypatch, logged_before_the_failure):
    table = qualified(database, "upstream")
    write_table(spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], TABLE), table)
    target = open_target(spark, root + "/table")
    whole = MergeTarget.apply

    def failing(self, batch, batch_id):
        if logged_before_the_failure:
            whole(self, batch, batch_id)
        raise RuntimeError("lost")

    monkeypatch.setattr(MergeTarget, "apply", failing)
    with pytest.raises(StreamingQueryException):
        stream_merge(stream_table(spark, table), target, root + "/checkpoint")
    monkeypatch.setattr(MergeTarget, "apply", whole)
    write_table(spark.createDataFrame([(2, 0, "c"), (3, 1, "d")], TABLE), table)
    stream_merge(stream_table(spark, table), target, root + "/checkpoint")
    assert rows(target.snapshot()) == [(1, 1, "a"), (2, 0, "c"), (3, 1, "d")]


def test_unfinished_folders_are_not_read(spark, root):
    target = open_target(spark, root)
    target.apply(spark.createDataFrame([(1, 1, "a")], TABLE), 0)
    target.apply(spark.createDataFrame([(1, 2, "b")], TABLE), 1)
    target.compact()
    storage.delete(spark, f"{root}/log/_batch_id=1/_SUCCESS")
    storage.delete(spark, f"{root}/base/upto=1/_SUCCESS")
    assert rows(target.snapshot()) == [(1, 1, "a")]


def test_stream_with_several_batches(spark, root, database):
    """Each append is a file of its own and, limited to one file, a micro-batch of its own."""
    table = qualified(database, "upstream")
    for number in range(3):
        batch = spark.createDataFrame([(1, 10 - number, f"b{number}"), (number + 5, 0, "x")], TABLE)
        write_table(batch.coalesce(1), table)
    target = open_target(spark, root + "/table")
    stream = stream_table(spark, table, max_files_per_trigger=1)
    query = stream_merge(stream, target, root + "/checkpoint")
    assert sum(p.numInputRows > 0 for p in query.recentProgress) == 3
    assert rows(target.snapshot()) == [(1, 8, "b2"), (5, 0, "x"), (6, 0, "x"), (7, 0, "x")]

    stream_merge(stream_table(spark, table), target, root + "/checkpoint")
    assert target.snapshot().count() == 4
    write_table(spark.createDataFrame([(1, 0, "later"), (9, 0, "y")], TABLE), table)
    stream_merge(stream_table(spark, table), target, root + "/checkpoint")
    assert rows(target.snapshot())[0] == (1, 0, "later")
    assert target.snapshot().count() == 5


def test_change_feed_from_a_table(spark, root, database):
    feed = qualified(database, "feed")
    write_table(change(spark, (1, 0, "a", "insert", 1), (2, 0, "b", "insert", 1)), feed)
    target = open_target(spark, root + "/table", delete=True)
    stream_merge(stream_changes(spark, feed), target, root + "/checkpoint")
    write_table(change(spark, (1, 0, "", "delete", 2), (2, 0, "c", "update_postimage", 2)), feed)
    stream_merge(stream_changes(spark, feed), target, root + "/checkpoint")
    assert rows(target.snapshot()) == [(2, 0, "c")]

    target.remove(root + "/checkpoint")
    assert not storage.exists(spark, root + "/table")
    assert not storage.exists(spark, root + "/checkpoint")


def test_remove_bucketed(spark, root):
    target = open_target(spark, root, buckets=4, base=spark.createDataFrame([(1, 0, "a")], TABLE))
    target.remove(root + "-checkpoint")
    again = MergeTarget.open(
        spark, root, "k", "t", schema=schema_of(spark, "k int, t int, u double"), buckets=4
    )
    assert again.snapshot().columns == ["k", "t", "u"]
    assert rows(again.snapshot()) == []


keys = st.one_of(st.none(), st.integers(0, 4))


@limits(max_examples=6, deadline=None)
@given(
    batches=st.lists(
        st.lists(st.tuples(keys, st.one_of(st.none(), st.integers(0, 3))), max_size=6),
        min_size=1,
        max_size=4,
    ),
    compact_after=st.integers(0, 3),
    buckets=st.sampled_from([None, 4]),
)
def test_guard_equals_latest_of_all(spark, batches, compact_after, buckets):
    numbers = iter(range(100))
    news = [[(k, t, f"row {next(numbers):02d}") for k, t in batch] for batch in batches]
    target = MergeTarget.open(
        spark, new_dir(spark, "property"), "k", ["t", "s"], schema=schema_of(spark, TABLE),
        order_guard=True, buckets=buckets,
    )
    for batch_id, batch in enumerate(news):
        target.apply(spark.createDataFrame(batch, TABLE), batch_id)
        if batch_id == compact_after:
            target.compact()
    everything = spark.createDataFrame([row for batch in news for row in batch], TABLE)
    assert rows(target.snapshot()) == rows(latest_per_key(everything, "k", ["t", "s"]))


kinds = st.sampled_from(["insert", "update_preimage", "update_postimage", "delete"])


@limits(max_examples=6, deadline=None)
@given(
    base=st.lists(keys, unique=True, max_size=5),
    batches=st.lists(
        st.lists(st.tuples(keys, st.integers(0, 3), kinds, st.integers(0, 2)), max_size=6),
        min_size=1,
        max_size=3,
    ),
    buckets=st.sampled_from([None, 4]),
)
def test_log_equals_merging_batch_by_batch(spark, base, batches, buckets):
    current = spark.createDataFrame([(k, 0, "base") for k in base], TABLE)
    target = open_target(
        spark, new_dir(spark, "property"), base=current, delete=True, buckets=buckets
    )
    number = 0
    for batch_id, batch in enumerate(batches):
        changes = []
        for k, t, kind, version in batch:
            number += 1
            changes.append((k, t * 1000 + number, f"row {number}", kind, version))
        df = change(spark, *changes)
        target.apply(df, batch_id)
        newest = latest_per_key(df, "k", "t", change_feed=True)
        current = merge(current, newest, "k", delete=True)
    assert rows(target.snapshot()) == rows(current)
    target.compact()
    assert rows(target.snapshot()) == rows(current)


def test_another_streams_checkpoint_is_refused(spark, root, database):
    targets = {}
    for letter in "ab":
        table = qualified(database, letter)
        write_table(spark.createDataFrame([(ord(letter), 1, letter)], TABLE), table)
        targets[letter] = open_target(spark, f"{root}/{letter}")
        stream_merge(stream_table(spark, table), targets[letter], f"{root}/of-{letter}")
        write_table(spark.createDataFrame([(ord(letter) + 10, 1, letter)], TABLE), table)
    with pytest.raises(ValueError, match="is fed by the stream"):
        stream_merge(stream_table(spark, qualified(database, "b")), targets["a"], f"{root}/of-b")
    stream_merge(stream_table(spark, qualified(database, "a")), targets["a"], f"{root}/of-a")
    assert rows(targets["a"].snapshot()) == [(97, 1, "a"), (107, 1, "a")]


def test_number_of_buckets_is_checked(spark, root):
    for buckets in (0, 100_001):
        with pytest.raises(ValueError, match="buckets"):
            open_target(spark, root, buckets=buckets)
    assert open_target(spark, root, buckets=100_000).buckets == 100_000


def test_name_follows_the_table(spark, root, database):
    target, name = open_target(spark, root), qualified(database, "named")
    target.apply(spark.createDataFrame([(1, 1, "a")], TABLE), 0)
    target.publish(name)
    assert rows(spark.sql(f"SELECT * FROM {name}")) == []
    target.compact()
    target.publish(name)
    assert rows(spark.sql(f"SELECT * FROM {name}")) == [(1, 1, "a")]
    write_table(spark.range(1), qualified(database, "taken"))
    with pytest.raises(ValueError, match="other columns"):
        target.publish(qualified(database, "taken"))


def test_a_folder_made_anew_forgets_its_old_columns(spark, root):
    target = open_target(spark, root, buckets=4)
    target.snapshot().count()
    storage.delete(spark, root)
    other = MergeTarget.open(spark, root, "k", ["t"], schema=schema_of(spark, "k int, t int"), buckets=4)
    assert other.snapshot().columns == ["k", "t"]
