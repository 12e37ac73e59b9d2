import base64
import json
import os
from pathlib import Path

import pytest
from conftest import rows
from pyspark.errors import StreamingQueryException

from millrace import storage
from millrace.plans import qualified, write_table
from millrace.sources import FormatSpec
from millrace.sources.schemas import Arrived
from millrace.streaming import TargetPaths, epochs, ingest_files, reset, stop

ORDER = """books array<struct<book_id: string, quantity: bigint, subtotal: bigint>>,
customer_id string, order_id string, order_timestamp string, quantity bigint, total bigint"""


def envelope(topic, payload, offset):
    text = payload if isinstance(payload, str) else json.dumps(payload)
    value = None if payload is None else base64.b64encode(text.encode()).decode()
    return json.dumps({"topic": topic, "value": value, "offset": offset}) + "\n"


def order(number, total):
    return {
        "order_id": number,
        "total": total,
        "books": [{"book_id": "B1", "quantity": 1, "subtotal": total}],
    }


class Job:
    """One ingest job, with its folders."""

    def __init__(self, spark, database, folder, spec=FormatSpec("json")):
        self.spark, self.database, self.folder, self.spec = spark, database, folder, spec
        (folder / "in").mkdir()
        self.table = qualified(database, "orders")
        self.roots = (str(folder / "checkpoints"), str(folder / "schemas"))
        self.paths = TargetPaths.under(*self.roots, database, "orders")

    def put(self, name, *lines):
        path = self.folder / "in" / name
        path.parent.mkdir(exist_ok=True)
        path.write_text("".join(lines))
        return path

    def run(self, **options):
        return ingest_files(
            self.spark, str(self.folder / "in"), self.spec, self.database, "orders", *self.roots,
            **options,
        )


@pytest.fixture
def job(spark, database, tmp_path):
    return Job(spark, database, tmp_path)


def test_decode_filter_and_exactly_once(spark, job):
    job.put(
        "a.json",
        envelope("orders", order("o1", 10), 0),
        envelope("books", {"order_id": "no"}, 1),
        envelope("orders", "not json", 2),
        envelope("orders", None, 3),
        json.dumps({"value": "e30="}) + "\n",
    )
    options = dict(message_schema=ORDER, filter_expr="topic = 'orders'")
    query = job.run(**options)
    assert not query.isActive
    found = spark.table(job.table)
    assert dict(found.dtypes)["value"] == "binary"
    assert rows(found.selectExpr("offset", "message.order_id", "message.total")) == [
        ("0", "o1", 10), ("2", None, None), ("3", None, None),
    ]
    books = found.selectExpr("explode(message.books) AS book").select("book.*")
    assert rows(books) == [("B1", 1, 10)]

    job.run(**options)
    assert spark.table(job.table).count() == 3
    job.put("later/b.json", envelope("orders", order("o2", 20), 4))
    job.run(**options)
    assert spark.table(job.table).count() == 4


def test_filter_may_use_the_message(spark, job):
    job.put("a.json", *[envelope("orders", order(f"o{i}", i), i) for i in range(5)])
    job.run(message_schema=ORDER, filter_expr="message.total >= 3")
    assert rows(spark.table(job.table).selectExpr("message.total")) == [(3,), (4,)]


def test_other_names_are_ignored_and_batches_limited(spark, job):
    for i in range(3):
        job.put(f"{i}.json", envelope("t", {"a": i}, i))
    job.put("skip.txt", "no json\n")
    query = job.run(max_files_per_trigger=1)
    assert spark.table(job.table).count() == 3
    assert sum(p.numInputRows > 0 for p in query.recentProgress) == 3


def test_reset_starts_over(spark, job):
    job.put("a.json", envelope("t", {"a": 1}, 0))
    job.run()
    assert storage.exists(spark, job.paths.checkpoint) and storage.exists(spark, job.paths.schema)
    reset(spark, job.table, job.paths)
    assert not spark.catalog.tableExists(job.table)
    assert not storage.exists(spark, job.paths.checkpoint)
    assert not storage.exists(spark, job.paths.schema)
    job.put("b.json", json.dumps({"new_column": 1}) + "\n")
    job.paths.create_checkpoint(spark)
    job.run()
    assert spark.table(job.table).count() == 2
    assert "new_column" in spark.table(job.table).columns


def test_new_columns_reach_the_table(spark, job):
    job.put("a.json", envelope("t", {"a": 1}, 0))
    job.run(message_schema="a int")
    job.put("b.json", json.dumps({"topic": "u", "region": "north"}) + "\n")
    job.run(message_schema="a int")
    assert rows(spark.table(job.table).select("topic", "region", "message.a")) == [
        ("t", None, 1), ("u", "north", None),
    ]


def test_lines_that_are_not_json_are_kept(spark, job):
    job.put("a.json", envelope("t", {"a": 1}, 0), "{broken\n")
    job.run()
    assert rows(spark.table(job.table).select("topic", "_corrupt_record")) == [
        (None, "{broken"), ("t", None),
    ]


def test_a_failed_run_is_taken_up_again(spark, job):
    job.put("a.json", envelope("t", {"a": 1}, "7"), envelope("t", {"a": 1}, "x"))
    with pytest.raises(StreamingQueryException):
        job.run(filter_expr="cast(offset AS int) > 0")
    job.run(filter_expr="try_cast(offset AS int) > 0")
    assert rows(spark.table(job.table).select("offset")) == [("7",)]


def test_csv_and_parquet_files(spark, database, tmp_path):
    (tmp_path / "csv").mkdir()
    csv = Job(spark, database, tmp_path / "csv", FormatSpec("csv", {"header": True, "sep": "|"}))
    csv.put("a.csv", "id|name\n1|x\n2|\n")
    csv.run(hints={"id": "int"})
    assert rows(spark.table(csv.table)) == [(1, "x"), (2, None)]
    spark.sql(f"DROP TABLE {csv.table}")

    (tmp_path / "parquet").mkdir()
    parquet = Job(spark, database, tmp_path / "parquet", FormatSpec("parquet"))
    spark.range(4).write.parquet(str(tmp_path / "parquet" / "in" / "1"))
    parquet.run(hints={})
    assert spark.table(parquet.table).count() == 4


def test_csv_envelope(spark, database, tmp_path):
    """The default hint types a column ``value`` that is there, and invents none in CSV."""
    csv = Job(spark, database, tmp_path, FormatSpec("csv", {"header": True}))
    csv.put("a.csv", "topic,value\norders,plain\n")
    csv.run()
    assert rows(spark.table(csv.table)) == [("orders", b"plain")]
    reset(spark, csv.table, csv.paths)
    csv.put("a.csv", "topic\norders\n")
    csv.run()
    assert rows(spark.table(csv.table)) == [("orders",)]


def test_old_file_with_a_new_column_is_loaded(spark, database, tmp_path):
    job = Job(spark, database, tmp_path, FormatSpec("json"))
    job.put("a.json", '{"a": "1"}\n')
    job.run(hints={})
    old = job.put("b.json", '{"a": "2", "b": "x"}\n')
    month_ago = old.stat().st_mtime - 30 * 86400
    os.utime(old, (month_ago, month_ago))
    job.put("c.json", '{"a": "3"}\n')
    job.run(hints={})
    assert rows(spark.table(job.table), "a", "b") == [("1", None), ("2", "x"), ("3", None)]


def test_csv_columns_move_and_appear(spark, database, tmp_path):
    job = Job(spark, database, tmp_path, FormatSpec("csv", {"header": True}))
    for number, text in enumerate(["a,b,c\n1,2,3\n", "b,a,c\n20,10,30\n", "a,d,b,c\n100,400,200,300\n"]):
        job.put(f"{number}.csv", text)
        job.run()
    job.put("3.csv", "c,b,a\n7,8,9\n")
    job.put("4.csv", "a,b,c,e\n1,1,1,5\n")
    job.run()
    assert spark.table(job.table).columns == ["a", "b", "c", "d", "e"]
    assert rows(spark.table(job.table), "a", "b", "c", "d", "e") == [
        ("1", "1", "1", None, "5"), ("1", "2", "3", None, None), ("10", "20", "30", None, None),
        ("100", "200", "300", "400", None), ("9", "8", "7", None, None),
    ]


@pytest.mark.parametrize("batch_first", [True, False])
def test_batch_and_stream_share_a_table(spark, database, tmp_path, batch_first):
    job = Job(spark, database, tmp_path, FormatSpec("parquet"))

    def batch():
        write_table(spark.range(3).selectExpr("id + 100 AS id"), job.table)

    if batch_first:
        batch()
    spark.range(2).write.parquet(str(tmp_path / "in" / "1"))
    job.run(hints={})
    if not batch_first:
        batch()
    spark.range(2, 4).write.parquet(str(tmp_path / "in" / "2"))
    job.run(hints={})
    batch()
    expected = [(0,), (1,), (2,), (3,)] + sorted([(100,), (101,), (102,)] * 2)
    assert rows(spark.table(job.table)) == expected


def test_new_fields_inside_a_column_are_refused_not_lost(spark, database, tmp_path):
    job = Job(spark, database, tmp_path, FormatSpec("json"))
    job.put("a.json", '{"a": {"x": "1"}}\n')
    job.run(hints={})
    job.put("b.json", '{"a": {"x": "2", "y": "3"}}\n')
    for _ in range(2):
        with pytest.raises(Exception, match="cannot become"):
            job.run(hints={})
    assert spark.table(job.table).count() == 1


def test_wider_payload_is_refused_not_lost(spark, database, tmp_path):
    job = Job(spark, database, tmp_path, FormatSpec("json"))
    job.put("a.json", envelope("t", {"k": 1}, 0))
    job.run(message_schema="k int")
    job.put("b.json", envelope("t", {"k": 1, "m": 2}, 1))
    with pytest.raises(Exception, match="cannot become"):
        job.run(message_schema="k int, m int")


def test_portions_of_a_batch(spark, database, tmp_path, monkeypatch):
    """Five files, two names at a time on the driver; after a failure only what lacks is written."""
    job = Job(spark, database, tmp_path, FormatSpec("csv", {"header": True}))
    for number in range(5):
        job.put(f"{number}.csv", "a,b\n" if number % 2 else "b,a\n", f"{number},x\n")
    job.put("5.csv", "a,b\n", "bad,x\n")
    taken = []
    portion = Arrived.portion

    def watch(self, number):
        groups = portion(self, number)
        taken.append(sum(map(len, groups.values())))
        return groups

    monkeypatch.setattr(Arrived, "portion", watch)
    with pytest.raises(StreamingQueryException):
        job.run(files_at_once=1, filter_expr="cast(coalesce(nullif(a, 'x'), b) AS int) >= 0")
    assert max(taken) < 6
    written = len(list(Path(spark.table(job.table).inputFiles()[0].removeprefix("file:")).parent.parent.iterdir()))
    assert written >= 1
    job.run(files_at_once=1000, filter_expr="try_cast(coalesce(nullif(a, 'x'), b) AS int) >= 0")
    found = rows(spark.table(job.table).selectExpr("coalesce(nullif(a, 'x'), b)"))
    assert found == [(str(n),) for n in range(5)]


def test_names_with_signs_that_readers_interpret(spark, database, tmp_path):
    job = Job(spark, database, tmp_path, FormatSpec("csv", {"header": True}))
    for number, name in enumerate(["a b.csv", "x[1].csv", "ü%20.csv", "{y}.csv", "#z.csv"]):
        job.put(name, "a\n", f"{number}\n")
    job.run()
    assert rows(spark.table(job.table)) == [(str(n),) for n in range(5)]


def test_files_without_lines_give_no_table(spark, database, tmp_path):
    job = Job(spark, database, tmp_path, FormatSpec("csv", {"header": True}))
    job.put("a.csv", "\n \n")
    job.run()
    assert not spark.catalog.tableExists(job.table)
    job.put("b.csv", "\n", "a\n", "1\n")
    job.run()
    assert rows(spark.table(job.table)) == [("1",)]


def test_archived_files_are_forgotten_and_not_loaded_twice(spark, database, tmp_path):
    job = Job(spark, database, tmp_path, FormatSpec("json"))
    archive = str(tmp_path / "archive")
    for run in range(3):
        for number in range(2):
            job.put(f"sub/{number}.json", json.dumps({"a": f"{run}-{number}"}) + "\n")
        job.run(hints={}, max_files_per_trigger=1, archive=archive)
        assert not [p for p in (tmp_path / "in").rglob("*") if p.is_file()]
    job.run(hints={}, archive=archive)
    expected = [(f"{run}-{number}",) for run in range(3) for number in range(2)]
    assert rows(spark.table(job.table)) == expected
    assert len([p for p in (tmp_path / "archive").rglob("*.json")]) == 6
    # Nothing of the epochs before is left in the checkpoint.
    assert not storage.exists(spark, f"{job.paths.checkpoint}/sources")
    assert storage.folder_names(spark, f"{job.paths.checkpoint}/epochs") == ["3"]


def test_archiving_is_taken_up_again(spark, database, tmp_path, monkeypatch):
    """The move breaks off after one file; meanwhile a new file has come under the moved one's name."""
    job = Job(spark, database, tmp_path, FormatSpec("json"))
    archive = str(tmp_path / "archive")
    old = [job.put(f"{number}.json", json.dumps({"a": f"old {number}"}) + "\n") for number in range(3)]
    move, moved = storage.move, []

    def fails(spark, path, *rest):
        if moved:
            raise OSError("the store is away")
        moved.append(path)
        return move(spark, path, *rest)

    monkeypatch.setattr(storage, "move", fails)
    monkeypatch.setattr(epochs, "MOVERS", 1)
    with pytest.raises(OSError):
        job.run(hints={}, archive=archive)
    monkeypatch.setattr(storage, "move", move)
    left = [p for p in old if p.exists()]
    assert len(left) == 2
    again = next(p for p in old if not p.exists())
    again.write_text(json.dumps({"a": "new one"}) + "\n")
    job.run(hints={}, archive=archive)
    job.run(hints={}, archive=archive)
    assert rows(spark.table(job.table)) == [("new one",)] + [(f"old {n}",) for n in range(3)]


def test_a_batch_that_is_not_loaded_keeps_the_epoch(spark, database, tmp_path):
    job = Job(spark, database, tmp_path, FormatSpec("json"))
    archive = str(tmp_path / "archive")
    job.put("a.json", '{"a": "1"}\n')
    job.run(hints={})
    job.put("b.json", '{"a": "x"}\n')
    with pytest.raises(StreamingQueryException):
        job.run(hints={}, filter_expr="cast(a AS int) > 0", archive=archive)
    assert storage.file_names(spark, str(tmp_path / "in")) == ["b.json"]
    job.run(hints={}, filter_expr="a <> ''", archive=archive)
    assert rows(spark.table(job.table)) == [("1",), ("x",)]
    assert storage.file_names(spark, str(tmp_path / "in")) == []


def test_archive_must_be_elsewhere(spark, job):
    job.put("a.json", '{"a": "1"}\n')
    with pytest.raises(ValueError, match="lies in the folder"):
        job.run(archive=str(job.folder / "in" / "done"))
    with pytest.raises(ValueError, match="wait"):
        job.run(archive=str(job.folder / "done"), wait=False)


def test_stop(spark, job):
    assert stop(None) is False
    job.put("a.json", envelope("t", {"a": 1}, 0))
    assert stop(job.run()) is False
    query = spark.readStream.format("rate").load().writeStream.format("noop").start()
    assert stop(query) is True
    assert not query.isActive
