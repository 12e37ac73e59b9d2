import pytest
from conftest import rows
from pyspark.errors import AnalysisException

from millrace.functions import token_count
from millrace.plans import ensure_layers, load_batch, qualified, write_table


def test_qualified_names_are_quoted():
    assert qualified("bronze", "t") == "`spark_catalog`.`bronze`.`t`"
    assert qualified("raw", "a`b", "`uc-demo`") == "`uc-demo`.`raw`.`a``b`"


def test_layers_are_created_once(spark, tmp_path):
    for _ in range(2):
        ensure_layers(spark, str(tmp_path))
    assert spark.catalog.getDatabase("bronze").locationUri.rstrip("/").endswith("/bronze")
    assert spark.catalog.getDatabase("clean").locationUri.rstrip("/").endswith("/silver")
    write_table(spark.range(3), qualified("clean", "numbers"))
    assert list((tmp_path / "silver" / "numbers").glob("*.parquet"))
    assert "numbers" in [t.name for t in spark.catalog.listTables("clean")]
    spark.sql("DROP DATABASE bronze CASCADE")
    spark.sql("DROP DATABASE clean CASCADE")


def test_append_and_overwrite(spark, database, tmp_path):
    (tmp_path / "a.csv").write_text("id,s\n1,x\n2,\n")
    name = load_batch(spark, "csv", tmp_path / "a.csv", database, "t")
    assert rows(spark.table(name)) == [("1", "x"), ("2", None)]
    load_batch(spark, "csv", tmp_path / "a.csv", database, "t")
    assert spark.table(name).count() == 4
    load_batch(spark, "csv", tmp_path / "a.csv", database, "t", mode="overwrite")
    assert spark.table(name).count() == 2


def test_append_of_another_shape_fails(spark, database):
    write_table(spark.range(1), qualified(database, "t"))
    with pytest.raises(AnalysisException):
        write_table(spark.range(1).selectExpr("id", "id AS more"), qualified(database, "t"))


def test_typed_load(spark, database, tmp_path):
    (tmp_path / "a.csv").write_text("id;d\n1;2024-05-06\nx;bad\n")
    name = load_batch(spark, "csv", tmp_path, database, "t", "id int, d date", sep=";")
    assert rows(spark.table(name).selectExpr("id", "cast(d AS string)")) == [
        (None, None), (1, "2024-05-06"),
    ]


def test_text_load_and_count(spark, database, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "a.txt").write_text("stream after stream: 100 rows")
    (tmp_path / "deep" / "b.txt").write_text("one\ntwo 2")
    name = load_batch(spark, "text", tmp_path, database, "words")
    assert spark.table(name).columns == ["value"]
    assert rows(token_count(spark.table(name))) == [(6,)]
    assert rows(token_count(spark.table(name), pattern=None)) == [(8,)]


def test_other_file_types_are_refused(spark, database, tmp_path):
    with pytest.raises(NotImplementedError):
        load_batch(spark, "xlsx", tmp_path, database, "t")
