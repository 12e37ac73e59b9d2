from conftest import executed_plan, rows

from millrace.operators import in_range, null_counts

STAFF = "emp_id int, emp_name string, department string, salary int"
PEOPLE = [
    (1, "Ada", "Sales", 41000),
    (2, "Ben", "Tech", None),
    (3, None, "Law", 52000),
    (4, "Cem", None, 61000),
    (5, "Dee", "Tech", 66000),
    (6, "Eve", "Sales", None),
    (7, None, None, None),
]


def test_null_counts(spark):
    counted = null_counts(spark.createDataFrame(PEOPLE, STAFF))
    assert counted.columns == [f"null_cnt_{c}" for c in ("emp_id", "emp_name", "department", "salary")]
    assert rows(counted) == [(0, 2, 2, 3)]


def test_null_counts_other_prefix(spark):
    counted = null_counts(spark.createDataFrame(PEOPLE, STAFF), prefix="cnt_")
    assert counted.first().asDict() == {
        "cnt_emp_id": 0, "cnt_emp_name": 2, "cnt_department": 2, "cnt_salary": 3,
    }


def test_null_counts_of_no_rows_are_null(spark):
    assert rows(null_counts(spark.createDataFrame([], STAFF))) == [(None,) * 4]


def test_null_counts_quote_names(spark):
    counted = null_counts(spark.createDataFrame([(None, 1)], "`a.b` int, `c d` int"))
    assert counted.first().asDict() == {"null_cnt_a.b": 1, "null_cnt_c d": 0}


def test_range_is_inclusive_and_drops_null(spark):
    df = spark.createDataFrame([(9,), (10,), (15,), (20,), (21,), (None,)], "v int")
    assert rows(in_range(df, "v", 10, 20)) == [(10,), (15,), (20,)]
    assert rows(in_range(df, "v", 20, 10)) == []


def test_range_reaches_the_scan(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    plan = executed_plan(in_range(lines, "l_partkey", 5, 9).select("l_partkey"))
    assert "GreaterThanOrEqual(l_partkey,5)" in plan
    assert "ReadSchema: struct<l_partkey:bigint>" in plan
