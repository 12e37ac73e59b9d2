import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("millrace-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(folder / "shared"))
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    folder = Path("/root/testdata/sf0.001")
    if not folder.exists():
        pytest.skip("the given tables are not here")
    return str(folder)


@pytest.fixture
def database(spark):
    from millrace.plans.queries import new_database

    return new_database(spark)


@pytest.fixture
def settings(spark):
    """Change session settings for one test."""
    before = {}

    def change(**values):
        for key, value in values.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def rows(df, *columns):
    """All rows as a sorted list of tuples; NULL sorts first."""
    picked = df.select(*columns) if columns else df
    return sorted(
        (tuple(r) for r in picked.collect()),
        key=lambda r: [(v is not None, str(type(v)), v) for v in r],
    )


def executed_plan(df):
    """The plan as it ran, adaptive changes included."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
