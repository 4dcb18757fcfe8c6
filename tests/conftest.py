import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from crewlens.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session(
        "crewlens-tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def make(spark):
    """Small literal frames: ``make("a string, b double", [...])``."""
    return lambda schema, rows: spark.createDataFrame(rows, schema)


def values(df, *order):
    """Collected rows as plain tuples, sorted by the given columns if any."""
    rows = df.orderBy(*order).collect() if order else df.collect()
    return [tuple(r) for r in rows]


def plan_of(df):
    """Text of the physical plan."""
    return df._jdf.queryExecution().executedPlan().toString()
