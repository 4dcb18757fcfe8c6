"""Compare every registered query with its SQL: ``python -m gate.check [sf_dir] [name ...]``."""

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from crewlens.session import session
from gate import ORACLES, QUERIES

DEFAULT_DIR = "/root/testdata/sf0.01"


def oracle(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def _cell(value: object) -> object:
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def rows_of(columns: list[str], data: list[tuple]) -> list[tuple]:
    """Rows with columns in name order, sorted; NaN reads as missing and -0.0 as 0.0."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_cell(r[i]) for i in order) for r in data]
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf: str) -> str | None:
    """None if equal, else what differs first."""
    df: DataFrame = QUERIES[name](spark, sf)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(ORACLES[name])
    want_columns = [d[0] for d in cursor.description]
    want = rows_of(want_columns, cursor.fetchall())
    if sorted(df.columns) != sorted(want_columns):
        return f"columns {sorted(df.columns)} != {sorted(want_columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} != {b}"
    return None


def main(sf: str, names: list[str]) -> int:
    spark = session("crewlens-check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle(sf)
    failed = 0
    for name in names or QUERIES:
        start = time.perf_counter()
        try:
            problem = compare(spark, con, name, sf)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.perf_counter() - start:.2f}s {problem or ''}", flush=True)
    print(f"{failed} failed of {len(names or QUERIES)}")
    return failed


if __name__ == "__main__":
    arguments = sys.argv[1:]
    folder = arguments.pop(0) if arguments and "/" in arguments[0] else DEFAULT_DIR
    sys.exit(main(folder, arguments) > 0)
