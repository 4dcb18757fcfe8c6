"""Row selection: snapshots, slices, year filters, look-ups, one row per key."""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crewlens.functions.parsing import col, icontains


def drop_missing(df: DataFrame, *names: str) -> DataFrame:
    """Rows where all the columns are known, as plain null tests that can be pushed down."""
    return df.where(reduce(and_, [col(n).isNotNull() for n in names]))


def latest_snapshot(df: DataFrame, period: str, grain: str | None = None) -> DataFrame:
    """Rows of the last period, or of the calendar unit (``grain``) the last period falls in.

    The maximum is a scalar subquery: it is evaluated first and then reaches the parquet scan
    as a pushed filter, so only row groups of the last period are read.
    """
    last = df.agg(F.max(col(period)).alias("last"))
    if grain is None:
        return df.where(col(period) == last.scalar())
    start = last.select(F.trunc(F.col("last"), grain))
    return df.where(col(period) >= start.scalar())


def in_year(c: Column, year: int) -> Column:
    """Date or timestamp within a year, as a range so that it can be pushed to the scan."""
    low, high = (F.lit(f"{y}-01-01").cast("date") for y in (year, year + 1))
    return (c >= low) & (c < high)


def review_documents(df: DataFrame, name: Column, score: Column, kinds: Sequence[str]) -> DataFrame:
    """Rows whose document name holds one of the kinds (any case), or that carry a score."""
    keep = score.isNotNull()
    for kind in kinds:
        keep = keep | icontains(name, kind)
    return df.where(keep)


def rows_between(df: DataFrame, order: str, low: int, high: int) -> DataFrame:
    """Rows ``low`` to ``high - 1`` in the given order, planned as a bounded top-k."""
    return df.orderBy(col(order).asc()).offset(low).limit(high - low)


def labelled_rows(df: DataFrame, order: str, low: int, labels: Sequence[str], target: str) -> DataFrame:
    """Slice as many rows as there are labels and overwrite ``target`` by row position.

    The unpartitioned window sees at most one row per label.
    """
    part = rows_between(df, order, low, low + len(labels))
    position = F.row_number().over(Window.orderBy(col(order).asc()))
    names = F.array(*[F.lit(x) for x in labels])
    return part.withColumn(target, F.element_at(names, position))


def lookup_or(value: Column, condition: Column, default: Column | str) -> Column:
    """Aggregate: value of the row that meets the condition, else the default text."""
    found = F.max(F.when(condition, value))
    return F.coalesce(found, default if isinstance(default, Column) else F.lit(default))


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in the given order.

    Spark turns the rank filter into a group limit ahead of the shuffle, so at most one row
    per key leaves a map task and a hot key does not pile up in one reducer.
    """
    rank = F.row_number().over(Window.partitionBy(*[col(k) for k in keys]).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], period: str, row: str, drop_null_period: bool = False
) -> DataFrame:
    """Last row per key by period, ties to the later row. A missing period counts as last."""
    rows = df.where(col(period).isNotNull()) if drop_null_period else df
    return one_per_key(rows, keys, [col(period).desc_nulls_first(), col(row).desc()])


def best_per_key(df: DataFrame, keys: Sequence[str], best: Sequence[str], row: str) -> DataFrame:
    """Row per key with the highest values (missing ones last), ties to the earlier row."""
    return one_per_key(df, keys, [*[col(b).desc_nulls_last() for b in best], col(row).asc()])


def first_rows(df: DataFrame, best: Sequence[str], n: int, *ties: str) -> DataFrame:
    """The first n rows by several descending keys, missing ones last, ties in ascending order.

    Sorted and cut in one step: every task hands on n rows at most.
    """
    order = [*[col(b).desc_nulls_last() for b in best], *[col(t).asc_nulls_last() for t in ties]]
    return df.orderBy(*order).limit(n)


def top_k(df: DataFrame, by: str, k: int, *ties: str) -> DataFrame:
    """The k rows with the highest value, planned as a bounded top-k without a full sort."""
    return first_rows(df, [by], k, *ties)
