"""Wide to long, long to wide, and stacking of scalars into rows."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crewlens.functions.parsing import col, num_of


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], variable: str, value: str) -> DataFrame:
    """Wide to long; the value columns are read as doubles first."""
    typed = df.select(*[col(i) for i in ids], *[num_of(df, v).alias(v) for v in values])
    return typed.unpivot([col(i) for i in ids], [col(v) for v in values], variable, value)


def metric_columns(
    df: DataFrame, key: str, metric: str, value: str, names: Mapping[str, str]
) -> DataFrame:
    """Long to wide: one column per wanted metric, keeping keys that have all of them.

    A key with a metric twice gets a row for each, in all combinations with the other metrics.
    """
    parts = [df.where(col(metric) == m).select(col(key), col(value).alias(n)) for m, n in names.items()]
    return reduce(lambda left, right: left.join(right, key), parts)


def stack_rows(df: DataFrame, rows: Sequence[Mapping[str, Column]]) -> DataFrame:
    """One output row per mapping, for every input row."""
    structs = [F.struct(*[c.alias(n) for n, c in row.items()]) for row in rows]
    return df.select(F.inline(F.array(*structs)))
