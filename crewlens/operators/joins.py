"""Equi-joins of pre-aggregated facts. Sides are left to the optimizer's own size check."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame

from crewlens.functions.parsing import col
from crewlens.operators.grouping import medians
from crewlens.operators.lookup import join_group_facts


def enrich(master: DataFrame, facts: Sequence[DataFrame], key: str) -> DataFrame:
    """Left-join facts with one row per key onto the master.

    All sides are already hashed on the key by the step that made them one row per key, so
    the joins need no further shuffle, and a key never meets more than one row per side. A
    column that both sides have gets ``_x`` on the left and ``_y`` on the right.
    """
    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        same = (set(left.columns) & set(right.columns)) - {key}
        for c in same:
            left, right = left.withColumnRenamed(c, f"{c}_x"), right.withColumnRenamed(c, f"{c}_y")
        return left.join(right, key, "left")

    return reduce(joined, facts, master)


def join_on(tables: Sequence[DataFrame], key: str) -> DataFrame:
    """Inner-join several tables on one key."""
    return reduce(lambda left, right: left.join(right, key), tables)


def full_outer(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full outer join with one merged key column, in key order."""
    return left.join(right, key, "full_outer").orderBy(col(key).asc_nulls_last())


def fill_zero(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Replace NULL by zero in those of the columns that exist."""
    return df.na.fill(0, subset=[n for n in names if n in df.columns])


def with_group_medians(
    df: DataFrame,
    group: str,
    values: Mapping[str, Column],
    spread: Sequence[str] = (),
    approx: bool = False,
    stage: bool = False,
) -> DataFrame:
    """Attach per-group medians to every row; rows without a group get NULL.

    Aggregate and join back, not a window, so that no group has to fit into one task. See
    ``medians`` for the options.
    """
    table = medians(df, group, values, spread, approx, stage)
    return join_group_facts(df, table, group, "left", spread, stage=stage, held=True)
