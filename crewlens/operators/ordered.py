"""Forward fill in row order without an ordered pass over the whole table in one task."""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crewlens.functions.parsing import col
from crewlens.operators.lookup import leaf_bytes

BLOCK_ROWS = 1 << 20
# Bytes of the tables read up to which there are few enough blocks for one level of them: a block
# holds a row or more, and a row takes a byte or more.
ONE_LEVEL_UP_TO = 64 << 20


def row_levels(df: DataFrame, order: str, rows: int = BLOCK_ROWS) -> list[Column]:
    """Block of a row, and the wider blocks that one lies in: functions of its ordinal alone,
    ascending with it.

    A whole-number ordinal is cut every ``rows``, every ``rows`` squared and every ``rows``
    cubed; a file ordinal (``part``, ``seq``) every ``rows`` within its part, then by part.
    """
    kind = df.schema[order].dataType
    if isinstance(kind, T.StructType):
        o = col(order)
        block = F.struct(o["part"].alias("part"), (o["seq"] - F.pmod(o["seq"], F.lit(rows))).alias("start"))
        return [block, o["part"], F.lit(0)]
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"{order} is no row ordinal: {kind.simpleString()}")
    c = col(order).cast("long")
    return [c - F.pmod(c, F.lit(rows**n)) for n in (1, 2, 3)]


def _matches(names: Sequence[str], prefix: str) -> Column:
    return reduce(and_, [col(n).eqNullSafe(F.col(f"{prefix}{i}")) for i, n in enumerate(names)])


def forward_fill(
    df: DataFrame,
    value: str,
    order: str,
    target: str,
    partition: Sequence[str] = (),
    rows: int = BLOCK_ROWS,
    one_level_up_to: int = ONE_LEVEL_UP_TO,
) -> DataFrame:
    """Last non-null value at or before each row.

    Rows are cut into blocks by their ordinal, blocks into blocks of blocks, and so on. Each
    yields its last value; from the widest down, a running pass inside the next wider block
    tells what a block starts with; rows are then filled inside their block. However far apart
    the ordinals lie, no task sees more than ``rows`` rows or blocks of one partition at a time.
    Tables of up to ``one_level_up_to`` bytes, as the planner knows them, get no wider blocks.
    The blocks depend on the data only, so a task that is run again after the loss of an
    executor meets the same blocks.
    """
    made = row_levels(df, order, rows)
    if leaf_bytes(df) <= one_level_up_to:
        made = made[:1]
    given, levels = list(partition), [f"_b{n}" for n in range(len(made))]
    blocks = df.withColumns(dict(zip(levels, made, strict=True)))
    present = col(value).isNotNull()
    last = blocks.groupBy(*[col(p) for p in given], *levels).agg(
        F.max_by(col(value), F.when(present, col(order))).alias("_end")
    )
    ends = [last]
    for n in range(len(levels) - 1):
        keys = [*given, *levels[n + 1 :]]
        known = F.when(F.col("_end").isNotNull(), F.col(levels[n]))
        ends.append(ends[-1].groupBy(*[col(k) for k in keys]).agg(F.max_by("_end", known).alias("_end")))
    carried: DataFrame | None = None
    for n in reversed(range(len(levels))):
        keys = [*given, *levels[n + 1 :]]
        ahead = Window.partitionBy(*[col(k) for k in keys]).orderBy(levels[n]).rowsBetween(Window.unboundedPreceding, -1)
        own = ends[n].withColumn("_own", F.last("_end", ignorenulls=True).over(ahead))
        if carried is not None:
            own = own.join(carried, _matches(keys, f"_k{n + 1}_"), "left")
            own = own.withColumn("_own", F.coalesce("_own", "_carry"))
        names = [*given, *levels[n:]]
        carried = own.select(
            *[col(k).alias(f"_k{n}_{i}") for i, k in enumerate(names)], F.col("_own").alias("_carry")
        )
    inside = Window.partitionBy(*[col(p) for p in given], "_b0").orderBy(col(order))
    running = F.last(col(value), ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    filled = blocks.join(carried, _matches([*given, *levels], "_k0_"), "left")
    return filled.withColumn(target, F.coalesce(running, F.col("_carry"))).drop(
        *levels, "_carry", *[f"_k0_{i}" for i in range(len(given) + len(levels))]
    )
