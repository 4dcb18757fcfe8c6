"""Joining a table of group facts back to the rows of its groups."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crewlens.functions.parsing import col, quoted
from crewlens.session import materialise

SALTS = 16
# Rows of one group that a task should get, groups that may have more, and what the sketch tracks.
ROWS_PER_TASK = 4_000_000
HOT_KEYS = 1000
TRACKED = 20_000
# Rows from which on a group's facts are held by every task instead, if asked for.
HELD_FROM = 250_000
# Salts of rows without a group, which match no facts.
LOOSE_SALTS = 1024
# Bytes of the tables read from which on the groups are measured.
MEASURE_FROM = 128 << 20


def leaf_bytes(df: DataFrame) -> int:
    """Bytes of all tables that a plan reads, as the planner knows them; nothing is run."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))


def salt_of(df: DataFrame, spread: Sequence[str] = (), salts: int = SALTS) -> Column:
    """Salt of a row from the columns in ``spread`` (all columns if none are named).

    They should tell most rows apart. A hash and not a random number: a task that is run
    again after the loss of an executor must send each row to the same place.
    """
    return F.pmod(F.xxhash64(*[col(c) for c in spread or df.columns]), F.lit(salts)).cast("int")


def measured_fan_out(rows: DataFrame, group: str, rows_per_task: int = ROWS_PER_TASK, keys: int = HOT_KEYS) -> DataFrame:
    """The groups with more rows than a task should get, and over how many tasks to spread each.

    A sketch of heavy hitters finds them in one aggregation; there are ``keys`` of them at most,
    and any group with a few ten-thousandths of all rows is among the candidates.
    """
    top = rows.where(col(group).isNotNull()).agg(F.expr(f"approx_top_k({quoted(group)}, {keys}, {TRACKED})").alias("t"))
    found = top.select(F.inline("t").alias(group, "_count")).where(F.col("_count") > rows_per_task)
    return found.select(col(group), F.ceil(F.col("_count") / rows_per_task).cast("int").alias("_fan"))


def _spread_by_heat(rows: DataFrame, facts: DataFrame, group: str, spread: Sequence[str], rows_per_task: int) -> tuple[DataFrame, DataFrame]:
    """Rows with a salt below the fan-out of their group, and facts copied as often."""
    hot = measured_fan_out(rows, group, rows_per_task).withColumnRenamed(group, "_hot")
    # HOT_KEYS rows at most.
    known = [d.join(F.broadcast(hot), col(group) == F.col("_hot"), "left").drop("_hot") for d in (rows, facts)]
    fan = F.coalesce("_fan", F.when(col(group).isNull(), F.lit(LOOSE_SALTS)).otherwise(F.lit(1)))
    salt = F.pmod(F.xxhash64(*[col(c) for c in spread or rows.columns]), fan).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_fan", F.lit(1)) - 1))
    return known[0].withColumn("_salt", salt).drop("_fan"), known[1].withColumn("_salt", copies).drop("_fan")


def _held_by_heat(rows: DataFrame, facts: DataFrame, group: str, how: str, spread: Sequence[str], rows_per_task: int) -> DataFrame:
    """Rows of hot groups joined to their broadcast facts where they are, all others by a shuffle."""
    hot = measured_fan_out(rows, group, rows_per_task).select(col(group).alias("_hot"))
    # HOT_KEYS rows at most, and as many facts.
    marked = [d.join(F.broadcast(hot), col(group) == F.col("_hot"), "left") for d in (rows, facts)]
    near = [d.where("_hot IS NOT NULL").drop("_hot") for d in marked]
    cold = [d.where("_hot IS NULL").drop("_hot") for d in marked]
    loose = F.pmod(F.xxhash64(*[col(c) for c in spread or rows.columns]), F.lit(LOOSE_SALTS)).cast("int")
    salted = cold[0].withColumn("_salt", F.when(col(group).isNull(), loose).otherwise(F.lit(0)))
    shuffled = salted.join(cold[1].withColumn("_salt", F.lit(0)), [group, "_salt"], how).drop("_salt")
    return near[0].join(F.broadcast(near[1]), group, how).unionByName(shuffled)


def join_group_facts(
    rows: DataFrame,
    facts: DataFrame,
    group: str,
    how: str = "left",
    spread: Sequence[str] = (),
    salts: int | None = None,
    stage: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
    held: bool = False,
) -> DataFrame:
    """Join facts with one row per group to rows of any group size.

    The shuffle key is (group, salt): a large group, or the rows without a group, go to many
    tasks. An aggregation by group on top then combines per task before its own shuffle, and the
    runtime may split a hot partition further, which it does not do where the aggregation relies
    on the join's partitioning.

    Large inputs are measured first: a group gets a salt for every ``rows_per_task`` of its rows,
    and cold groups get none, so that facts are copied only where that helps. Inputs that are too
    small for a second look, as the planner knows their tables, get ``SALTS`` for every group;
    ``salts`` states a number for all groups.

    ``held=True`` does without salts for large inputs: the facts of the groups with more than
    ``HELD_FROM`` rows, ``HOT_KEYS`` at most, are broadcast, and only rows of the others are
    shuffled. No task then sorts more of a group than that, however many rows it has. It is for
    narrow facts and costs a second look at the rows.

    ``stage=True`` writes the facts to the shared folder first. With their size in bytes known,
    the planner may broadcast them by its own threshold; then the rows are not shuffled at all.
    """
    if stage:
        facts = materialise(facts, "facts")
    if salts is None and leaf_bytes(rows) > MEASURE_FROM:
        if held:
            return _held_by_heat(rows, facts, group, how, spread, min(rows_per_task, HELD_FROM))
        salted, copies = _spread_by_heat(rows, facts, group, spread, rows_per_task)
    else:
        salts = salts or SALTS
        copies = facts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        salted = rows.withColumn("_salt", salt_of(rows, spread, salts))
    return salted.join(copies, [group, "_salt"], how).drop("_salt")
