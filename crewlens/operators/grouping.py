"""Grouping forms: null keys dropped, fixed label sets, mode and exact median for hot groups."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from crewlens.functions.aggregates import STEPS, sum_of_parts, sum_parts
from crewlens.functions.parsing import col, quoted
from crewlens.operators.lookup import join_group_facts, leaf_bytes
from crewlens.operators.rows import drop_missing

# percentile_approx is off by at most 1 / ACCURACY of the rows; the bracket around the
# middle is taken forty times as wide.
ACCURACY = 10_000
MARGIN = 0.004
# Values inside the bracket that one task sorts; beyond, they are counted in so many cells first.
MOST_SORTED = 1_000_000
# Bytes of the tables read from which on there could be that many. A row takes a byte or more.
NARROW_FROM = 128 << 20
CELLS = 1024
STRIDE = 32


def group_nonnull(df: DataFrame, *keys: str) -> GroupedData:
    """Group, leaving out rows with a missing key."""
    return drop_missing(df, *keys).groupBy(*[col(k) for k in keys])


def by_year(df: DataFrame, date: Column, aggregates: Mapping[str, Column], keep_null: bool = True) -> DataFrame:
    """Aggregates per ``year`` of a date; rows without a readable date form a last group, or go."""
    dated = df.withColumn("year", F.year(date))
    groups = dated.groupBy("year") if keep_null else group_nonnull(dated, "year")
    return groups.agg(*[c.alias(n) for n, c in aggregates.items()]).orderBy(F.col("year").asc_nulls_last())


def label_dimension(df: DataFrame, key: str, labels: Sequence[str]) -> DataFrame:
    """One row per label with its ordinal ``_ord``."""
    names = F.array(*[F.lit(x) for x in labels])
    return df.sparkSession.range(1).select(F.posexplode(names).alias("_ord", key))


def group_complete(
    df: DataFrame,
    key: str,
    labels: Sequence[str],
    aggregates: Mapping[str, Column],
    zero: Sequence[str] = (),
    keep_null: bool = False,
) -> DataFrame:
    """Aggregate by a banded column so that every label has a row, in label order.

    Labels without rows get zero for the columns in ``zero`` and NULL otherwise. A value that is
    none of the labels counts as missing. Rows outside all bands form a last row only if
    ``keep_null`` is set and there are any. The input is read once. The aggregate has one row
    per label at most, which bounds the broadcast.
    """
    named = df.withColumn(key, F.when(col(key).isin(*labels), col(key)))
    groups = named.groupBy(col(key)) if keep_null else group_nonnull(named, key)
    found = groups.agg(*[c.alias(n) for n, c in aggregates.items()])
    labelled = label_dimension(df, key, labels)
    out = labelled.join(found, key, "full_outer") if keep_null else labelled.join(F.broadcast(found), key, "left")
    last = F.coalesce(F.col("_ord"), F.lit(len(labels)))
    return out.na.fill(0, list(zero)).orderBy(last).select(key, *aggregates)


def totals_with_mode(
    df: DataFrame,
    key: str,
    category: str,
    sums: Mapping[str, str],
    counts: Mapping[str, str],
    mode: str,
) -> DataFrame:
    """Sums, non-null counts and the most frequent category per key, ties to the smallest.

    Aggregated by (key, category) first: a hot key is spread over its categories and no task
    holds the value counts of a whole group. The second step sees one row per category.
    """
    by_category = df.where(col(key).isNotNull()).groupBy(col(key), col(category)).agg(
        F.count(col(category)).alias("_n"),
        *[F.expr(f"sum({part})").alias(f"{n}.{i}") for n, c in sums.items() for i, part in enumerate(sum_parts(c))],
        *[F.count(col(c)).alias(n) for n, c in counts.items()],
    )
    rank = F.when(col(category).isNotNull(), F.struct(-F.col("_n"), col(category)))
    return by_category.groupBy(col(key)).agg(
        *[
            F.coalesce(sum_of_parts([f"sum({quoted(f'{n}.{i}')})" for i in range(len(STEPS) + 1)]), F.lit(0.0)).alias(n)
            for n in sums
        ],
        *[F.sum(F.col(n)).alias(n) for n in counts],
        F.min_by(col(category), rank).alias(mode),
    )


def medians(
    df: DataFrame,
    group: str,
    values: Mapping[str, Column],
    spread: Sequence[str] = (),
    approx: bool = False,
    stage: bool = False,
    most_sorted: int | None = None,
) -> DataFrame:
    """Exact medians of several expressions per non-null group.

    Spark's exact median keeps every distinct value of a group in one buffer. Here a sketch of
    fixed size first brackets the middle of each group, then values outside the bracket are
    moved to its ends, which leaves the median unchanged. Equal values are counted together
    before anything is sorted, and the middle is read off a running count over the under one
    percent of the values inside. If more than ``most_sorted`` different ones are there, they are
    first counted in ``CELLS`` cells of about as many values each, and only the cell that holds
    the middle is sorted: a task sees a hundred-thousandth of the group's values. That step is
    planned if the tables read are so large that it could be needed, or if ``most_sorted`` is
    given. The sketch bound makes a bracket that misses the middle impossible; should it happen
    nevertheless, the query fails instead of returning a wrong value.

    ``spread`` names columns that tell the rows of a large group apart. ``approx=True`` stops
    after the sketch. ``stage=True`` writes the brackets to the shared folder first: if they
    are few, they are broadcast and the rows are not shuffled at all.
    """
    known = drop_missing(df, group)
    named = [c.alias(n) for n, c in values.items()]
    rows = known.select(col(group), *named)
    if approx:
        return rows.groupBy(col(group)).agg(
            *[F.percentile_approx(F.col(n), 0.5, ACCURACY).cast("double").alias(n) for n in values]
        )
    cuts = F.array(F.lit(0.5 - MARGIN), F.lit(0.5 + MARGIN))
    brackets = rows.groupBy(col(group)).agg(
        *[F.percentile_approx(F.col(n), cuts, ACCURACY).alias(f"_{n}") for n in values]
    )
    told = [c for c in spread or df.columns if c != group]
    apart = known.select(col(group), *named, F.xxhash64(*[col(c) for c in told]).alias("_apart"))
    joined = join_group_facts(apart, brackets, group, "inner", ["_apart"], stage=stage, held=True)
    cells = F.array(*[_clamped(i, n) for i, n in enumerate(values)])
    counted = (
        joined.select(col(group).alias("_g"), F.inline(cells))
        .groupBy("_g", "_i", "_v", "_side")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    narrow = most_sorted is not None or leaf_bytes(df) > NARROW_FROM
    placed = _narrowed(counted, MOST_SORTED if most_sorted is None else most_sorted) if narrow else _ranked(counted)
    # The middle one or two values; they must not lie outside the bracket.
    middle = F.col("_v").isNotNull() & _holds_middle()
    out = []
    for i, n in enumerate(values):
        own = middle & (F.col("_i") == i)
        ends = F.min(F.when(own, F.col("_v"))) + F.max(F.when(own, F.col("_v")))
        missed = F.max(F.when(own, F.abs("_side"))) > 0
        out.append(F.when(missed, F.raise_error(F.lit("median outside its bracket")).cast("double")).otherwise(ends / 2).alias(n))
    return placed.groupBy(F.col("_g").alias(group)).agg(*out)


def _holds_middle() -> Column:
    """Does a row's stretch of ranks, from ``_below`` on up to ``_upto``, hold a middle one?"""
    below, upto = F.col("_below"), F.col("_upto")
    low, high = F.floor((F.col("_all") + 1) / 2), F.floor(F.col("_all") / 2) + 1
    return ((below < low) & (upto >= low)) | ((below < high) & (upto >= high))


def _cell() -> Column:
    """Number of cuts below a value, found among every ``STRIDE``-th of them and then between two."""
    coarse = f"size(filter(sequence({STRIDE}, {CELLS - STRIDE}, {STRIDE}), k -> _cuts[k - 1] < _v)) * {STRIDE}"
    return F.expr(f"{coarse} + size(filter(slice(_cuts, {coarse} + 1, {STRIDE - 1}), c -> c < _v))")


def _middle_cells(counted: DataFrame, most_sorted: int) -> tuple[DataFrame, DataFrame]:
    """The (group, expression) pairs with too many values to sort, and of their values those in
    the cells that hold a middle rank, with ``_before`` and ``_all``."""
    steps = ", ".join(f"{k / CELLS!r}D" for k in range(1, CELLS))
    wide = counted.groupBy("_g", "_i").agg(
        F.count("_v").alias("_values"), F.expr(f"percentile_approx(_v, array({steps}), {ACCURACY})").alias("_cuts")
    ).where(F.col("_values") > most_sorted)
    celled = counted.where("_v IS NOT NULL").join(wide.select("_g", "_i", "_cuts"), ["_g", "_i"])
    celled = celled.select("_g", "_i", "_v", "_side", "_n", _cell().alias("_cell"))
    sums = celled.groupBy("_g", "_i", "_cell").agg(F.sum("_n").alias("_n"))
    by = Window.partitionBy("_g", "_i")
    upto = F.sum("_n").over(by.orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0))
    cells = sums.select(
        "_g", "_i", "_cell", (upto - F.col("_n")).alias("_below"), upto.alias("_upto"), F.sum("_n").over(by).alias("_all")
    )
    middle = cells.where(_holds_middle()).select("_g", "_i", "_cell", F.col("_below").alias("_before"), "_all")
    return wide, celled.join(middle, ["_g", "_i", "_cell"])


def _ranked(counted: DataFrame) -> DataFrame:
    """Values with the ranks they take (``_below``, ``_upto``) among all (``_all``) of their group."""
    by = Window.partitionBy("_g", "_i")
    n = F.when(F.col("_v").isNotNull(), F.col("_n")).otherwise(F.lit(0))
    upto = F.sum(n).over(by.orderBy("_v", "_side").rowsBetween(Window.unboundedPreceding, 0))
    return counted.select("_g", "_i", "_v", "_side", (upto - n).alias("_below"), upto.alias("_upto"), F.sum(n).over(by).alias("_all"))


def _narrowed(counted: DataFrame, most_sorted: int) -> DataFrame:
    """``_ranked``, of groups with too many values those near the middle only.

    The runtime drops the second branch as soon as it finds that no group has too many.
    """
    wide, kept = _middle_cells(counted, most_sorted)
    few = counted.join(wide.select("_g", "_i"), ["_g", "_i"], "left_anti")
    inside = Window.partitionBy("_g", "_i", "_cell").orderBy("_v", "_side").rowsBetween(Window.unboundedPreceding, 0)
    end = F.col("_before") + F.sum("_n").over(inside)
    near = kept.select("_g", "_i", "_v", "_side", (end - F.col("_n")).alias("_below"), end.alias("_upto"), "_all")
    return _ranked(few).unionByName(near)


def _clamped(i: int, name: str) -> Column:
    """A value moved into its bracket, and on which side of it it was; a null value gives nulls."""
    value, low, high = F.col(name).cast("double"), F.col(f"_{name}")[0].cast("double"), F.col(f"_{name}")[1].cast("double")
    side = F.when(value < low, F.lit(-1)).when(value > high, F.lit(1)).otherwise(F.lit(0))
    moved = F.when(value.isNotNull(), F.least(F.greatest(value, low), high))
    return F.struct(F.lit(i).alias("_i"), moved.alias("_v"), side.alias("_side"))
