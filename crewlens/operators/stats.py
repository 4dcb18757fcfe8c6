"""Profiles and statistics in one aggregate pass each."""

from collections.abc import Mapping, Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crewlens.functions import aggregates as A
from crewlens.functions.parsing import col
from crewlens.functions.scalars import pct, ratio, round_half_even
from crewlens.operators.columns import to_numeric_all
from crewlens.operators.reshape import stack_rows
from crewlens.vocabulary import ROW


def profile_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Number of rows and columns per named table; the row ordinal is no column of the sheet."""
    parts = [
        t.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("name"), "n_rows", F.lit(sum(c != ROW for c in t.columns)).alias("n_cols")
        )
        for name, t in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def unreadable(df: DataFrame, read: Mapping[str, Column]) -> DataFrame:
    """Rows, given values and unreadable values for each column and the expression that reads it."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(col(c)).alias(f"_g{i}") for i, c in enumerate(read)],
        *[F.count_if(col(c).isNotNull() & value.isNull()).alias(f"_u{i}") for i, (c, value) in enumerate(read.items())],
    )
    return stack_rows(counts, [
        {"column": F.lit(c), "n_rows": F.col("_rows"), "n_given": F.col(f"_g{i}"), "n_unreadable": F.col(f"_u{i}")}
        for i, c in enumerate(read)
    ])


def data_quality(df: DataFrame, digits: int = 2) -> DataFrame:
    """Missing values per column as count and percent, worst first."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(col(c).isNull()).alias(f"_m{i}") for i, c in enumerate(df.columns)],
    )
    rows = [
        {
            "column": F.lit(c),
            "Missing_Count": F.col(f"_m{i}"),
            "Missing_Pct": round_half_even(pct(ratio(F.col(f"_m{i}"), F.col("_rows"))), digits),
            "_ord": F.lit(i),
        }
        for i, c in enumerate(df.columns)
    ]
    order = [F.col("Missing_Pct").desc(), F.col("Missing_Count").desc(), F.col("_ord")]
    return stack_rows(counts, rows).orderBy(*order).drop("_ord")


def corr_matrix(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair of columns, over complete pairs."""
    pairs = list(combinations_with_replacement(range(len(names)), 2))
    numbers = to_numeric_all(df, names)
    once = numbers.agg(*[A.correlation(col(names[i]), col(names[j])).alias(f"_r{i}_{j}") for i, j in pairs])
    cells = [
        {"x": F.lit(a), "y": F.lit(b), "r": F.col(f"_r{min(i, j)}_{max(i, j)}")}
        for i, a in enumerate(names)
        for j, b in enumerate(names)
    ]
    return stack_rows(once, cells)


def ols_by(df: DataFrame, group: str, x: str, y: str) -> DataFrame:
    """Least-squares line of y on x per group, in group order."""
    cx, cy = col(x), col(y)
    return df.groupBy(col(group)).agg(
        A.slope(cx, cy).alias("slope"),
        A.intercept(cx, cy).alias("intercept"),
        A.r_squared(cx, cy).alias("r2"),
        A.pair_count(cx, cy).alias("n"),
    ).orderBy(col(group))


def histogram_by(df: DataFrame, x: str, group: str, bins: int) -> DataFrame:
    """Counts per equal-width bin and group, in bin order; the upper end belongs to the last bin.

    The input is counted per group and value first; ends and bins come from those counts.
    """
    known = df.where(col(x).isNotNull()).groupBy(col(group), col(x)).agg(F.count(F.lit(1)).alias("_n"))
    ends = known.agg(F.struct(F.min(col(x)).alias("low"), F.max(col(x)).alias("high")).alias("ends"))
    placed = known.select(col(group), col(x), "_n", ends.scalar().alias("_ends"))
    low, high = F.col("_ends.low"), F.col("_ends.high")
    # One value only: there is no width, and width_bucket is NULL.
    number = F.least(F.coalesce(F.width_bucket(col(x), low, high, F.lit(bins)), F.lit(1)), F.lit(bins))
    width = (high - low) / F.lit(bins)
    counted = placed.groupBy(number.alias("bin"), col(group), low.alias("_low"), width.alias("_width")).agg(
        F.sum("_n").alias("n")
    )
    return counted.select(
        "bin",
        (F.col("_low") + (F.col("bin") - 1) * F.col("_width")).alias("bin_start"),
        (F.col("_low") + F.col("bin") * F.col("_width")).alias("bin_end"),
        col(group),
        "n",
    ).orderBy("bin", col(group))
