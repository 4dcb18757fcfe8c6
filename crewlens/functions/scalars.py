"""Row-level rules: clipping, banding, tenure, ratios, rounding and number formats."""

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip(c: Column, low: float | None = None, high: float | None = None) -> Column:
    """Limit to [low, high]. NULL stays NULL: ``greatest`` and ``least`` alone would skip it."""
    bounded = c
    if low is not None:
        bounded = F.greatest(bounded, F.lit(low))
    if high is not None:
        bounded = F.least(bounded, F.lit(high))
    return F.when(c.isNotNull(), bounded)


def band(c: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the right-closed interval ``(edges[i], edges[i + 1]]``; NULL outside all of them."""
    if len(edges) != len(labels) + 1:
        raise ValueError("need one more edge than labels")
    steps = [(c <= F.lit(float(upper)), label) for upper, label in zip(edges[1:], labels)]
    first = F.when(c <= F.lit(float(edges[0])), F.lit(None).cast("string"))
    return reduce(lambda chain, step: chain.when(step[0], F.lit(step[1])), steps, first)


def ratio(a: Column, b: Column) -> Column:
    """a / b, NULL where b is zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def nullif0(c: Column) -> Column:
    """Zero becomes NULL."""
    return F.nullif(c, F.lit(0))


def pct(c: Column) -> Column:
    """A share as percent."""
    return c * F.lit(100.0)


def round_half_even(c: Column, digits: int) -> Column:
    """Round to ``digits`` places: scaled, ties to the even whole number, scaled back.

    Eight places further the value is rounded first, so that the last bits of a mean or ratio do
    not decide on which side of a tie it falls; sums of amounts are exact (``exact_sum``).
    """
    scale = F.lit(float(10**digits))
    return F.rint(F.round(c.cast("double"), digits + 8) * scale) / scale


def days_between(later: Column, earlier: Column) -> Column:
    """Whole days elapsed, rounded down also below zero.

    Calendar days, less one where the time of day has not been reached again. Zone-free
    timestamps, so no session time zone can move the result.
    """
    def time_of_day(c: Column) -> Column:
        return c - c.cast("date").cast("timestamp_ntz")

    a, b = later.cast("timestamp_ntz"), earlier.cast("timestamp_ntz")
    short = F.when(time_of_day(b) > time_of_day(a), F.lit(1)).otherwise(F.lit(0))
    return F.datediff(a.cast("date"), b.cast("date")) - short


def tenure_years(entry: Column, reference: str, days_per_year: float) -> Column:
    """Years from the entry date to a fixed reference date."""
    return days_between(F.lit(reference).cast("timestamp_ntz"), entry) / F.lit(days_per_year)


def two_way(condition: Column, yes: str, no: str) -> Column:
    """``yes`` where the condition holds, ``no`` where it does not or is unknown."""
    return F.when(condition, F.lit(yes)).otherwise(F.lit(no))


def count_across(columns: Sequence[Column], predicate: Callable[[Column], Column]) -> Column:
    """How many of the columns of a row meet the predicate."""
    hits = [F.when(predicate(c), F.lit(1)).otherwise(F.lit(0)) for c in columns]
    return reduce(lambda a, b: a + b, hits, F.lit(0))


def plain_number(c: Column, digits: int = 2) -> Column:
    """A rounded value as text with at least one decimal ('8185.0', '89.4', '3.39'), no exponent."""
    fixed = c.cast(f"decimal(38,{digits})").cast("string")
    return F.regexp_replace(fixed, r"(\.\d+?)0+$", "$1")
