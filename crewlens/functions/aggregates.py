"""Aggregate expressions. All of them combine on the map side before the shuffle."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from crewlens.functions.parsing import quoted
from crewlens.functions.scalars import ratio


def share(condition: Column) -> Column:
    """Share of rows that meet the condition; rows where it is unknown count as misses."""
    return F.avg(F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0)))


def sum0(c: Column) -> Column:
    """Sum, zero for a group without any value."""
    return F.coalesce(F.sum(c), F.lit(0))


# A sum is kept as whole numbers of the STEPS, each at most 2**(DIGIT_BITS - 1) per value, so that
# 10**11 values fit a 64-bit sum. Values from BEYOND on are added as they are.
DIGIT_BITS = 26
STEPS = tuple(2.0**n for n in (-46, -20, 6, 32))
BEYOND = STEPS[-1] * 2.0**DIGIT_BITS


def sum_parts(name: str) -> list[str]:
    """The parts of an exact sum of a column, as SQL: one whole number per step, and what none of
    the steps holds.

    Sums of whole numbers do not depend on the order of addition, and all of them are plain
    64-bit numbers. The last part is a sum of doubles: of what is finer than the finest step, of
    values too large for the widest, of infinities and NaN. (SQL, since to build the expressions
    one by one from Python takes longer than to run them on a small table.)
    """
    x = f"cast({quoted(name)} as double)"
    # Not a plain condition: that would be moved into every part, and evaluated for each anew.
    held = f"({x} * if(abs({x}) < {BEYOND!r}D, 1.0D, null))"
    whole = [f"rint({held} * {1 / step!r}D)" for step in STEPS]
    digits = [f"cast({w} - {up} * {2.0**DIGIT_BITS!r}D as bigint)" for w, up in zip(whole, whole[1:])]
    return [*digits, f"cast({whole[-1]} as bigint)", f"coalesce({held} - {whole[0]} * {STEPS[0]!r}D, {x})"]


def sum_of_parts(parts: Sequence[str]) -> Column:
    """The sum as a double, from the sums of its parts, in SQL; NULL if there was no value.

    Carries go up first, which leaves at most half a digit of either sign in each part but the
    top one; the parts are then added from the smallest on.
    """
    *whole, out = parts
    carry = "0L"
    for total, step in zip(whole, STEPS, strict=True):
        total = f"(coalesce({total}, 0L) + {carry})"
        if step == STEPS[-1]:
            digit = total
        else:
            carry = f"shiftright({total} + {1 << DIGIT_BITS - 1}L, {DIGIT_BITS})"
            digit = f"({total} - shiftleft({carry}, {DIGIT_BITS}))"
        out = f"({out} + {digit} * {step!r}D)"
    return F.expr(out)


def exact_sum(name: str) -> Column:
    """Sum that does not depend on the order of addition, to the last place or the one before.

    It holds for values between about 1e-6 and 2e17 in size, and finer ones to 2**-46; what lies
    beyond adds up as doubles do. Infinities and NaN are kept.
    """
    return sum_of_parts([f"sum({part})" for part in sum_parts(name)])


def amount0(name: str) -> Column:
    """``exact_sum``, zero for a group without any value."""
    return F.coalesce(exact_sum(name), F.lit(0.0))


def first_by(value: Column, *order: Column) -> Column:
    """First non-null value in ascending order of the ordering columns."""
    return F.min_by(value, F.when(value.isNotNull(), F.struct(*order)))


def descending(c: Column, tag: str) -> list[Column]:
    """Sort keys that put a number in descending order with NULL last, for use in a struct."""
    return [c.isNull().alias(f"{tag}_missing"), (-c).alias(f"{tag}_reversed")]


def sum_per_distinct(value: str, identity: Column) -> Column:
    """Sum of a column divided by the number of distinct identities, at least one."""
    return ratio(exact_sum(value), F.greatest(F.count_distinct(identity), F.lit(1)))


def weighted_mean(value: Column, weight: Column) -> Column:
    """Sum of value times weight over the sum of weights."""
    return ratio(F.sum(value * weight), F.sum(weight))


def at_latest(value: Column, period: Column) -> Column:
    """Value of the row with the latest period."""
    return F.max_by(value, period)


def at_first(value: Column, period: Column) -> Column:
    """Value of the row with the first period."""
    return F.min_by(value, period)


def paired(x: Column, y: Column) -> tuple[Column, Column]:
    """Both columns, each nulled where the other one is missing."""
    both = x.isNotNull() & y.isNotNull()
    return F.when(both, x), F.when(both, y)


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation over complete pairs; NULL where a side is constant."""
    px, py = paired(x, y)
    return ratio(F.covar_pop(px, py), F.stddev_pop(px) * F.stddev_pop(py))


def slope(x: Column, y: Column) -> Column:
    """Least-squares slope of y on x over complete pairs; NULL where x is constant."""
    px, py = paired(x, y)
    return ratio(F.covar_pop(px, py), F.var_pop(px))


def intercept(x: Column, y: Column) -> Column:
    """Least-squares intercept of y on x."""
    px, py = paired(x, y)
    return F.avg(py) - slope(x, y) * F.avg(px)


def r_squared(x: Column, y: Column) -> Column:
    """Share of the variance of y explained by the line; NULL where a side is constant."""
    px, py = paired(x, y)
    cov = F.covar_pop(px, py)
    return ratio(cov * cov, F.var_pop(px) * F.var_pop(py))


def pair_count(x: Column, y: Column) -> Column:
    """Number of complete pairs."""
    return F.count(paired(x, y)[0])
