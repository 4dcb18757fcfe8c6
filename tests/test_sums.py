"""Sums that neither lose values nor depend on the order of addition."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from crewlens.functions import aggregates as A
from crewlens.operators.grouping import totals_with_mode


def total(make, values, parts=1):
    df = make("v double", [(v,) for v in values]).repartition(parts)
    return df.agg(A.exact_sum("v").alias("t")).first().t


def test_values_that_a_decimal_would_lose(make):
    assert total(make, [math.inf, 1.0]) == math.inf
    assert total(make, [-math.inf, 1.0]) == -math.inf
    assert math.isnan(total(make, [math.inf, -math.inf]))
    assert math.isnan(total(make, [math.nan, 1.0]))
    assert total(make, [1e-9] * 5) == 5e-9
    assert total(make, [1e21, 1.0]) == 1e21
    assert total(make, [1e300, 1.0, -1e300]) == 1.0
    assert total(make, [2.0**80] * 3) == 3 * 2.0**80
    assert total(make, [5e-324, 5e-324]) == 1e-323


def test_nulls_and_nothing(make):
    assert total(make, [None, None]) is None and total(make, []) is None
    assert total(make, [None, 2.5, None]) == 2.5
    df = make("v double", [(None,)])
    assert df.agg(A.amount0("v").alias("t")).first().t == 0.0


@pytest.mark.parametrize("scale", [1e-6, 1.0, 1e6, 1e12])
def test_as_near_as_a_double_and_the_same_in_any_order(make, scale):
    rng = random.Random(2)
    values = [rng.choice((-1, 1, 1)) * rng.random() * scale * 10 ** rng.randrange(-3, 4) for _ in range(3000)]
    exact = float(sum(map(Fraction, values)))
    got = {total(make, sorted(values, key=lambda _: rng.random()), 1 + k) for k in range(5)}
    assert len(got) == 1
    assert abs(got.pop() - exact) <= 2 * math.ulp(exact)


def test_what_cancels_leaves_the_small_rest(make):
    assert total(make, [1e15, 0.25, -1e15, -0.5]) == -0.25
    assert total(make, [0.1] * 10) == 1.0 and total(make, [-0.1] * 10) == -1.0
    assert total(make, [4e9, -4e9, -1e-3]) == -1e-3


def test_many_large_values_do_not_overflow(spark):
    df = spark.range(1_000_000).select((F.lit(3e21) + F.col("id") * 0).alias("v"))
    assert df.agg(A.exact_sum("v").alias("t")).first().t == pytest.approx(3e27, rel=1e-10)
    df = spark.range(1_000_000).select((F.lit(1e17) + F.col("id") * 0).alias("v"))
    assert df.agg(A.exact_sum("v").alias("t")).first().t == 1e23


def test_totals_by_key_carry_the_parts_on(make):
    rows = [("a", "x", 0.1)] * 10 + [("a", "y", math.inf)] + [("b", "x", 1e21), ("b", None, 1.0), ("b", "x", -1e21), ("c", "z", None)]
    got = totals_with_mode(make("k string, g string, v double", rows), "k", "g", {"t": "v"}, {"n": "v"}, "m")
    assert {r.k: (r.t, r.n, r.m) for r in got.collect()} == {"a": (math.inf, 11, "x"), "b": (1.0, 3, "x"), "c": (0.0, 0, "z")}


def test_plan_sums_plain_numbers(spark):
    plan = spark.range(5).agg(A.exact_sum("id"))._jdf.queryExecution().optimizedPlan().toString()
    assert "decimal" not in plan.lower()
