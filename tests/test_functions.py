import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from crewlens import vocabulary as V
from crewlens.functions import aggregates as A
from crewlens.functions import parsing as P
from crewlens.functions import scalars as S
from tests.conftest import values


def one(make, schema, cells, column):
    """Apply a column to single-column rows and return the list of results."""
    df = make(f"i int, {schema}", list(enumerate(cells)) if not isinstance(cells[0], tuple) else [(i, *c) for i, c in enumerate(cells)])
    return [r[0] for r in df.orderBy("i").select(column).collect()]


@pytest.mark.parametrize("text,number", [
    ("4", 4.0), (" 3 ", 3.0), ("\u00a03\t", 3.0), ("-.5", -0.5), ("1.", 1.0), ("+2e3", 2000.0), ("1E-2", 0.01),
    ("N/A", None), ("4,5", None), ("1.0f", None), ("1d", None), ("NaN", None), ("", None), (None, None), ("1 2", None),
])
def test_parse_num(make, text, number):
    assert one(make, "t string", [text], P.parse_num(F.col("t"))) == [number]


def test_parse_ts(make):
    cells = ["2024-02-29", "2024-02-29 08:30:00", "2024-02-30", "soon", None, " 2024-01-01 "]
    assert one(make, "t string", cells, P.parse_ts(F.col("t"))) == [
        datetime(2024, 2, 29), datetime(2024, 2, 29, 8, 30), None, None, None, datetime(2024, 1, 1),
    ]


def test_parse_dayfirst_does_not_depend_on_the_first_value(make):
    cells = ["31/12/2024", "1/2/2024", "12/31/2024", "05/06/2024 14:05", "2024-12-31", "bad", None]
    assert one(make, "t string", cells, P.parse_dayfirst(F.col("t"))) == [
        date(2024, 12, 31), date(2024, 2, 1), None, date(2024, 6, 5), date(2024, 12, 31), None, None,
    ]


def test_std_key(make):
    cells = [" 17 ", "17.0", "\u00a017", "A1.0x", "  ", None]
    assert one(make, "t string", cells, P.std_key(F.col("t"))) == ["17", "17", "17", "A1.0x", None, None]


def test_key_of_doubles_has_no_exponent(make):
    df = make("k double", [(12345678.0,), (1.5,), (None,), (math.nan,)])
    assert [r[0] for r in df.select(P.key_of(df, "k")).collect()] == ["12345678", "1.5", None, None]


def test_typed_columns_are_not_parsed_again(make):
    df = make("d double, i int, t timestamp_ntz", [(math.nan, 3, datetime(2024, 5, 6, 7)), (2.5, None, None)])
    out = df.select(P.num_of(df, "d"), P.num_of(df, "i"), P.ts_of(df, "t"), P.dayfirst_of(df, "t"))
    assert values(out) == [(None, 3.0, datetime(2024, 5, 6, 7), date(2024, 5, 6)), (2.5, None, None, None)]


def test_text_flags_count_null_as_false(make):
    cells = [" RÉALISÉ ", "réalisé", "realise", None]
    assert one(make, "t string", cells, P.norm_eq(F.col("t"), "Réalisé")) == [True, True, False, False]
    assert one(make, "t string", ["Yes ", "yes", None], P.norm_eq(F.col("t"), "yes", trim=False)) == [False, True, False]
    assert one(make, "t string", ["Document TERMINÉ", "En cours", None], P.icontains(F.col("t"), "termin")) == [True, False, False]
    assert one(make, "t string", [" Oui, tout à fait", "non, oui", None], P.istartswith(F.col("t"), "oui")) == [True, False, False]
    assert one(make, "t string", ["F", "M", None], P.eq_flag(F.col("t"), "F")) == [True, False, False]


def test_clip_keeps_null(make):
    assert one(make, "x double", [-1.0, 2.0, 9.0, None], S.clip(F.col("x"), 0, 3)) == [0.0, 2.0, 3.0, None]
    assert one(make, "x double", [-1.0, 9.0, None], S.clip(F.col("x"), low=0.0)) == [0.0, 9.0, None]


def test_bands_are_closed_on_the_right(make):
    cells = [-0.2, -0.1, -0.05, 0.0, 0.1, 0.2, 7.0, 7.5, 20.0, 20.5, math.inf, None]
    assert one(make, "x double", cells, S.band(F.col("x"), V.BAND_EDGES_KPI, V.BAND_LABELS)) == [
        None, None, "0h", "0h", "0h", "0.1-7h", "0.1-7h", "7-20h", "7-20h", "20h+", "20h+", None,
    ]
    segment = S.band(F.col("x"), V.BAND_EDGES_SEGMENT, V.BAND_LABELS)
    assert one(make, "x double", [-0.01, 0.0, 0.05, 7.0], segment) == [None, "0h", "0.1-7h", "0.1-7h"]
    with pytest.raises(ValueError):
        S.band(F.col("x"), (0.0, 1.0), ("a", "b"))


def test_ratio_and_zero(make):
    assert one(make, "a double, b double", [(6.0, 3.0), (1.0, 0.0), (None, 1.0)], S.ratio(F.col("a"), F.col("b"))) == [2.0, None, None]
    assert one(make, "n int", [0, 4, None], S.nullif0(F.col("n"))) == [None, 4, None]


def test_rounding_takes_ties_to_even(make):
    assert one(make, "x double", [0.125, 0.135, 2.675, -0.125], S.round_half_even(F.col("x"), 2)) == [0.12, 0.14, 2.68, -0.12]


def test_rounding_ignores_the_order_of_addition(make):
    cells = [3243.185, 3243.1850000000004, 3243.1849999999995]
    assert set(one(make, "x double", cells, S.round_half_even(F.col("x"), 2))) == {round(3243.185 * 100) / 100}


def test_days_are_floored(make):
    # 08:00 to midnight ten days later is nine whole days; two days and eight hours ahead is minus three
    later, earlier = F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz")
    cells = [
        ("2025-12-31 00:00:00", "2025-12-21 08:00:00"),
        ("2025-12-31 00:00:00", "2026-01-02 08:00:00"),
        ("2025-12-31 00:00:00", "2025-12-30 00:00:00"),
        ("2025-12-31 00:00:00", None),
    ]
    assert one(make, "a string, b string", cells, S.days_between(later, earlier)) == [9, -3, 1, None]
    tenure = S.tenure_years(earlier, "2025-12-31", 365.25)
    assert one(make, "a string, b string", cells[2:3], tenure) == [1 / 365.25]


def test_days_do_not_depend_on_the_session_zone(spark, make):
    df = make("b string", [("2024-03-30 12:00:00",)])
    days = S.days_between(F.lit("2024-04-01 11:59:00").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz"))
    seen = set()
    for zone in ("UTC", "Europe/Paris", "America/Sao_Paulo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        seen.add(df.select(days).first()[0])
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert seen == {1}


def test_two_way_takes_the_second_label_when_unknown(make):
    flag = S.two_way((F.col("a") > 10) & (F.col("b") > 15), "High Risk", "Normal")
    assert one(make, "a double, b double", [(11.0, 16.0), (None, 16.0), (11.0, None), (10.0, 16.0)], flag) == [
        "High Risk", "Normal", "Normal", "Normal",
    ]


def test_count_across(make):
    df = make("a string, b string, c string", [("Oui", " oui, oui", "Non"), (None, None, None)])
    cs = [F.col(c) for c in "abc"]
    out = df.select(
        S.count_across(cs, lambda c: P.istartswith(c, "oui")),
        S.count_across(cs, lambda c: c.isNotNull()),
        S.count_across([], lambda c: c.isNotNull()),
    )
    assert values(out) == [(2, 3, 0), (0, 0, 0)]


def test_plain_number(make):
    cells = [8185.0, 89.4, 3.39, 12345678.0, 0.0, 100.0, None]
    assert one(make, "x double", cells, S.plain_number(F.col("x"))) == [
        "8185.0", "89.4", "3.39", "12345678.0", "0.0", "100.0", None,
    ]


def test_share_counts_unknown_rows(make):
    df = make("g string", [("Female",), ("Male",), (None,)])
    assert df.agg(A.share(F.col("g") == "Female")).first()[0] == pytest.approx(1 / 3)


def test_sum_of_nothing_is_zero(make):
    df = make("k string, x double", [("a", None), ("b", 1.5), ("b", None)])
    assert values(df.groupBy("k").agg(A.sum0(F.col("x"))), "k") == [("a", 0.0), ("b", 1.5)]


def test_first_by_skips_null_values_and_sorts_null_scores_last(make):
    rows = [
        ("a", None, None, 1), ("a", "late", None, 2), ("a", None, 5.0, 3), ("a", "best", 4.0, 4), ("a", "tie", 4.0, 5),
        ("b", None, 1.0, 6), ("c", "only", None, 7), ("c", "later", None, 8),
    ]
    df = make("k string, v string, s double, r long", rows)
    order = [*A.descending(F.col("s"), "s"), F.col("r")]
    assert values(df.groupBy("k").agg(A.first_by(F.col("v"), *order)), "k") == [("a", "best"), ("b", None), ("c", "only")]


def test_statistics_on_constant_and_missing_input(make):
    df = make("g string, x double, y double", [
        ("flat", 1.0, 1.0), ("flat", 1.0, 2.0), ("one", 1.0, 2.0), ("none", None, 1.0),
        ("line", 1.0, 3.0), ("line", 2.0, 5.0), ("line", 4.0, 9.0), ("line", None, 7.0), ("line", 3.0, None),
    ])
    x, y = F.col("x"), F.col("y")
    out = df.groupBy("g").agg(
        A.correlation(x, y), A.slope(x, y), A.intercept(x, y), A.r_squared(x, y), A.pair_count(x, y)
    )
    got = {r[0]: tuple(r)[1:] for r in out.collect()}
    assert got["flat"] == (None, None, None, None, 2)
    assert got["one"] == (None, None, None, None, 1)
    assert got["none"] == (None, None, None, None, 0)
    assert got["line"] == pytest.approx((1.0, 2.0, 1.0, 1.0, 3))


def test_weighted_mean_latest_and_first(make):
    df = make("p string, v double, n long", [("2024", 0.5, 1), ("2025", 0.8, 3), ("2023", 0.1, 0)])
    v, n, p = F.col("v"), F.col("n"), F.col("p")
    assert values(df.agg(A.weighted_mean(v, n), A.at_latest(v, p), A.at_first(v, p))) == [(pytest.approx(0.725), 0.8, 0.1)]
    assert df.where("n = 0").agg(A.weighted_mean(v, n)).first()[0] is None
    assert df.agg(A.sum_per_distinct("v", F.lit(None).cast("string"))).first()[0] == pytest.approx(1.4)
