"""Identities between published result values. FIXED VALUES, as published."""

import pytest
from pyspark.sql import functions as F

from crewlens.functions import aggregates as A
from crewlens.functions.scalars import pct, ratio, round_half_even
from crewlens.plans import prepare
from crewlens.sources.writers import kpi_lines
from tests.conftest import values

FINANCE = [
    ("2022", 3990.94, 1249964.97234, -392348.18757, -4385.54648, 313.2006425403539, 98.30971840468662, 1.0988755731732374),
    ("2023", 6395.34, 1677331.59581, -514944.933020001, -6282.89308, 262.2740301234962, 80.51877351634174, 0.9824173663949063),
    ("2024", 6616.4, 2083436.67974, -658035.31625, -5924.72777, 314.88977083308146, 99.45518956683394, 0.8954609409951032),
    ("2025", 6453.610000000001, 2100010.63102, -678785.49119, -5118.79311, 325.40091995332847, 105.17919291528305, 0.7931674070791386),
]
REVIEWS = [("France", 1992, 0.8835925740090316), ("Luxembourg", 1771, 0.9063205417607223)]
RATINGS = [(4.322461439588689, 778), (4.485009085402786, 1651), (4.526438848920863, 1390), (4.495023419203747, 427)]
ABSENCES = [70174.5, 16183.0, 7132.5, 2161.0, 1417.5, 843.5, 404.5, 384.0, 44.0]
BANDS = [(3.426330532212885, 1784), (3.1877133105802047, 293), (3.3891213389121337, 239), (3.3887445887445886, 1155)]
TRAINING = [(1519, 41085.92, 27.048005266622777), (1584, 34331.19, 21.673731060606062), (1539, 33760.19, 21.936445743989605)]
HEADCOUNT = 8185


def test_finance_ratios(make):
    positions = make("year string, avg_fte_proxy double", [r[:2] for r in FINANCE])
    amounts = make("year string, nbi double, personnel_cost double, training_cost double", [(r[0], *r[2:5]) for r in FINANCE])
    got = values(prepare.finance_ratios(positions, amounts))
    assert got == [(int(r[0]), *r[1:5], *map(pytest.approx, r[5:])) for r in FINANCE]


def test_weighted_means(make):
    reviews = make("c string, n long, v double", REVIEWS)
    ratings = make("v double, n long", RATINGS)
    bands = make("v double, n long", BANDS)
    mean = A.weighted_mean(F.col("v"), F.col("n"))
    assert reviews.agg(round_half_even(pct(mean), 1)).first()[0] == 89.4
    assert ratings.agg(round_half_even(mean, 2)).first()[0] == 4.47
    assert bands.agg(round_half_even(mean, 2)).first()[0] == 3.39


def test_hours_and_days_per_head(make):
    training = make("n long, h double, per double", TRAINING)
    for got, want in values(training.select(ratio(F.col("h"), F.col("n")), "per")):
        assert got == pytest.approx(want)
    absences = make("d double", [(d,) for d in ABSENCES])
    per_head = ratio(A.sum0(F.col("d")), F.lit(HEADCOUNT))
    assert absences.agg(round_half_even(per_head, 2)).first()[0] == 12.06


def test_headline_lines(make):
    kpis = make("kpi string, value double, definition string", [
        ("Latest monthly headcount", 8185.0, "Unique active employees in latest workforce snapshot"),
        ("Training satisfaction", 4.47, "Average post-training rating across completed quick reviews (1-5)"),
    ])
    assert [r[0] for r in kpi_lines(kpis).collect()] == [
        "- Latest monthly headcount: 8185.0 (Unique active employees in latest workforce snapshot)",
        "- Training satisfaction: 4.47 (Average post-training rating across completed quick reviews (1-5))",
    ]
