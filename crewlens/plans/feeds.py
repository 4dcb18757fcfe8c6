"""Tables behind the charts of the report, in chart order and chart units."""

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crewlens.functions.scalars import pct
from crewlens.plans.kpis import satisfaction

LARGEST_GROUPS = 8


def capacity(monthly: DataFrame) -> DataFrame:
    """Headcount and female share in percent per month."""
    return monthly.select("PERIOD", "headcount", pct(F.col("female_share")).alias("female_share_pct")).orderBy("PERIOD")


def completion(reviews: DataFrame) -> DataFrame:
    """Completion rate in percent per country, lowest first."""
    rate = pct(F.col("completion_rate")).alias("completion_rate_pct")
    return reviews.select("country", rate).orderBy(F.col("completion_rate_pct").asc_nulls_last(), "country")


def effectiveness(quick: DataFrame, cold: DataFrame) -> DataFrame:
    """Rating and positive answers in percent per year."""
    impact = pct(F.col("avg_positive_impact_rate")).alias("positive_impact_pct")
    return satisfaction(quick, cold).select("year", "avg_training_rating", impact).orderBy("year")


def absence_mix(mix: DataFrame, k: int = LARGEST_GROUPS) -> DataFrame:
    """The k absence groups with most days."""
    return mix.orderBy(F.col("absence_days").desc_nulls_last(), "absence_group").limit(k)


def training_vs_performance(summary: DataFrame) -> DataFrame:
    """Score per training band."""
    return summary.select("training_band", "avg_performance_score")


def chart_feeds(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All chart tables from the KPI tables."""
    return {
        "headcount_and_gender": capacity(tables["monthly_headcount"]),
        "review_completion_by_country": completion(tables["review_metrics"]),
        "training_hours": tables["training_kpis"].select("year", "training_hours").orderBy("year"),
        "training_effectiveness": effectiveness(tables["quick_scores"], tables["cold_impact"]),
        "absence_mix": absence_mix(tables["absence_group_mix"]),
        "value_creation_efficiency": tables["finance"]
        .select("year", "nbi_per_fte", "personnel_cost_per_fte")
        .orderBy("year"),
        "training_vs_performance": training_vs_performance(tables["training_perf_summary"]),
    }
