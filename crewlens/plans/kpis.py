"""KPI tables over prepared inputs. Every function is one lazy plan; inputs are passed in, so
the same plan runs on any table with these columns."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crewlens import vocabulary as V
from crewlens.functions import aggregates as A
from crewlens.functions.parsing import eq_flag
from crewlens.functions.scalars import band, pct, ratio, round_half_even
from crewlens.operators.grouping import by_year, group_complete, group_nonnull, totals_with_mode
from crewlens.operators.joins import full_outer
from crewlens.operators.reshape import stack_rows
from crewlens.operators.rows import drop_missing, in_year, latest_snapshot, lookup_or


def _capacity(female: str, approx: bool = False) -> list[Column]:
    # Heads are distinct ids; the share is over rows, and rows of unknown gender count.
    heads = F.approx_count_distinct("employee_id", 0.01) if approx else F.count_distinct("employee_id")
    return [
        heads.alias("headcount"),
        A.share(F.col("gender") == female).alias("female_share"),
    ]


def monthly_headcount(workforce: DataFrame, female: str = V.FEMALE, approx: bool = False) -> DataFrame:
    """Headcount and female share per month.

    ``approx=True`` estimates the heads to about one percent and needs no shuffle of ids.
    """
    return group_nonnull(workforce, "PERIOD").agg(*_capacity(female, approx)).orderBy("PERIOD")


def headcount_by_country(workforce: DataFrame, female: str = V.FEMALE, grain: str | None = None) -> DataFrame:
    """Headcount and female share per country in the latest snapshot, largest first."""
    latest = latest_snapshot(workforce, "PERIOD", grain)
    return (
        group_nonnull(latest, "country").agg(*_capacity(female)).orderBy(F.col("headcount").desc(), "country")
    )


def review_metrics(
    reviews: DataFrame, done: str = V.REVIEW_DONE, high_from: float = V.HIGH_PERFORMER_FROM
) -> DataFrame:
    """Review coverage and scores per country, over all review years given."""
    completed = eq_flag(F.col("review_completion_status"), done)
    score = F.col("performance_score")
    return (
        group_nonnull(reviews, "country")
        .agg(
            F.count_distinct("employee_id").alias("employees_with_reviews"),
            A.share(completed).alias("completion_rate"),
            F.avg(score).alias("avg_performance_score"),
            A.share(score >= high_from).alias("high_performer_share"),
        )
        .orderBy(F.col("employees_with_reviews").desc(), "country")
    )


def training_kpis(training: DataFrame, done: str = V.TRAINING_DONE, key: str = "year") -> DataFrame:
    """Completed training per year."""
    return (
        group_nonnull(training.where(F.col("status") == done), key)
        .agg(
            F.count_distinct("employee_id").alias("trained_employees"),
            F.count("course").alias("completed_courses"),
            A.amount0("hours").alias("training_hours"),
            A.sum_per_distinct("hours", F.col("employee_id")).alias("avg_hours_per_trained_employee"),
            A.share(F.col("certification_flag")).alias("certification_rate"),
        )
        .orderBy(key)
    )


def _by_survey_year(surveys: DataFrame, done: str, **aggregates: Column) -> DataFrame:
    return by_year(surveys.where(F.col("status") == done), F.col("date"), aggregates, keep_null=False)


def quick_scores(quick: DataFrame, done: str = V.SURVEY_DONE) -> DataFrame:
    """Rating of completed quick surveys per year."""
    rating = F.col("general_rating")
    return _by_survey_year(
        quick, done, avg_training_rating=F.avg(rating), rating_responses=F.count(rating)
    )


def cold_impact(cold: DataFrame, done: str = V.SURVEY_DONE) -> DataFrame:
    """Mean share of positive answers per completed cold survey and year."""
    return _by_survey_year(
        cold,
        done,
        avg_positive_impact_rate=F.avg("impact_positive_rate"),
        impact_responses=A.sum0(F.col("impact_answer_count")),
    )


def absence_by_employee(absences: DataFrame) -> DataFrame:
    """Days, events and most frequent absence group per employee."""
    return totals_with_mode(
        absences,
        "employee_id",
        "absence_group",
        sums={"absence_days": "working_days"},
        counts={"absence_events": "absence_date"},
        mode="main_group",
    )


def absence_group_mix(absences: DataFrame) -> DataFrame:
    """Absence days per group, largest first."""
    return (
        group_nonnull(absences, "absence_group")
        .agg(A.amount0("working_days").alias("absence_days"))
        .orderBy(F.col("absence_days").desc(), "absence_group")
    )


def training_perf_summary(
    reviews: DataFrame,
    training: DataFrame,
    done: str = V.TRAINING_DONE,
    edges: Sequence[float] = V.BAND_EDGES_KPI,
    labels: Sequence[str] = V.BAND_LABELS,
) -> DataFrame:
    """Mean score and reviewed employees per band of completed training hours.

    Hours are summed per employee before the join; the reviews side may hold an employee
    more than once.
    """
    hours = (
        group_nonnull(training.where(F.col("status") == done), "employee_id")
        .agg(A.amount0("hours").alias("training_hours"))
    )
    scored = drop_missing(reviews, "performance_score").select("employee_id", "performance_score")
    joined = scored.join(hours, "employee_id", "left").na.fill(0.0, ["training_hours"])
    banded = joined.withColumn("training_band", band(F.col("training_hours"), edges, labels))
    return group_complete(
        banded,
        "training_band",
        labels,
        {
            "avg_performance_score": F.avg("performance_score"),
            "employee_count": F.count_distinct("employee_id"),
        },
        zero=["employee_count"],
    )


def kpi_summary(
    workforce: DataFrame,
    reviews: DataFrame,
    training: DataFrame,
    quick: DataFrame,
    absences: DataFrame,
    finance: DataFrame,
    year: int = V.REPORT_YEAR,
    female: str = V.FEMALE,
    review_done: str = V.REVIEW_DONE,
    training_done: str = V.TRAINING_DONE,
    survey_done: str = V.SURVEY_DONE,
) -> DataFrame:
    """The headline KPIs, one row each.

    Every input is reduced to one row by its own aggregate and enters as a scalar subquery:
    nothing is joined and the subqueries run side by side. Inputs feeding two KPIs are
    aggregated once. Workforce is read for the latest period only.
    """
    completed = eq_flag(F.col("review_completion_status"), review_done)
    inputs = {
        "w": latest_snapshot(workforce, "PERIOD").agg(*_capacity(female)),
        "r": reviews.agg(A.share(completed).alias("completion"), F.avg("performance_score").alias("score")),
        "t": training.where((F.col("status") == training_done) & (F.col("year") == year)).agg(
            A.amount0("hours").alias("hours")
        ),
        "q": quick.where(F.col("status") == survey_done).agg(F.avg("general_rating").alias("rating")),
        "a": absences.where(F.col("employee_id").isNotNull()).agg(A.amount0("working_days").alias("days")),
        "f": finance.where(F.col("year") == year).agg(F.max("nbi_per_fte").alias("nbi")),
    }
    row = workforce.sparkSession.range(1).select(*[_as_struct(t).scalar().alias(n) for n, t in inputs.items()])
    values = {
        "headcount": F.col("w.headcount").cast("double"),
        "female": pct(F.col("w.female_share")),
        "completion": pct(F.col("r.completion")),
        "score": F.col("r.score"),
        "hours": F.col("t.hours"),
        "satisfaction": F.col("q.rating"),
        "absence": ratio(F.col("a.days"), F.col("w.headcount")),
        "nbi": F.col("f.nbi"),
    }
    return stack_rows(row, [
        {
            "kpi": F.lit(label.format(year=year)),
            "value": round_half_even(values[key], digits),
            "definition": F.lit(definition.format(year=year)),
        }
        for key, label, digits, definition in V.KPI_ROWS
    ])


def _as_struct(one_row: DataFrame) -> DataFrame:
    return one_row.select(F.struct(*one_row.columns).alias("row"))


def satisfaction(quick_scores: DataFrame, cold_impact: DataFrame) -> DataFrame:
    """Both survey series side by side, years of either."""
    return full_outer(quick_scores, cold_impact, "year")


def insight_facts(
    monthly: DataFrame,
    reviews: DataFrame,
    training: DataFrame,
    quick: DataFrame,
    cold: DataFrame,
    finance: DataFrame,
    first_year: int = V.FIRST_YEAR,
    year: int = V.REPORT_YEAR,
) -> DataFrame:
    """One row of facts for the report text, as texts where the text is formatted.

    Takes the finished KPI tables. A year without survey data reads 'n/a'.
    """
    period = F.col("PERIOD")
    here = F.col("year") == year
    started = F.when(in_year(period, first_year), period)
    inputs = {
        "w": monthly.agg(
            A.at_first(F.col("headcount"), started).alias("first"),
            A.at_latest(F.col("headcount"), period).alias("latest"),
            A.at_latest(F.col("female_share"), period).alias("female"),
        ),
        "t": training.where(here).agg(
            F.max("training_hours").alias("hours"), F.max("trained_employees").alias("people")
        ),
        "q": quick.agg(_text_or_na("%.2f/5", F.col("avg_training_rating"), here).alias("rating")),
        "c": cold.agg(_text_or_na("%.1f%%", pct(F.col("avg_positive_impact_rate")), here).alias("impact")),
        "r": reviews.agg(
            A.weighted_mean(F.col("completion_rate"), F.col("employees_with_reviews")).alias("completion")
        ),
        "f": finance.where(here).agg(
            F.max("nbi_per_fte").alias("nbi"), F.max("personnel_cost_per_fte").alias("personnel")
        ),
    }
    row = monthly.sparkSession.range(1).select(*[_as_struct(t).scalar().alias(n) for n, t in inputs.items()])
    return row.select(
        F.col("w.first").alias("first_headcount"),
        F.col("w.latest").alias("latest_headcount"),
        F.format_string("%.1f%%", pct(F.col("w.female"))).alias("latest_female_share"),
        F.format_string("%.0f", F.col("t.hours")).alias("training_hours"),
        F.col("t.people").alias("trained_employees"),
        F.col("q.rating").alias("training_rating"),
        F.col("c.impact").alias("positive_impact"),
        F.format_string("%.1f%%", pct(F.col("r.completion"))).alias("weighted_completion"),
        F.format_string("%.0f", F.col("f.nbi")).alias("nbi_per_fte"),
        F.format_string("%.0f", F.col("f.personnel")).alias("personnel_cost_per_fte"),
    )


def _text_or_na(pattern: str, value: Column, condition: Column) -> Column:
    return lookup_or(F.format_string(pattern, value), condition & value.isNotNull(), V.NOT_AVAILABLE)
