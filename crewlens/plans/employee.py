"""The employee table (one row per employee) and the analytics built on it."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crewlens import vocabulary as V
from crewlens.functions import aggregates as A
from crewlens.functions.parsing import DATE_FORMATS, col, date_of, icontains, norm_eq, num_of, ts_of
from crewlens.functions.scalars import band, clip, pct, ratio, round_half_even, tenure_years, two_way
from crewlens.operators import stats
from crewlens.operators.columns import column_or, first_existing, select_existing, standardize_id
from crewlens.operators.grouping import group_complete, group_nonnull
from crewlens.operators.joins import enrich, fill_zero, with_group_medians
from crewlens.operators.rows import best_per_key, latest_per_key, top_k
from crewlens.sources.readers import ROW

KEY = "Employee_ID"
FILLED = (
    "Total_Absence_Days",
    "Absence_Count",
    "Total_Training_Hours",
    "Training_Sessions_Count",
    "Completed_Training_Sessions",
    "Review_Completed_Flag",
)
NUMERIC = ("Tenure_Years", "Total_Training_Hours", "Total_Absence_Days", "Performance_Score_Numeric")
INDICATORS = (
    "Tenure_Years",
    "Total_Absence_Days",
    "Total_Training_Hours",
    "Review_Completed_Flag",
    "Performance_Score_Numeric",
    "Org_Fragility_Risk",
    "Absorptive_Capacity_Index",
    "Training_Performance_Delta",
)


def keyed(df: DataFrame, source: str) -> DataFrame:
    """The sheet with its id column as the employee key; a sheet that has the key stays as it is."""
    return df.drop(source) if KEY in df.columns else standardize_id(df, source, KEY)


def employee_master(
    df: DataFrame, order: str = ROW, drop_null_period: bool = False, formats: Sequence[str] = DATE_FORMATS
) -> DataFrame:
    """Latest workforce row per employee; rows without an id are dropped."""
    staff = keyed(df, V.ID_PRIMARY).where(col(KEY).isNotNull())
    if V.PERIOD not in staff.columns:
        return staff.drop(order)
    dated = staff.withColumn(V.PERIOD, date_of(staff, V.PERIOD, formats))
    return latest_per_key(dated, [KEY], V.PERIOD, order, drop_null_period).drop(order)


def absence_facts(df: DataFrame) -> DataFrame:
    """Absence days and events per employee, from the best day column the sheet has."""
    days = first_existing(df, V.ABSENCE_DAYS_PREFERENCE)
    events = keyed(df, V.EMPLOYEE_CODE)
    return group_nonnull(events.select(KEY, num_of(events, days).alias("_days")), KEY).agg(
        A.amount0("_days").alias("Total_Absence_Days"),
        F.count("_days").alias("Absence_Count"),
    )


def training_facts(df: DataFrame) -> DataFrame:
    """Hours of all sessions (negatives as zero), distinct and completed sessions per employee."""
    sessions = keyed(df, V.EMPLOYEE_CODE)
    done = norm_eq(col(V.TRAINING_STATUS), V.TRAINING_DONE) if V.TRAINING_STATUS in df.columns else F.lit(True)
    rows = sessions.select(
        KEY,
        clip(num_of(sessions, V.TRAINING_HOURS), low=0.0).alias("_hours"),
        col(V.SESSION).alias("_session"),
        done.alias("_done"),
    )
    return group_nonnull(rows, KEY).agg(
        A.amount0("_hours").alias("Total_Training_Hours"),
        F.count_distinct("_session").alias("Training_Sessions_Count"),
        F.count_if("_done").alias("Completed_Training_Sessions"),
    )


def review_facts(df: DataFrame, order: str = ROW) -> DataFrame:
    """The best review row per employee: completed ones first, then by score."""
    reviews = keyed(df, V.WORKING_ID).where(col(KEY).isNotNull())
    if V.WORKING_DOCUMENT_STATUS in df.columns:
        done = icontains(col(V.WORKING_DOCUMENT_STATUS), V.REVIEW_DONE_STEM)
    else:
        done = norm_eq(column_or(df, V.REVIEW_STATUS), V.REVIEW_DONE)
    score = num_of(reviews, V.REVIEW_SCORE) if V.REVIEW_SCORE in df.columns else F.lit(None).cast("double")
    flagged = reviews.withColumns(
        {"Review_Completed_Flag": done.cast("int"), "Performance_Score_Numeric": score}
    )
    best = ["Review_Completed_Flag", "Performance_Score_Numeric"]
    wanted = [KEY, *best, V.REVIEW_SCORE, V.WORKING_UNIT, V.WORKING_CONTRACT, V.WORKING_YEAR]
    return best_per_key(select_existing(flagged, [*wanted, order]), [KEY], best, order).drop(order)


def integrated_employee(
    workforce: DataFrame, reviews: DataFrame, absences: DataFrame, training: DataFrame, order: str = ROW,
    formats: Sequence[str] = DATE_FORMATS,
) -> DataFrame:
    """Latest snapshot per employee with review, absence and training facts.

    Each input is reduced to one row per employee before the joins.
    """
    facts = [review_facts(reviews, order), absence_facts(absences), training_facts(training)]
    return fill_zero(enrich(employee_master(workforce, order, formats=formats), facts, KEY), FILLED)


def department_column(df: DataFrame) -> str:
    """The local entity where the sheet has it, else the country group."""
    return V.ENTITY_LABEL if V.ENTITY_LABEL in df.columns else V.COUNTRY_GROUP


def entry_date(df: DataFrame) -> str | None:
    """The column that holds the date of joining, if any; two that could are an error."""
    found = [c for c in df.columns if c.startswith(V.ENTRY_DATE_PREFIX)]
    if len(found) > 1:
        raise ValueError(f"name the entry date: any of {found}")
    return found[0] if found else None


def tenure_and_risk(
    df: DataFrame,
    entered: str | None = None,
    reference: str = V.REFERENCE_DATE,
    risk_tenure: float = V.RISK_TENURE_YEARS,
    risk_absence: float = V.RISK_ABSENCE_DAYS,
    formats: Sequence[str] = DATE_FORMATS,
) -> DataFrame:
    """The employee table with tenure in years and the risk flag."""
    entered = entered or entry_date(df)
    if entered:
        dated = df.withColumn(entered, ts_of(df, entered, formats))
        dated = dated.withColumn("Tenure_Years", tenure_years(col(entered), reference, V.DAYS_PER_YEAR))
    else:
        dated = df.withColumn("Tenure_Years", F.lit(None).cast("double"))
    risky = (F.col("Tenure_Years") > risk_tenure) & (F.col("Total_Absence_Days") > risk_absence)
    return dated.withColumn("Org_Fragility_Risk", two_way(risky, *V.RISK_LABELS))


def training_measures(
    df: DataFrame,
    department: str | None = None,
    edges: Sequence[float] = V.BAND_EDGES_SEGMENT,
    labels: Sequence[str] = V.BAND_LABELS,
    approx: bool = False,
    stage: bool = False,
) -> DataFrame:
    """The employee table with training index and band, and the score against the baseline.

    Both department medians (training hours of all, score of those without training) come
    from one aggregation and are joined back once.
    """
    department = department or department_column(df)
    hours, score = F.col("Total_Training_Hours"), F.col("Performance_Score_Numeric")
    medians: Mapping[str, Column] = {
        "Dept_Median_Training": hours,
        "Dept_No_Training_Baseline": F.when(hours == 0, score),
    }
    based = with_group_medians(df, department, medians, [KEY], approx, stage)
    index = ratio(hours, F.col("Dept_Median_Training") + 1)
    return based.withColumns({
        "Absorptive_Capacity_Index": clip(index, *V.INDEX_RANGE),
        "Training_Intensity_Band": band(hours, edges, labels),
        "Training_Performance_Delta": score - F.col("Dept_No_Training_Baseline"),
    })


def employee_indicators(
    df: DataFrame,
    department: str | None = None,
    stage: bool = False,
    entered: str | None = None,
    reference: str = V.REFERENCE_DATE,
    formats: Sequence[str] = DATE_FORMATS,
) -> DataFrame:
    """The employee table with all indicators, at the default thresholds and bands."""
    return training_measures(tenure_and_risk(df, entered, reference, formats=formats), department, stage=stage)


def indicator_view(df: DataFrame, department: str | None = None) -> DataFrame:
    """The key indicators per employee."""
    return select_existing(df, [KEY, department or department_column(df), *INDICATORS])


def governance_summary(df: DataFrame, department: str | None = None) -> DataFrame:
    """Review completion and score per department, rows without one included, best first."""
    department = department or department_column(df)
    return (
        df.groupBy(col(department))
        .agg(
            F.count_distinct(KEY).alias("Employees"),
            round_half_even(pct(F.avg("Review_Completed_Flag")), 2).alias("Review_Completion_Rate"),
            round_half_even(F.avg("Performance_Score_Numeric"), 2).alias("Avg_Performance_Score"),
        )
        .orderBy(F.col("Review_Completion_Rate").desc_nulls_last(), col(department).asc_nulls_last())
    )


def governance_top(df: DataFrame, k: int = 10, department: str | None = None) -> DataFrame:
    """The k departments with the highest completion rate."""
    department = department or department_column(df)
    return top_k(governance_summary(df, department), "Review_Completion_Rate", k, department)


def training_band_summary(indicators: DataFrame, labels: Sequence[str] = V.BAND_LABELS) -> DataFrame:
    """Employees, hours, score and delta per training band, a row for 'no band' if there is one."""
    def rounded(name: str) -> Column:
        return round_half_even(F.avg(name), 2)

    return group_complete(
        indicators,
        "Training_Intensity_Band",
        labels,
        {
            "Employee_Count": F.count_distinct(KEY),
            "Avg_Training_Hours": rounded("Total_Training_Hours"),
            "Avg_Performance_Score": rounded("Performance_Score_Numeric"),
            "Avg_Performance_Delta": rounded("Training_Performance_Delta"),
        },
        zero=["Employee_Count"],
        keep_null=True,
    )


def trend_by_risk(indicators: DataFrame) -> DataFrame:
    """Line of absence days on training hours per risk flag."""
    return stats.ols_by(indicators, "Org_Fragility_Risk", "Total_Training_Hours", "Total_Absence_Days")


def tenure_histogram(
    indicators: DataFrame, department: str | None = None, bins: int = V.HISTOGRAM_BINS
) -> DataFrame:
    """Employees per tenure bin and department."""
    return stats.histogram_by(indicators, "Tenure_Years", department or department_column(indicators), bins)


def correlation(indicators: DataFrame) -> DataFrame:
    """Correlation of the core numeric columns."""
    return stats.corr_matrix(indicators, NUMERIC)
