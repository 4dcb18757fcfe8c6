"""Typed, canonically named tables from the raw sheets. Projections and filters only, except
for the reviews of one employee, which are combined to one row."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crewlens import vocabulary as V
from crewlens.functions import aggregates as A
from crewlens.functions.parsing import DATE_FORMATS, col, date_of, dayfirst_of, istartswith, norm_eq, num_of
from crewlens.functions.scalars import count_across, nullif0, ratio
from crewlens.operators.columns import clean_header, column_or, select_positions
from crewlens.operators.joins import join_on
from crewlens.operators.ordered import forward_fill
from crewlens.operators.reshape import melt, metric_columns
from crewlens.operators.rows import drop_missing, labelled_rows, review_documents
from crewlens.sources.readers import ROW


def workforce(df: DataFrame, formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Monthly snapshots; rows without an id or a readable period are dropped."""
    typed = df.select(
        F.coalesce(col(V.ID_PRIMARY), column_or(df, V.ID_BACKUP)).alias("employee_id"),
        date_of(df, V.PERIOD, formats).alias("PERIOD"),
        col(V.COUNTRY_LABEL).alias("country"),
        col(V.GENDER_LABEL).alias("gender"),
        col(V.CONTRACT_LABEL).alias("contract"),
        col(V.ENTITY_LABEL).alias("entity"),
        col(V.AGE_RANGE).alias("age_range"),
    )
    return drop_missing(typed, "employee_id", "PERIOD")


def performance_2023(df: DataFrame, order: str = ROW) -> DataFrame:
    """Review scores; the country stands only in the first row of each block."""
    filled = forward_fill(df, V.REVIEW_COUNTRY_2023, order, "country")
    return drop_missing(filled, V.REVIEW_ID).select(
        col(V.REVIEW_ID).alias("employee_id"),
        "country",
        F.lit(2023).alias("year"),
        num_of(df, V.REVIEW_SCORE_2023).alias("performance_score"),
    )


def performance_2024(df: DataFrame, order: str = ROW) -> DataFrame:
    """Review documents combined per employee, country and year (missing keys included).

    Best score, and the first known statuses when the documents are read from the best score
    down, in file order among equals.
    """
    docs = df.select(
        col(V.REVIEW_ID).alias("employee_id"),
        col(V.REVIEW_COUNTRY).alias("country"),
        num_of(df, V.REVIEW_YEAR).cast("int").alias("year"),
        num_of(df, V.REVIEW_SCORE).alias("score"),
        col(V.DOCUMENT_NAME).alias("document"),
        col(V.REVIEW_STATUS).alias("status"),
        col(V.DOCUMENT_STATUS).alias("document_status"),
        col(order).alias("_order"),
    )
    kept = review_documents(docs, F.col("document"), F.col("score"), V.DOCUMENT_KINDS)
    best_first = [*A.descending(F.col("score"), "score"), F.col("_order")]
    return kept.groupBy("employee_id", "country", "year").agg(
        F.max("score").alias("performance_score"),
        A.first_by(F.col("status"), *best_first).alias("review_completion_status"),
        A.first_by(F.col("document_status"), *best_first).alias("document_status"),
    )


def absenteeism(df: DataFrame, formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Absence events; rows without an id or a readable date are dropped."""
    typed = df.select(
        col(V.EMPLOYEE_CODE).alias("employee_id"),
        date_of(df, V.ABSENCE_DATE, formats).alias("absence_date"),
        F.coalesce(num_of(df, V.WORKED_DAYS), F.lit(0.0)).alias("working_days"),
        F.coalesce(col(V.ABSENCE_GROUP), F.lit(V.UNKNOWN)).alias("absence_group"),
        col(V.COMPANY).alias("entity"),
        col(V.GENDER).alias("gender"),
    )
    return drop_missing(typed, "employee_id", "absence_date")


def training_records(df: DataFrame) -> DataFrame:
    """Training sessions, all statuses, hours as they are."""
    return df.select(
        col(V.EMPLOYEE_CODE).alias("employee_id"),
        num_of(df, V.TRAINING_YEAR).cast("int").alias("year"),
        F.coalesce(num_of(df, V.TRAINING_HOURS), F.lit(0.0)).alias("hours"),
        F.coalesce(col(V.TRAINING_STATUS), F.lit(V.UNKNOWN)).alias("status"),
        col(V.TRAINING_ENTITY).alias("entity"),
        norm_eq(col(V.CERTIFICATIONS), V.CERTIFIED, trim=False).alias("certification_flag"),
        col(V.COURSES).alias("course"),
    )


def training_quick(df: DataFrame) -> DataFrame:
    """Ratings right after a training."""
    return df.select(
        col(V.SURVEY_ID).alias("employee_id"),
        dayfirst_of(df, V.SURVEY_DATE).alias("date"),
        num_of(df, V.SURVEY_RATING).alias("general_rating"),
        col(V.QUICK_STATUS).alias("status"),
    )


def training_cold(df: DataFrame) -> DataFrame:
    """Later surveys: positive and given answers over the impact questions that exist."""
    headers = {clean_header(c): c for c in df.columns}
    answers = [col(headers[q]) for q in V.IMPACT_QUESTIONS if q in headers]
    counted = df.select(
        col(V.SURVEY_ID).alias("employee_id"),
        dayfirst_of(df, V.SURVEY_DATE).alias("date"),
        col(V.COLD_STATUS).alias("status"),
        count_across(answers, lambda c: istartswith(c, V.POSITIVE_ANSWER)).alias("positive_impact_answers"),
        count_across(answers, lambda c: c.isNotNull()).alias("impact_answer_count"),
    )
    rate = ratio(F.col("positive_impact_answers"), nullif0(F.col("impact_answer_count")))
    return counted.withColumn("impact_positive_rate", rate)


def finance(pl: DataFrame, fte: DataFrame, order: str = ROW, years: Sequence[str] = V.FINANCE_YEARS) -> DataFrame:
    """Yearly amounts and amounts per full-time position, from two wide sheets by position.

    The years stand side by side from the second column on, in the second sheet with a column
    between them.
    """
    n = len(years)
    amounts = select_positions(pl, range(n + 1), ["metric", *years])
    amounts = melt(amounts.where(F.col("metric").isNotNull()), ["metric"], years, "year", "value")

    ordinal = fte.columns.index(order)
    segments = select_positions(fte, [*range(0, 2 * n + 1, 2), ordinal], ["segment", *years, order])
    segments = labelled_rows(segments, order, V.FTE_FIRST_ROW, V.FTE_SEGMENTS, "segment")
    positions = melt(segments, ["segment"], years, "year", "value")
    return finance_ratios(
        positions.where(F.col("segment") == V.FTE_SEGMENTS[0]).select("year", F.col("value").alias("avg_fte_proxy")),
        metric_columns(amounts, "year", "metric", "value", V.PL_METRICS),
    )


def finance_ratios(positions: DataFrame, amounts: DataFrame) -> DataFrame:
    """Amounts per position and year; costs are booked negative and shown positive."""
    fte = F.col("avg_fte_proxy")
    return join_on([positions, amounts], "year").select(
        F.col("year").cast("int").alias("year"),
        "avg_fte_proxy",
        "nbi",
        "personnel_cost",
        "training_cost",
        ratio(F.col("nbi"), fte).alias("nbi_per_fte"),
        ratio(F.abs("personnel_cost"), fte).alias("personnel_cost_per_fte"),
        ratio(F.abs("training_cost"), fte).alias("training_cost_per_fte"),
    ).orderBy("year")
