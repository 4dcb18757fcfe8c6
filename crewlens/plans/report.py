"""The whole report: sources to result tables, chart feeds, text facts and the employee table."""

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crewlens import vocabulary as V
from crewlens.functions.parsing import DATE_FORMATS, date_of, dayfirst_of, num_of
from crewlens.operators import dates, stats
from crewlens.operators.rows import drop_missing
from crewlens.plans import employee, feeds, kpis, prepare
from crewlens.session import materialise, materialise_bucketed
from crewlens.sources import publish
from crewlens.sources.readers import load_sources, read_csv
from crewlens.sources.writers import kpi_lines, save_employee_table, save_kpi_lines, save_tables

# Results with a row per employee; everything else is of report size.
EMPLOYEE_GRAIN = ("absence_by_employee", "performance_2023", "performance_2024")
# Results with a row per month, year, band or fixed line: written as one file.
SINGLE = (
    "kpi_summary", "monthly_headcount", "training_kpis", "quick_scores", "cold_impact", "finance", "training_perf_summary",
    "training_band_summary", "trend_by_risk", "correlation", "insight_facts", "source_counts", "source_quality",
)


@dataclass(frozen=True)
class Options:
    """How the sheets are read and judged."""

    sep: str = ","
    encoding: str = "UTF-8"
    multi_line: Collection[str] = ()
    date_formats: Sequence[str] = DATE_FORMATS
    year: int = V.REPORT_YEAR
    department: str | None = None
    entered: str | None = None
    reference: str = V.REFERENCE_DATE
    column_dates: bool = False
    #: Buckets of the sheets of the employee table; 0 leaves them as they are.
    buckets: int = 0
    #: Complete versions to keep; 0 writes in place.
    versions: int = 0
    #: Date patterns of single columns (``<sheet>.<header>``), where they differ from ``date_formats``.
    column_formats: Mapping[str, Sequence[str]] = field(default_factory=dict)

    def formats(self, sheet: str, column: str) -> Sequence[str]:
        """Date patterns of a column."""
        return self.column_formats.get(f"{sheet}.{column}", self.date_formats)


def with_column_dates(sources: Mapping[str, DataFrame], options: Options) -> Options:
    """The options with the date patterns of each date column chosen by all of its values."""
    staff = sources["workforce"]
    entered = options.entered or employee.entry_date(staff)
    dated = {"workforce": [V.PERIOD, *([entered] if entered else [])], "absenteeism": [V.ABSENCE_DATE]}
    chosen = {}
    for sheet, columns in dated.items():
        found = dates.column_layouts(sources[sheet], columns)
        chosen |= {f"{sheet}.{c}": dates.LAYOUTS[layout] for c, layout in found.items()}
    return replace(options, column_formats={**chosen, **options.column_formats})


def source_quality(sources: Mapping[str, DataFrame], options: Options = Options()) -> DataFrame:
    """Per sheet and typed column: rows, given values, and those that cannot be read."""
    dated = {"workforce": V.PERIOD, "absenteeism": V.ABSENCE_DATE}
    surveyed = {"training_quick": V.SURVEY_DATE, "training_cold": V.SURVEY_DATE}
    numbered = {"performance_2024": V.REVIEW_SCORE, "training_records": V.TRAINING_HOURS, "training_quick": V.SURVEY_RATING}
    parts = []
    for sheet, df in sources.items():
        read = {}
        if sheet in dated:
            read[dated[sheet]] = date_of(df, dated[sheet], options.formats(sheet, dated[sheet]))
        if sheet in surveyed:
            read[surveyed[sheet]] = dayfirst_of(df, surveyed[sheet])
        if sheet in numbered:
            read[numbered[sheet]] = num_of(df, numbered[sheet])
        if read:
            parts.append(stats.unreadable(df, read).select(F.lit(sheet).alias("sheet"), "*"))
    return reduce(DataFrame.unionByName, parts)


def kpi_tables(sources: Mapping[str, DataFrame], share: bool = False, options: Options = Options()) -> dict[str, DataFrame]:
    """All KPI tables as lazy plans.

    ``share`` writes the combined reviews, which three results read, to the shared folder
    once; the other inputs are projections that each reader prunes for itself.
    """
    workforce = prepare.workforce(sources["workforce"], options.formats("workforce", V.PERIOD))
    reviews = prepare.performance_2024(sources["performance_2024"])
    if share:
        reviews = materialise(reviews, "reviews")
    absences = prepare.absenteeism(sources["absenteeism"], options.formats("absenteeism", V.ABSENCE_DATE))
    training = prepare.training_records(sources["training_records"])
    quick = prepare.training_quick(sources["training_quick"])
    cold = prepare.training_cold(sources["training_cold"])
    finance = prepare.finance(sources["finance_pl"], sources["finance_fte"])
    return {
        "kpi_summary": kpis.kpi_summary(workforce, reviews, training, quick, absences, finance, options.year),
        "monthly_headcount": kpis.monthly_headcount(workforce),
        "headcount_by_country": kpis.headcount_by_country(workforce),
        "review_metrics": kpis.review_metrics(reviews),
        "training_kpis": kpis.training_kpis(training),
        "quick_scores": kpis.quick_scores(quick),
        "cold_impact": kpis.cold_impact(cold),
        "absence_by_employee": kpis.absence_by_employee(absences),
        "absence_group_mix": kpis.absence_group_mix(absences),
        "finance": finance,
        "training_perf_summary": kpis.training_perf_summary(reviews, training),
        "performance_2023": prepare.performance_2023(sources["performance_2023"]),
        "performance_2024": drop_missing(reviews, "performance_score").select(
            "employee_id", "country", "performance_score"
        ),
    }


#: Id columns of the sheets that the employee table is made of.
KEYED = {
    "workforce": V.ID_PRIMARY, "performance_working": V.WORKING_ID, "absenteeism": V.EMPLOYEE_CODE, "training_records": V.EMPLOYEE_CODE,
}


def bucketed_sources(sources: Mapping[str, DataFrame], buckets: int) -> dict[str, DataFrame]:
    """The sheets of the employee table, dealt to buckets by employee once.

    Every later step by employee, in this and in further reports on the same tables, then runs
    inside a bucket: the employee table is made without a shuffle.
    """
    return {
        name: materialise_bucketed(employee.keyed(sources[name], source), name, employee.KEY, buckets) for name, source in KEYED.items()
    }


def employee_table(sources: Mapping[str, DataFrame], options: Options = Options()) -> DataFrame:
    """The integrated employee table as a lazy plan."""
    return employee.integrated_employee(
        sources["workforce"],
        sources["performance_working"],
        sources["absenteeism"],
        sources["training_records"],
        formats=options.formats("workforce", V.PERIOD),
    )


def employee_tables(
    integrated: DataFrame, indicators: DataFrame, department: str | None = None
) -> dict[str, DataFrame]:
    """Analytics on the employee table; both inputs are read several times."""
    return {
        "data_quality": stats.data_quality(integrated),
        "performance_governance_summary": employee.governance_summary(indicators, department),
        "performance_governance_top": employee.governance_top(indicators, department=department),
        "indicator_view": employee.indicator_view(indicators, department),
        "training_band_summary": employee.training_band_summary(indicators),
        "trend_by_risk": employee.trend_by_risk(indicators),
        "tenure_histogram": employee.tenure_histogram(indicators, department),
        "correlation": employee.correlation(indicators),
    }


def saved_tables(spark: SparkSession, folder: str, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Written report-size tables read back with the schema they were written with."""
    small = {n: t for n, t in tables.items() if n not in EMPLOYEE_GRAIN}
    return {n: read_csv(spark, f"{folder}/{n}", t.schema) for n, t in small.items()}


def heads(tables: Mapping[str, DataFrame], rows: int = 10) -> dict[str, DataFrame]:
    """The first rows of every table, for display."""
    return {n: t.limit(rows) for n, t in tables.items()}


def run(
    spark: SparkSession, root: str, out: str, fmt: str = "csv", options: Options = Options()
) -> dict[str, DataFrame]:
    """Read the sheets under ``root`` and write all results under ``out``.

    Text sheets have several readers each, so they are first copied to columnar form in the
    shared folder: the text is parsed once and every reader prunes columns. The employee table
    and its indicators are written there too before their readers start. Chart feeds and text
    facts are made from the written KPI tables. ``session.discard_copies`` removes the copies once the returned
    tables are no longer needed; the command line does.

    Results are written in place, table by table. With ``options.versions`` they become a new
    version, which readers (``publish.read_published``) see once it is complete; so many versions
    are kept.
    """
    target, version = out, 0
    if options.versions:
        version, out = publish.begin(spark, target)
    sources = load_sources(spark, root, fmt, options.sep, encoding=options.encoding, multi_line=options.multi_line)
    if fmt == "csv":
        sources = {n: materialise(t, n) for n, t in sources.items()}
    if options.column_dates:
        options = with_column_dates(sources, options)
    tables = kpi_tables(sources, share=True, options=options)
    save_tables(tables, f"{out}/tables", SINGLE)
    saved = saved_tables(spark, f"{out}/tables", tables)

    dealt = bucketed_sources(sources, options.buckets) if options.buckets else sources
    integrated = materialise(employee_table(dealt, options), "employee")
    judged = employee.employee_indicators(
        integrated, options.department, stage=True, entered=options.entered, reference=options.reference,
        formats=options.formats("workforce", options.entered or employee.entry_date(integrated) or ""),
    )
    indicators = materialise(judged, "indicators")
    save_employee_table(indicators, f"{out}/employee", options.department or employee.department_column(indicators))
    analytics = employee_tables(integrated, indicators, options.department)
    checks = {"source_counts": stats.profile_counts(sources), "source_quality": source_quality(sources, options)}
    save_tables({**checks, **analytics}, f"{out}/analytics", SINGLE)

    facts = kpis.insight_facts(
        *[saved[n] for n in (
            "monthly_headcount", "review_metrics", "training_kpis", "quick_scores", "cold_impact", "finance",
        )],
        year=options.year,
    )
    charts = feeds.chart_feeds(saved)
    save_tables(charts, f"{out}/feeds")
    save_tables({"insight_facts": facts}, f"{out}/facts", SINGLE)
    save_kpi_lines(saved["kpi_summary"], f"{out}/headline")
    if version:
        folders = {"tables": tables, "analytics": {**checks, **analytics}, "feeds": charts, "facts": {"insight_facts": facts}}
        written = {f"{f}/{n}": ("csv", t.schema) for f, group in folders.items() for n, t in group.items()}
        written |= {"employee/csv": ("csv", indicators.schema), "employee/parquet": ("parquet", indicators.schema)}
        written["headline"] = ("text", kpi_lines(saved["kpi_summary"]).schema)
        publish.commit(spark, target, version, written, options.versions)
    return {**tables, **analytics, "insight_facts": facts, "employee_indicators": indicators}
