"""The named results of the report over the driver's tables, each with its SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crewlens import vocabulary as V
from crewlens.functions import scalars as S
from crewlens.operators import grouping, joins, rows, stats
from crewlens.plans import employee, kpis, prepare
from crewlens.sources.writers import kpi_lines
from gate import sheets
from gate.registry import query
from gate.sheets import table

SPEND_EDGES = (-0.1, 0.1, 400.0, 700.0, float("inf"))
SEGMENT_EDGES = (-0.01, 0.0, 3000.0, 3500.0, float("inf"))


# Hours and money have two decimals and are summed as decimals, so that the SQL is exact and
# the order of addition cannot decide how a value is rounded.

# --- SQL building blocks -------------------------------------------------------------------

CUSTOMERS = "orders join customer on o_custkey = c_custkey"
PLACED = f"{CUSTOMERS} join nation on c_nationkey = n_nationkey"
SCORE = "case when o_orderstatus <> 'P' then cast(substr(o_orderpriority, 1, 1) as double) end"
REVIEWS = f"""
  docs as (
    select o_custkey employee_id, n_name country, cast(year(o_orderdate) as bigint) yr, o_orderkey,
           {SCORE} score,
           nullif(o_orderstatus, 'O') status, nullif(o_orderstatus, 'F') doc_status
    from {PLACED}
    where o_orderpriority < '3' or o_orderstatus <> 'P'),
  reviews as (
    select employee_id, country, yr as year, max(score) performance_score,
           arg_max(status, (coalesce(score, -1), -o_orderkey)) filter (where status is not null) review_completion_status,
           arg_max(doc_status, (coalesce(score, -1), -o_orderkey)) filter (where doc_status is not null) document_status
    from docs group by all)"""
TRAINING = """
  sessions as (
    select user_id employee_id, cast(dayofmonth(ts) as bigint) as year, value as hours, event_type status,
           coalesce(cast(json_extract_string(props, '$.k') as int) < 30, false) certified,
           nullif(json_extract_string(props, '$.k'), '7') course, json_extract_string(props, '$.k') session
    from events)"""
QUICK = """
  quick as (
    select cast(year(try_strptime(strftime(o_orderdate, '%d/%m/%Y'), '%d/%m/%Y')) as bigint) as year, o_orderstatus status,
           case when o_orderpriority < '5' then cast(substr(o_orderpriority, 1, 1) as double) end rating
    from orders)"""
QUICK_SCORES = """
  quick_scores as (
    select year, avg(rating) avg_training_rating, count(rating) rating_responses
    from quick where status = '{done}' and year {years} group by year)"""
COLD = """
  answers as (
    select cast(year(o_orderdate) as bigint) as year,
           case when o_orderstatus = 'F' then ' Oui' when o_orderstatus = 'O' then 'Non' end a1,
           case when substr(o_orderpriority, 1, 1) = '1' then 'oui, tout à fait'
                when substr(o_orderpriority, 1, 1) < '5' then 'Non' end a2
    from orders where o_totalprice > 100000),
  cold as (
    select year,
           coalesce(cast(lower(trim(a1)) like 'oui%' as int), 0) + coalesce(cast(lower(trim(a2)) like 'oui%' as int), 0) pos,
           cast(a1 is not null as int) + cast(a2 is not null as int) n
    from answers),
  cold_impact as (
    select year, avg(pos / nullif(n, 0)) avg_positive_impact_rate, cast(sum(n) as bigint) impact_responses
    from cold where year {years} group by year)"""
FINANCE = """
  heads as (
    select year(o_orderdate) y, cast(count(*) as double) avg_fte_proxy
    from orders where o_orderpriority like '2%' group by 1),
  amounts as (
    select year(o_orderdate) y,
           cast(sum(case when o_orderstatus = 'F' then cast(o_totalprice as decimal(18, 2)) end) as double) nbi,
           cast(-sum(case when o_orderstatus = 'O' then cast(o_totalprice as decimal(18, 2)) end) as double) personnel_cost,
           cast(-sum(case when o_orderstatus = 'P' then cast(o_totalprice as decimal(18, 2)) end) as double) training_cost
    from orders group by 1),
  finance as (
    select cast(y + 27 as bigint) as year, avg_fte_proxy, nbi, personnel_cost, training_cost,
           nbi / avg_fte_proxy nbi_per_fte, abs(personnel_cost) / avg_fte_proxy personnel_cost_per_fte,
           abs(training_cost) / avg_fte_proxy training_cost_per_fte
    from heads join amounts using (y))"""
MONTHLY = f"""
  monthly as (
    select cast(date_trunc('month', o_orderdate) as date) as PERIOD, count(distinct o_custkey) headcount,
           avg(case when c_mktsegment = 'BUILDING' then 1.0 else 0.0 end) female_share
    from {CUSTOMERS} group by 1)"""
REVIEW_METRICS = """
  review_metrics as (
    select country, count(distinct employee_id) employees_with_reviews,
           avg(case when review_completion_status = 'F' then 1.0 else 0.0 end) completion_rate,
           avg(performance_score) avg_performance_score,
           avg(case when performance_score >= 4 then 1.0 else 0.0 end) high_performer_share
    from reviews group by country)"""
TRAINING_KPIS = """
  training_kpis as (
    select year, count(distinct employee_id) trained_employees, count(course) completed_courses,
           sum(hours) training_hours, sum(hours) / greatest(count(distinct employee_id), 1) avg_hours_per_trained_employee,
           avg(case when certified then 1.0 else 0.0 end) certification_rate
    from sessions where status = 'purchase' group by year)"""
EMPLOYEES = f"""
  master as (
    select cast(o_custkey as varchar) "Employee_ID", o_orderdate, n_name, c_nationkey, o_orderkey
    from {PLACED}
    qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1),
  best as (
    select cast(o_custkey as varchar) "Employee_ID", cast(o_orderstatus = 'F' as int) flag, {SCORE} score,
           year(o_orderdate) yr
    from orders
    qualify row_number() over (partition by o_custkey
      order by (o_orderstatus = 'F') desc, score desc nulls last, o_orderkey) = 1),
  absent as (
    select cast(l_partkey as varchar) "Employee_ID", sum(l_quantity) as days, count(l_quantity) as events
    from lineitem group by 1),
  trained as (
    select cast(user_id as varchar) "Employee_ID", cast(sum(cast(value as decimal(18, 2))) as double) as hours, count(distinct json_extract_string(props, '$.k')) sessions,
           count(*) filter (where event_type = 'purchase') done
    from events group by 1),
  employee as (
    select "Employee_ID", cast(m.o_orderdate as date) as "PERIOD", n_name,
           cast(m.o_orderdate as date) - cast(c_nationkey * 150 as int) entered,
           coalesce(flag, 0) "Review_Completed_Flag", score "Performance_Score_Numeric", yr,
           coalesce(days, 0) "Total_Absence_Days", coalesce(events, 0) "Absence_Count",
           coalesce(hours, 0) "Total_Training_Hours", coalesce(sessions, 0) "Training_Sessions_Count",
           coalesce(done, 0) "Completed_Training_Sessions"
    from master m left join best using ("Employee_ID") left join absent using ("Employee_ID")
    left join trained using ("Employee_ID"))"""
INDICATORS = f"""
  dept as (
    select n_name, median("Total_Training_Hours") med,
           median("Performance_Score_Numeric") filter (where "Total_Training_Hours" = 0) base
    from employee group by n_name),
  measured as (
    select *, date_diff('day', cast(entered as date), date '2025-12-31') / 365.25 tenure
    from employee join dept using (n_name)),
  indicators as (
    select *, tenure "Tenure_Years",
           case when tenure > 28 and "Total_Absence_Days" > 15 then 'High Risk' else 'Normal' end "Org_Fragility_Risk",
           least(greatest("Total_Training_Hours" / (med + 1), 0), 3) "Absorptive_Capacity_Index",
           case when "Total_Training_Hours" <= 0 then '0h' when "Total_Training_Hours" <= {SEGMENT_EDGES[2]} then '0.1-7h'
                when "Total_Training_Hours" <= {SEGMENT_EDGES[3]} then '7-20h' else '20h+' end band,
           "Performance_Score_Numeric" - base "Training_Performance_Delta"
    from measured)"""
def half_even(value: str, digits: int) -> str:
    """SQL for rounding ties to the even neighbour, spelled out: scaled, rounded, scaled back."""
    y = f"(round({value}, {digits + 8}) * {10**digits})"
    return f"(case when {y} - floor({y}) = 0.5 then 2 * floor(({y} + 0.5) / 2) else round({y}) end / {10**digits})"


MEAN_HOURS = (
    'cast(sum(cast("Total_Training_Hours" as decimal(18, 2))) as double) / nullif(count("Total_Training_Hours"), 0)'
)
BANDS = "(values (0, '0h'), (1, '0.1-7h'), (2, '7-20h'), (3, '20h+')) b(o, label)"


# --- KPI tables ----------------------------------------------------------------------------

@query("monthly_headcount", f"""
with {MONTHLY} select PERIOD as "PERIOD", headcount, round(female_share, 4) female_share from monthly""")
def monthly_headcount(spark: SparkSession, sf: str) -> DataFrame:
    return kpis.monthly_headcount(sheets.workforce(spark, sf, nations=False), female="BUILDING")


@query("headcount_by_country", f"""
select n_name country, count(distinct o_custkey) headcount,
       round(avg(case when c_mktsegment = 'BUILDING' then 1.0 else 0.0 end), 4) female_share
from {PLACED} where year(o_orderdate) = (select max(year(o_orderdate)) from orders) group by 1""")
def headcount_by_country(spark: SparkSession, sf: str) -> DataFrame:
    return kpis.headcount_by_country(sheets.workforce(spark, sf), female="BUILDING", grain="year")


@query("latest_snapshot", """
select o_orderkey, o_custkey from orders where o_orderdate = (select max(o_orderdate) from orders)""")
def latest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return rows.latest_snapshot(table(spark, sf, "orders"), "o_orderdate").select("o_orderkey", "o_custkey")


@query("review_best", f"with {REVIEWS} select * from reviews")
def review_best(spark: SparkSession, sf: str) -> DataFrame:
    return sheets.reviews(spark, sf)


@query("review_docs_filter", """
select p_partkey, p_name, p_size from part
where lower(p_name) like '%ring%' or lower(p_name) like '%widget%' or p_size > 40""")
def review_docs_filter(spark: SparkSession, sf: str) -> DataFrame:
    score = F.when(F.col("p_size") > 40, F.col("p_size"))
    kept = rows.review_documents(table(spark, sf, "part"), F.col("p_name"), score, ("Ring", "Widget"))
    return kept.select("p_partkey", "p_name", "p_size")


@query("review_metrics", f"""
with {REVIEWS}, {REVIEW_METRICS}
select country, employees_with_reviews, round(completion_rate, 4) completion_rate,
       round(avg_performance_score, 4) avg_performance_score, round(high_performer_share, 4) high_performer_share
from review_metrics""")
def review_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return kpis.review_metrics(sheets.reviews(spark, sf), done="F")


@query("training_kpis", f"""
with {TRAINING}, {TRAINING_KPIS}
select year, trained_employees, completed_courses, round(training_hours, 4) training_hours,
       round(avg_hours_per_trained_employee, 4) avg_hours_per_trained_employee,
       round(certification_rate, 4) certification_rate
from training_kpis""")
def training_kpis(spark: SparkSession, sf: str) -> DataFrame:
    return kpis.training_kpis(prepare.training_records(sheets.training_sheet(spark, sf)), done="purchase")


@query("quick_scores", f"""
with {QUICK}, {QUICK_SCORES.format(done="F", years="is not null")}
select year, round(avg_training_rating, 4) avg_training_rating, rating_responses from quick_scores""")
def quick_scores(spark: SparkSession, sf: str) -> DataFrame:
    return kpis.quick_scores(prepare.training_quick(sheets.quick_sheet(spark, sf)), done="F")


@query("cold_impact", f"""
with {COLD.format(years="is not null")}
select year, round(avg_positive_impact_rate, 4) avg_positive_impact_rate, impact_responses from cold_impact""")
def cold_impact(spark: SparkSession, sf: str) -> DataFrame:
    return kpis.cold_impact(prepare.training_cold(sheets.cold_sheet(spark, sf)))


@query("absence_by_employee", """
with counted as (
  select l_suppkey employee_id, coalesce(nullif(l_returnflag, 'N'), 'Unknown') g, count(*) n
  from lineitem group by all),
main as (
  select employee_id, g main_group from counted
  qualify row_number() over (partition by employee_id order by n desc, g) = 1)
select employee_id, round(sum(l_quantity), 4) absence_days, count(l_shipdate) absence_events, main_group
from lineitem join main on l_suppkey = employee_id group by employee_id, main_group""")
def absence_by_employee(spark: SparkSession, sf: str) -> DataFrame:
    return kpis.absence_by_employee(prepare.absenteeism(sheets.absence_sheet(spark, sf)))


@query("absence_group_mix", """
select coalesce(nullif(l_returnflag, 'N'), 'Unknown') absence_group, round(sum(l_quantity), 4) absence_days
from lineitem group by 1""")
def absence_group_mix(spark: SparkSession, sf: str) -> DataFrame:
    return kpis.absence_group_mix(prepare.absenteeism(sheets.absence_sheet(spark, sf)))


@query("finance_ratios", f"""
with {FINANCE}
select year, {", ".join(f"round({c}, 6) {c}" for c in (
    "avg_fte_proxy", "nbi", "personnel_cost", "training_cost",
    "nbi_per_fte", "personnel_cost_per_fte", "training_cost_per_fte"))}
from finance""", digits=6)
def finance_ratios(spark: SparkSession, sf: str) -> DataFrame:
    return sheets.finance(spark, sf)


@query("training_perf_summary", f"""
with {REVIEWS}, {TRAINING},
hours as (select employee_id, sum(hours) h from sessions where status = 'purchase' group by 1),
scored as (
  select r.employee_id, performance_score, coalesce(h, 0) h
  from reviews r left join hours using (employee_id) where performance_score is not null),
banded as (
  select *, case when h <= {SPEND_EDGES[0]} then null when h <= {SPEND_EDGES[1]} then '0h' when h <= {SPEND_EDGES[2]} then '0.1-7h'
                 when h <= {SPEND_EDGES[3]} then '7-20h' else '20h+' end band from scored)
select label training_band, round(avg(performance_score), 4) avg_performance_score,
       count(distinct employee_id) employee_count
from {BANDS} left join banded on band = label group by 1""")
def training_perf_summary(spark: SparkSession, sf: str) -> DataFrame:
    training = prepare.training_records(sheets.training_sheet(spark, sf))
    return kpis.training_perf_summary(sheets.reviews(spark, sf), training, done="purchase", edges=SPEND_EDGES)


def _kpi_table(spark: SparkSession, sf: str) -> DataFrame:
    return kpis.kpi_summary(
        sheets.workforce(spark, sf, nations=False),
        sheets.reviews(spark, sf),
        # the day of the month stands in for the year of a session
        prepare.training_records(sheets.training_sheet(spark, sf)).withColumn("year", F.col("year") + 2000),
        prepare.training_quick(sheets.quick_sheet(spark, sf)),
        prepare.absenteeism(sheets.absence_sheet(spark, sf)),
        sheets.finance(spark, sf),
        year=2025,
        female="BUILDING",
        review_done="F",
        training_done="purchase",
        survey_done="F",
    )


KPI_SQL = f"""
with {REVIEWS}, {TRAINING}, {QUICK}, {FINANCE}, {MONTHLY},
latest as (select * from monthly order by PERIOD desc limit 1),
vals(o, v) as (
  select 0, cast(headcount as double) from latest
  union all select 1, round_even(female_share * 100, 1) from latest
  union all select 2, round_even(avg(case when review_completion_status = 'F' then 1.0 else 0.0 end) * 100, 1) from reviews
  union all select 3, round_even(avg(performance_score), 2) from reviews
  union all select 4, round_even(sum(hours), 1) from sessions where status = 'purchase' and year = 25
  union all select 5, round_even(avg(rating), 2) from quick where status = 'F'
  union all select 6, round_even((select sum(l_quantity) from lineitem) / headcount, 2) from latest
  union all select 7, round_even(nbi_per_fte, 2) from finance where year = 2025),
names(o, kpi, definition) as (values {", ".join(
    f"({i}, '{label}', '{text}')".format(year=V.REPORT_YEAR) for i, (_, label, _, text) in enumerate(V.KPI_ROWS))})
"""


@query("kpi_summary", KPI_SQL + "select kpi, v as value, definition from vals join names using (o)")
def kpi_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _kpi_table(spark, sf)


@query("kpi_lines", KPI_SQL + """
select '- ' || kpi || ': ' || case when contains(t, '.') then t else t || '.0' end || ' (' || definition || ')' as line
from (select *, regexp_replace(regexp_replace(printf('%.2f', v), '0+$', ''), '\\.$', '') t from vals join names using (o))""")
def kpi_text(spark: SparkSession, sf: str) -> DataFrame:
    return kpi_lines(_kpi_table(spark, sf))


@query("satisfaction_outer", f"""
with {QUICK}, {QUICK_SCORES.format(done="F", years="is not null")}, {COLD.format(years="is not null")}
select year, round(avg_training_rating, 4) avg_training_rating, rating_responses,
       round(avg_positive_impact_rate, 4) avg_positive_impact_rate, impact_responses
from quick_scores full join (select * replace (year + 2 as year) from cold_impact) using (year)""")
def satisfaction_outer(spark: SparkSession, sf: str) -> DataFrame:
    quick = kpis.quick_scores(prepare.training_quick(sheets.quick_sheet(spark, sf)), done="F")
    cold = kpis.cold_impact(prepare.training_cold(sheets.cold_sheet(spark, sf)))
    # two years apart, so that either side has years of its own
    return kpis.satisfaction(quick, cold.withColumn("year", F.col("year") + 2))


@query("insight_facts", f"""
with {REVIEWS}, {REVIEW_METRICS}, {TRAINING}, {TRAINING_KPIS}, {QUICK}, {QUICK_SCORES.format(done="F", years="is not null")},
  {COLD.format(years="is not null")}, {FINANCE}, {MONTHLY}
select (select arg_min(headcount, PERIOD) from monthly where year(PERIOD) = 1998) first_headcount,
       (select arg_max(headcount, PERIOD) from monthly) latest_headcount,
       (select printf('%.1f%%', arg_max(female_share, PERIOD) * 100) from monthly) latest_female_share,
       (select printf('%.0f', max(training_hours)) from training_kpis where year = 12) training_hours,
       (select max(trained_employees) from training_kpis where year = 12) trained_employees,
       coalesce((select printf('%.2f/5', max(avg_training_rating)) from quick_scores where year + 90 = 1999), 'n/a') training_rating,
       coalesce((select printf('%.1f%%', max(avg_positive_impact_rate) * 100) from cold_impact where year = 1999), 'n/a') positive_impact,
       (select printf('%.1f%%', sum(completion_rate * employees_with_reviews) / sum(employees_with_reviews) * 100)
        from review_metrics) weighted_completion,
       (select printf('%.0f', nbi_per_fte) from finance where year = 2024) nbi_per_fte,
       (select printf('%.0f', personnel_cost_per_fte) from finance where year = 2024) personnel_cost_per_fte""")
def insight_facts(spark: SparkSession, sf: str) -> DataFrame:
    # every series has its own calendar here: bring the looked-up rows to 1999
    training = kpis.training_kpis(prepare.training_records(sheets.training_sheet(spark, sf)), done="purchase")
    quick = kpis.quick_scores(prepare.training_quick(sheets.quick_sheet(spark, sf)), done="F")
    return kpis.insight_facts(
        kpis.monthly_headcount(sheets.workforce(spark, sf, nations=False), female="BUILDING"),
        kpis.review_metrics(sheets.reviews(spark, sf), done="F"),
        training.withColumn("year", F.col("year") + 1987),
        quick.withColumn("year", F.col("year") + 90),
        kpis.cold_impact(prepare.training_cold(sheets.cold_sheet(spark, sf))),
        sheets.finance(spark, sf).withColumn("year", F.col("year") - 25),
        first_year=1998,
        year=1999,
    )


# --- Employee table ------------------------------------------------------------------------

def _employees(spark: SparkSession, sf: str) -> DataFrame:
    return employee.integrated_employee(
        sheets.master_sheet(spark, sf),
        sheets.working_sheet(spark, sf),
        sheets.absence_sheet(spark, sf, by="l_partkey"),
        sheets.done_sheet(spark, sf),
    )


def _at_risk(spark: SparkSession, sf: str) -> DataFrame:
    return employee.tenure_and_risk(_employees(spark, sf), risk_tenure=28)


def _indicators(spark: SparkSession, sf: str) -> DataFrame:
    return employee.training_measures(_at_risk(spark, sf), edges=SEGMENT_EDGES)


@query("integrated_employee", f"""
with {EMPLOYEES}
select "Employee_ID", "PERIOD", n_name "ENTITY_LABEL_LOCAL", cast(entered as date) "DATE_ENTRY",
       cast("Review_Completed_Flag" as bigint) "Review_Completed_Flag", "Performance_Score_Numeric",
       cast(cast("Performance_Score_Numeric" as int) as varchar) "Note de performance", cast(yr as bigint) " Année",
       round("Total_Absence_Days", 4) "Total_Absence_Days", "Absence_Count",
       round("Total_Training_Hours", 4) "Total_Training_Hours", "Training_Sessions_Count", "Completed_Training_Sessions"
from employee""")
def integrated_employee(spark: SparkSession, sf: str) -> DataFrame:
    return _employees(spark, sf)


@query("employee_indicators", f"""
with {EMPLOYEES}, {INDICATORS}
select "Employee_ID", n_name "ENTITY_LABEL_LOCAL", round("Tenure_Years", 4) "Tenure_Years",
       round("Total_Absence_Days", 4) "Total_Absence_Days", round("Total_Training_Hours", 4) "Total_Training_Hours",
       cast("Review_Completed_Flag" as bigint) "Review_Completed_Flag", "Performance_Score_Numeric",
       "Org_Fragility_Risk", round("Absorptive_Capacity_Index", 4) "Absorptive_Capacity_Index",
       "Training_Performance_Delta"
from indicators""")
def employee_indicators(spark: SparkSession, sf: str) -> DataFrame:
    return employee.indicator_view(_indicators(spark, sf))


@query("data_quality", """
with joined as (
  select c_custkey, c_name, c_nationkey, c_mktsegment, n_events, total
  from customer left join (select user_id, count(*) n_events, sum(value) total from events
                           group by 1)
  on c_custkey = user_id)
select * from (""" + " union all ".join(
    f"""select '{c}' as "column", count(*) filter (where {c} is null) "Missing_Count",
        round_even(100.0 * count(*) filter (where {c} is null) / count(*), 2) "Missing_Pct" from joined"""
    for c in ("c_custkey", "c_name", "c_nationkey", "c_mktsegment", "n_events", "total")) + ")")
def data_quality(spark: SparkSession, sf: str) -> DataFrame:
    facts = table(spark, sf, "events").groupBy(F.col("user_id").alias("c_custkey"))
    facts = facts.agg(F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("total"))
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return stats.data_quality(joins.enrich(customers, [facts], "c_custkey"))


@query("governance_summary", f"""
with {EMPLOYEES}
select n_name "ENTITY_LABEL_LOCAL", count(distinct "Employee_ID") "Employees",
       round_even(avg("Review_Completed_Flag") * 100, 2) "Review_Completion_Rate",
       round_even(avg("Performance_Score_Numeric"), 2) "Avg_Performance_Score"
from employee group by 1""")
def governance_summary(spark: SparkSession, sf: str) -> DataFrame:
    return employee.governance_summary(_employees(spark, sf))


@query("governance_top", f"""
with {EMPLOYEES}
select n_name "ENTITY_LABEL_LOCAL", count(distinct "Employee_ID") "Employees",
       round_even(avg("Review_Completed_Flag") * 100, 2) "Review_Completion_Rate",
       round_even(avg("Performance_Score_Numeric"), 2) "Avg_Performance_Score"
from employee group by 1 order by 3 desc, 1 limit 10""")
def governance_top(spark: SparkSession, sf: str) -> DataFrame:
    return employee.governance_top(_employees(spark, sf))


@query("training_bands_segment", f"""
with {EMPLOYEES}, {INDICATORS}
select label "Training_Intensity_Band", count(distinct "Employee_ID") "Employee_Count",
       {half_even(MEAN_HOURS, 2)} "Avg_Training_Hours",
       round_even(avg("Performance_Score_Numeric"), 2) "Avg_Performance_Score",
       round_even(avg("Training_Performance_Delta"), 2) "Avg_Performance_Delta"
from {BANDS} left join indicators on band = label group by 1""")
def training_bands_segment(spark: SparkSession, sf: str) -> DataFrame:
    return employee.training_band_summary(_indicators(spark, sf))


@query("band_null_kept", f"""
with banded as (
  select o_orderkey, o_custkey, case when h <= -0.1 then null when h <= 0.1 then '0h' when h <= 7 then '0.1-7h'
         when h <= 20 then '7-20h' else '20h+' end band
  from (select *, o_totalprice / 10000 - 1 h from orders))
select label band, count(distinct o_custkey) n
from (select label from {BANDS} union all select null) left join banded on band is not distinct from label
group by 1""")
def band_null_kept(spark: SparkSession, sf: str) -> DataFrame:
    hours = F.col("o_totalprice") / 10000 - 1
    banded = table(spark, sf, "orders").withColumn("band", S.band(hours, V.BAND_EDGES_KPI, V.BAND_LABELS))
    return grouping.group_complete(
        banded, "band", V.BAND_LABELS, {"n": F.count_distinct("o_custkey")}, zero=["n"], keep_null=True
    )


@query("trend_by_group", f"""
with {EMPLOYEES}, {INDICATORS}
select "Org_Fragility_Risk", round(regr_slope(y, x), 4) slope, round(regr_intercept(y, x), 4) intercept,
       round(regr_r2(y, x), 4) r2, cast(regr_count(y, x) as bigint) n
from (select "Org_Fragility_Risk", "Total_Training_Hours" x, "Total_Absence_Days" y from indicators) group by 1""")
def trend_by_group(spark: SparkSession, sf: str) -> DataFrame:
    return employee.trend_by_risk(_at_risk(spark, sf))


@query("tenure_histogram", f"""
with {EMPLOYEES}, {INDICATORS},
ends as (select min("Tenure_Years") lo, max("Tenure_Years") hi from indicators),
placed as (
  select n_name, lo, hi, cast(least(floor(("Tenure_Years" - lo) * 30 / (hi - lo)), 29) + 1 as bigint) bin
  from indicators, ends)
select bin, round(lo + (bin - 1) * (hi - lo) / 30, 4) bin_start, round(lo + bin * (hi - lo) / 30, 4) bin_end,
       n_name "ENTITY_LABEL_LOCAL", count(*) n
from placed group by all""")
def tenure_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return employee.tenure_histogram(_at_risk(spark, sf))




@query("correlation_pairs", f"with {EMPLOYEES}, {INDICATORS} select * from (" + " union all ".join(
    f"""select '{a}' x, '{b}' y, round(corr("{a}", "{b}"), 4) r from indicators"""
    for a in employee.NUMERIC for b in employee.NUMERIC) + ")")
def correlation_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return employee.correlation(_at_risk(spark, sf))
