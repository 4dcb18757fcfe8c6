"""The whole report on dirty sheets, checked against SQL that reads the same CSV files."""

import duckdb
import pytest

from crewlens import vocabulary as V
from crewlens.__main__ import main as command_line
from crewlens.operators.columns import clean_columns
from crewlens.plans import employee, feeds, kpis, prepare, report
from crewlens.session import MB, sizing
from crewlens.sources import readers, writers
from tests.conftest import values
from tests.dirty import generate


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return generate(tmp_path_factory.mktemp("sheets") / "in")


@pytest.fixture(scope="module")
def sources(spark, folder):
    return readers.load_sources(spark, str(folder), views=True)


@pytest.fixture(scope="module")
def tables(sources):
    return report.kpi_tables(sources)


@pytest.fixture(scope="module")
def sql(folder):
    con = duckdb.connect()
    con.execute("create macro num(t) as case when regexp_matches(trim(t), '^[+-]?(\\d+\\.?\\d*|\\.\\d+)$') then trim(t)::double end")
    con.execute("create macro cell(t) as case when t in ('', 'N/A') then null else t end")
    for path in folder.glob("*.csv"):
        con.execute(f"create view {path.stem} as select * from read_csv('{path}', all_varchar = true, header = true, quote = '\"', nullstr = '')")
    con.execute(f"""create view staff as
      select row_number() over () r, coalesce("{V.ID_PRIMARY}", "{V.ID_PRIMARY}_1") id, try_cast("PERIOD" as date) p,
             "{V.COUNTRY_LABEL}" country, "{V.GENDER_LABEL}" gender
      from workforce where coalesce("{V.ID_PRIMARY}", "{V.ID_PRIMARY}_1") is not null and try_cast("PERIOD" as date) is not null""")
    con.execute(f"""create view reviews as
      with d as (select row_number() over () r, "{V.REVIEW_ID}" id, "{V.REVIEW_COUNTRY}" country, num("{V.REVIEW_SCORE}") score,
                        "{V.REVIEW_STATUS}" status, "{V.DOCUMENT_NAME}" doc from performance_2024)
      select id, country, max(score) score,
             arg_min(status, (-coalesce(score, -1), r)) filter (where status is not null) status
      from d where lower(doc) like '%evaluation%' or lower(doc) like '%responsabilit%' or score is not null
      group by id, country""")
    return lambda q: con.execute(q).fetchall()


def approx(rows):
    return [tuple(pytest.approx(v) if isinstance(v, float) else v for v in r) for r in rows]


def test_headcount(tables, sql, sources):
    want = sql("""select p, count(distinct id), avg(case when gender = 'Female' then 1.0 else 0 end)
                  from staff group by 1 order by 1""")
    assert len(want) == 24 and values(tables["monthly_headcount"]) == approx(want)
    near = kpis.monthly_headcount(prepare.workforce(sources["workforce"]), approx=True).collect()
    assert all(abs(r.headcount - w[1]) <= 3 for r, w in zip(near, want))
    want = sql("""select country, count(distinct id), avg(case when gender = 'Female' then 1.0 else 0 end) from staff
                  where p = (select max(p) from staff) and country is not null group by 1 order by 2 desc, 1""")
    assert values(tables["headcount_by_country"]) == approx(want)


def test_reviews(tables, sql):
    want = sql("""select country, count(distinct id), avg(case when status = 'Terminé' then 1.0 else 0 end), avg(score),
                  avg(case when score >= 4 then 1.0 else 0 end) from reviews where country is not null
                  group by 1 order by 2 desc, 1""")
    assert values(tables["review_metrics"]) == approx(want)
    assert tables["performance_2024"].count() == sql("select count(*) from reviews where score is not null")[0][0]


def test_review_year_2023(tables, sql):
    got = tables["performance_2023"]
    assert got.columns == ["employee_id", "country", "year", "performance_score"]
    want = sql(f"""select "{V.REVIEW_ID}", case when r <= 5 then null when r <= 60 then 'France' else 'Luxembourg' end, 2023, num("{V.REVIEW_SCORE_2023}")
                   from (select row_number() over () r, * from performance_2023) where "{V.REVIEW_ID}" is not null order by 1""")
    assert values(got, "employee_id") == want


def test_training(tables, sql):
    want = sql(f"""
      select num("Year")::int y, count(distinct "{V.EMPLOYEE_CODE}"), count("{V.COURSES}"), sum(coalesce(num("{V.TRAINING_HOURS}"), 0)),
             sum(coalesce(num("{V.TRAINING_HOURS}"), 0)) / count(distinct "{V.EMPLOYEE_CODE}"),
             avg(case when lower("{V.CERTIFICATIONS}") = 'yes' then 1.0 else 0 end)
      from training_records where "Status" = 'Réalisé' and num("Year") is not null group by 1 order by 1""")
    assert len(want) == 3 and values(tables["training_kpis"]) == approx(want)


def test_surveys(tables, sql):
    day = f"coalesce(try_strptime(\"{V.SURVEY_DATE}\", '%d/%m/%Y'), try_strptime(\"{V.SURVEY_DATE}\", '%Y-%m-%d'))"
    want = sql(f"""select year({day}), avg(num("{V.SURVEY_RATING}")), count(num("{V.SURVEY_RATING}")) from training_quick
                   where "{V.QUICK_STATUS}" = 'Complétée' and {day} is not null group by 1 order by 1""")
    assert len(want) == 3 and values(tables["quick_scores"]) == approx(want)
    names = [q.replace(" ", "\u00a0", 1) if i % 2 else q for i, q in enumerate(V.IMPACT_QUESTIONS)]
    pos = " + ".join(f"coalesce((lower(trim(\"{q}\")) like 'oui%')::int, 0)" for q in names)
    n = " + ".join(f'("{q}" is not null)::int' for q in names)
    want = sql(f"""select year({day}), avg(({pos}) / nullif({n}, 0)), sum({n})::bigint from training_cold
                   where "{V.COLD_STATUS}" = 'Complétée' and {day} is not null group by 1 order by 1""")
    assert values(tables["cold_impact"]) == approx(want)


def test_absences(tables, sql):
    events = f"""(select "{V.EMPLOYEE_CODE}" id, coalesce(num("{V.WORKED_DAYS}"), 0) d, coalesce("{V.ABSENCE_GROUP}", 'Unknown') g
                 from absenteeism where "{V.EMPLOYEE_CODE}" is not null and try_cast("{V.ABSENCE_DATE}" as date) is not null)"""
    want = sql(f"select g, sum(d) from {events} group by 1 order by 2 desc, 1")
    assert values(tables["absence_group_mix"]) == approx(want)
    want = sql(f"""with c as (select id, g, count(*) n from {events} group by all),
      m as (select id, g from c qualify row_number() over (partition by id order by n desc, g) = 1)
      select id, sum(d), count(*), any_value(m.g) from {events} e join m using (id) group by 1 order by 1""")
    assert values(tables["absence_by_employee"], "employee_id") == approx(want)


def test_finance(tables):
    got = values(tables["finance"])
    assert [r[:5] for r in got] == [(2022, 10, 100.5, -50, -1), (2023, 11, 110, -55, -2), (2024, 12, 120, -60, -3), (2025, 13, 130, -65, -4)]
    assert got[0][5:] == pytest.approx((10.05, 5.0, 0.1))


def test_training_bands(tables, sql):
    want = sql(f"""
      with h as (select "{V.EMPLOYEE_CODE}" id, sum(coalesce(num("{V.TRAINING_HOURS}"), 0)) h from training_records
                 where "Status" = 'Réalisé' and "{V.EMPLOYEE_CODE}" is not null group by 1),
      b as (select r.id, score, coalesce(h, 0) h from reviews r left join h using (id) where score is not null),
      c as (select *, case when h <= -0.1 then null when h <= 0.1 then '0h' when h <= 7 then '0.1-7h' when h <= 20 then '7-20h' else '20h+' end band from b)
      select l, avg(score), count(distinct id) from (values (0, '0h'), (1, '0.1-7h'), (2, '7-20h'), (3, '20h+')) x(o, l)
      left join c on band = l group by o, l order by o""")
    assert values(tables["training_perf_summary"]) == approx(want)


def test_kpis_agree_with_their_tables(tables):
    kpi = {r.kpi: r.value for r in tables["kpi_summary"].collect()}
    assert list(kpi) == [label.format(year=2025) for _, label, _, _ in V.KPI_ROWS]
    last = tables["monthly_headcount"].collect()[-1]
    assert kpi["Latest monthly headcount"] == last.headcount
    assert kpi["Female representation"] == pytest.approx(last.female_share * 100, abs=0.0501)
    days = sum(r.absence_days for r in tables["absence_by_employee"].collect())
    assert kpi["2025 absence days per active employee"] == pytest.approx(days / last.headcount, abs=0.00501)
    assert kpi["2025 training hours"] == [r.training_hours for r in tables["training_kpis"].collect() if r.year == 2025][0]
    assert kpi["2025 NBI per FTE"] == 10.0


def test_employee_table(spark, sources, sql):
    table = report.employee_table(sources).cache()
    ids = [r[0] for r in table.select(employee.KEY).collect()]
    assert len(ids) == len(set(ids)) == sql(f'select count(distinct trim("{V.ID_PRIMARY}")) from workforce')[0][0]
    # the row without a period is taken as the last one
    assert table.where("Employee_ID = 'E0001'").select(f"`{V.AGE_RANGE}`").first()[0] == "50-59"
    want = sql(f"""
      with s as (select distinct "{V.ID_PRIMARY}" id from workforce where "{V.ID_PRIMARY}" is not null),
      a as (select "{V.EMPLOYEE_CODE}" id, coalesce(sum(num("{V.WORKED_DAYS}")), 0) d, count(num("{V.WORKED_DAYS}")) n from absenteeism group by 1),
      t as (select "{V.EMPLOYEE_CODE}" id, coalesce(sum(greatest(num("{V.TRAINING_HOURS}"), 0)) filter (where num("{V.TRAINING_HOURS}") is not null), 0) h, count(distinct "{V.SESSION}") n,
                   count(*) filter (where lower(trim("Status")) = 'réalisé') c from training_records group by 1)
      select s.id, coalesce(d, 0), coalesce(a.n, 0), coalesce(h, 0), coalesce(t.n, 0), coalesce(c, 0)
      from s left join a using (id) left join t using (id) order by 1""")
    got = table.select(employee.KEY, *employee.FILLED[:5])
    assert values(got, employee.KEY) == approx(want)
    want = sql(f"""
      select trim("{V.WORKING_ID.strip()}"), (lower("{V.WORKING_DOCUMENT_STATUS.strip()}") like '%termin%')::int f, num("{V.REVIEW_SCORE}") s
      from (select row_number() over () r, * from performance_working) where "{V.WORKING_ID.strip()}" is not null
      qualify row_number() over (partition by trim("{V.WORKING_ID.strip()}") order by coalesce(f, 0) desc, s desc nulls last, r) = 1""")
    best = {i: (f or 0, s) for i, f, s in want}
    for r in table.select(employee.KEY, "Review_Completed_Flag", "Performance_Score_Numeric").collect():
        assert (r[1], r[2]) == best.get(r[0], (0, None))


def test_run_writes_everything(spark, folder, tmp_path):
    out = str(tmp_path / "out")
    done = report.run(spark, str(folder), out)
    assert {p.name for p in (tmp_path / "out").iterdir()} == {"tables", "employee", "analytics", "feeds", "facts", "headline"}
    assert len(list((tmp_path / "out" / "tables").iterdir())) == 13
    lines = [r[0] for r in spark.read.text(f"{out}/headline").collect()]
    assert len(lines) == 8 and lines[7] == "- 2025 NBI per FTE: 10.0 (Net banking income divided by average FTE)"
    facts = done["insight_facts"].first()
    assert facts.nbi_per_fte == "10" and facts.personnel_cost_per_fte == "5" and facts.training_rating.endswith("/5")
    wide = spark.read.option("header", True).csv(f"{out}/employee/csv")
    assert V.WORKING_UNIT in wide.columns and wide.count() == spark.read.parquet(f"{out}/employee/parquet").count()
    bands = done["training_band_summary"].collect()
    assert [b[0] for b in bands] == list(V.BAND_LABELS) and sum(b[1] for b in bands) == wide.count()
    shown = report.heads(report.saved_tables(spark, f"{out}/tables", {n: done[n] for n in ("monthly_headcount", "finance")}))
    assert {n: t.count() for n, t in shown.items()} == {"monthly_headcount": 10, "finance": 4}
    back = readers.read_csv(spark, f"{out}/tables/monthly_headcount", done["monthly_headcount"].schema)
    assert values(back) == values(done["monthly_headcount"])
    writers.save_employee_table(done["employee_indicators"], f"{out}/split", V.ENTITY_LABEL)
    assert spark.read.parquet(f"{out}/split/parquet").count() == wide.count()


def test_command_line(spark, folder, tmp_path):
    command_line([str(folder), str(tmp_path / "out")])
    assert (tmp_path / "out" / "headline" / "_SUCCESS").exists()


def test_sizing():
    small, large = sizing(10**9, 8), sizing(100 * 10**12, 4000)
    assert small == {"spark.sql.files.maxPartitionBytes": str(128 * MB), "spark.sql.shuffle.partitions": "8"}
    assert sizing(10**15, 4000, 0.5)["spark.sql.shuffle.partitions"] == str(10**15 // 2 // (256 * MB))
    assert large == {"spark.sql.files.maxPartitionBytes": "625000000", "spark.sql.shuffle.partitions": "37252"}


def test_parquet_sheets_give_the_same_results(spark, sources, tables, tmp_path):
    for name, table in sources.items():
        table.write.parquet(str(tmp_path / f"{name}.parquet"))
    again = report.kpi_tables(readers.load_sources(spark, str(tmp_path), fmt="parquet"))
    for name in ("kpi_summary", "monthly_headcount", "review_metrics", "performance_2023", "finance", "cold_impact"):
        first = tables[name].columns[0]
        assert values(again[name], first) == approx(values(tables[name], first)), name
    some = readers.load_sources(spark, str(tmp_path), fmt="parquet", names=["workforce"])
    assert list(some) == ["workforce"]


def test_bucketed_sheets_give_the_employee_table_without_a_shuffle(spark, sources):
    plain = report.employee_table(sources)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dealt = report.bucketed_sources(sources, 4)
        table = report.employee_table(dealt)
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("SortMergeJoin") == 3
        first = plain.columns[0]
        assert table.columns and sorted(table.columns) == sorted(plain.columns)
        assert values(table.select(*[f"`{c}`" for c in plain.columns]), employee.KEY) == values(plain, employee.KEY), first
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_period_filter_reaches_a_typed_workforce_scan(spark, make, tmp_path):
    rows = [(f"e{i}", None, f"2024-{1 + i % 12:02d}-01", "F", "Female", "P", "x", "30") for i in range(24)]
    names = [V.ID_PRIMARY, V.ID_BACKUP, V.PERIOD, V.COUNTRY_LABEL, V.GENDER_LABEL, V.CONTRACT_LABEL, V.ENTITY_LABEL, V.AGE_RANGE]
    df = make(", ".join(f"`{n}` string" for n in names), rows)
    df.withColumn(V.PERIOD, df[V.PERIOD].cast("date")).write.parquet(str(tmp_path / "w"))
    sheet = readers.read_table(spark, str(tmp_path / "w"))
    out = kpis.headcount_by_country(prepare.workforce(sheet))
    assert values(out) == [("F", 2, 1.0)]
    plan = out._jdf.queryExecution().toString()
    assert "EqualTo(PERIOD,ScalarSubquery" in plan and V.AGE_RANGE not in plan.split("ReadSchema")[1].split("\n")[0]


def test_indicators_on_literal_rows(make):
    df = make(f"Employee_ID string, {V.ENTITY_LABEL} string, {V.ENTRY_DATE_PREFIX}_X string, Total_Training_Hours double, Total_Absence_Days double, Review_Completed_Flag int, Performance_Score_Numeric double", [
        ("a", "P", "2010-12-31", 0.0, 20.0, 1, 3.0), ("b", "P", "2024-12-31", 8.0, 20.0, 0, 4.0),
        ("c", "P", "bad", 0.0, 1.0, 1, None), ("d", None, "2000-01-01", 7.0, 15.0, 1, 5.0), ("e", "Q", "2015-01-01", 90.0, 16.0, 1, 2.0),
    ])
    out = employee.employee_indicators(df)
    got = {r.Employee_ID: r for r in out.collect()}
    assert [got[k].Org_Fragility_Risk for k in "abcde"] == ["High Risk", "Normal", "Normal", "Normal", "High Risk"]
    assert [got[k].Training_Intensity_Band for k in "abcde"] == ["0h", "7-20h", "0h", "0.1-7h", "20h+"]
    assert [got[k].Absorptive_Capacity_Index for k in "abcde"] == pytest.approx([0.0, 3.0, 0.0, None, 90 / 91])
    assert [got[k].Training_Performance_Delta for k in "abcde"] == [0.0, 1.0, None, None, None]
    assert got["b"].Tenure_Years == pytest.approx(365 / 365.25) and got["c"].Tenure_Years is None
    assert values(employee.governance_summary(out)) == [(None, 1, 100.0, 5.0), ("Q", 1, 100.0, 2.0), ("P", 3, 66.67, 3.5)] or \
        values(employee.governance_summary(out)) == [("Q", 1, 100.0, 2.0), (None, 1, 100.0, 5.0), ("P", 3, 66.67, 3.5)]


def test_sheet_variants(make):
    plain = make("`Employee Code` string, Total_Training_Hours string, Session_ID string", [("a", "-1", "s"), ("a", "2", "s")])
    assert values(employee.training_facts(plain)) == [("a", 2.0, 1, 2)]
    with pytest.raises(KeyError):
        employee.absence_facts(plain)
    calendar = make(f"`Employee Code` string, `{V.CALENDAR_DAYS}` string", [("a", "1.5"), ("a", "x"), (None, "1")])
    assert values(employee.absence_facts(calendar)) == [("a", 1.5, 1)]
    status = make("` IUG` string, Statut string, _row long", [("a", " terminé ", 1), ("b", None, 2)])
    got = employee.review_facts(status).select("Employee_ID", "Review_Completed_Flag", "Performance_Score_Numeric")
    assert values(got, "Employee_ID") == [("a", 1, None), ("b", 0, None)]
    bare = make("` IUG` string, _row long", [("a", 1)])
    assert values(employee.review_facts(bare).select("Review_Completed_Flag")) == [(0,)]
    undated = make("`ID Employee` string, COUNTRY_GROUP string, _row long", [("a", "x", 1), ("a", "y", 2), (None, "z", 3)])
    master = employee.employee_master(undated)
    assert master.count() == 2 and employee.department_column(master) == V.COUNTRY_GROUP
    assert employee.entry_date(master) is None


def test_feeds_and_missing_years(make):
    quick = make("year int, avg_training_rating double, rating_responses long", [(2023, 4.0, 2), (2024, 4.5, 3)])
    cold = make("year int, avg_positive_impact_rate double, impact_responses long", [(2024, 0.5, 4), (2026, 0.75, 1)])
    assert values(feeds.effectiveness(quick, cold)) == [(2023, 4.0, None), (2024, 4.5, 50.0), (2026, None, 75.0)]
    mix = make("absence_group string, absence_days double", [(f"g{i}", float(i)) for i in range(10)])
    assert [r[0] for r in feeds.absence_mix(mix).collect()] == [f"g{i}" for i in range(9, 1, -1)]
    monthly = make("PERIOD string, headcount long, female_share double", [("2024-01-01", 5, 0.4), ("2025-12-01", 9, 0.5)])
    monthly = monthly.withColumn("PERIOD", monthly.PERIOD.cast("date"))
    reviews = make("country string, employees_with_reviews long, completion_rate double", [("F", 3, 1.0), ("L", 1, 0.0)])
    training = make("year int, training_hours double, trained_employees long", [(2025, 12.6, 3)])
    finance = make("year int, nbi_per_fte double, personnel_cost_per_fte double", [(2025, 325.4, 105.2)])
    facts = kpis.insight_facts(monthly, reviews, training, quick, cold, finance)
    assert values(facts) == [(5, 9, "50.0%", "13", 3, "n/a", "n/a", "75.0%", "325", "105")]


def test_results_do_not_depend_on_partitioning(sources):
    spread = {n: t.repartition(13) if "_row" in t.columns or n not in ("finance_fte",) else t for n, t in sources.items()}
    one, many = report.kpi_tables(sources), report.kpi_tables(spread)
    for name in ("review_metrics", "training_perf_summary", "performance_2023", "absence_by_employee"):
        a, b = (values(t[name], *t[name].columns[:1]) for t in (one, many))
        assert a == approx(b), name


# --- sources -------------------------------------------------------------------------------

def test_duplicate_headers_and_missing_tokens(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a, a,a,"b\u00a0""x""",\n1,N/A,3,"q ""r"", s",5\n,nan,,NULL,x\n', encoding="utf-8")
    df = readers.read_table(spark, str(tmp_path / "t.csv"), clean=False)
    assert df.columns == ["a", " a", "a.1", 'b\u00a0"x"', "Unnamed: 4"]
    assert values(df) == [("1", None, "3", 'q "r", s', "5"), (None, None, None, None, "x")]
    assert clean_columns(df).columns[3] == 'b "x"'


def test_file_ordinal_follows_file_order(spark, tmp_path):
    folder = tmp_path / "many.csv"
    folder.mkdir()
    n = 0
    for part, size in (("a", 2), ("b", 900), ("c", 30)):
        (folder / f"{part}.csv").write_text("v\n" + "".join(f"{n + i}\n" for i in range(size)))
        n += size
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        df = readers.read_table(spark, str(folder), ordinal=True)
        assert df.rdd.getNumPartitions() > 3
        assert [int(r.v) for r in df.orderBy("_row").collect()] == list(range(n))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    df.write.parquet(str(tmp_path / "p"))
    kept = readers.read_table(spark, str(tmp_path / "p"), ordinal=True)
    assert kept.select("_row").dtypes == df.select("_row").dtypes
    spark.range(20).coalesce(1).write.parquet(str(tmp_path / "q"))
    made = readers.read_table(spark, str(tmp_path / "q"), ordinal=True)
    assert [r.id for r in made.orderBy("_row").collect()] == list(range(20))


def test_given_ordinals_are_used(spark, tmp_path):
    (tmp_path / "t.csv").write_text("v,_row\nb,2\na,1\n")
    df = readers.read_table(spark, str(tmp_path / "t.csv"), ordinal=True)
    assert values(df, "_row") == [("a", 1), ("b", 2)]
    with pytest.raises(ValueError):
        readers.read_table(spark, str(tmp_path / "t.xlsx"), fmt="xlsx")


def test_read_csv_infers_types(spark, tmp_path):
    (tmp_path / "t.csv").write_text("k,v\n2023-01-01,1.5\n")
    assert [t for _, t in readers.read_csv(spark, str(tmp_path / "t.csv")).dtypes] == ["date", "double"]


def test_cold_survey_with_missing_questions(make):
    df = make("Matricule string, Date string, Status string", [("a", "1/1/2024", "Complétée")])
    assert values(prepare.training_cold(df).select("impact_answer_count", "impact_positive_rate")) == [(0, None)]


def test_line_breaks_inside_cells(spark, tmp_path):
    path = tmp_path / "sheet.csv"
    path.write_text('a,b,c\n1,"x\ny",2\n3,z,4\n')
    assert values(readers.read_table(spark, str(path), multi_line=True), "a") == [("1", "x\ny", "2"), ("3", "z", "4")]
    with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
        readers.read_table(spark, str(path)).collect()


def test_day_first_periods_are_kept(spark, make):
    sheet = make(
        f"`{V.ID_PRIMARY}` string, `{V.ID_BACKUP}` string, {V.PERIOD} string, {V.COUNTRY_LABEL} string, {V.GENDER_LABEL} string, "
        f"{V.CONTRACT_LABEL} string, {V.ENTITY_LABEL} string, `{V.AGE_RANGE}` string",
        [(str(i), None, d, None, None, None, None, None) for i, d in enumerate(("31/12/2025", "2025-12-31", "31.12.2025", "never"))],
    )
    assert [str(r.PERIOD) for r in prepare.workforce(sheet).collect()] == ["2025-12-31"] * 3


def test_two_entry_dates_are_an_error(make):
    df = make("DATE_ENTRY_GROUP string, DATE_ENTRY_FIRM string, Total_Absence_Days double", [("1990-01-01", "2020-01-01", 1.0)])
    with pytest.raises(ValueError, match="entry date"):
        employee.tenure_and_risk(df)
    named = employee.tenure_and_risk(df, "DATE_ENTRY_FIRM", "2026-01-01").first()
    assert 5.9 < named.Tenure_Years < 6.1
