"""Result sets that appear as a whole, date layouts of whole columns, and bitmaps of heads."""

import pytest
from pyspark.sql import functions as F

from crewlens import vocabulary as V
from crewlens.operators import dates
from crewlens.plans import employee, report
from crewlens.sources import publish
from tests.conftest import values
from tests.dirty import generate


def test_a_run_killed_between_two_tables_leaves_the_former_version(spark, make, tmp_path):
    out = str(tmp_path / "out")
    good = {"a": make("x long", [(1,), (2,)]), "b": make("y string", [("old",)])}
    assert publish.publish(spark, out, good).version == 1
    broken = {"a": make("x long", [(3,)]), "b": make("y string", [("new",)]).select(F.raise_error(F.lit("killed")).cast("string").alias("y"))}
    with pytest.raises(Exception, match="killed"):
        publish.publish(spark, out, broken)
    read = publish.read_published(spark, out, check=True)
    assert values(read["a"], "x") == [(1,), (2,)] and values(read["b"]) == [("old",)]
    # The next run does not take the broken one's folder.
    third = publish.publish(spark, out, {"a": make("x long", [(5,)])})
    assert third.version == 3 and list(publish.read_published(spark, out)) == ["a"]
    assert publish.current(spark, out).tables["a"]["rows"] == 1


def test_old_versions_go_and_lost_rows_are_noticed(spark, make, tmp_path):
    out = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        publish.current(spark, out)
    for i in range(4):
        publish.publish(spark, out, {"t": make("x long, s string", [(i, 'q "r",\n')] * 3)}, fmt="csv" if i == 3 else "parquet", single=["t"], keep=2)
    assert sorted(p.name for p in (tmp_path / "out" / "versions").iterdir()) == ["00000003", "00000004"]
    with pytest.raises(Exception, match="rows|MALFORMED"):
        publish.read_published(spark, out, check=True)["t"].collect()


def test_a_started_version_is_not_taken_twice(spark, make, tmp_path):
    out = str(tmp_path / "out")
    first, second = publish.begin(spark, out), publish.begin(spark, out)
    assert (first[0], second[0]) == (1, 2)
    with pytest.raises(FileNotFoundError):
        publish.current(spark, out)


def test_report_as_a_version(spark, tmp_path):
    folder, out = generate(tmp_path / "in", employees=30), str(tmp_path / "out")
    report.run(spark, str(folder), out, options=report.Options(versions=1))
    tables = publish.read_published(spark, out, check=True)
    assert {"tables/monthly_headcount", "feeds/training_vs_performance", "employee/parquet", "headline"} <= set(tables)
    assert tables["tables/monthly_headcount"].count() == 24


# --- date layouts --------------------------------------------------------------------------

def test_later_rows_decide_the_layout_of_a_column(spark, make):
    rows = [(f"0{i % 9 + 1}/0{i % 8 + 1}/2025", f"0{i % 9 + 1}/0{i % 8 + 1}/2025") for i in range(300)]
    rows += [("13/06/2025", "06/13/2025"), ("2025-02-03", None), (" 1/2/2025 ", "never")]
    df = make("d string, m string", rows).repartition(6)
    assert dates.column_layouts(df, ["d", "m", "none"]) == {"d": "day first", "m": "month first"}
    read = dates.with_dates(df.where("d like '%1/2/2025%' or m = '06/13/2025'"), ["d", "m"])
    got = {(r.d and str(r.d)[:10], r.m and str(r.m)[:10]) for r in dates.with_dates(df, ["d", "m"]).where("m is null or month(m) = 6").collect()}
    assert ("2025-06-13", "2025-06-13") in got and ("2025-02-01", None) in got and ("2025-02-03", None) in got
    assert read.count() == 2


def test_a_column_that_nothing_decides_is_an_error_that_names_it(make):
    df = make("a string, b string", [("05/06/2025", "06/06/2025"), ("01/02/2024", "07/07/2025")])
    with pytest.raises(ValueError, match="'a' .*day first.*month first.*01/02/2024"):
        dates.column_layouts(df, ["a", "b"])
    assert dates.column_layouts(df, ["a", "b"], default="month first") == {"a": "month first", "b": "month first"}
    # Equal under both readings, or without values: nothing to decide.
    assert dates.column_layouts(df, ["b"]) == {"b": "day first"}
    assert dates.column_layouts(make("a string, t date", [(None, None)]), ["a", "t"]) == {"a": "day first"}
    assert dates.column_layouts(make("t date", []), ["t"]) == {}


def test_own_layout_reaches_the_employee_table(make):
    names = [V.ID_PRIMARY, V.PERIOD, V.ENTITY_LABEL, "DATE_ENTRY_FIRM"]
    staff = make(", ".join(f"`{n}` string" for n in names) + ", _row long", [
        ("e", "2025.12.31", "new", "1990.01.02", 0), ("e", "2025.11.30", "old", "1990.01.02", 1),
    ])
    formats = ("yyyy.MM.dd",)
    latest = employee.employee_master(staff, formats=formats).first()
    assert latest[V.ENTITY_LABEL] == "new" and str(latest[V.PERIOD]) == "2025-12-31"
    table = employee.employee_master(staff, formats=formats).withColumn("Total_Absence_Days", F.lit(1.0))
    assert employee.tenure_and_risk(table, formats=formats).first().Tenure_Years == pytest.approx(36.0, abs=0.01)


def test_report_with_layouts_of_whole_columns(spark, tmp_path):
    folder = generate(tmp_path / "in", employees=20)
    text = (folder / "absenteeism.csv").read_text(encoding="utf-8")
    import re

    swapped = re.sub(r"2025-(\d\d)-10", lambda m: f"{m[1]}/{13 if m[1] == '03' else 10}/2025", text)
    (folder / "absenteeism.csv").write_text(swapped, encoding="utf-8")
    from crewlens.sources.readers import load_sources

    sources = load_sources(spark, str(folder))
    options = report.with_column_dates(sources, report.Options())
    assert options.formats("absenteeism", V.ABSENCE_DATE) == dates.MONTH_FIRST_FORMATS
    n = sources["absenteeism"].where(F.col(f"`{V.ABSENCE_DATE}`").like("%/%")).where(F.col(f"`{V.EMPLOYEE_CODE}`").isNotNull()).count()
    assert report.kpi_tables(sources, options=options)["absence_by_employee"].agg(F.sum("absence_events")).first()[0] == n


# --- bitmaps of heads ----------------------------------------------------------------------

def test_every_roll_up_of_one_bitmap_table_equals_distinct_counts(spark):
    from crewlens.operators import heads

    df = spark.range(90_000).selectExpr(
        "if(id % 11 = 0, null, cast(xxhash64(id) % 50000 as string)) who", "make_date(2023 + id % 3, 1 + id % 12, 1) month",
        "case when id % 3 < 2 then 'hot' when id % 7 = 0 then null else 'c' || id % 5 end country",
    )
    bitmaps = heads.head_bitmaps(df, "who", ["month", "country"]).cache()
    year = F.year("month").alias("year")
    for keys, plain in ((["month"], ["month"]), (["country"], ["country"]), ([year], [year]), ([year, "country"], [year, "country"]), ([], [])):
        got = heads.head_counts(bitmaps, keys)
        want = df.where("who is not null").groupBy(*plain).agg(F.count_distinct("who").alias("heads"))
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr), keys
    again = heads.head_counts(heads.rolled_up(heads.rolled_up(bitmaps, ["month"]), [year]), ["year"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, heads.head_counts(bitmaps, [year]).collect()))
    assert bitmaps.groupBy("month", "country").count().agg(F.max("count")).first()[0] >= 2
    bitmaps.unpersist()


def test_bitmaps_of_nothing(make):
    from crewlens.operators import heads

    empty = heads.head_bitmaps(make("who string, g string", [(None, "x")]), "who", ["g"])
    assert heads.head_counts(empty, ["g"]).collect() == [] and heads.head_counts(empty, []).first().heads == 0
