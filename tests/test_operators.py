import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crewlens import vocabulary as V
from crewlens.functions.scalars import band
from crewlens.operators import columns, grouping, joins, lookup, ordered, reshape, rows, stats
from crewlens.session import shared_folder
from tests.conftest import plan_of, values

FEW = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


# --- columns -------------------------------------------------------------------------------

def test_headers(make):
    df = make("` A\u00a0b ` string, `c.d` string", [("1", "2")])
    clean = columns.clean_columns(df)
    assert clean.columns == ["A b", "c.d"]
    assert columns.rename(clean, {"A b": "x", "nope": "y"}).columns == ["x", "c.d"]
    assert columns.select_existing(clean, ["c.d", "zz"]).columns == ["c.d"]
    assert columns.first_existing(clean, ["zz", "c.d", "A b"]) == "c.d"
    with pytest.raises(KeyError):
        columns.first_existing(clean, ["zz"])
    out = clean.select(columns.column_or(clean, "c.d"), columns.column_or(clean, "zz", 1.5, "double").alias("zz"))
    assert values(out) == [("2", 1.5)]
    assert values(columns.select_positions(clean, [1, 0], ["p", "q"])) == [("2", "1")]
    assert values(columns.standardize_id(make("k string", [(" 7.0",)]), "k", "id")) == [("7",)]
    assert values(columns.to_numeric_all(make("a string, b int", [("x", 1), ("2", None)]), ["a", "b"])) == [(None, 1.0), (2.0, None)]


# --- rows ----------------------------------------------------------------------------------

def test_latest_snapshot_is_a_pushed_scalar(spark, tmp_path):
    spark.range(100).selectExpr("id", "date_add(date'2024-01-01', cast(id as int)) d").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    latest = rows.latest_snapshot(df, "d")
    assert latest.count() == 1
    plan = latest._jdf.queryExecution().toString()
    assert "EqualTo(d,ScalarSubquery" in plan and "Join" not in plan
    assert rows.latest_snapshot(df, "d", "month").count() == 9


def test_year_range_reaches_the_scan(spark, tmp_path):
    spark.range(800).selectExpr("id", "cast(date_add(date'2024-01-01', cast(id as int)) as timestamp_ntz) d").write.parquet(str(tmp_path / "t"))
    kept = spark.read.parquet(str(tmp_path / "t")).where(rows.in_year(F.col("d"), 2025))
    assert kept.count() == 365
    assert "GreaterThanOrEqual(d,2025-01-01" in kept._jdf.queryExecution().toString()


def test_review_documents(make):
    df = make("doc string, score double", [
        ("EVALUATION annuelle", None), ("Fiche Responsabilités", None), ("Autre", None), (None, None), (None, 3.0), ("Autre", 2.0),
    ])
    assert rows.review_documents(df, F.col("doc"), F.col("score"), V.DOCUMENT_KINDS).count() == 4


def test_slices_and_labels(make):
    df = make("_row long, seg string, v int", [(0, "head", 0), (3, "c", 3), (1, "a", 1), (2, "b", 2), (4, "rest", 4)])
    assert values(rows.rows_between(df, "_row", 1, 3).select("v")) == [(1,), (2,)]
    labelled = rows.labelled_rows(df, "_row", 1, V.FTE_SEGMENTS, "seg")
    assert values(labelled.select("seg", "v"), "v") == [("total", 1), ("permanent", 2), ("temporary", 3)]


def test_lookup_or(make):
    df = make("y int, v string", [(2024, "a"), (2025, None)])
    out = df.agg(*[rows.lookup_or(F.col("v"), F.col("y") == y, "n/a") for y in (2024, 2025, 2026)])
    assert values(out) == [("a", "n/a", "n/a")]


def test_latest_per_key_takes_a_missing_period_as_last(make):
    df = make("k string, p string, r long, v int", [
        ("a", "2024-01-01", 1, 1), ("a", "2024-02-01", 2, 2), ("a", "2024-02-01", 3, 3),
        ("b", None, 1, 4), ("b", "2025-01-01", 2, 5),
    ])
    assert values(rows.latest_per_key(df, ["k"], "p", "r").select("k", "v"), "k") == [("a", 3), ("b", 4)]
    kept = rows.latest_per_key(df, ["k"], "p", "r", drop_null_period=True)
    assert values(kept.select("k", "v"), "k") == [("a", 3), ("b", 5)]


def test_best_per_key_puts_missing_scores_last(make):
    df = make("k string, f int, s double, r long", [
        ("a", 0, 5.0, 1), ("a", 1, None, 2), ("a", 1, 2.0, 3), ("a", 1, 2.0, 4), ("b", 0, None, 5),
    ])
    assert values(rows.best_per_key(df, ["k"], ["f", "s"], "r").select("k", "r"), "k") == [("a", 3), ("b", 5)]


def test_one_row_per_key_is_limited_before_the_shuffle(make):
    df = make("k string, p string, r long", [("a", "x", 1)])
    plan = plan_of(rows.latest_per_key(df, ["k"], "p", "r"))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange")


def test_top_k_needs_no_full_sort(spark):
    df = spark.range(100).selectExpr("id", "id % 7 as v")
    top = rows.top_k(df, "v", 3, "id")
    assert values(top) == [(6, 6), (13, 6), (20, 6)]
    assert "TakeOrderedAndProject" in plan_of(top)


# --- grouping ------------------------------------------------------------------------------

def test_null_groups(make):
    df = make("k string, v int", [("a", 1), (None, 2)])
    assert values(grouping.group_nonnull(df, "k").count()) == [("a", 1)]


def test_group_complete(make):
    df = make("b string, id string, x double", [("0h", "p", 1.0), ("0h", "p", 3.0), ("20h+", "q", None), (None, "r", 5.0)])
    aggregates = {"n": F.count_distinct("id"), "m": F.avg("x")}
    known = [("0h", 1, 2.0), ("0.1-7h", 0, None), ("7-20h", 0, None), ("20h+", 1, None)]
    assert values(grouping.group_complete(df, "b", V.BAND_LABELS, aggregates, zero=["n"])) == known
    kept = grouping.group_complete(df, "b", V.BAND_LABELS, aggregates, zero=["n"], keep_null=True)
    assert values(kept) == [*known, (None, 1, 5.0)]


def test_totals_with_mode(make):
    df = make("k string, g string, d double, e string", [
        ("a", "x", 1.0, "1"), ("a", "y", 2.0, None), ("a", "y", None, "1"), ("a", "x", 0.5, "1"),
        ("b", None, None, "1"), ("c", None, 1.0, "1"), ("c", "z", 1.0, "1"), (None, "z", 9.0, "1"),
    ])
    out = grouping.totals_with_mode(df, "k", "g", {"days": "d"}, {"events": "e"}, "main")
    assert values(out, "k") == [("a", 3.5, 3, "x"), ("b", 0.0, 1, None), ("c", 2.0, 2, "z")]


def test_mode_of_one_hot_key_is_counted_per_category_first(make):
    plan = plan_of(grouping.totals_with_mode(make("k string, g string, d double", [("a", "x", 1.0)]), "k", "g", {"s": "d"}, {}, "m"))
    assert "hashpartitioning(k" in plan and "g#" in plan[plan.rindex("hashpartitioning"):][:80]


@FEW
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-5, 5), st.floats(-1e6, 1e6))), max_size=60))
def test_medians_equal_the_plain_median(make, data):
    df = make("g string, x double", [(g, None if x is None else float(x)) for g, x in data])
    got = dict(values(grouping.medians(df, "g", {"m": F.col("x")})))
    groups = {g for g, _ in data if g is not None}
    assert set(got) == groups
    for g in groups:
        xs = [float(x) for k, x in data if k == g and x is not None]
        assert got[g] == (pytest.approx(statistics.median(xs)) if xs else None)


@pytest.mark.parametrize("stage", [False, True])
def test_medians_of_large_and_skewed_groups(spark, stage):
    random.seed(5)
    df = spark.range(0, 60000, 1, 16).selectExpr(
        "case when id % 10 < 7 then 'hot' else concat('g', id % 10) end g",
        "cast(hash(id) as double) / 1000 x",
        "case when id % 3 = 0 then cast(pmod(hash(id, 1), 40) as double) end y",
    )
    got = {r.g: (r.mx, r.my) for r in grouping.medians(df, "g", {"mx": F.col("x"), "my": F.col("y")}, stage=stage).collect()}
    want = {r.g: (r.mx, r.my) for r in df.groupBy("g").agg(F.median("x").alias("mx"), F.median("y").alias("my")).collect()}
    assert got == want
    near = grouping.medians(df, "g", {"mx": F.col("x")}, approx=True).collect()
    assert {r.g for r in near} == set(want)


# --- joins ---------------------------------------------------------------------------------

def test_left_joins_keep_the_master_rows(make):
    master = make("k string, v int", [("a", 1), ("b", 2), (None, 3)])
    facts = make("k string, n long", [("a", 5), ("z", 9), (None, 7)])
    more = make("k string, x double", [("b", 0.5)])
    out = joins.fill_zero(joins.enrich(master, [facts, more], "k"), ["n", "x", "absent"])
    assert values(out, "v") == [("a", 1, 5, 0.0), ("b", 2, 0, 0.5), (None, 3, 0, 0.0)]


def test_enrich_shuffles_each_side_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = spark.range(1000).selectExpr("id % 50 as k", "id")
        master = rows.best_per_key(base, ["k"], ["id"], "id")
        facts = [base.groupBy("k").agg(F.sum("id").alias(f"s{i}"), F.max("id").alias(f"m{i}")) for i in range(3)]
        assert plan_of(joins.enrich(master, facts, "k")).count("Exchange hashpartitioning") == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_chain_and_outer(make):
    a = make("year int, a int", [(2023, 1), (2024, 2)])
    b = make("year int, b int", [(2024, 3), (2025, 4)])
    assert values(joins.join_on([a, b], "year")) == [(2024, 2, 3)]
    assert values(joins.full_outer(a, b, "year")) == [(2023, 1, None), (2024, 2, 3), (2025, None, 4)]


@pytest.mark.parametrize("stage", [False, True])
def test_group_medians_are_attached_to_every_row(make, stage):
    df = make("d string, h double, s double", [
        ("x", 0.0, 2.0), ("x", 4.0, 5.0), ("x", 0.0, 3.0), ("y", 1.0, 4.0), (None, 0.0, 1.0),
    ])
    wanted = {"mid": F.col("h"), "base": F.when(F.col("h") == 0, F.col("s"))}
    out = joins.with_group_medians(df, "d", wanted, stage=stage)
    assert values(out.select("d", "h", "mid", "base"), "d", "h") == [
        (None, 0.0, None, None), ("x", 0.0, 0.0, 2.5), ("x", 0.0, 0.0, 2.5), ("x", 4.0, 0.0, 2.5), ("y", 1.0, 1.0, None),
    ]


def test_hot_group_is_spread_before_its_aggregate(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(1000).selectExpr("id", "case when id % 9 < 8 then 'hot' else 'g' end g", "cast(id as double) x")
        plan = plan_of(grouping.medians(df, "g", {"m": F.col("x")}, ["id"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = plan.index("SortMergeJoin")
    assert "_salt" in plan[join:join + 120]
    # equal values are counted per task before the shuffle, and no exact percentile buffers them
    assert plan.index("partial_count(1)") < join and "percentile(" not in plan.replace("percentile_approx(", "")


@pytest.mark.parametrize("n", [1, 2, 7, 1000, 40_001])
def test_medians_narrowed_to_a_cell_are_those_of_spark(spark, n):
    df = spark.range(n).selectExpr(
        "if(id % 3 = 0, 'a', 'hot') g", "id", "cast(xxhash64(id) % 1000003 as double) x", "if(id % 5 = 0, null, floor(sqrt(id))) y",
        "case when id % 7 = 0 then 1e300 when id % 7 = 1 then -1e300 else pow(10.0D, id % 300 - 150) end z", "cast(null as double) e",
    )
    wanted = {c: F.col(c) for c in "xyze"}
    got = grouping.medians(df, "g", wanted, ["id"], most_sorted=3)
    plain = df.groupBy("g").agg(*[F.median(c).alias(c) for c in wanted])
    assert values(got, "g") == values(plain.select("g", *wanted), "g")


def test_no_task_sorts_more_than_a_cell_of_ten_million_values(spark):
    n = 10_000_000
    half = (0.5 - grouping.MARGIN) * n, (0.5 + grouping.MARGIN) * n
    inside = spark.range(n).where(F.col("id").between(*half)).selectExpr(
        "'hot' _g", "0 _i", "cast(id as double) _v", "0 _side", "1L _n"
    )
    wide, kept = grouping._middle_cells(inside, 10_000)
    assert wide.first()._values > 70_000
    # A cell has a thousandth of the values, and twice the sketch's error.
    assert 0 < kept.count() <= 2 * 80_000 * (1 / grouping.CELLS + 2 / grouping.ACCURACY)
    df = spark.range(n).selectExpr("'hot' g", "id", "cast(id as double) x")
    assert values(grouping.medians(df, "g", {"m": F.col("x")}, ["id"], most_sorted=10_000)) == [("hot", (n - 1) / 2)]


def test_salt_is_repeatable_and_even(spark):
    df = spark.range(16000).selectExpr("id", "1 as same")
    one, two = (df.select(lookup.salt_of(df, ["id"]).alias("s")).groupBy("s").count().orderBy("s").collect() for _ in range(2))
    assert one == two and len(one) == lookup.SALTS
    assert max(r["count"] for r in one) < 1200


def test_group_facts_are_joined_by_group_and_salt(make):
    df = make("g string, x int", [("a", 1), ("b", 2), ("c", 3), (None, 4)])
    facts = make("g string, f int", [("a", 10), ("b", 20), ("c", 30)])
    for stage in (False, True):
        out = lookup.join_group_facts(df, facts, "g", stage=stage)
        assert "_salt" in plan_of(out)
        assert values(out.select("g", "x", "f"), "x") == [("a", 1, 10), ("b", 2, 20), ("c", 3, 30), (None, 4, None)]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_groups_get_tasks_by_their_rows_and_cold_ones_none(spark, monkeypatch, how):
    monkeypatch.setattr(lookup, "MEASURE_FROM", 0)
    df = spark.range(60_000).selectExpr("id", "case when id % 3 = 0 then 'hot' when id % 7 = 0 then null else 'c' || id % 2000 end g")
    facts = df.where("g is not null").groupBy("g").agg(F.count("*").alias("n"))
    fans = {r.g: r._fan for r in lookup.measured_fan_out(df, "g", 500).collect()}
    assert fans == {"hot": 40}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        out = lookup.join_group_facts(df, facts, "g", how, ["id"], rows_per_task=500)
        placed = out.withColumn("task", F.spark_partition_id()).groupBy("g").agg(F.count_distinct("task").alias("t"), F.count("*").alias("n")).collect()
    finally:
        for key in ("adaptive.enabled", "autoBroadcastJoinThreshold"):
            spark.conf.unset(f"spark.sql.{key}")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    tasks = {r.g: r.t for r in placed}
    assert tasks["hot"] > 20 and all(t == 1 for g, t in tasks.items() if g not in ("hot", None))
    assert tasks.get(None, 30) > 25
    plain = df.join(facts, "g", how)
    assert out.groupBy("g").agg(F.count("*"), F.sum("n")).orderBy("g").collect() == plain.groupBy("g").agg(F.count("*"), F.sum("n")).orderBy("g").collect()
    assert sorted(out.columns) == sorted(plain.columns)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_facts_of_hot_groups_are_held_where_the_rows_are(spark, monkeypatch, how):
    monkeypatch.setattr(lookup, "MEASURE_FROM", 0)
    monkeypatch.setattr(lookup, "HELD_FROM", 500)
    df = spark.range(0, 60_000, 1, 30).selectExpr("id", "case when id % 3 = 0 then 'hot' when id % 5 = 0 then 'bare' when id % 7 = 0 then null else 'c' || id % 2000 end g")
    facts = df.where("g <> 'bare'").groupBy("g").agg(F.count("*").alias("n"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        out = lookup.join_group_facts(df, facts, "g", how, ["id"], held=True)
        hot = out.where("g = 'hot'").select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert hot == 30
    plain = df.join(facts, "g", how)
    assert out.columns == plain.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, plain.collect()))


def test_medians_of_hot_and_cold_groups(spark, monkeypatch):
    monkeypatch.setattr(lookup, "MEASURE_FROM", 0)
    monkeypatch.setattr(lookup, "HELD_FROM", 500)
    df = spark.range(0, 20_000, 1, 6).selectExpr(
        "id", "case when id % 2 = 0 then 'hot' when id % 7 = 0 then null else 'c' || id % 40 end g",
        "case when id % 11 <> 0 then cast(pmod(xxhash64(id), 3000) as double) / 8 end x",
    )
    want = {r.g: r.x for r in df.where("g is not null").groupBy("g").agg(F.median("x").alias("x")).collect()}
    for most in (None, 5):
        got = grouping.medians(df, "g", {"x": F.col("x")}, ["id"], most_sorted=most)
        assert {r.g: r.x for r in got.collect()} == want
    based = joins.with_group_medians(df, "g", {"m": F.col("x")}, ["id"])
    assert based.count() == 20_000 and {r.g: r.m for r in based.select("g", "m").distinct().collect()} == want | {None: None}


def test_shared_folder_is_required_on_a_cluster(spark, monkeypatch):
    class Cluster:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default: default)})
        sparkContext = type("Context", (), {"master": "yarn"})

    with pytest.raises(ValueError):
        shared_folder(Cluster)
    named = type("Named", (Cluster,), {"conf": type("Conf", (), {"get": staticmethod(lambda key, default: "file:/shared/tables")})})
    assert shared_folder(named) == "file:/shared/tables"


@FEW
@given(st.lists(st.floats(-5, 50), min_size=1, max_size=30))
def test_bands_cover_every_value_once(make, xs):
    df = make("x double", [(x,) for x in xs])
    banded = df.withColumn("b", band(F.col("x"), V.BAND_EDGES_KPI, V.BAND_LABELS))
    got = {r.b: r.n for r in grouping.group_complete(banded, "b", V.BAND_LABELS, {"n": F.count("*")}, ["n"], True).collect()}
    assert sum(got.values()) == len(xs) and got.get(None, 0) == sum(x <= -0.1 for x in xs)
    assert got["0.1-7h"] == sum(0.1 < x <= 7 for x in xs) and got["20h+"] == sum(x > 20 for x in xs)


@FEW
@given(st.lists(st.tuples(st.sampled_from("abc"), st.one_of(st.none(), st.integers(0, 3))), min_size=1, max_size=30))
def test_one_row_per_key_is_the_first_in_order(make, cells):
    data = [(k, v, i) for i, (k, v) in enumerate(cells)]
    df = make("k string, v int, r long", data)
    got = dict((k, r) for k, _, r in values(rows.best_per_key(df, ["k"], ["v"], "r")))
    want = {}
    for k, v, r in sorted(data, key=lambda d: (d[1] is None, -(d[1] or 0), d[2])):
        want.setdefault(k, r)
    assert got == want
    master = df.select("k").distinct()
    assert joins.enrich(master, [rows.best_per_key(df, ["k"], ["v"], "r")], "k").count() == len(want)


# --- row order -----------------------------------------------------------------------------

def filled_by_hand(data):
    last = {}
    out = []
    for key, pos, v in sorted(data, key=lambda r: r[1]):
        if v is not None:
            last[key] = v
        out.append((key, pos, v, last.get(key)))
    return out


@FEW
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.sampled_from("xyz"))), min_size=1, max_size=40),
       st.integers(1, 9), st.booleans(), st.booleans())
def test_forward_fill_equals_a_loop(make, cells, block, keyed, small):
    data = [(k, i * 3, v) for i, (k, v) in enumerate(cells)]
    shuffled = random.Random(3).sample(data, len(data))
    df = make("k string, p long, v string", shuffled)
    out = ordered.forward_fill(df, "v", "p", "f", ["k"] if keyed else [], block, 1 << 63 if small else 0)
    want = filled_by_hand(data) if keyed else [(k, p, v, f) for (k, p, v), (_, _, _, f) in zip(
        data, filled_by_hand([(None, p, v) for _, p, v in data]))]
    assert values(out, "p") == want


def test_forward_fill_of_a_file_ordinal(make):
    df = make("_row struct<part:string,seq:long>, v string", [
        (("f1", 0), "a"), (("f1", 5), None), (("f2", 0), None), (("f2", 1), "b"), (("f3", 0), None),
    ])
    out = ordered.forward_fill(df, "v", "_row", "f", rows=2)
    assert [r.f for r in out.orderBy("_row").collect()] == ["a", "a", "a", "b", "b"]


def test_row_blocks_need_an_ordinal(make):
    with pytest.raises(TypeError):
        ordered.row_levels(make("d double", [(1.0,)]), "d")
    big = (1 << 60) + 5
    df = make("i long", [(big,), (-1,)])
    assert values(df.select(ordered.row_levels(df, "i", 4)[0])) == [(big - 1,), (-4,)]


@pytest.mark.parametrize("one_level_up_to", [0, 1 << 20])
def test_forward_fill_sends_only_the_widest_blocks_to_one_task(spark, one_level_up_to):
    df = spark.range(100).selectExpr("id", "nullif(id % 5, 1) v")
    plan = plan_of(ordered.forward_fill(df, "v", "id", "f", one_level_up_to=one_level_up_to))
    single = plan.index("SinglePartition")
    assert "max_by" in plan[single:single + 900]
    assert plan.count("SinglePartition") == 1


# --- reshaping and statistics --------------------------------------------------------------

def test_melt_and_metric_columns(make):
    wide = make("m string, `2022` string, `2023` double", [("nbi", "1.5", 2.0), ("cost", "x", -1.0), ("other", "9", 9.0)])
    long = reshape.melt(wide, ["m"], ["2022", "2023"], "year", "value")
    assert values(long, "m", "year") == [
        ("cost", "2022", None), ("cost", "2023", -1.0), ("nbi", "2022", 1.5), ("nbi", "2023", 2.0), ("other", "2022", 9.0), ("other", "2023", 9.0),
    ]
    names = {"nbi": "n", "cost": "c"}
    assert values(reshape.metric_columns(long, "year", "m", "value", names), "year") == [("2022", 1.5, None), ("2023", 2.0, -1.0)]
    assert reshape.metric_columns(long, "year", "m", "value", {"nbi": "n", "absent": "a"}).count() == 0


def test_data_quality(make):
    df = make("a string, `b.c` double, d int", [("x", None, 1), (None, None, 1), ("x", 1.0, 1)])
    assert values(stats.data_quality(df)) == [("b.c", 2, 66.67), ("a", 1, 33.33), ("d", 0, 0.0)]


def test_corr_matrix(make):
    df = make("a string, b double, c double", [("1", 2.0, 1.0), ("2", 4.0, 1.0), ("x", 9.0, 1.0), ("3", 7.0, None)])
    got = {(r.x, r.y): r.r for r in stats.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert len(got) == 9 and got["a", "b"] == got["b", "a"] == pytest.approx(0.9933992677987828)
    assert got["a", "a"] == pytest.approx(1.0) and got["c", "c"] is None and got["a", "c"] is None


def test_histogram_edges(make):
    df = make("x double, g string", [(0.0, "p"), (3.0, "p"), (1.0, "q"), (2.9999, "q"), (None, "q")])
    assert values(stats.histogram_by(df, "x", "g", 3).select("bin", "g", "n"), "bin", "g") == [
        (1, "p", 1), (2, "q", 1), (3, "p", 1), (3, "q", 1),
    ]
    flat = make("x double, g string", [(2.0, "p"), (2.0, "p")])
    assert values(stats.histogram_by(flat, "x", "g", 30).select("bin", "n")) == [(1, 2)]
    assert stats.histogram_by(flat.where("false"), "x", "g", 30).count() == 0


def test_profile_counts(make):
    a, b = make("x int", [(1,), (2,)]), make("x int, y int", [])
    assert values(stats.profile_counts({"a": a, "b": b}), "name") == [("a", 2, 1), ("b", 0, 2)]


def test_unknown_labels_count_as_missing(make):
    df = make("band string, x int", [("low", 1), ("odd", 2), (None, 3), ("low", 4)])
    n = {"n": F.count(F.lit(1))}
    assert values(grouping.group_complete(df, "band", ["low", "high"], n, ["n"])) == [("low", 2), ("high", 0)]
    kept = grouping.group_complete(df, "band", ["low", "high"], n, ["n"], keep_null=True)
    assert values(kept) == [("low", 2), ("high", 0), (None, 2)]


def test_equal_metrics_give_a_row_each(make):
    long = make("year string, m string, value double", [("2022", "c", -10.0), ("2022", "c", -3.0), ("2022", "n", 5.0)])
    wide = reshape.metric_columns(long, "year", "m", "value", {"n": "nbi", "c": "cost"})
    assert values(wide, "cost") == [("2022", 5.0, -10.0), ("2022", 5.0, -3.0)]


def test_same_names_on_both_sides(make):
    left = make("k string, a int", [("x", 1), ("y", 2)])
    right = make("k string, a int", [("x", 3)])
    out = joins.enrich(left, [right], "k")
    assert out.columns == ["k", "a_x", "a_y"] and values(out, "k") == [("x", 1, 3), ("y", 2, None)]


def test_forward_fill_of_sparse_ordinals(make):
    step = (1 << 40) + 12345
    rows = [(i * step, str(i) if i % 7 == 3 else None) for i in range(-40, 60)]
    out = ordered.forward_fill(make("o long, v string", rows).repartition(5), "v", "o", "f", rows=1 << 20)
    last, want = None, {}
    for o, v in rows:
        last = v or last
        want[o] = last
    assert {r.o: r.f for r in out.collect()} == want


def test_median_of_many_distinct_values(spark):
    df = spark.range(400_001).selectExpr("'g' AS g", "CAST(id * id % 1000003 AS double) AS v", "id")
    want = df.agg(F.median("v")).first()[0]
    assert grouping.medians(df, "g", {"v": F.col("v")}, ["id"]).first().v == want
