"""One query per operator or function family that the named results do not isolate."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crewlens import vocabulary as V
from crewlens.functions import aggregates as A
from crewlens.functions import parsing as P
from crewlens.functions import scalars as S
from crewlens.operators import columns, grouping, joins, ordered, reshape, rows, stats
from crewlens.plans import feeds, kpis, prepare
from gate import sheets
from gate.registry import query
from gate.results import (
    COLD, FINANCE, MONTHLY, PLACED, QUICK, QUICK_SCORES, REVIEW_METRICS, REVIEWS, TRAINING, TRAINING_KPIS,
)
from gate.sheets import table

# --- Sources and columns -------------------------------------------------------------------


TABLES = {
    "region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11, "events": 6,
    "documents": 5, "embeddings": 3, "pages": 3, "benchmark": 2, "labels": 3, "conversations": 4,
}


@query("profile_counts", " union all ".join(
    f"select '{n}' as name, count(*) n_rows, cast({c} as bigint) n_cols from {n}" for n, c in TABLES.items()))
def profile_counts(spark: SparkSession, sf: str) -> DataFrame:
    return stats.profile_counts({n: spark.read.parquet(f"{sf}/{n}.parquet") for n in TABLES})


@query("schema_drift", """
select cast(o_custkey as varchar) "Employee_ID", o_totalprice amount, o_orderstatus status, null as entity,
       'none' as channel, cast(2023 as bigint) as year
from orders""")
def schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    odd = table(spark, sf, "orders").toDF("key", " o_custkey", "Statut doc ", "amount", "date", "priority")
    clean = columns.clean_columns(odd)
    keyed = columns.standardize_id(clean, "o_custkey", "Employee_ID")
    named = columns.rename(keyed, {columns.first_existing(keyed, ["Statut", "Statut doc"]): "status", "absent": "x"})
    extended = named.select(
        "*",
        columns.column_or(named, "entity").alias("entity"),
        columns.column_or(named, "channel", "none").alias("channel"),
        F.lit(2023).alias("year"),
    )
    return columns.select_existing(
        extended, ["Employee_ID", "amount", "status", "missing", "entity", "channel", "year"]
    )


@query("select_positions", "select o_orderkey as k, o_orderstatus as s, o_orderpriority as p from orders")
def select_positions(spark: SparkSession, sf: str) -> DataFrame:
    return columns.select_positions(table(spark, sf, "orders"), [0, 2, 5], ["k", "s", "p"])


@query("numeric_columns", """
select cast(o_orderkey as double) o_orderkey, try_cast(o_orderstatus as double) o_orderstatus,
       round(o_totalprice, 4) o_totalprice
from orders""")
def numeric_columns(spark: SparkSession, sf: str) -> DataFrame:
    return columns.to_numeric_all(table(spark, sf, "orders"), ["o_orderkey", "o_orderstatus", "o_totalprice"])


# --- Rows ----------------------------------------------------------------------------------


@query("year_filter", """
select cast(year(o_orderdate) as bigint) as year, count(*) n from orders where year(o_orderdate) = 1997 group by 1""")
def year_filter(spark: SparkSession, sf: str) -> DataFrame:
    kept = table(spark, sf, "orders").where(rows.in_year(F.col("o_orderdate"), 1997))
    return kept.groupBy(F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("n"))


@query("lookup_or_default", """
select coalesce((select max(n_name) from nation where n_nationkey = 3), 'n/a') found,
       coalesce((select max(n_name) from nation where n_nationkey = 99), 'n/a') absent""")
def lookup_or_default(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("n_nationkey")
    return table(spark, sf, "nation").agg(
        rows.lookup_or(F.col("n_name"), key == 3, V.NOT_AVAILABLE).alias("found"),
        rows.lookup_or(F.col("n_name"), key == 99, V.NOT_AVAILABLE).alias("absent"),
    )


@query("row_slice", """
select o_orderkey, o_custkey, case o_orderkey when 1 then 'total' when 2 then 'permanent' else 'temporary' end segment
from orders where o_orderkey between 1 and 3""")
def row_slice(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.col("o_orderstatus").alias("segment"))
    return rows.labelled_rows(orders, "o_orderkey", V.FTE_FIRST_ROW, V.FTE_SEGMENTS, "segment")


@query("drop_missing", """
select o_orderkey, flag from (select o_orderkey, o_custkey, nullif(o_orderstatus, 'P') flag from orders)
where flag is not null""")
def drop_missing(spark: SparkSession, sf: str) -> DataFrame:
    flag = F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("flag")
    return rows.drop_missing(table(spark, sf, "orders").select("o_orderkey", flag), "flag")


@query("latest_per_key", """
select o_custkey, o_orderkey, o_orderstatus, d from (
  select *, case when o_orderpriority like '5%' then null else cast(o_orderdate as date) end d from orders)
qualify row_number() over (partition by o_custkey order by d desc nulls first, o_orderkey desc) = 1""")
def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    dated = F.when(F.col("o_orderpriority") < "5", F.col("o_orderdate").cast("date"))
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", dated.alias("d"))
    return rows.latest_per_key(orders, ["o_custkey"], "d", "o_orderkey")


@query("best_per_key", """
select o_custkey, o_orderkey, done, score from (
  select *, cast(o_orderstatus = 'F' as bigint) done,
         case when o_orderpriority < '5' then cast(substr(o_orderpriority, 1, 1) as double) end score from orders)
qualify row_number() over (partition by o_custkey order by done desc, score desc nulls last, o_orderkey) = 1""")
def best_per_key(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        "o_custkey",
        "o_orderkey",
        (F.col("o_orderstatus") == "F").cast("int").alias("done"),
        F.when(F.col("o_orderpriority") < "5", P.parse_num(sheets.priority())).alias("score"),
    )
    return rows.best_per_key(orders, ["o_custkey"], ["done", "score"], "o_orderkey")


@query("top_k", """
select n_name, round(sum(cast(o_totalprice as decimal(18, 2))), 2)::double total from """ + PLACED + """
group by n_name order by total desc, n_name limit 8""", digits=2)
def top_k(spark: SparkSession, sf: str) -> DataFrame:
    totals = sheets.orders_of_customers(spark, sf).groupBy("n_name").agg(A.sum0(F.col("o_totalprice")).alias("total"))
    return rows.top_k(totals, "total", 8, "n_name")


@query("sort_and_head", """
select o_orderkey, score, o_totalprice from (
  select *, case when o_orderpriority < '5' then cast(substr(o_orderpriority, 1, 1) as double) end score from orders)
order by score desc nulls last, o_totalprice desc, o_orderkey limit 10""")
def sort_and_head(spark: SparkSession, sf: str) -> DataFrame:
    score = F.when(F.col("o_orderpriority") < "5", P.parse_num(sheets.priority())).alias("score")
    orders = table(spark, sf, "orders").select("o_orderkey", score, "o_totalprice")
    return rows.first_rows(orders, ["score", "o_totalprice"], 10, "o_orderkey")


# --- Joins ---------------------------------------------------------------------------------


@query("left_join_fill_zero", """
select c_custkey, coalesce(n, 0) n, round(coalesce(total, 0), 4) total
from customer left join (select user_id, count(*) n, sum(value) total from events group by 1) on c_custkey = user_id""")
def left_join_fill_zero(spark: SparkSession, sf: str) -> DataFrame:
    facts = table(spark, sf, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n"), A.sum0(F.col("value")).alias("total")
    )
    joined = joins.enrich(table(spark, sf, "customer").select("c_custkey"), [facts], "c_custkey")
    return joins.fill_zero(joined, ["n", "total", "not_there"])


@query("inner_join_chain", """
with f as (select year(o_orderdate) y, count(*) n_f from orders where o_orderstatus = 'F' group by 1),
o as (select year(o_orderdate) y, count(*) n_o from orders where o_orderstatus = 'O' group by 1),
p as (select year(o_orderdate) y, count(*) n_p from orders where o_orderstatus = 'P' group by 1)
select cast(y as bigint) as year, n_f, n_o, n_p from f join o using (y)
join (select * replace (y + 2 as y) from p) using (y)""")
def inner_join_chain(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    parts = [
        orders.where(F.col("o_orderstatus") == s).groupBy("year").agg(F.count(F.lit(1)).alias(f"n_{s.lower()}"))
        for s in ("F", "O", "P")
    ]
    # two years apart, so that some years miss on one side
    parts[2] = parts[2].withColumn("year", F.col("year") + 2)
    return joins.join_on(parts, "year")


@query("scalar_aggregates", """
select max(o_orderdate)::date as last_day, round(avg(o_totalprice), 2) mean_price,
       round(sum(cast(o_totalprice as decimal(18, 2)))::double / (select count(distinct o_custkey) from orders), 2) per_head
from orders""", digits=2)
def scalar_aggregates(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    heads = orders.agg(F.count_distinct("o_custkey"))
    total = orders.agg(
        F.max("o_orderdate").cast("date").alias("last_day"),
        F.avg("o_totalprice").alias("mean_price"),
        A.sum0(F.col("o_totalprice")).alias("total"),
    )
    return total.select("last_day", "mean_price", S.ratio(F.col("total"), heads.scalar()).alias("per_head"))


@query("group_baseline", f"""
with base as (
  select n_name, median(o_totalprice) mid, median(o_totalprice) filter (where o_orderstatus = 'F') base
  from {PLACED} group by n_name)
select o_orderkey, round(mid, 4) mid, round(o_totalprice - base, 4) delta,
       round(least(greatest(o_totalprice / (mid + 1), 0), 3), 4) idx
from {PLACED} join base using (n_name)""")
def group_baseline(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("o_totalprice")
    wanted = {"mid": price, "base": F.when(F.col("o_orderstatus") == "F", price)}
    based = joins.with_group_medians(sheets.orders_of_customers(spark, sf), "n_name", wanted, ["o_orderkey"])
    index = S.clip(S.ratio(price, F.col("mid") + 1), *V.INDEX_RANGE)
    return based.select("o_orderkey", "mid", (price - F.col("base")).alias("delta"), index.alias("idx"))


# --- Aggregates ----------------------------------------------------------------------------


@query("aggregate_rules", f"""
select n_name, round(sum(o_totalprice) filter (where o_orderstatus = 'F'), 4) sum_f,
       coalesce(round(sum(o_totalprice) filter (where o_orderstatus = 'X'), 4), 0.0) sum_none,
       count(*) filter (where o_orderstatus = 'F') n_f, count(nullif(o_orderstatus, 'P')) n_known,
       round(avg(case when o_orderstatus = 'P' then null else o_totalprice end), 4) avg_known,
       round(avg(case when nullif(o_orderstatus, 'P') = 'F' then 1.0 else 0.0 end), 4) share_f,
       round(sum(o_totalprice * o_orderkey) / sum(o_orderkey), 4) weighted,
       round(sum(o_totalprice) / count(distinct o_custkey), 4) per_head,
       arg_max(o_orderstatus, (o_orderdate, o_orderkey)) last_status,
       arg_min(o_orderstatus, (o_orderdate, o_orderkey)) first_status
from {PLACED} group by 1""")
def aggregate_rules(spark: SparkSession, sf: str) -> DataFrame:
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    known = F.nullif(status, F.lit("P"))
    when = F.struct("o_orderdate", "o_orderkey")
    return sheets.orders_of_customers(spark, sf).groupBy("n_name").agg(
        A.sum0(F.when(status == "F", price)).alias("sum_f"),
        A.sum0(F.when(status == "X", price)).alias("sum_none"),
        F.count_if(status == "F").alias("n_f"),
        F.count(known).alias("n_known"),
        F.avg(F.when(known.isNotNull(), price)).alias("avg_known"),
        A.share(known == "F").alias("share_f"),
        A.weighted_mean(price, F.col("o_orderkey")).alias("weighted"),
        A.sum_per_distinct("o_totalprice", F.col("o_custkey")).alias("per_head"),
        A.at_latest(status, when).alias("last_status"),
        A.at_first(status, when).alias("first_status"),
    )


@query("null_keys", """
with s as (select nullif(o_orderstatus, 'P') k, o_custkey from orders)
select 'kept' as rule, k, count(distinct o_custkey) n from s group by k
union all select 'dropped', k, count(distinct o_custkey) from s where k is not null group by k""")
def null_keys(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("k"), "o_custkey")
    n = F.count_distinct("o_custkey").alias("n")
    kept = orders.groupBy("k").agg(n).select(F.lit("kept").alias("rule"), "k", "n")
    dropped = grouping.group_nonnull(orders, "k").agg(n).select(F.lit("dropped").alias("rule"), "k", "n")
    return kept.unionByName(dropped)


@query("group_mode", """
select l_partkey, mode_flag, round(days, 4) as days, events from (
  select l_partkey, l_returnflag mode_flag, sum(sum(l_quantity)) over p as days, cast(sum(count(*)) over p as bigint) events,
         row_number() over (partition by l_partkey order by count(*) desc, l_returnflag) r
  from lineitem group by l_partkey, l_returnflag window p as (partition by l_partkey))
where r = 1""")
def group_mode(spark: SparkSession, sf: str) -> DataFrame:
    return grouping.totals_with_mode(
        table(spark, sf, "lineitem"),
        "l_partkey",
        "l_returnflag",
        sums={"days": "l_quantity"},
        counts={"events": "l_orderkey"},
        mode="mode_flag",
    )


@query("group_median", """
select l_returnflag, round(median(l_extendedprice), 4) price, median(l_quantity) quantity, median(l_discount) discount
from lineitem group by 1""")
def group_median(spark: SparkSession, sf: str) -> DataFrame:
    values = {"price": F.col("l_extendedprice"), "quantity": F.col("l_quantity"), "discount": F.col("l_discount")}
    return grouping.medians(table(spark, sf, "lineitem"), "l_returnflag", values, ["l_orderkey", "l_partkey"])


@query("group_by_derived_year", """
select cast(year(o_orderdate) as bigint) as year, count(distinct o_custkey) heads from orders group by 1""")
def group_by_derived_year(spark: SparkSession, sf: str) -> DataFrame:
    heads = {"heads": F.count_distinct("o_custkey")}
    return grouping.by_year(table(spark, sf, "orders"), F.col("o_orderdate"), heads)


@query("parse_period", """
select o_orderkey, cast(o_orderdate as date) as day from orders""")
def parse_period(spark: SparkSession, sf: str) -> DataFrame:
    day, status = F.col("o_orderdate"), F.col("o_orderstatus")
    text = (
        F.when(status == "F", F.date_format(day, "d/M/yyyy"))
        .when(status == "O", F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format(day, "dd.MM.yyyy"))
    )
    orders = table(spark, sf, "orders").select("o_orderkey", text.alias("day"))
    return orders.select("o_orderkey", P.date_of(orders, "day").alias("day"))


@query("source_quality", """
select 'day' as "column", count(*) n_rows, count(*) n_given, count(*) filter (where o_orderstatus = 'P') n_unreadable from orders
union all
select 'score', count(*), count(*) filter (where o_orderstatus <> 'O'), count(*) filter (where o_orderstatus = 'F') from orders""")
def source_quality(spark: SparkSession, sf: str) -> DataFrame:
    status = F.col("o_orderstatus")
    day = F.when(status == "P", F.lit("soon")).otherwise(F.date_format("o_orderdate", "d/M/yyyy"))
    score = F.when(status == "F", F.lit("4,5")).when(status == "P", F.lit(" 3 "))
    sheet = table(spark, sf, "orders").select(day.alias("day"), score.alias("score"))
    return stats.unreadable(sheet, {"day": P.date_of(sheet, "day"), "score": P.num_of(sheet, "score")})


@query("line_statistics", """
select l_returnflag, round(regr_slope(y, x), 4) slope, round(regr_intercept(y, x), 2) intercept,
       round(regr_r2(y, x), 4) r2, cast(regr_count(y, x) as bigint) n
from (select l_returnflag, l_quantity x, case when l_linestatus = 'F' then l_tax * 1000 end y from lineitem) group by 1""")
def line_statistics(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        "l_returnflag",
        F.col("l_quantity").alias("x"),
        F.when(F.col("l_linestatus") == "F", F.col("l_tax") * 1000).alias("y"),
    )
    fitted = stats.ols_by(lines, "l_returnflag", "x", "y")
    return fitted.withColumn("intercept", F.round("intercept", 2))


@query("pairwise_correlation", """
with t as (select case when l_returnflag <> 'A' then l_quantity end q, l_extendedprice p,
                  case when l_linestatus = 'F' then l_discount end d from lineitem)
select * from (""" + " union all ".join(
    f"select '{a}' x, '{b}' y, round(corr({a}, {b}), 4) r from t" for a in ("q", "p", "d") for b in ("q", "p", "d")
) + ")")
def pairwise_correlation(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        F.when(F.col("l_returnflag") != "A", F.col("l_quantity")).alias("q"),
        F.col("l_extendedprice").alias("p"),
        F.when(F.col("l_linestatus") == "F", F.col("l_discount")).alias("d"),
    )
    return stats.corr_matrix(lines, ["q", "p", "d"])


@query("price_histogram", """
with ends as (select min(l_extendedprice) lo, max(l_extendedprice) hi from lineitem),
placed as (select l_returnflag, lo, hi, cast(least(floor((l_extendedprice - lo) * 30 / (hi - lo)), 29) + 1 as bigint) bin
           from lineitem, ends)
select bin, round(lo + (bin - 1) * (hi - lo) / 30, 4) bin_start, round(lo + bin * (hi - lo) / 30, 4) bin_end,
       l_returnflag, count(*) n
from placed group by all""")
def price_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return stats.histogram_by(table(spark, sf, "lineitem"), "l_extendedprice", "l_returnflag", V.HISTOGRAM_BINS)


# --- Row order -----------------------------------------------------------------------------


@query("forward_fill", """
select o_orderkey, last_value(case when o_orderpriority like '1%' then o_orderstatus end ignore nulls)
  over (order by o_orderkey rows between unbounded preceding and current row) filled
from orders""")
def forward_fill(spark: SparkSession, sf: str) -> DataFrame:
    seen = F.when(F.col("o_orderpriority") < "2", F.col("o_orderstatus")).alias("seen")
    orders = table(spark, sf, "orders").select("o_orderkey", seen)
    return ordered.forward_fill(orders, "seen", "o_orderkey", "filled", rows=1000).drop("seen")


@query("forward_fill_by_key", """
select o_custkey, o_orderkey, last_value(case when o_orderpriority like '1%' then o_orderstatus end ignore nulls)
  over (partition by o_custkey order by o_orderkey rows between unbounded preceding and current row) filled
from orders""")
def forward_fill_by_key(spark: SparkSession, sf: str) -> DataFrame:
    seen = F.when(F.col("o_orderpriority") < "2", F.col("o_orderstatus")).alias("seen")
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", seen)
    return ordered.forward_fill(orders, "seen", "o_orderkey", "filled", ["o_custkey"], rows=1000).drop("seen")


@query("performance_2023", """
select o_custkey employee_id, country, cast(2023 as bigint) as year,
       case when o_orderstatus <> 'O' then cast(substr(o_orderpriority, 1, 1) as double) end performance_score
from (select *, last_value(case when o_orderpriority like '1%' then o_orderstatus end ignore nulls)
        over (order by o_orderkey rows between unbounded preceding and current row) country from orders)""")
def performance_2023(spark: SparkSession, sf: str) -> DataFrame:
    sheet = table(spark, sf, "orders").select(
        F.when(F.col("o_orderpriority") < "2", F.col("o_orderstatus")).alias(V.REVIEW_COUNTRY_2023),
        F.col("o_custkey").alias(V.REVIEW_ID),
        F.when(F.col("o_orderstatus") != "O", sheets.priority()).otherwise(F.lit("N/A")).alias(V.REVIEW_SCORE_2023),
        F.col("o_orderkey").alias("_row"),
    )
    return prepare.performance_2023(sheet)


# --- Reshaping -----------------------------------------------------------------------------


@query("melt", """
select * from (
  select l_returnflag, 'l_quantity' as measure, round(sum(l_quantity), 2) as amount from lineitem group by 1
  union all select l_returnflag, 'l_tax', round(sum(l_tax), 2) from lineitem group by 1
  union all select l_returnflag, 'l_discount', round(sum(l_discount), 2) from lineitem group by 1)""", digits=2)
def melt(spark: SparkSession, sf: str) -> DataFrame:
    measures = ["l_quantity", "l_tax", "l_discount"]
    wide = table(spark, sf, "lineitem").groupBy("l_returnflag").agg(*[A.sum0(F.col(m)).alias(m) for m in measures])
    return reshape.melt(wide, ["l_returnflag"], measures, "measure", "amount")


@query("metric_columns", """
with t as (select n_regionkey, cast(count(*) as double) n, c_mktsegment from customer join nation on c_nationkey = n_nationkey
           group by all)
select cast(b.n_regionkey as bigint) n_regionkey, b.n as builders, m.n as makers
from (select * from t where c_mktsegment = 'BUILDING') b join (select * from t where c_mktsegment = 'MACHINERY') m
using (n_regionkey)""")
def metric_columns(spark: SparkSession, sf: str) -> DataFrame:
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    long = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_regionkey", "c_mktsegment")
    counted = long.agg(F.count(F.lit(1)).cast("double").alias("n"))
    names = {"BUILDING": "builders", "MACHINERY": "makers"}
    return reshape.metric_columns(counted, "n_regionkey", "c_mktsegment", "n", names)


@query("metric_columns_repeated", """
select cast(a.o_custkey as bigint) o_custkey, a.o_totalprice as open, b.o_totalprice as done
from orders a join orders b using (o_custkey) where a.o_orderstatus = 'O' and b.o_orderstatus = 'F'""")
def metric_columns_repeated(spark: SparkSession, sf: str) -> DataFrame:
    return reshape.metric_columns(
        table(spark, sf, "orders"), "o_custkey", "o_orderstatus", "o_totalprice", {"O": "open", "F": "done"}
    )


@query("enrich_same_names", """
select c_custkey, c.c_acctbal as c_acctbal_x, round(o.total, 4) as c_acctbal_y
from customer c left join (select o_custkey c_custkey, sum(cast(o_totalprice as decimal(18, 2)))::double total from orders group by 1) o
using (c_custkey)""")
def enrich_same_names(spark: SparkSession, sf: str) -> DataFrame:
    spent = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("c_acctbal")
    )
    return joins.enrich(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), [spent], "c_custkey")


# --- Scalar functions ----------------------------------------------------------------------


@query("parse_numbers", r"""
with t as (
  select o_orderkey, case o_orderstatus
    when 'F' then ' ' || o_totalprice || ' '
    when 'O' then case substr(o_orderpriority, 1, 1) when '1' then '1.0f' when '2' then '4,5' when '3' then '1d'
                  when '4' then 'NaN' else '.5e1' end
    else o_orderpriority end raw from orders)
select o_orderkey, round(case when regexp_matches(trim(raw), '^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$')
                         then try_cast(trim(raw) as double) end, 4) number
from t""")
def parse_numbers(spark: SparkSession, sf: str) -> DataFrame:
    odd = F.element_at(
        F.array(*[F.lit(x) for x in ("1.0f", "4,5", "1d", "NaN", ".5e1")]), sheets.priority().cast("int")
    )
    raw = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit(" "), F.col("o_totalprice").cast("string"), F.lit(" ")))
        .when(F.col("o_orderstatus") == "O", odd)
        .otherwise(F.col("o_orderpriority"))
    )
    return table(spark, sf, "orders").select("o_orderkey", P.parse_num(raw).alias("number"))


@query("parse_dates", """
select o_orderkey, case when o_orderstatus = 'F' then cast(o_orderdate as date) end iso,
       case o_orderstatus when 'P' then null else cast(o_orderdate as date) end day_first
from orders""")
def parse_dates(spark: SparkSession, sf: str) -> DataFrame:
    status, day = F.col("o_orderstatus"), F.col("o_orderdate")
    iso = F.when(status == "F", F.date_format(day, "yyyy-MM-dd HH:mm:ss")).otherwise(F.lit("31/12/x"))
    text = (
        F.when(status == "F", F.date_format(day, "dd/MM/yyyy"))
        .when(status == "O", F.date_format(day, "d/M/yyyy"))
        .otherwise(F.date_format(day, "MM-yyyy"))
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", P.parse_ts(iso).cast("date").alias("iso"), P.parse_dayfirst(text).alias("day_first")
    )


@query("key_standardise", """
select o_orderkey, case o_orderstatus when 'P' then null else cast(o_custkey as varchar) end "Employee_ID" from orders""")
def key_standardise(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_custkey").cast("string")
    raw = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("  "), key, F.lit("\t")))
        .when(F.col("o_orderstatus") == "O", F.concat(key, F.lit(".0")))
        .otherwise(F.lit("  "))
    )
    odd = table(spark, sf, "orders").select("o_orderkey", raw.alias("ID"))
    return columns.standardize_id(odd, "ID", "Employee_ID")


@query("text_flags", """
select o_orderkey, lower(o_orderpriority) = '1-urgent' urgent, o_orderstatus = 'F' as filled,
       lower(o_orderpriority) like '%low%' low, lower(o_orderpriority) like '4-not%' unset,
       cast(coalesce(cast(nullif(o_orderstatus, 'P') = 'O' as int), 0) as bigint) open,
       coalesce(nullif(o_orderstatus, 'P'), o_orderpriority) state, coalesce(nullif(o_orderstatus, 'P'), 'Unknown') known
from orders""")
def text_flags(spark: SparkSession, sf: str) -> DataFrame:
    known = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        P.norm_eq(F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit(" ")), "1-Urgent").alias("urgent"),
        P.eq_flag(known, "F").alias("filled"),
        P.icontains(F.col("o_orderpriority"), "Low").alias("low"),
        P.istartswith(F.concat(F.lit(" "), F.col("o_orderpriority")), "4-Not").alias("unset"),
        P.eq_flag(known, "O").cast("int").alias("open"),
        F.coalesce(known, F.col("o_orderpriority")).alias("state"),
        F.coalesce(known, F.lit(V.UNKNOWN)).alias("known"),
    )


@query("scalar_rules", """
select l_orderkey, l_linenumber, l_suppkey, l_partkey, l_shipdate::date as shipped,
       round(least(greatest(l_quantity, 10), 40), 4) clipped,
       round(l_extendedprice / nullif(l_linenumber - 1, 0), 4) per_line,
       round(abs(l_discount - 0.05), 4) gap, round(l_tax * 100, 4) tax_pct,
       round_even(l_extendedprice / 1000, 1) thousands,
       case when l_quantity <= 0 then null when l_quantity <= 10 then 'S' when l_quantity <= 25 then 'M' else 'L' end size,
       case when l_quantity > 30 and l_returnflag <> 'A' then 'High Risk' else 'Normal' end risk,
       round(date_diff('day', l_shipdate::date, date '2025-12-31') / 365.25, 4) tenure,
       cast(year(l_shipdate) as bigint) as year, cast(floor(l_quantity) as bigint) whole
from lineitem""")
def scalar_rules(spark: SparkSession, sf: str) -> DataFrame:
    quantity, price = F.col("l_quantity"), F.col("l_extendedprice")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey",
        F.col("l_shipdate").cast("date").alias("shipped"),
        S.clip(quantity, 10.0, 40.0).alias("clipped"),
        S.ratio(price, S.nullif0(F.col("l_linenumber") - 1)).alias("per_line"),
        F.abs(F.col("l_discount") - 0.05).alias("gap"),
        S.pct(F.col("l_tax")).alias("tax_pct"),
        S.round_half_even(price / 1000, 1).alias("thousands"),
        S.band(quantity, (0.0, 10.0, 25.0, float("inf")), ("S", "M", "L")).alias("size"),
        S.two_way((quantity > 30) & (F.col("l_returnflag") != "A"), *V.RISK_LABELS).alias("risk"),
        S.tenure_years(F.col("l_shipdate"), V.REFERENCE_DATE, V.DAYS_PER_YEAR).alias("tenure"),
        F.year("l_shipdate").alias("year"),
        quantity.cast("int").alias("whole"),
    )


@query("elapsed_days", """
select event_id, cast(floor(epoch_us(timestamp '2024-01-15 12:00:00' - ts) / 86400000000.0) as bigint) as n_days from events""")
def elapsed_days(spark: SparkSession, sf: str) -> DataFrame:
    reference = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    return table(spark, sf, "events").select("event_id", S.days_between(reference, F.col("ts")).alias("n_days"))


@query("count_across", """
select o_orderkey, cast((o_orderstatus = 'F')::int + (o_orderpriority like '1%')::int as bigint) hits,
       cast((o_orderstatus <> 'P')::int + 1 as bigint) given
from orders""")
def count_across(spark: SparkSession, sf: str) -> DataFrame:
    answers = [
        F.when(F.col("o_orderstatus") == "F", F.lit(" Oui")).when(F.col("o_orderstatus") == "O", F.lit("Non")),
        F.when(F.col("o_orderpriority") < "2", F.lit("OUI, souvent")).otherwise(F.lit("non")),
    ]
    return table(spark, sf, "orders").select(
        "o_orderkey",
        S.count_across(answers, lambda c: P.istartswith(c, V.POSITIVE_ANSWER)).alias("hits"),
        S.count_across(answers, lambda c: c.isNotNull()).alias("given"),
    )


@query("number_formats", """
select n_name, printf('%.1f%%', cast(100.0 * count(*) filter (where o_orderstatus = 'F') / count(*) as double)) share,
       printf('%.2f/5', avg(cast(substr(o_orderpriority, 1, 1) as double))) rating, printf('%.0f', count(*)::double) n
from """ + PLACED + " group by 1")
def number_formats(spark: SparkSession, sf: str) -> DataFrame:
    rating = F.avg(P.parse_num(sheets.priority()))
    return sheets.orders_of_customers(spark, sf).groupBy("n_name").agg(
        F.format_string("%.1f%%", S.pct(A.share(F.col("o_orderstatus") == "F"))).alias("share"),
        F.format_string("%.2f/5", rating).alias("rating"),
        F.format_string("%.0f", F.count(F.lit(1)).cast("double")).alias("n"),
    )


# --- Chart tables --------------------------------------------------------------------------


@query("feed_capacity", f"""
with {MONTHLY} select PERIOD as "PERIOD", headcount, round(female_share * 100, 4) female_share_pct from monthly""")
def feed_capacity(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.capacity(kpis.monthly_headcount(sheets.workforce(spark, sf, nations=False), female="BUILDING"))


@query("feed_completion", f"""
with {REVIEWS}, {REVIEW_METRICS} select country, round(completion_rate * 100, 4) completion_rate_pct from review_metrics""")
def feed_completion(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.completion(kpis.review_metrics(sheets.reviews(spark, sf), done="F"))


@query("feed_training_hours", f"""
with {TRAINING}, {TRAINING_KPIS} select year, round(training_hours, 2) training_hours from training_kpis""", digits=2)
def feed_training_hours(spark: SparkSession, sf: str) -> DataFrame:
    training = prepare.training_records(sheets.training_sheet(spark, sf))
    return kpis.training_kpis(training, done="purchase").select("year", "training_hours").orderBy("year")


@query("feed_effectiveness", f"""
with {QUICK}, {QUICK_SCORES.format(done="F", years="is not null")}, {COLD.format(years="is not null")}
select year, round(avg_training_rating, 4) avg_training_rating,
       round(avg_positive_impact_rate * 100, 4) positive_impact_pct
from quick_scores full join cold_impact using (year)""")
def feed_effectiveness(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.effectiveness(
        kpis.quick_scores(prepare.training_quick(sheets.quick_sheet(spark, sf)), done="F"),
        kpis.cold_impact(prepare.training_cold(sheets.cold_sheet(spark, sf))),
    )


@query("feed_absence_mix", """
select cast(p_size as varchar) absence_group, round(sum(l_quantity), 4) absence_days
from lineitem join part on l_partkey = p_partkey group by 1 order by 2 desc, 1 limit 8""")
def feed_absence_mix(spark: SparkSession, sf: str) -> DataFrame:
    lines, part = table(spark, sf, "lineitem"), table(spark, sf, "part")
    events = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_size").cast("string").alias("absence_group"), F.col("l_quantity").alias("working_days")
    )
    return feeds.absence_mix(kpis.absence_group_mix(events))


@query("feed_efficiency", f"""
with {FINANCE} select year, round(nbi_per_fte, 6) nbi_per_fte, round(personnel_cost_per_fte, 6) personnel_cost_per_fte
from finance""", digits=6)
def feed_efficiency(spark: SparkSession, sf: str) -> DataFrame:
    return sheets.finance(spark, sf).select("year", "nbi_per_fte", "personnel_cost_per_fte")
