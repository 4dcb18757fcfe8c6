"""Queries that write a driver table as sheets to the shared folder and read it with the library."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crewlens import vocabulary as V
from crewlens.operators import dates, heads, stats
from crewlens.plans import feeds
from crewlens.session import materialise, scratch
from crewlens.sources import publish, readers
from crewlens.sources.writers import CSV, save_employee_table, save_tables
from gate import results
from gate.registry import ORACLES, query
from gate.sheets import table


def sheet_folder(spark: SparkSession, name: str) -> str:
    return f"{scratch(spark, 'sheets')}/{name}"


@query("sheet_headers_reconciled", """
select cast(o_orderkey as varchar) id, cast(o_custkey as varchar) customer,
       case when o_orderkey % 3 < 2 then o_orderstatus end status,
       case when o_orderkey % 3 = 1 then o_orderpriority end priority from orders""")
def sheet_headers_reconciled(spark: SparkSession, sf: str) -> DataFrame:
    """Three groups of files in one folder: swapped, additional, missing and badly written headers."""
    orders = table(spark, sf, "orders").withColumn("g", F.col("o_orderkey") % 3)
    path = sheet_folder(spark, "orders.csv")
    forms = (
        {"id": "o_orderkey", "customer": "o_custkey", "status": "o_orderstatus"},
        {" status": "o_orderstatus", "customer ": "o_custkey", "priority": "o_orderpriority", " id": "o_orderkey"},
        {"customer": "o_custkey", "id": "o_orderkey"},
    )
    for g, names in enumerate(forms):
        part = orders.where(F.col("g") == g).select(*[F.col(c).cast("string").alias(n) for n, c in names.items()])
        part.write.mode("append").options(**CSV).csv(path)
    return readers.read_table(spark, path, expected=["id", "customer", "status"])


_TOKENS = ", ".join(f"'{t}'" for t in V.MISSING_TOKENS)


@query("sheet_line_breaks", f"""
select cast(doc_id as varchar) doc_id, md5(text) as text_md5, cast(length(text) as bigint) n from
  (select doc_id, case when text not in ({_TOKENS}) then text end as text from documents)""")
def sheet_line_breaks(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts with quotes and line breaks in cells, read in splits of 64 KB."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    path = sheet_folder(spark, "documents.csv")
    docs.select("text", "doc_id").write.options(**CSV, quoteAll=True, emptyValue="").csv(path)
    read = readers.read_table(spark, path, multi_line=True, split_bytes=1 << 16)
    return read.select("doc_id", F.md5("text").alias("text_md5"), F.length("text").cast("long").alias("n"))


@query("sheet_catalog", """
select cast(count(*) as bigint) n_rows, cast(7 as bigint) n_cols, 'absenteeism' as name from lineitem
union all select count(*), 4, 'training_quick' from orders""")
def sheet_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """Two sheets written as CSV, loaded as a catalog and counted."""
    folder = sheet_folder(spark, "root")
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    absences = lines.select(*[F.col(c).cast("string") for c in ("l_suppkey", "l_shipdate", "l_quantity", "l_tax", "l_discount", "l_returnflag", "l_linestatus")])
    surveys = orders.select(*[F.col(c).cast("string") for c in ("o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")])
    save_tables({"absenteeism.csv": absences, "training_quick.csv": surveys}, folder)
    return stats.profile_counts(readers.load_sources(spark, folder, names=["absenteeism", "training_quick"]))


@query("tables_published", """
select o_custkey, o_orderstatus, count(*) n, round(sum(o_totalprice), 4) total from orders group by all""")
def tables_published(spark: SparkSession, sf: str) -> DataFrame:
    """A result published as a version, and read through its manifest."""
    out = sheet_folder(spark, "published")
    totals = table(spark, sf, "orders").groupBy("o_custkey", "o_orderstatus").agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 4).alias("total")
    )
    publish.publish(spark, out, {"totals": totals}, fmt="csv")
    return publish.read_published(spark, out)["totals"]


@query("employee_table_saved", """
select cast(o_custkey as bigint) o_custkey, o_orderstatus, o_orderkey from orders""")
def employee_table_saved(spark: SparkSession, sf: str) -> DataFrame:
    """A table saved with a folder per value, and read back."""
    out = sheet_folder(spark, "employee")
    save_employee_table(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), out, "o_orderstatus")
    return spark.read.schema("o_orderkey long, o_custkey long, o_orderstatus string").parquet(f"{out}/parquet")


@query("column_date_layouts", """
select o_orderkey, cast(o_orderdate as date) day_first, cast(o_orderdate as date) month_first from orders""")
def column_date_layouts(spark: SparkSession, sf: str) -> DataFrame:
    """Two columns whose layout only days after the twelfth tell."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "d/M/yyyy").alias("day_first"), F.date_format("o_orderdate", "M/d/yyyy").alias("month_first")
    )
    read = dates.with_dates(orders, ["day_first", "month_first"])
    return read.select("o_orderkey", *[F.col(c).cast("date").alias(c) for c in ("day_first", "month_first")])


@query("heads_rolled_up", """
with s as (select o_custkey, date_trunc('month', o_orderdate)::date as month, o_orderstatus status from orders)
select 'month' as grain, cast(month as varchar) as key, count(distinct o_custkey) heads from s group by all
union all select 'year', cast(year(month) as varchar), count(distinct o_custkey) from s group by all
union all select 'status', status, count(distinct o_custkey) from s group by all
union all select 'all', 'all', count(distinct o_custkey) from s""")
def heads_rolled_up(spark: SparkSession, sf: str) -> DataFrame:
    """Four distinct counts from one written table of bitmaps."""
    rows = table(spark, sf, "orders").select("o_custkey", F.trunc("o_orderdate", "month").alias("month"), F.col("o_orderstatus").alias("status"))
    bitmaps = materialise(heads.head_bitmaps(rows, "o_custkey", ["month", "status"]), "bitmaps")
    grains = {
        "month": F.col("month").cast("string"), "year": F.year("month").cast("string"), "status": F.col("status"), "all": F.lit("all"),
    }
    parts = [
        heads.head_counts(bitmaps, [key.alias("key")]).select(F.lit(grain).alias("grain"), "key", "heads") for grain, key in grains.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("feed_training_vs_performance", f"""
select training_band, avg_performance_score from ({ORACLES["training_perf_summary"]})""")
def feed_training_vs_performance(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.training_vs_performance(results.training_perf_summary(spark, sf))
