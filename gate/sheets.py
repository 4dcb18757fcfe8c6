"""Driver tables in the shape of the source sheets, so that the queries run the real plans.

Roles: an order is a monthly snapshot row and a review of its customer, a line item is an
absence event of its supplier, an event is a training session of its user.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crewlens import vocabulary as V
from crewlens.plans import prepare
from crewlens.sources.readers import ROW

STATUS_METRICS = dict(zip(("F", "O", "P"), V.PL_METRICS))
FIRST_FINANCE_YEAR = 1995
# The seven years of orders under the labels of the sheets.
FINANCE_YEARS = [str(2022 + i) for i in range(7)]


# Schemas of the tables in use. Stating them saves the footer-reading job of every scan.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def priority() -> Column:
    """First character of the order priority, a score of 1 to 5 as text."""
    return F.substring("o_orderpriority", 1, 1)


def orders_of_customers(spark: SparkSession, sf: str, nations: bool = True) -> DataFrame:
    """Orders with the attributes of their customers.

    Look-ups by unique key, hence left joins: a plan that needs no attribute drops them.
    """
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    if not nations:
        return joined
    return joined.join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")


def workforce_sheet(spark: SparkSession, sf: str, nations: bool = True) -> DataFrame:
    """Snapshot rows. The first id is missing for pending orders, the second one is not."""
    rows = orders_of_customers(spark, sf, nations)
    place = F.col("n_name") if nations else F.lit(None).cast("string")
    return rows.select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias(V.ID_PRIMARY),
        F.col("o_custkey").alias(V.ID_BACKUP),
        F.trunc("o_orderdate", "month").alias(V.PERIOD),
        place.alias(V.COUNTRY_LABEL),
        F.col("c_mktsegment").alias(V.GENDER_LABEL),
        F.col("c_mktsegment").alias(V.CONTRACT_LABEL),
        place.alias(V.ENTITY_LABEL),
        F.col("o_orderpriority").alias(V.AGE_RANGE),
    )


def workforce(spark: SparkSession, sf: str, nations: bool = True) -> DataFrame:
    return prepare.workforce(workforce_sheet(spark, sf, nations))


def master_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshot rows for the employee table, with an entry date and the order key as ordinal."""
    return orders_of_customers(spark, sf).select(
        F.col("o_custkey").alias(V.ID_PRIMARY),
        F.col("o_orderdate").alias(V.PERIOD),
        F.col("n_name").alias(V.ENTITY_LABEL),
        F.date_sub(F.col("o_orderdate").cast("date"), F.col("c_nationkey") * 150).alias(V.ENTRY_DATE_PREFIX),
        F.col("o_orderkey").alias(ROW),
    )


def review_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """Review documents; scores only for finished and open orders, as text."""
    return orders_of_customers(spark, sf).select(
        F.col("o_custkey").alias(V.REVIEW_ID),
        F.year("o_orderdate").alias(V.REVIEW_YEAR),
        F.when(F.col("o_orderstatus") != "P", priority()).alias(V.REVIEW_SCORE),
        F.col("n_name").alias(V.REVIEW_COUNTRY),
        F.when(F.col("o_orderpriority") < "3", F.lit("Evaluation annuelle")).alias(V.DOCUMENT_NAME),
        F.nullif(F.col("o_orderstatus"), F.lit("O")).alias(V.REVIEW_STATUS),
        F.nullif(F.col("o_orderstatus"), F.lit("F")).alias(V.DOCUMENT_STATUS),
        F.col("o_orderkey").alias(ROW),
    )


def reviews(spark: SparkSession, sf: str) -> DataFrame:
    return prepare.performance_2024(review_sheet(spark, sf))


def working_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """The working variant of the reviews, headers with leading blanks included."""
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias(V.WORKING_ID),
        F.when(F.col("o_orderstatus") == "F", F.lit("Document Terminé"))
        .when(F.col("o_orderstatus") == "O", F.lit("En cours"))
        .alias(V.WORKING_DOCUMENT_STATUS),
        F.when(F.col("o_orderstatus") != "P", priority()).alias(V.REVIEW_SCORE),
        F.year("o_orderdate").alias(V.WORKING_YEAR),
        F.col("o_orderkey").alias(ROW),
    )


def absence_sheet(spark: SparkSession, sf: str, by: str = "l_suppkey") -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col(by).alias(V.EMPLOYEE_CODE),
        F.col("l_shipdate").alias(V.ABSENCE_DATE),
        F.col("l_quantity").alias(V.WORKED_DAYS),
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias(V.ABSENCE_GROUP),
        F.col("l_linestatus").alias(V.COMPANY),
        F.col("l_linestatus").alias(V.GENDER),
    )


def training_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions; the day of the month stands in for the year, as all events fall in one month."""
    key = F.get_json_object("props", "$.k")
    return table(spark, sf, "events").select(
        F.col("user_id").alias(V.EMPLOYEE_CODE),
        F.dayofmonth("ts").alias(V.TRAINING_YEAR),
        F.col("value").alias(V.TRAINING_HOURS),
        F.col("event_type").alias(V.TRAINING_STATUS),
        F.col("event_type").alias(V.TRAINING_ENTITY),
        F.when(key.cast("int") < 30, F.lit("YES")).when(key.cast("int") < 60, F.lit("no")).alias(V.CERTIFICATIONS),
        F.nullif(key, F.lit("7")).alias(V.COURSES),
        key.alias(V.SESSION),
    )


def done_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions with purchases under the label of a completed training."""
    status = F.when(F.col(V.TRAINING_STATUS) == "purchase", F.lit(" réalisé ")).otherwise(F.col(V.TRAINING_STATUS))
    return training_sheet(spark, sf).withColumn(V.TRAINING_STATUS, status)


def quick_sheet(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias(V.SURVEY_ID),
        F.date_format("o_orderdate", "d/M/yyyy").alias(V.SURVEY_DATE),
        F.when(F.col("o_orderpriority") < "5", F.concat(priority(), F.lit(".0"))).alias(V.SURVEY_RATING),
        F.col("o_orderstatus").alias(V.QUICK_STATUS),
    )


def cold_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """Two of the wide answer columns; pending low-priority orders have no answer at all."""
    status, rank = F.col("o_orderstatus"), priority()
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias(V.SURVEY_ID),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias(V.SURVEY_DATE),
        F.when(F.col("o_totalprice") > 100000, F.lit(V.SURVEY_DONE)).otherwise(F.lit("En cours")).alias(V.COLD_STATUS),
        F.when(status == "F", F.lit(" Oui")).when(status == "O", F.lit("Non")).alias(V.IMPACT_QUESTIONS[0]),
        F.when(rank == "1", F.lit("oui, tout à fait")).when(rank < "5", F.lit("Non")).alias(
            V.IMPACT_QUESTIONS[1].replace(" ", "\u00a0", 1)
        ),
    )


def finance_sheets(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Orders pivoted to the two wide sheets: amounts per status, heads per priority."""
    orders = table(spark, sf, "orders").withColumn("_y", F.year("o_orderdate"))
    years = [FIRST_FINANCE_YEAR + i for i in range(len(FINANCE_YEARS))]
    money = F.col("o_totalprice").cast("decimal(18,2)")
    amount = F.when(F.col("o_orderstatus") == "F", money).otherwise(-money)
    names = F.create_map(*[F.lit(x) for pair in STATUS_METRICS.items() for x in pair])
    pl = orders.groupBy(names[F.col("o_orderstatus")].alias("label")).agg(
        *[F.sum(F.when(F.col("_y") == y, amount)).cast("double").alias(f"c{y}") for y in years]
    )
    fte = orders.groupBy(priority().alias("label")).agg(
        *[F.count_if(F.col("_y") == y).cast("double").alias(f"c{y}") for y in years]
    )
    spaced = [c for y in years for c in (F.lit(None).cast("double").alias(f"gap{y}"), F.col(f"c{y}"))]
    return pl, fte.select("label", *spaced, (F.col("label").cast("int") - 1).alias(ROW))


def finance(spark: SparkSession, sf: str) -> DataFrame:
    return prepare.finance(*finance_sheets(spark, sf), years=FINANCE_YEARS)
