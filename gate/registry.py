"""Registry of queries and their SQL."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crewlens.functions.parsing import col

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str, digits: int = 4) -> Callable[[Query], Query]:
    def register(plan: Query) -> Query:
        QUERIES[name] = lambda spark, sf: tidy(plan(spark, sf), digits)
        ORACLES[name] = sql
        return plan

    return register


def tidy(df: DataFrame, digits: int) -> DataFrame:
    """Whole numbers as bigint, doubles rounded: sums depend on the order of addition."""
    def shown(f: T.StructField) -> Column:
        c = col(f.name)
        if isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.DoubleType):
            c = F.round(c, digits)
        return c.alias(f.name)

    return df.select(*[shown(f) for f in df.schema.fields])
