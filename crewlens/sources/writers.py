"""Sinks: result tables as CSV, the employee table as CSV and parquet, KPI lines as text."""

from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crewlens.functions.scalars import plain_number

# Quotes are doubled and outer blanks of cells and headers kept, as spreadsheets do.
CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def save_tables(tables: Mapping[str, DataFrame], folder: str, single: Collection[str] = ()) -> None:
    """One CSV folder with header per table.

    Names in ``single`` become one file: results of report size, a row per month, year or band.
    """
    for name, table in tables.items():
        out = table.coalesce(1) if name in single else table
        out.write.mode("overwrite").options(**CSV).csv(f"{folder}/{name}")


def save_employee_table(df: DataFrame, folder: str, partition_by: str | None = None) -> None:
    """The employee table as CSV and as parquet.

    With ``partition_by`` the parquet copy gets one folder per value. The rebalance hint
    splits a large department over several tasks and files and merges small ones.
    """
    df.write.mode("overwrite").options(**CSV).csv(f"{folder}/csv")
    writer = df.hint("rebalance", partition_by).write.partitionBy(partition_by) if partition_by else df.write
    writer.mode("overwrite").parquet(f"{folder}/parquet")


def kpi_lines(kpis: DataFrame) -> DataFrame:
    """KPI rows as text lines."""
    value = plain_number(F.col("value"))
    return kpis.select(F.format_string("- %s: %s (%s)", F.col("kpi"), value, F.col("definition")).alias("line"))


def save_kpi_lines(kpis: DataFrame, folder: str) -> None:
    """Write the KPI lines as one text file."""
    kpi_lines(kpis).coalesce(1).write.mode("overwrite").text(folder)
