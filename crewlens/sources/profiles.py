"""Profiles of a sheet kept per file, so that only new files are read.

For every file and column, the number of rows and of missing cells are kept in a small table,
with the file's length and time of change. An update lists the files, reads those that are new or
have changed, and puts their counts in; files that are gone drop out. Counts of a sheet are sums
over its files.
"""

import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crewlens import vocabulary as V
from crewlens.functions.parsing import col
from crewlens.functions.scalars import pct, ratio, round_half_even
from crewlens.operators.columns import clean_header
from crewlens.sources.headers import layouts
from crewlens.sources.readers import text_schema

SCHEMA = "path string, length long, changed timestamp, layout string, name string, position int, n_rows long, n_missing long"
FILE = ["path", "length", "changed"]


def listed(spark: SparkSession, path: str) -> DataFrame:
    """path, length and time of change of every file; no file is opened."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    # The path as a scan's own metadata column has it.
    return found.select(F.col("_metadata.file_path").alias("path"), "length", F.col("modificationTime").alias("changed")).where("length > 0")


def _missing(name: str) -> Column:
    return col(name).isNull() | col(name).isin(*V.MISSING_TOKENS)


def file_counts(spark: SparkSession, files: Sequence[str], sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """path, layout, column, position, rows and missing cells of the given CSV files, read once.

    Lines are counted before anything is shuffled: one row per file and task is.
    """
    parts = []
    for layout in layouts(spark, [unquote(f) for f in files], sep, encoding, clean_header):
        reader = spark.read.options(header=True, sep=sep, escape='"', encoding=encoding, mode="FAILFAST")
        rows = reader.schema(text_schema(layout.names)).csv(list(layout.files))
        counted = rows.groupBy(F.col("_metadata.file_path").alias("path")).agg(
            F.count(F.lit(1)).alias("n_rows"), *[F.count_if(_missing(n)).alias(f"_m{k}") for k, n in enumerate(layout.names)]
        )
        cells = F.array(*[
            F.struct(F.lit(n).alias("name"), F.lit(k).alias("position"), F.col(f"_m{k}").alias("n_missing")) for k, n in enumerate(layout.names)
        ])
        parts.append(counted.select("path", F.lit("\x1f".join(layout.names)).alias("layout"), "n_rows", F.inline(cells)))
    out = parts[0] if parts else spark.createDataFrame([], "path string, layout string, n_rows long, name string, position int, n_missing long")
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def stored(spark: SparkSession, store: str) -> DataFrame:
    """What is kept: the newest state, or nothing yet."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(store)
    fs = where.getFileSystem(conf)
    states = sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []
    complete = [s for s in states if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{store}/{s}/_SUCCESS"))]
    return spark.read.schema(SCHEMA).parquet(f"{store}/{complete[-1]}") if complete else spark.createDataFrame([], SCHEMA)


def update(spark: SparkSession, path: str, store: str, sep: str = ",", encoding: str = "UTF-8") -> list[str]:
    """Bring the kept profiles up to date and return the files that were read for it.

    The new state is written beside the old one and counts once it is complete. The driver holds
    the list of new files, no counts.
    """
    files, old = listed(spark, path), stored(spark, store)
    known = old.select(*FILE).distinct()
    new = sorted(r.path for r in files.join(known, FILE, "left_anti").select("path").collect())
    kept = old.join(files.select(*FILE), FILE, "left_semi")
    state = kept.select(*[f.split(" ")[0] for f in SCHEMA.split(", ")])
    if new:
        state = state.unionByName(file_counts(spark, new, sep, encoding).join(files, "path").select(*state.columns))
    number = f"{_next(spark, store):08d}-{uuid.uuid4().hex}"
    state.coalesce(1).write.parquet(f"{store}/{number}")
    return new


def _next(spark: SparkSession, store: str) -> int:
    where = spark._jvm.org.apache.hadoop.fs.Path(store)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []
    return max([0, *(int(n[:8]) for n in names if n[:8].isdigit())]) + 1


def kept_quality(spark: SparkSession, store: str, digits: int = 2) -> DataFrame:
    """``stats.data_quality`` of the whole sheet from the kept counts.

    A column that some files lack is missing in all of their rows.
    """
    cells = stored(spark, store)
    files = cells.groupBy("path").agg(F.max("n_rows").alias("n_rows"))
    rows = files.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n"))
    known = cells.groupBy("name").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_missing").alias("n_missing"), F.min(F.struct("path", "position")).alias("_first")
    )
    counted = known.withColumn("_all", rows.scalar()).withColumn("Missing_Count", F.col("n_missing") + F.col("_all") - F.col("n_rows"))
    share = round_half_even(pct(ratio(F.col("Missing_Count"), F.col("_all"))), digits)
    return counted.withColumn("Missing_Pct", share).orderBy(
        F.col("Missing_Pct").desc(), F.col("Missing_Count").desc(), "_first"
    ).select(F.col("name").alias("column"), "Missing_Count", "Missing_Pct")
