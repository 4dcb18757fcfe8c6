"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crewlens.session import shared_folder

WORD = r"[^\x20\x09-\x0D]+"
#: Stands for a null doc_id: it comes last.
LAST = (1 << 63) - 1
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def saved(df: DataFrame) -> DataFrame:
    """The rows written to the folder of ``spark.checkpoint.dir``; the lineage ends there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def row_key(*columns: str) -> Column:
    """A digest of the given columns of a row; equal rows share it."""
    return F.md5(F.to_json(F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])))


def ranged(df: DataFrame, order: Sequence[Column], part: str) -> DataFrame:
    """Rows dealt to partitions by ranges of ``order``, with the partition's number; written.

    The written numbers stay the same whatever is recomputed later.
    """
    return saved(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()))


def running_sums(df: DataFrame, order: Sequence[Column], values: Iterable[str], suffix: str = "_before") -> DataFrame:
    """Sum of each value over all rows that come earlier in ``order``, as ``<value><suffix>``.

    Two levels: within ranges of rows, and over one total per range, so that no task sees more
    than a range or one row per range.
    """
    values = list(values)
    part = "__part"
    dealt = ranged(df, order, part)
    totals = dealt.groupBy(part).agg(*[F.sum(v).alias(f"__sum_{v}") for v in values])
    ahead = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(part, *[F.coalesce(F.sum(f"__sum_{v}").over(ahead), F.lit(0)).alias(f"__at_{v}") for v in values])
    within = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = dealt.select("*", *[F.coalesce(F.sum(v).over(within), F.lit(0)).alias(f"__in_{v}") for v in values])
    return own.join(offsets, part).select(
        *df.columns, *[(F.col(f"__in_{v}") + F.col(f"__at_{v}")).alias(f"{v}{suffix}") for v in values]
    )


def texts_of(docs: DataFrame) -> DataFrame:
    """doc (a null doc_id comes last), tid (a hash of the text) and text (null as empty)."""
    text = F.coalesce("text", F.lit("")).alias("text")
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), text).select(
        "doc", F.xxhash64("text").alias("tid"), "text"
    )
