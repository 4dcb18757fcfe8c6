"""Distinct counts that can be rolled up: bitmaps of ids per grain.

Ids get numbers from a written dictionary. For every group of the finest grain, a bitmap per
bucket of numbers tells which ids occur. A coarser count is the union of bitmaps, without the
rows: heads per year come from heads per month, and nobody who is there in two months counts
twice. Bitmaps of one bucket are a few KB whatever the number of rows, and the buckets of a large
group lie in many tasks.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crewlens.functions.parsing import col
from crewlens.session import materialise

ID, NUMBER, BUCKET, BITMAP = "_id", "_number", "_bucket", "_bitmap"


def id_numbers(df: DataFrame, identity: str) -> DataFrame:
    """Each known id with a number, written, so that the numbers stay what they are.

    Numbers are dense within the partitions that the distinct ids lie in, and that is what makes
    bitmaps dense; between partitions there are gaps, which no bitmap covers.
    """
    ids = df.select(col(identity).alias(ID)).where(F.col(ID).isNotNull()).distinct()
    return materialise(ids.withColumn(NUMBER, F.monotonically_increasing_id()), "ids")


def head_bitmaps(df: DataFrame, identity: str, grain: Sequence[str], numbers: DataFrame | None = None) -> DataFrame:
    """One row per group of ``grain`` and bucket: the bitmap of the ids seen there.

    Rows without an id are seen nowhere; missing grain values form a group. Equal rows are
    dropped before the ids are looked up, so that each group asks for an id once per task.
    """
    numbers = id_numbers(df, identity) if numbers is None else numbers
    rows = df.where(col(identity).isNotNull()).select(*[col(g) for g in grain], col(identity).alias(ID)).distinct()
    placed = rows.join(numbers, ID).select(
        *[col(g) for g in grain],
        F.bitmap_bucket_number(NUMBER).alias(BUCKET),
        F.bitmap_bit_position(NUMBER).alias("_bit"),
    )
    return placed.groupBy(*[col(g) for g in grain], BUCKET).agg(F.bitmap_construct_agg("_bit").alias(BITMAP))


def rolled_up(bitmaps: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Bitmaps of a coarser grain: columns of the finer one, or expressions of them with a name."""
    by = [col(k) if isinstance(k, str) else k for k in keys]
    return bitmaps.groupBy(*by, F.col(BUCKET)).agg(F.bitmap_or_agg(BITMAP).alias(BITMAP))


def head_counts(bitmaps: DataFrame, keys: Sequence[str | Column], name: str = "heads") -> DataFrame:
    """Distinct ids per group of any coarser grain; ``keys`` empty gives all of them."""
    by = [col(k) if isinstance(k, str) else k for k in keys]
    merged = rolled_up(bitmaps, keys)
    out = [c for c in merged.columns if c not in (BUCKET, BITMAP)]
    counted = merged.groupBy(*[col(c) for c in out]).agg(F.sum(F.bitmap_count(BITMAP)).alias(name))
    return counted if by else counted.select(F.coalesce(name, F.lit(0).cast("long")).alias(name))
