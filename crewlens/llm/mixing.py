"""Mixing sources to target weights by systematic sampling.

Each source gets a target number of words. Its documents, in order of size, are laid end to
end, each as long as its expected copies; one random offset per source fixes a comb of integer
marks, and a document is taken once per mark that falls on it. The order by size keeps the
words taken within about one document of the target.

Only identifiers and sizes are shuffled. A source of any size is spread over ranges of rows;
the positions inside it come from range totals.

Nulls: a null text has size 0; a null source is a source of its own, the last in order; a null
doc_id is an ordinary value. A source without words has target 0 and nothing is taken. Repeated
rows each hold their own place on the line. An empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crewlens.llm.common import WORD, ranged, row_key, running_sums, saved

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
SEED = 17


def size_of(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Target words per source from (source, source_size): filled by weight up to a ceiling.

    The sources are sorted by the level at which they reach ``most`` times their size. Those
    below the common level sit at their ceiling, the others get the level times their weight;
    the level is read off at the first source that the rest of the share does not fill.
    """
    ranked = running_sums(sizes.withColumn("one", F.lit(1)), [F.col("source").asc_nulls_last()], ["one"], "_no")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("one_no") % len(weights) + 1).cast("int"))
    filled = ranked.select(
        "source", "source_size", weight.alias("weight"), (F.col("source_size") * most).cast("double").alias("ceiling")
    ).withColumn("level", F.col("ceiling") / F.col("weight"))
    summed = running_sums(filled, [F.col("level"), F.col("source").asc_nulls_last()], ["ceiling", "weight"])
    budget = sizes.agg(F.sum("source_size") * share).scalar()
    weighed = filled.agg(F.sum("weight")).scalar()
    at = (budget - F.col("ceiling_before")) / (weighed - F.col("weight_before"))
    common = summed.withColumn("at", at).where("at <= level").agg(F.min_by("at", "level")).scalar()
    below = filled.withColumn("common", common)
    full = F.least(F.col("ceiling"), F.col("common") * F.col("weight"))
    return below.select(
        "source", "source_size", F.when(F.col("common").isNull(), F.col("ceiling")).otherwise(full).alias("target")
    )


def counted(
    rows: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED
) -> DataFrame:
    """Copies of every row of (doc_id, source, size, ...): adds source_size, target, copies."""
    part = "__range"
    order = [F.col("source").asc_nulls_last(), F.col("size"), F.col("doc_id"), *[F.col(c) for c in rows.columns if c == "key"]]
    # Written first: dealing rows to ranges reads them twice.
    dealt = ranged(saved(rows), order, part)
    totals = dealt.groupBy(part, "source").agg(F.sum("size").alias("words"), F.count("*").alias("n"))
    ahead = Window.partitionBy("source").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(part, "source", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    sizes = totals.groupBy("source").agg(F.sum("words").alias("source_size"))
    goal = targets(sizes, weights, share, most)
    placed = offsets.join(goal.withColumnRenamed("source", "g"), F.col("source").eqNullSafe(F.col("g"))).drop("g")
    own = dealt.withColumn(
        "at", F.row_number().over(Window.partitionBy(part, "source").orderBy(*order))
    )
    rate = F.col("target") / F.col("source_size")
    # Four digits of a digest: a fraction of 16 bits, exact in every later sum.
    drawn = F.substring(F.md5(F.concat(F.coalesce("s", F.lit("")), F.lit(str(seed)))), 1, 4)
    offset = F.conv(drawn, 16, 10).cast("double") / F.lit(65536.0)
    joined = own.join(
        placed.withColumnRenamed("source", "s").withColumnRenamed(part, "p"),
        (F.col(part) == F.col("p")) & F.col("source").eqNullSafe(F.col("s")),
    )
    last = F.col("ahead") + F.col("at")
    copies = (
        F.when(F.col("source_size") == 0, F.lit(0))
        .when(rate >= most, F.lit(int(most)))
        .otherwise(F.floor(last * rate + offset) - F.floor((last - 1) * rate + offset))
        .cast("long")
    )
    return joined.select(*rows.columns, "source_size", "target", copies.alias("copies"))


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    rows = docs.select("doc_id", "source", size_of("text").alias("size"))
    return counted(rows, **options).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: every row as often as it was taken, with the columns of ``docs``."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select(row.alias("row"), row_key("doc_id", "source", "text").alias("key"))
    slim = docs.select("doc_id", "source", size_of("text").alias("size"), row_key("doc_id", "source", "text").alias("key"))
    nth = Window.partitionBy("key").orderBy("copies")
    taken = counted(slim, **options).select("key", "copies").withColumn("nth", F.row_number().over(nth)).where("copies > 0")
    held = keyed.withColumn("nth", F.row_number().over(Window.partitionBy("key").orderBy(F.lit(0))))
    return (
        held.join(taken, ["key", "nth"])
        .select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
        .select("row.*")
    )
