"""Chat logs: growing snapshots of one conversation collapse to the longest, then are rendered.

A log that is cut off at some turn is a prefix of the full one. Every conversation gets a
rolling hash per turn; a conversation whose last hash is an inner hash of another at the same
length is a prefix of it and goes by an anti-join. Equal conversations keep the smallest id.

Order of turns: turn, role, text, nulls first. A null role renders as ``DEFAULT_ROLE``, a null
text as empty; both still differ from their rendered values in comparisons. Rows without conv_id
belong to no conversation and are left out. Marker strings inside texts are broken up, so that a
text cannot open a turn. Repeated rows are turns of their own. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crewlens.llm.common import saved

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
DEFAULT_ROLE = "user"
HASH = ["h1", "h2", "pos"]


def rolling(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), the hash of all turns up to pos (two words), whether it is the last.

    The rolling hash is the exclusive or of the turns' hashes, each taken with its position.
    """
    order = ["turn", "role", "text"]
    by = Window.partitionBy("conv_id")
    placed = turns.where("conv_id IS NOT NULL").select(
        "conv_id", *order, F.row_number().over(by.orderBy(*order)).alias("pos"), F.count("*").over(by).alias("n")
    )
    # Nulls are skipped by the hash function, so their presence is hashed too.
    parts = [F.col("pos"), F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")]
    so_far = by.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return placed.select(
        "conv_id", "pos", "n", F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit("second"), *reversed(parts)).alias("b")
    ).select(
        "conv_id",
        "pos",
        F.bit_xor("a").over(so_far).alias("h1"),
        F.bit_xor("b").over(so_far).alias("h2"),
        (F.col("pos") == F.col("n")).alias("last"),
    )


def maximal(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns and copies of the conversations that are no prefix of another."""
    hashed = saved(rolling(turns))
    ends = hashed.where("last").groupBy(*HASH).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"))
    inner = hashed.where("NOT last").select(*HASH).distinct()
    return ends.join(inner, HASH, "left_anti").select("conv_id", F.col("pos").cast("long").alias("n_turns"), "copies")


def rendered(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, copies, text of the maximal conversations."""
    def clean(c):
        return F.replace(F.replace(c, F.lit(OPEN), F.lit("<im_start>")), F.lit(CLOSE), F.lit("<im_end>"))

    kept = maximal(turns)
    lines = F.transform(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))),
        lambda t: F.concat(
            F.lit(OPEN),
            clean(F.coalesce(t["role"], F.lit(DEFAULT_ROLE))),
            F.lit("\n"),
            clean(F.coalesce(t["text"], F.lit(""))),
            F.lit(CLOSE + "\n"),
        ),
    )
    # One conversation is one text, so its turns must fit in a row.
    return (
        turns.select("conv_id", "turn", "role", "text")
        .join(kept, "conv_id")
        .groupBy("conv_id", "n_turns", "copies")
        .agg(F.array_join(lines, "").alias("text"))
    )
