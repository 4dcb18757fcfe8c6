"""Prefix trie of conversations by collapsing whole sequences.

A node is a distinct sequence of first turns (role and text); the root is the empty one. Equal
conversations are grouped into one sequence with its number of conversations and its list of ids
(the ends). Sequences that are an inner prefix of another one go by an anti-join; those left are
the leaves. Every distinct sequence, and not every conversation, is then laid out into its
prefixes, weighted, and the prefixes are aggregated.

Sums over subtrees need no walk. A node's subtree is all that its sequences hold from its depth
on, so a sum over conversations is a suffix sum of each sequence, added up per node. Where every
node counts once, each is given to one sequence, the one with the smallest id through it; what a
sequence owns is a suffix of it, so one depth per sequence tells.

Turns are told apart by two 64-bit hashes, taken with their depth, and prefixes by the exclusive
or of them. Aggregations combine before their shuffles, so a first turn that a third of all
conversations share is no hot task. A conversation's own turns are put in order by one task, on
disk if need be.

Order of turns: turn (null first), then role, then text. Null role and text become empty. Rows
without conv_id belong to no conversation and are left out. Repeated rows are turns of their own.
An empty table gives no nodes, not even a root. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crewlens.llm.common import saved

#: Conversations whose ids leave the same remainder-free part share the first of them as base.
FAMILY = 5
MOST_BORROWED = 9
NODE = ["a", "b", "depth"]
#: Bytes of a list of ends that go to one row before it is hashed.
PIECE = 1 << 20


def _hashes(first: Column, second: Column) -> list[Column]:
    """Two hashes of a turn, from its depth and the digests of its role and text."""
    return [F.xxhash64("depth", first).alias("x"), F.xxhash64(F.lit("second"), "depth", second).alias("y")]


def numbered(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), role, text, n_bytes of the text, two digests of the turn."""
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")],
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return rows.select(
        "conv_id", F.row_number().over(order).alias("pos"), "role", "text",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.xxhash64("role", "text").alias("ta"), F.xxhash64("text", F.lit("second"), "role").alias("tb"),
    )


def plain(placed: DataFrame) -> DataFrame:
    """The conversations as they are: a row of depth 0 for each, and its turns from depth 1 on."""
    kept = [c for c in placed.columns if c not in ("conv_id", "pos")]
    top = placed.where("pos = 1").select("conv_id", F.lit(0).alias("depth"), *_blank(placed, kept))
    return placed.select("conv_id", F.col("pos").alias("depth"), *kept).unionByName(top)


def _blank(rows: DataFrame, names: list[str]) -> list[Column]:
    return [F.lit("" if rows.schema[c].dataType.simpleString() == "string" else 0).cast(rows.schema[c].dataType).alias(c) for c in names]


def rebuilt(placed: DataFrame) -> DataFrame:
    """As ``plain``, after each conversation c took the first h turns of conversation c - c % 5 in
    place of its own first h; h is the checksum of its id modulo 9.

    A base lends eight turns at most, to four conversations.
    """
    kept = [c for c in placed.columns if c not in ("conv_id", "pos")]
    c = F.col("conv_id")
    h = (F.crc32(c.cast("string").cast("binary")) % MOST_BORROWED).alias("h")
    based = placed.select("*", h, (c % FAMILY == 0).alias("is_base"))
    own = based.where("is_base OR pos > h").select("conv_id", F.lit(2).alias("part"), "pos", *kept)
    top = based.where("pos = 1").select("conv_id", F.lit(0).alias("part"), F.lit(0).alias("pos"), *_blank(placed, kept))
    borrowers = based.where("pos = 1 AND NOT is_base AND h > 0").select("conv_id", "h", (c - c % FAMILY).alias("base"))
    heads = placed.where((c % FAMILY == 0) & (F.col("pos") < MOST_BORROWED)).withColumnRenamed("conv_id", "base")
    lent = borrowers.join(heads, "base").where("pos <= h").select("conv_id", F.lit(1).alias("part"), "pos", *kept)
    by = Window.partitionBy("conv_id").orderBy("part", "pos")
    rows = own.unionByName(top).unionByName(lent)
    return rows.select("conv_id", (F.row_number().over(by) - 1).alias("depth"), *kept)


def sequences(steps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Prefixes of every conversation and the collapsed conversations.

    Prefixes: conv_id, depth, node (a, b), parent (pa, pb), n_bytes, last. Sequences: node (a, b,
    depth), conv_id (the smallest), weight (conversations).
    """
    by = Window.partitionBy("conv_id").orderBy("depth")
    whole = Window.partitionBy("conv_id")
    zero = F.lit(0).cast("long")
    hashed = steps.select(
        "conv_id", "depth", "n_bytes", (F.col("depth") == F.max("depth").over(whole)).alias("last"),
        *[F.when(F.col("depth") > 0, h).otherwise(zero).alias(n) for h, n in zip(_hashes(F.col("ta"), F.col("tb")), "xy", strict=True)],
    )
    so_far = by.rowsBetween(Window.unboundedPreceding, 0)
    prefixes = saved(hashed.select("*", F.bit_xor("x").over(so_far).alias("a"), F.bit_xor("y").over(so_far).alias("b")).select(
        "conv_id", "depth", "n_bytes", "last", "a", "b",
        F.col("a").bitwiseXOR(F.col("x")).alias("pa"), F.col("b").bitwiseXOR(F.col("y")).alias("pb"),
    ))
    collapsed = prefixes.where("last").groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("weight"))
    return prefixes, saved(collapsed)


def nodes(prefixes: DataFrame, collapsed: DataFrame) -> DataFrame:
    """One row per node: a, b, depth, conv_id, parent_conv_id, n_convs, n_children, n_leaves,
    saved_bytes (over its subtree, each node's conversations but one times the bytes of its turn)."""
    mine = prefixes.join(collapsed.select("conv_id", "weight"), "conv_id")
    inner = mine.where("NOT last").select("a", "b").distinct()
    leaves = collapsed.join(inner, ["a", "b"], "left_anti").select("conv_id", F.lit(1).alias("leaf"))
    laid = saved(mine.join(leaves, "conv_id", "left"))
    shared = laid.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"), F.count("leaf").alias("n_leaves"),
        F.any_value("pa").alias("pa"), F.any_value("pb").alias("pb"),
    )
    shared = saved(shared)
    owned = shared.groupBy("conv_id").agg(F.min("depth").alias("owns_from"))
    below = Window.partitionBy("conv_id").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    # Of its conversations a node saves all but one; that one is counted with the owner.
    counted = F.col("weight") - F.coalesce((F.col("depth") >= F.col("owns_from")).cast("long"), F.lit(0))
    summed = laid.join(owned, "conv_id", "left").select(*NODE, F.sum(counted * F.col("n_bytes")).over(below).alias("below"))
    saving = summed.groupBy(*NODE).agg(F.sum("below").alias("saved_bytes"))
    children = shared.where("depth > 0").groupBy(
        F.col("pa").alias("a"), F.col("pb").alias("b"), (F.col("depth") - 1).alias("depth")
    ).agg(F.count("*").alias("n_children"))
    whole = shared.join(saving, NODE).join(children, NODE, "left")
    return _with_parents(saved(whole.select(
        *NODE, "conv_id", "pa", "pb", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        "n_leaves", "saved_bytes",
    )))


def _with_parents(table: DataFrame) -> DataFrame:
    """Adds the parent's conv_id.

    A node whose conversation owns the parent too has the same id there. Only where a sequence
    leaves the way of a smaller id must the parent be looked up: one row per sequence.
    """
    owned = table.groupBy("conv_id").agg(F.min("depth").alias("owns_from"))
    first = table.where("depth > 0").join(owned, "conv_id").where("depth = owns_from")
    above = table.select(F.col("a").alias("pa"), F.col("b").alias("pb"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("up"))
    asked = first.select("conv_id", "depth", "pa", "pb").join(above, ["pa", "pb", "depth"]).select("conv_id", "depth", "up")
    parent = F.when(F.col("depth") > 0, F.coalesce("up", "conv_id"))
    return table.join(asked, ["conv_id", "depth"], "left").select(
        *NODE, "conv_id", parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_bytes"
    )


def ends(prefixes: DataFrame) -> DataFrame:
    """Node (a, b, depth) and conv_id of every conversation that ends there."""
    return prefixes.where("last").select(*NODE, "conv_id")


def turns_of(table: DataFrame, steps: DataFrame) -> DataFrame:
    """The nodes with role and text of their last turn, empty for the root.

    ``steps`` must hold role and text; each node reads one row of them.
    """
    return table.join(steps.select("conv_id", "depth", "role", "text"), ["conv_id", "depth"])


def ends_digest(listed: DataFrame) -> DataFrame:
    """Node and ends_sha256 of the ids that end there, ascending, joined by commas.

    The ids are sorted over ranges, so that a long list lies in many of them, and each range
    joins them to pieces. A digest can only be taken front to back: the pieces of a list then
    stream through one task that holds one of them at a time.
    """
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, size = None, [], 0
        out: list[tuple] = []

        def close() -> None:
            if ids:
                out.append((*now, ids[0], ",".join(map(str, ids))))

        for batch in batches:
            for *node, i in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if node != now or size >= PIECE:
                    close()
                    now, ids, size = node, [], 0
                ids.append(i)
                size += len(str(i)) + 1
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip((*NODE, "first", "piece"), x, strict=True)) for x in out], shape)
                out = []
        close()
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip((*NODE, "first", "piece"), x, strict=True)) for x in out], shape)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            out = []
            for *node, _, piece in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if node == now:
                    state.update(b",")
                else:
                    if now is not None:
                        out.append((*now, state.hexdigest()))
                    now, state = node, hashlib.sha256()
                state.update(piece.encode())
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip((*NODE, "ends_sha256"), x, strict=True)) for x in out], final)
        if now is not None:
            yield pa.RecordBatch.from_pylist([dict(zip((*NODE, "ends_sha256"), (*now, state.hexdigest()), strict=True))], final)

    key = [pa.field("a", pa.int64()), pa.field("b", pa.int64()), pa.field("depth", pa.int32())]
    shape = pa.schema([*key, pa.field("first", pa.int64()), pa.field("piece", pa.string())])
    final = pa.schema([*key, pa.field("ends_sha256", pa.string())])
    order = [*NODE, "conv_id"]
    ids = listed.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = ids.mapInArrow(join, "a long, b long, depth int, first long, piece string")
    streams = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return streams.mapInArrow(digest, "a long, b long, depth int, ends_sha256 string")


def report(turns: DataFrame) -> DataFrame:
    """The nodes of the rebuilt conversations, with the digest of the ids that end at each."""
    slim = saved(numbered(turns).drop("role", "text"))
    prefixes, collapsed = sequences(rebuilt(slim))
    table = nodes(prefixes, collapsed).join(ends_digest(ends(prefixes)), NODE, "left")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return table.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved_bytes").alias("saved_tokens"), F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
    )
