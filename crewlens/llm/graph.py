"""Connected components over an edge table, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crewlens.llm.common import saved
from crewlens.llm.workers import lean


#: Edges that a task contracts at once, and written parts that it reads.
AT_ONCE = 1 << 20
PARTS = 32


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The edges' components as stars: every node but the smallest, and the smallest of its component."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        # Hang the roots of both ends on the lower one, then shorten all ways to the roots.
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    own = label != np.arange(len(nodes))
    return nodes[own], nodes[label[own]]


def contracted(edges: DataFrame) -> DataFrame:
    """Fewer edges (a, b) that connect the same nodes: a group of n nodes leaves n - 1 per task,
    however many edges it has there.

    ``edges`` must be cheap to read, as a written table is: a task reads ``PARTS`` of its parts. It
    holds ``AT_ONCE`` edges at most and hands on what it has when contracting them frees too little.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def shrunk() -> tuple[np.ndarray, np.ndarray]:
            return stars(*(np.concatenate(c) for c in zip(*held, strict=True)))

        for batch in batches:
            held.append((batch.column("a").to_numpy(), batch.column("b").to_numpy()))
            size += batch.num_rows
            if size >= AT_ONCE:
                held = [shrunk()]
                size = len(held[0][0])
                if size > AT_ONCE // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in held[0]], ["a", "b"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in shrunk()], ["a", "b"])

    parts = edges.rdd.getNumPartitions()
    return edges.select("a", "b").coalesce(max(1, parts // PARTS)).mapInArrow(lean(work), "a long, b long")


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Every neighbour is hung on the smallest node around: the larger ones, or the smaller ones."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    around = both if large else both.where("b < a")
    least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    joined = around.join(least, "a")
    moved = joined.where("b > a") if large else joined
    out = moved.select(F.col("b").alias("a"), F.col("low").alias("b"))
    if not large:
        out = out.unionByName(least.select("a", F.col("low").alias("b")))
    return out.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def partial_components(edges: DataFrame) -> DataFrame:
    """node, root after one round: equal roots are connected, but a component may still have
    several."""
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = saved(_star(saved(_star(saved(now), True)), False))
    return saved(now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")))


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node of its component, for every node of an edge (a, b).

    Ends when a round leaves the edges as they were: then each component is a star around its
    smallest node. Every round is written. Self-loops and repeated edges are allowed.
    """
    now = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        now = saved(_star(saved(_star(now, True)), False))
    roots = now.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
