"""Approximate nearest neighbours by collision counting.

Vectors are scaled to length one and projected on the lines of whole random rotations, at least
``LINES`` of them. Each line keeps its values in one sorted array. A query opens a window around
its own value in every array and counts, for each vector, in how many windows it lies; what lies
outside is the smaller part and is what is counted. A vector in at least ``SHARE`` of the windows
is a candidate and is verified with its true cosine. Lines of one rotation share out a distance
exactly, which makes the counts of near and far vectors differ far more than those of unrelated
lines: some three percent of random vectors are verified.

Windows serve a radius. The first one is that of a query's ``FIRST_RANK``-th nearest among
``SAMPLE`` vectors of the block; windows then widen by a constant factor on the same arrays (virtual
rehashing: no table is rebuilt). A query is done once its k-th best verified vector lies well within
the current radius, for then a nearer one would have collided often enough with high probability.

Spark deals the distinct vectors into blocks of about ``BLOCK`` and the queries into blocks of
``QUERY_BLOCK``; each pair of blocks is one task-sized group, and the best k of every query and
block are merged. Equal vectors are one entry with their k + 1 smallest ids, so that copies are
neither searched twice nor lost: more of them could not be among the k nearest.

Vectors that are null, of length zero, or hold a null or a non-finite number take no part, as
queries or candidates, and neither do rows without vec_id. Vectors of different sizes are
searched apart. A repeated row counts once. With fewer than k candidates a query gets all.
Ties go to the smaller vec_id. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crewlens.llm.common import saved

LINES = 128
#: Share of the windows that a candidate lies in.
SHARE = 0.925
#: Half the width of a window, as a multiple of the radius it serves.
REACH = 1.8
SAMPLE = 1024
FIRST_RANK = 8
SMALLEST = 0.01
WIDEN = 1.1
BLOCK = 16384
QUERY_BLOCK = 4096
MOST_APART = 2.0
#: The k-th best must lie that much within the radius: vectors at its very edge collide less often.
SLACK = 1.05


def usable(vector: str) -> Column:
    v = F.col(vector)
    plain = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(v.isNotNull() & plain & F.exists(v, lambda x: x != 0), F.lit(False))


class SortedLines:
    """Index of one block: a sorted array of values, and the vectors in that order, per line."""

    def __init__(self, vectors: np.ndarray) -> None:
        self.vectors = np.ascontiguousarray(vectors, np.float64)
        self.length = np.sqrt((self.vectors * self.vectors).sum(axis=1))
        self.unit = self.vectors / self.length[:, None]
        rng, size = np.random.default_rng(11), self.vectors.shape[1]
        turns = [np.linalg.qr(rng.standard_normal((size, size)))[0] for _ in range(-(-LINES // size))]
        self.lines = np.concatenate(turns, axis=1) * np.sqrt(size)
        values = self.unit @ self.lines
        self.order = np.argsort(values, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(values, self.order.T, 0).T.copy()
        self.sample = self.unit[rng.permutation(len(self.unit))[:SAMPLE]]

    def first_radius(self, queries: np.ndarray) -> np.ndarray:
        """Distance of each query (of length one) to its ``FIRST_RANK``-th nearest sampled vector."""
        near = np.sort(queries @ self.sample.T, axis=1)[:, ::-1][:, min(FIRST_RANK, len(self.sample)) - 1]
        return np.sqrt(np.maximum(0.0, 2 - 2 * near)).clip(SMALLEST, MOST_APART)

    def candidates(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The vectors in enough of the windows, given where those begin and end in each line."""
        outside = [line[:x] for line, x in zip(self.order, low.tolist(), strict=True)]
        outside += [line[x:] for line, x in zip(self.order, high.tolist(), strict=True)]
        missed = np.bincount(np.concatenate(outside), minlength=len(self.vectors))
        return np.flatnonzero(missed <= int((1 - SHARE) * len(self.order)))

    def search(self, queries: np.ndarray, enough) -> int:
        """Gives every query its new candidates, at wider and wider windows, until
        ``enough(query number, new candidates, radius)``; returns how many there were."""
        unit = queries / np.sqrt((queries * queries).sum(axis=1))[:, None]
        at = (unit @ self.lines).T
        radius, seen, verified = self.first_radius(unit), {}, 0
        active = np.arange(len(queries))
        while len(active):
            reach = REACH * radius[active]
            low = np.array([np.searchsorted(v, x[active] - reach, "left") for v, x in zip(self.values, at, strict=True)])
            high = np.array([np.searchsorted(v, x[active] + reach, "right") for v, x in zip(self.values, at, strict=True)])
            left = []
            for k, q in enumerate(active.tolist()):
                # Beyond the largest possible distance everything is a candidate.
                last = radius[q] >= MOST_APART
                found = np.arange(len(self.vectors)) if last else self.candidates(low[:, k], high[:, k])
                fresh = np.setdiff1d(found, seen[q], assume_unique=True) if q in seen else found
                verified += len(fresh)
                if not enough(q, fresh, radius[q]) and not last:
                    seen[q] = np.union1d(seen[q], fresh) if q in seen else fresh
                    left.append(q)
            active = np.array(left, np.int64)
            radius[active] = np.minimum(radius[active] * WIDEN, MOST_APART)
        return verified

    def cosine(self, query: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Exact cosines; the same pair gives the same number in whatever block it is met."""
        dots = (self.vectors[rows] * query).sum(axis=1)
        return dots / (self.length[rows] * np.sqrt((query * query).sum()))


def nearest(
    index: SortedLines, ids: list[np.ndarray], queries: np.ndarray, own: list[int], k: int
) -> tuple[list[list[tuple[float, int]]], int]:
    """The k best (score, vec_id) of one block for every query, without the query's own id, and
    the number of vectors that were verified."""
    best: list[list[tuple[float, int]]] = [[] for _ in own]

    def enough(q: int, fresh: np.ndarray, radius: float) -> bool:
        if len(fresh):
            score = index.cosine(queries[q], fresh)
            # A vector holds k + 1 ids at most; those below the k-th best cannot enter.
            floor = -best[q][-1][0] if len(best[q]) == k else -np.inf
            if len(fresh) > 2 * k + 2:
                floor = max(floor, np.partition(score, -k - 1)[-k - 1])
            top = fresh[score >= floor]
            pairs = [(-s, int(i)) for s, r in zip(score[score >= floor], top, strict=True) for i in ids[r] if i != own[q]]
            best[q] = sorted(best[q] + pairs)[:k]
        # Chord length of the k-th best on the unit sphere.
        return len(best[q]) == k and SLACK * np.sqrt(max(0.0, 2 + 2 * best[q][-1][0])) <= radius

    verified = index.search(queries, enough)
    return [[(-s, i) for s, i in x] for x in best], verified


def search(vectors: DataFrame, is_query: Column, k: int = 5, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found; vectors hold (vec_id, embedding)."""
    good = vectors.where(usable("embedding") & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")
    )
    queries = saved(good.where(is_query).dropDuplicates(["vec_id"]))
    # The limit by rank is applied before the shuffle too, so a frequent vector stays small.
    first = Window.partitionBy("v").orderBy("vec_id")
    few = good.withColumn("rank", F.dense_rank().over(first)).where(F.col("rank") <= k + 1).drop("rank")
    distinct = saved(few.groupBy("v").agg(F.sort_array(F.collect_set("vec_id")).alias("ids")))
    blocks = max(1, -(-distinct.count() // block))
    chunks = max(1, -(-queries.count() // QUERY_BLOCK))
    cell = ["size", "block", "chunk"]
    size = F.size("v").alias("size")
    left = distinct.select(
        size, F.pmod(F.xxhash64("v"), F.lit(blocks)).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), "v", "ids"
    )
    right = queries.select(
        size, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
        F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int").alias("chunk"), "v", F.col("vec_id").alias("query_id"),
    )

    def match(mine: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, float]] = []
        if len(mine) and len(asked):
            own = asked["query_id"].tolist()
            found, _ = nearest(SortedLines(np.stack(mine["v"].to_numpy())), mine["ids"].tolist(), np.stack(asked["v"].to_numpy()).astype(np.float64), own, k)
            out = [(q, i, s) for q, best in zip(own, found, strict=True) for s, i in best]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    # A task per pair of blocks: these are few bytes and much work, so they are not merged by size.
    pairs = blocks * chunks
    left, right = (x.repartition(pairs, *cell) for x in (left, right))
    found = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInPandas(match, "query_id long, vec_id long, score double")
    # The same id may come from two different vectors in a table with repeated ids: best first.
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
