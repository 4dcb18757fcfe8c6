import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from crewlens.llm import neighbours
from crewlens.llm.common import table

SCHEMA = "vec_id long, embedding array<float>"


def exact(vectors, query_ids, k=5):
    ids = np.array(sorted(vectors))
    m = np.stack([np.asarray(vectors[i], np.float64) for i in ids])
    m = m / np.linalg.norm(m, axis=1, keepdims=True)
    out = {}
    for q in query_ids:
        s = m @ m[np.searchsorted(ids, q)]
        order = [i for i in np.lexsort((ids, -np.round(s, 12))) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(s[i])) for i in order]
    return out


def recall(got, want):
    have = {}
    for r in got:
        have.setdefault(r.query_id, []).append(r.vec_id)
    hits = sum(len(set(have.get(q, [])) & {i for i, _ in n}) for q, n in want.items())
    return hits / max(1, sum(map(len, want.values())))


def test_recall_on_the_whole_table(spark):
    df = table(spark, "/root/testdata/sf0.1", "embeddings")
    vectors = {r.vec_id: r.embedding for r in df.collect()}
    want = exact(vectors, [i for i in vectors if i % 50 == 0])
    got = neighbours.search(df, F.col("vec_id") % 50 == 0).collect()
    assert recall(got, want) >= 0.98
    assert len(got) == sum(map(len, want.values()))
    for r in got:
        a, b = (np.asarray(vectors[i], np.float64) for i in (r.query_id, r.vec_id))
        assert abs(r.score - a @ b / (np.linalg.norm(a) * np.linalg.norm(b))) < 1e-12
    for q in want:
        own = sorted((r.rank, -r.score, r.vec_id) for r in got if r.query_id == q)
        assert [x[0] for x in own] == [1, 2, 3, 4, 5] and [x[1:] for x in own] == sorted(x[1:] for x in own)


def kinds(n, size=64):
    """Random vectors, and clustered ones of unlike spread."""
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((40, size)) * 3
    return {
        "random": rng.standard_normal((n, size)),
        "clustered": centres[rng.integers(0, 40, n)] + rng.standard_normal((n, size)) * rng.choice((0.1, 1.0), (n, 1)),
    }


@pytest.mark.parametrize("kind", ["random", "clustered"])
def test_few_vectors_are_verified_and_the_nearest_are_among_them(kind):
    """One block of the production size."""
    vectors = kinds(neighbours.BLOCK)[kind].astype(np.float32).astype(np.float64)
    own = list(range(0, len(vectors), 50))
    got, verified = neighbours.nearest(neighbours.SortedLines(vectors), [np.array([i]) for i in range(len(vectors))], vectors[own], own, 5)
    want = exact(dict(enumerate(vectors)), own)
    hits = sum(len({i for _, i in g} & {i for i, _ in want[q]}) for q, g in zip(own, got, strict=True))
    assert hits >= 0.95 * 5 * len(own)
    assert verified <= 0.05 * len(vectors) * len(own)


def test_recall_over_several_blocks_of_the_production_size(spark):
    n = 40_000
    vectors = kinds(n)["random"].astype(np.float32)
    df = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(n), "embedding": vectors.tolist()}), SCHEMA)
    got = neighbours.search(df, F.col("vec_id") % 200 == 0).collect()
    want = exact(dict(enumerate(vectors)), range(0, n, 200))
    assert len(got) == 5 * len(want) and recall(got, want) >= 0.95


def test_one_vector_in_a_third_of_the_rows(make):
    rng = np.random.default_rng(1)
    rows = [(i, [1.0, 2.0, 3.0, 4.0] if i % 3 == 0 else rng.standard_normal(4).tolist()) for i in range(600)]
    got = neighbours.search(make(SCHEMA, rows), F.col("vec_id") % 50 == 0).collect()
    for q in range(0, 600, 150):
        assert [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)] == [
            i for i in range(0, 24, 3) if i != q
        ][:5]
    want = exact({i: np.float32(v) for i, v in rows}, range(0, 600, 50))
    assert recall(got, want) >= 0.95


def test_edges(make):
    rows = [
        (0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [None, 1.0]), (6, []),
        (7, [2.0, 0.0]), (8, [0.0, 1.0]), (None, [1.0, 0.0]), (50, [-1.0, 0.0]), (50, [-1.0, 0.0]), (100, [1.0, 1.0, 1.0]),
    ]
    df = make(SCHEMA, rows).withColumn("v", F.lit(1)).withColumn("rank", F.lit("x")).withColumn("size", F.lit(0))
    got = sorted(tuple(r) for r in neighbours.search(df, F.col("vec_id") % 50 == 0).collect())
    assert [g[:3] for g in got] == [(0, 1, 7), (0, 2, 8), (0, 3, 50), (50, 1, 8), (50, 2, 0), (50, 3, 7)]
    assert [round(g[3], 12) for g in got] == [1.0, 0.0, -1.0, 0.0, -1.0, -1.0]
    assert neighbours.search(make(SCHEMA, []), F.col("vec_id") % 50 == 0).collect() == []
