import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from crewlens.llm import graph, jaccard
from crewlens.llm.common import table
from tests.llm import brute

SCHEMA = "doc_id long, text string"


def compare(rows, df, **options):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar(df, **options).collect()}
    whole = brute.components(rows)
    assert got == {d: (len(brute.shingles(t)), whole[d]) for d, t in rows}


def chains(seed, n=150):
    """Texts made from others by a few changed words, so that groups are long chains."""
    rng = random.Random(seed)
    texts = []
    for _ in range(n):
        if texts and rng.random() < 0.7:
            w = list(rng.choice(texts[-12:]))
            for _ in range(rng.randrange(1, 4)):
                w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
            if rng.random() < 0.3:
                w = w[: len(w) - rng.randrange(1, 9)]
        else:
            w = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(20, 120))]
        texts.append(w)
    ids = rng.sample(range(10**6), n)
    return [(i, " ".join(w)) for i, w in zip(ids, texts, strict=True)]


@pytest.mark.parametrize("seed", [1, 2])
def test_chains(make, seed):
    rows = chains(seed)
    compare(rows, make(SCHEMA, rows).repartition(6))


def test_a_passage_and_copies_in_many(make):
    rng = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"{passage} {' '.join(f'x{rng.randrange(10**6)}' for _ in range(rng.randrange(5, 60)))}") for i in range(120)]
    rows += [(1000 + i, "the same text in very many of the rows here") for i in range(60)]
    rows += [(2000 + i, f"{passage} tail{i}") for i in range(40)]
    compare(rows, make(SCHEMA, rows).repartition(5))


def test_whole_table(spark):
    df = table(spark, "/root/testdata/sf0.001", "documents")
    compare([(r.doc_id, r.text) for r in df.collect()], df)


def test_edges(make):
    long = " ".join(f"w{i % 9000}" for i in range(30000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a b"), (5, "A  b\n"), (6, "a b c"), (7, "a b c d e"), (8, "A B C D E"), (9, "é É"), (10, "é é"), (11, long), (12, long + " end")]
    df = make(SCHEMA, rows).withColumn("doc", F.lit("x")).withColumn("n", F.lit(0)).withColumn("tid", F.lit(0))
    compare(rows, df)
    assert jaccard.similar(make(SCHEMA, [])).collect() == []
    same = make(SCHEMA, [(None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (5, "other text"), (None, "z")])
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard.similar(same).collect())
    assert got == [("5", 1, "5"), ("5", 2, "5"), ("5", 2, "5"), ("None", 1, "None"), ("None", 2, "5")]


def test_one_of_each_group_stays(make):
    rows = [*chains(3), (2_000_000, None), (2_000_001, " "), (2_000_001, " ")]
    df = make(SCHEMA, [*rows, rows[0]]).withColumn("component", F.lit("x")).withColumn("row", F.lit(1))
    kept = jaccard.keep_one(df)
    assert kept.columns == df.columns
    want = [d for d, c in brute.components(rows[:-3]).items() if c == d]
    assert sorted(r.doc_id for r in kept.collect()) == sorted([*want, 2_000_000, 2_000_001, 2_000_001])


def near_copies(seed, n):
    """Texts that mostly are similar to each other, of two lengths that are at the threshold's edge."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(90)]
    rows = []
    for i in range(n):
        w = list(base if rng.random() < 0.6 else base[:70])
        w[rng.randrange(len(w))] = f"c{rng.randrange(10**6)}"
        rows.append((10**7 + i, " ".join(w)))
    return rows


@pytest.mark.parametrize("block", [None, 700])
def test_number_of_links(make, monkeypatch, block):
    if block:
        monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = chains(5, 80) + near_copies(6, 60)
    rows += [(2 * 10**7 + i, t) for i, (_, t) in enumerate(rows[70:100])] + [(1, None), (2, " "), (3, "alone")]
    sets = [(d, brute.shingles(t)) for d, t in rows]
    alike = lambda a, b: bool(a) and 100 * len(a & b) >= 75 * len(a | b)
    want = {d: sum(alike(a, b) for e, b in sets if e != d) for d, a in sets}
    got = jaccard.linked(make(SCHEMA, rows).repartition(4)).collect()
    assert {r.doc_id: r.n_links for r in got} == want
    assert max(want.values()) > 20
    whole = brute.components(rows)
    assert {r.doc_id: r.component_id for r in got} == whole


def test_null_and_repeated_ids_stay_unless_linked(make):
    near = " ".join(f"w{i}" for i in range(60))
    rows = [(None, "one text of its own words here"), (None, "a second text that is like no other"), (None, "the third of the unlinked texts")]
    rows += [(7, "an id that stands on this text"), (7, "and again on quite another one")]
    rows += [(None, near), (None, near + " end"), (9, near + " stop"), (None, "a copy twice over in here"), (None, "a copy twice over in here")]
    kept = jaccard.keep_one(make(SCHEMA, rows).repartition(3)).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted((str(d), t) for d, t in [*rows[:5], rows[7], rows[8]])


def test_components(make):
    rng = random.Random(8)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5)]
    edges += [(2000, 2001 + i) for i in range(100)]
    got = {r.node: r.root for r in graph.components(make("a long, b long", edges)).collect()}
    root = {x: x for e in edges for x in e if e[0] != e[1]}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            p, q = sorted((find(a), find(b)))
            root[q] = p
    assert got == {x: find(x) for x in root}
    assert graph.components(make("a long, b long", [])).collect() == []


def test_prefixes_share_the_first_common_token():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a = rng.choice(60, rng.integers(1, 40), replace=False).astype(np.uint64)
        b = np.unique(np.concatenate([a[: len(a) - len(a) // 8], rng.choice(60, 2).astype(np.uint64) + np.uint64(100)]))
        a = np.unique(a)
        both = len(np.intersect1d(a, b))
        if 100 * both >= 75 * (len(a) + len(b) - both):
            first, _, size = jaccard.prefixes(np.concatenate([a, b]), np.array([len(a), len(b)]), a[:3], np.array([1, 2, 1])[: len(a[:3])], 75)
            assert set(first[: size[0]].tolist()) & set(first[size[0] :].tolist())


def test_contracted_edges_connect_the_same_nodes(spark, monkeypatch):
    rng = random.Random(7)
    for n, m in ((1, 1), (5, 3), (60, 40), (60, 400), (400, 390), (3, 5000)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
        a, b = (np.array(x, np.int64) for x in zip(*edges))
        node, root = graph.stars(a * 7 - 9, b * 7 - 9)
        parent = list(range(n))

        def top(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for x, y in edges:
            low, high = sorted((top(x), top(y)))
            parent[high] = low
        want = {x * 7 - 9: top(x) * 7 - 9 for x in range(n) if top(x) != x}
        assert dict(zip(node.tolist(), root.tolist(), strict=True)) == want
    df = spark.range(0, 4000, numPartitions=64).selectExpr("id % 50 a", "pmod(xxhash64(id), 50) b")
    few = graph.contracted(df)
    assert few.count() <= 2 * 49 and graph.components(few).count() == graph.components(df).count() == 50
    monkeypatch.setattr(graph, "AT_ONCE", 8)
    assert graph.components(graph.contracted(df)).select("root").distinct().count() == 1
    assert graph.contracted(df.where("a < 0")).count() == 0
