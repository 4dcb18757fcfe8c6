import pytest
from pyspark.sql import functions as F

from crewlens.llm import mixing
from tests.llm import brute

SCHEMA = "doc_id long, text string, source string"
ROWS = [(i, "w " * (1 + i * 7 % 40), f"s{i % 7}" if i % 11 else None) for i in range(400)]


def check(rows, got):
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(brute.words(text))
    goal = brute.targets(sizes)
    source = {d: s for d, _, s in rows}
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(goal[s])
        assert 0 <= r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[s] += r.taken
    largest = {s: max(len(brute.words(t)) for _, t, x in rows if x == s) for s in sizes}
    for s in sizes:
        assert abs(taken[s] - goal[s]) <= 2 * largest[s]


def test_targets_and_taken(make):
    df = make(SCHEMA, ROWS)
    got = mixing.mix_report(df).collect()
    assert len(got) == len(ROWS)
    check(ROWS, got)
    assert sorted(got) == sorted(mixing.mix_report(df.repartition(5)).collect())


def test_a_third_in_one_source_and_ceiling(make):
    rows = [(i, "a b c", "big") for i in range(300)] + [(1000 + i, "x " * 50, "small") for i in range(4)]
    check(rows, mixing.mix_report(make(SCHEMA, rows)).collect())


def test_edges(make):
    rows = [(1, None, "a"), (2, "", "a"), (None, "x y", "b"), (4, "x y", "b"), (4, "x y", "b"), (5, "z", None), (6, "q " * 9000, "c")]
    got = mixing.mix_report(make(SCHEMA, rows)).collect()
    assert len(got) == len(rows)
    assert {r.taken for r in got if r.size == 0} == {0} and {r.target for r in got if r.source_size == 0} == {0.0}
    assert mixing.mix_report(make(SCHEMA, [])).collect() == []
    assert [r.taken for r in mixing.mix_report(make(SCHEMA, [(1, None, "a")])).collect()] == [0]


def test_mixed_rows_match_report(make):
    rows = [*ROWS, ROWS[3], ROWS[3], (None, None, None)]
    df = make(SCHEMA, rows).withColumn("size", F.lit("mine")).withColumn("Key", F.lit(1)).withColumn("row", F.lit(2))
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns and mixed.schema == df.schema or mixed.columns == df.columns
    copies = {r.doc_id: r.n for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    for r in mixing.mix_report(df).groupBy("doc_id", "size").agg(F.sum("taken").alias("t")).collect():
        assert copies.get(r.doc_id, 0) * r.size == r.t
