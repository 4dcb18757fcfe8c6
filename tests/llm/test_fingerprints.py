import random

import pytest
from pyspark.sql import functions as F

from crewlens.llm import fingerprints
from crewlens.llm.common import table
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


def got(df):
    return sorted((tuple(r) for r in fingerprints.next_likeness(df).collect()), key=repr)


def text_of(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}é" for _ in range(n))


@pytest.mark.parametrize("parts", ["1", "7"])
def test_equals_brute_force_however_the_ids_are_dealt(spark, make, parts):
    rng = random.Random(4)
    odd = [None, "", "a", "ab", "abc", "日本語の文", "\U0001f600" * 9, "x" * 5000, "q\x00z" * 40, "same text", "same text"]
    rows = [(7 * i - 30, t) for i, t in enumerate(odd + [text_of(rng, rng.randrange(1, 90)) for _ in range(60)])]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = make(SCHEMA, rows).withColumn("part", F.lit("x")).withColumn("kind", F.lit(9)).withColumn("n_chars", F.lit(1))
        assert got(df.repartition(5)) == sorted(brute.next_likeness(sorted(rows)), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_whole_table_equals_brute_force(spark):
    df = table(spark, SMALL, "documents").where("length(text) < 5000").select("doc_id", "text")
    rows = sorted(tuple(r) for r in df.collect())
    assert len(rows) > 150
    assert got(df) == sorted(brute.next_likeness(rows), key=repr)


def test_edges(make):
    assert got(make(SCHEMA, [])) == []
    assert got(make(SCHEMA, [(3, "lonely text of mine")])) == brute.next_likeness([(3, "lonely text of mine")])
    rows = [(1, "b b b b"), (None, "no id at all"), (None, None), (1, "b b b b"), (2, "two two two")]
    have = got(make(SCHEMA, rows))
    assert [r[0] for r in have] == [1, 1, 2, None, None]
    # Repeated rows follow one another, so the first one's next is its copy.
    assert sorted(r[6] for r in have if r[0] == 1)[1] == 1.0


def test_copies_share_a_digest_and_edits_stay_nearer_than_other_texts(spark):
    df = table(spark, "/root/testdata/sf0.01", "documents").where("length(text) >= 200")
    rows = fingerprints.next_likeness(df).collect()
    assert len({r.fingerprint for r in rows}) <= df.select("text").distinct().count()
    assert all(0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1 for r in rows)
    assert sum(r.near_edited > r.near_next for r in rows) >= 0.99 * len(rows)
    assert sorted(r.near_edited for r in rows)[len(rows) // 20] > 0.5


def test_compared_and_fingerprints(make):
    rows = [(1, "some text here"), (2, None), (3, "some text here")]
    df = fingerprints.fingerprints(make(SCHEMA, rows), "doc_id")
    assert {r.doc_id: r.fingerprint for r in df.collect()} == {d: brute.digest(t) for d, t in rows}
    pairs = df.withColumn("other", F.when(F.col("doc_id") != 3, F.lit(brute.digest("some text here"))))
    near = {r.doc_id: r.near for r in fingerprints.compared(pairs, "fingerprint", "other", "near").collect()}
    assert near == {1: 1.0, 2: brute.near(None, "some text here"), 3: None}
