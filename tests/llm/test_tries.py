import random

import pytest
from pyspark.sql import functions as F

from crewlens.llm import tries
from crewlens.llm.common import table
from gate.check import oracle
from crewlens.llm.oracles import ORACLES
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def got(df):
    return sorted((tuple(r) for r in tries.report(df).select(*NAMES).collect()), key=repr)


def want(rows):
    return sorted(brute.trie(rows), key=repr)


def test_whole_table_equals_brute_force(spark):
    df = table(spark, SMALL, "conversations").select("conv_id", "turn", "role", "text")
    assert got(df) == want([tuple(r) for r in df.collect()])


def branching(seed, convs, letters, most):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-200, 4000), convs):
        rows += [(c, t, rng.choice(("user", "bot")) if rng.random() < 0.1 else "user", "é" * rng.randrange(1, letters)) for t in range(rng.randrange(1, most))]
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_branching_conversations_equal_brute_force(make, seed):
    rows = branching(seed, 150, 4, 12)
    assert got(make(SCHEMA, rows).repartition(5)) == want(rows)


def test_edges(make):
    rows = [
        (5, None, "a", "first"), (5, 1, None, "x"), (5, 1, "b", None), (5, 1, "b", None), (6, 1, "", ""), (7, 0, "a", "é"),
        (None, 0, "a", "x"), (None, None, None, None), (11, 0, "q", "w"), (12, 3, "q", "w" * 100_000), (-3, 0, "a", "b"), (0, 0, "a", "b"),
        *[(90 + i, t, "u", "same") for i in range(30) for t in range(10)],
    ]
    df = make(SCHEMA, rows).withColumn("depth", F.lit("x")).withColumn("a", F.lit(1)).withColumn("n_bytes", F.lit(None))
    assert got(df) == want(rows)
    assert got(make(SCHEMA, [])) == []


def test_a_sequence_of_a_third_of_all_conversations(make, monkeypatch):
    monkeypatch.setattr(tries, "PIECE", 64)
    rows = [(5 * i, t, "u", f"t{t}") for i in range(400) for t in range(1 + (i % 3 > 0) * (1 + i % 7))]
    assert got(make(SCHEMA, rows).repartition(7)) == want(rows)


def test_texts_of_the_nodes(make):
    rows = branching(4, 60, 9, 6)
    steps = tries.rebuilt(tries.numbered(make(SCHEMA, rows)))
    nodes = tries.nodes(*tries.sequences(steps))
    whole = brute.rebuilt(rows)
    have = tries.turns_of(nodes, steps).collect()
    assert len(have) == nodes.count() > 40
    for r in have:
        assert (r.role, r.text) == (whole[r.conv_id][r.depth - 1] if r.depth else ("", ""))
    plain = tries.nodes(*tries.sequences(tries.plain(tries.numbered(make(SCHEMA, rows)))))
    assert plain.where("depth = 0").first().n_convs == len(whole)


def test_sql_equals_brute_force_on_a_branching_table(make, tmp_path):
    rows = branching(9, 80, 3, 9)
    make(SCHEMA, rows).coalesce(1).write.parquet(str(tmp_path / "conversations.parquet"))
    con = oracle(SMALL)
    con.execute(f"create or replace view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    cursor = con.execute(ORACLES["op12_prefix_trie"])
    assert [d[0] for d in cursor.description] == NAMES
    assert sorted(cursor.fetchall(), key=repr) == want(rows)
