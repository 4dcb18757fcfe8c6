import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from crewlens.llm import periods
from crewlens.llm.common import table
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


def hashed(words):
    return np.array([hash(w) for w in words], np.int64).view(np.uint64)


def test_random_words_over_small_alphabets_equal_brute_force():
    rng = random.Random(3)
    for k in range(1500):
        n, letters = rng.randrange(0, 70), rng.choice((1, 2, 2, 3, 5))
        w = [rng.randrange(letters) for _ in range(n)]
        if k % 3 == 0 and n:
            a, p = rng.randrange(n), 1 + rng.randrange(12)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        assert periods.runs_of(hashed(w)) == brute.runs(w), w


@pytest.mark.parametrize("period", [1, 2, 3, 5, 6, 7, 8, 15, 16, 17, 63, 64, 200])
def test_every_period_is_found_and_a_copy_too_few_is_not(period):
    unit = [f"u{i}" for i in range(period)]
    for length in (max(6, 4 * period), max(6, 4 * period) + period // 2, 9 * period + 7):
        w = ["x", "y", *(unit * 20)[:length], "z"]
        assert periods.runs_of(hashed(w)) == [(2, length, period)]
    assert periods.runs_of(hashed(["x", *(unit * 9)[: max(6, 4 * period) - 1], "z"])) == []


def test_units_whose_short_grams_recur():
    # Every gram of three occurs twice in the unit, so no short gram tells its period.
    unit = list("aababbaaabbbaababbab" + "aababbaaabbbaabbabab")
    for w in (unit * 5, ["x"] + unit * 4 + ["y"], unit * 6 + unit[:11]):
        assert periods.runs_of(hashed(w)) == brute.runs(w)


def test_one_word_a_million_times_is_linear():
    assert periods.runs_of(hashed(["a"] * 1_000_000)) == [(0, 1_000_000, 1)]
    w = (["a"] * 50 + ["b"] * 50) * 3000
    got = periods.runs_of(hashed(w))
    assert got[0] == (0, 50, 1) and (0, 300_000, 100) in got and len(got) == 6001


def compare(rows, df):
    got = {}
    for r in periods.report(periods.loops_planted(df)).collect():
        got.setdefault(r.doc_id, []).append(tuple(r)[1:])
    want = {}
    for d, t in rows:
        want.setdefault(d, []).append(brute.run_report(d, t))
    key = lambda r: tuple((x is not None, x) for x in r)
    assert {d: sorted(x, key=key) for d, x in got.items()} == {d: sorted(x, key=key) for d, x in want.items()}


def test_fixture_equals_brute_force(make):
    rng = random.Random(8)
    odd = [None, "", " \t\n", "one", "a a a a a", "a a a a a a", "é é\té é é é b", "a b " * 4, "x\x85y " * 9, "w " * 20000]
    rows = list(enumerate(odd)) + [(None, "q " * 8), (None, None), (3, "one"), (3, "one")]
    rows += [(100 + i, " ".join(f"w{rng.randrange(900)}" for _ in range(rng.randrange(1, 300)))) for i in range(150)]
    assert sum(zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows) > 10
    df = make(SCHEMA, rows).withColumn("runs", F.lit(1)).withColumn("n", F.lit("x")).withColumn("words", F.lit(0))
    compare(rows, df.repartition(4))


def test_whole_table_equals_brute_force(spark):
    df = table(spark, SMALL, "documents").select("doc_id", "text")
    compare([tuple(r) for r in df.collect() if len(r.text or "") < 20000], df.where("coalesce(length(text), 0) < 20000"))


def test_output_keeps_keys_and_whole_texts(make, monkeypatch):
    rows = [(i, f"t{i} " + "la li " * i + "end") for i in range(40)]
    monkeypatch.setattr(periods, "BATCH", 50)
    got = {r.doc_id: r for r in periods.collapse(make(SCHEMA, rows), "doc_id").collect()}
    assert got[10].collapsed == "t10 la li end" and [tuple(x) for x in got[10].runs] == [(1, 20, 2)]
    assert got[3].collapsed == "t3 la li la li la li end" and got[3].n_words == 8


def test_empty(make):
    assert periods.report(periods.loops_planted(make(SCHEMA, []))).collect() == []
    assert hashlib.sha256(b"").hexdigest() == periods.report(make(SCHEMA, [(1, None)])).first().runs_sha256
