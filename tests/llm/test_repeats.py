import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from crewlens.llm import repeats
from crewlens.llm.common import table
from tests.llm import brute

SCHEMA = "doc_id long, text string"


def expected(rows, depth=100):
    out = []
    for (d, t), gone in zip(rows, brute.repeats(rows, depth), strict=True):
        out.append((d, len((t or "").encode()), len(gone), brute.spans(gone), brute.sha(brute.cut(t, gone))))
    return out


def compare(rows, df, **options):
    got = [tuple(r) for r in repeats.report(df, **options).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(got, key=key) == sorted(expected(rows, options.get("depth", 100)), key=key)


def passages(seed, n=90):
    rng = random.Random(seed)
    letters = "abcdefgh éü日"
    pool = ["".join(rng.choice(letters) for _ in range(rng.randrange(60, 400))) for _ in range(12)]
    rows = []
    for i in rng.sample(range(10**6), n):
        parts = []
        for _ in range(rng.randrange(0, 6)):
            if rng.random() < 0.5:
                p = rng.choice(pool)
                a = rng.randrange(len(p))
                parts.append(p[a : a + rng.randrange(20, 300)])
            else:
                parts.append("".join(rng.choice(letters) for _ in range(rng.randrange(200))))
        rows.append((i, "".join(parts)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_passages(make, seed):
    rows = passages(seed)
    compare(rows, make(SCHEMA, rows).repartition(7))


def test_small_depth_and_self_overlap(make):
    rng = random.Random(6)
    rows = [(i, "".join(rng.choice("ab") for _ in range(rng.randrange(60)))) for i in range(40)] + [(99, "a" * 300), (98, "ab" * 200)]
    compare(rows, make(SCHEMA, rows).repartition(3), depth=12, anchor=5)


def test_many_copies(make):
    text = "".join(chr(97 + i * i % 23) for i in range(500))
    rows = [(1000 - i, text) for i in range(120)] + [(5000 + i, f"{i}{text[100:350]}{i}") for i in range(60)]
    compare(rows, make(SCHEMA, rows).repartition(9))


def test_edges(make):
    t = "".join(chr(97 + i * 7 % 25) + str(i % 10) for i in range(100))
    rows = [(1, None), (2, ""), (3, "x" * 99), (4, "x" * 100), (5, "x" * 101), (None, t), (None, t), (6, t), (6, t + "!"), (7, t[:150]), (8, "é" * 60 + t)]
    compare(rows, make(SCHEMA, rows).withColumn("bucket", F.lit("x")).withColumn("tid", F.lit(0)).withColumn("doc", F.lit(0)))
    assert repeats.report(make(SCHEMA, [])).collect() == []


def test_very_long_text(make):
    rng = random.Random(2)
    part = "".join(rng.choice("abcdefghijklmnop") for _ in range(400_000))
    rows = [(1, part + part[1000:4000]), (2, part[:200_000] + "zz")]
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in repeats.report(make(SCHEMA, rows)).collect()}
    assert got == {1: (3000, 1), 2: (200_000, 1)}


def test_whole_table(spark):
    df = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    compare([tuple(r) for r in df.collect()], df)


def test_texts_without_their_repeats(make):
    rows = [*passages(5), (-1, None), (-2, "")]
    df = make(SCHEMA, rows).withColumn("none", F.lit("x")).withColumn("row", F.lit(1)).select("none", "doc_id", "text", "row")
    left = repeats.remove(df)
    assert left.columns == df.columns
    got = {r.doc_id: (r.none, r.text, r.row) for r in left.collect()}
    for (d, t), gone in zip(rows, brute.repeats(rows), strict=True):
        assert got[d] == ("x", None if t is None else brute.cut(t, gone).decode("utf-8", "ignore"), 1)


def test_radix_groups_are_the_equal_strings():
    rng = np.random.default_rng(3)
    buf = rng.integers(97, 99, 4000).astype(np.uint8)
    starts = np.arange(0, 3900, 3)
    got = sorted(tuple(sorted(g.tolist())) for g in repeats.radix(np.zeros(len(starts), np.uint64), starts, repeats.eight(buf), 20))
    by = {}
    for i, s in enumerate(starts):
        by.setdefault(buf[s : s + 20].tobytes(), []).append(i)
    assert got == sorted(tuple(g) for g in by.values() if len(g) > 1)


def test_a_string_has_the_same_anchor_in_buffers_of_any_size(monkeypatch):
    """Also where hashes differ in their lower bits only."""
    rng = np.random.default_rng(5)
    text = rng.integers(97, 123, 400, dtype=np.uint8)
    real = repeats.Ranges.windows
    monkeypatch.setattr(repeats.Ranges, "windows", lambda self, size: real(self, size) >> np.uint64(44))

    def found(filler):
        buf = np.concatenate([text, rng.integers(97, 123, filler, dtype=np.uint8)])
        got = repeats.runs(buf, np.array([0, len(text), len(buf)]))
        return got[got["doc"] == 0][["key", "whole", "first", "runs", "back"]].tolist()

    assert found(200) == found(100_000) == found(1_500_000)
