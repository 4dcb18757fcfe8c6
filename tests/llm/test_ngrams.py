import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crewlens.llm import ngrams
from crewlens.llm.common import table
from tests.llm import brute

SCHEMA = "doc_id long, text string"


def compare(rows, df):
    got = {r.doc_id: r for r in ngrams.scores(df).collect()}
    want = brute.lm(rows, ngrams.MU)
    assert set(got) == set(want)
    for d, (n, known, all_, base, score) in want.items():
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (brute.fold(d) == 1, n, known, all_)
        assert r.base_score == pytest.approx(base, abs=1e-6)
        # A pair's count is kept within 1/2048 of a power of two.
        assert abs(r.score - score) <= n * np.log10(2) / 2048 + 1e-6


def test_whole_table(spark):
    df = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    compare([tuple(r) for r in df.collect()], df)


def test_edges_and_a_hot_word(make):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["the", "The", f"w{rng.randrange(90)}"]) for _ in range(rng.randrange(60)))) for i in range(200)]
    rows += [(1000, None), (1001, ""), (1002, "\t\n"), (1003, "é É \x85 a\x1fb"), (1004, "the " * 60000)]
    compare(rows, make(SCHEMA, rows).repartition(5).withColumn("doc", F.lit("x")).withColumn("held", F.lit(1)).withColumn("bucket", F.lit(0)))


def test_repeated_rows_null_ids_empty_tables(make):
    rows = [(2, "a b"), (2, "a b"), (2, "c"), (None, "a b z")]
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in ngrams.scores(make(SCHEMA, rows)).collect())
    assert brute.fold(2) != 1
    assert got == [("2", False, 2, 2, 8), ("2", False, 3, 3, 8), ("2", False, 3, 3, 8), ("None", False, 4, 3, 8)]
    assert ngrams.scores(make(SCHEMA, [])).collect() == []
    held = next(i for i in range(99) if brute.fold(i) == 1)
    (r,) = ngrams.scores(make(SCHEMA, [(held, "a")])).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (2, 0, 0, 0.0, 0.0)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3000), max_size=300), st.lists(st.integers(0, 3001), min_size=1, max_size=30))
def test_elias_fano_get_and_successor(values, asked):
    values = np.sort(np.array(values, np.uint64))
    ef = ngrams.EliasFano.of(values, 3000)
    assert np.array_equal(ef.get(np.arange(len(values))), values)
    for q in asked:
        for first, end in ((0, len(values)), (len(values) // 3, len(values) // 2)):
            at = ef.successor(np.array([q], np.uint64), np.array([first]), np.array([end]))[0]
            assert at == first + np.searchsorted(values[first:end], q)


def test_trie_finds_its_pairs_and_no_others(tmp_path):
    rng = np.random.default_rng(4)
    pairs = {(int(a), int(b)): int(c) for a, b, c in zip(rng.integers(0, 60, 3000), rng.integers(0, 1 << 48, 3000) % 500, rng.integers(1, 900, 3000))}
    keys = sorted(pairs)
    a, b = (np.array(x, np.uint64) for x in zip(*keys))
    buffer = ngrams.Trie.pack(a, b, np.array([pairs[k] for k in keys]))
    path = tmp_path / "trie"
    path.write_bytes(buffer)
    for trie in (ngrams.Trie(buffer), ngrams.Trie.open(str(path))):
        x, y = rng.integers(0, 70, 5000).astype(np.uint64), rng.integers(0, 520, 5000).astype(np.uint64)
        want = ngrams.quantised(np.array([pairs.get((int(i), int(j)), 0) for i, j in zip(x, y, strict=True)]))
        assert np.array_equal(trie.codes_of(x, y), want)
    empty = ngrams.Trie(ngrams.Trie.pack(a[:0], b[:0], np.zeros(0, int)))
    assert empty.codes_of(a[:3], b[:3]).tolist() == [0, 0, 0]


def test_quantised_counts():
    n = np.concatenate([np.arange(0, 5000), 2 ** np.arange(12, 63), [(1 << 63) - 1]])
    back = ngrams.restored(ngrams.quantised(n))
    assert back[0] == 0 and back[1] == 1 and np.all(np.abs(np.log2(back[1:] / n[1:])) <= 1 / 2048 + 1e-9)


def test_places_are_those_of_a_scan():
    owner = np.random.default_rng(1).integers(0, 9, 500)
    owner = owner[owner != 4]
    for part, at in enumerate(ngrams._places(owner, 11)):
        assert np.array_equal(at, np.flatnonzero(owner == part))
