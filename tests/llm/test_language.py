import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from crewlens.llm import language
from crewlens.llm.common import table
from tests.llm import brute

SCHEMA = "doc_id long, lang string, text string"


def test_accuracy_on_the_held_out_fold(spark):
    df = table(spark, "/root/testdata/sf0.01", "documents")
    lang = {r.doc_id: r.lang for r in df.collect()}
    got = language.identify(df).collect()
    assert len(got) == len(lang)
    assert all(r.held_out == (brute.fold(r.doc_id) == 0) and 0 <= r.score <= 1 for r in got)
    held = [r.lang_pred == lang[r.doc_id] for r in got if r.held_out]
    assert len(held) > 100 and np.mean(held) >= 0.97


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[3])
    got = sorted(((r.doc_id, r.held_out, r.lang_pred, r.score) for r in got), key=key)
    assert len(got) == len(want)
    for a, b in zip(got, sorted(want, key=key), strict=True):
        assert a[:3] == b[:3] and abs(a[3] - b[3]) < 1e-6, (a, b)


def test_fixture_equals_brute_force(make, monkeypatch):
    rng = random.Random(2)
    words = {x: [x + rng.choice("aeiou") + rng.choice("lmnrst") + str(k % 3) for k in range(40)] for x in ("de", "fr", "é", "щу")}
    rows = [(i, x, " ".join(rng.choices(words[x], k=rng.randrange(1, 40)))) for i, x in enumerate(rng.choices(list(words), k=160))]
    rows += [(900, None, "dea fro"), (901, "de", None), (902, "fr", "1 2 !"), (None, "fr", "fra frel0"), (903, None, "DEL1 " * 3000)]
    monkeypatch.setattr(language, "ROWS", 7)
    same(language.identify(make(SCHEMA, rows).repartition(3)).collect(), brute.language(rows))


def test_whole_table_equals_brute_force(spark):
    df = table(spark, "/root/testdata/sf0.001", "documents").where("length(text) < 6000").select("doc_id", "lang", "text")
    same(language.identify(df).collect(), brute.language([tuple(r) for r in df.collect()]))


def test_vectors_of_many_short_texts_are_made_few_at_a_time():
    texts = pa.array([f"t{i}" for i in range(3000)])
    parts = list(language.counted(texts))
    assert max(b - a for a, b, _ in parts) == language.ROWS and [a for a, _, _ in parts] == list(range(0, 3000, language.ROWS))
    whole = np.concatenate([c for _, _, c in parts])
    assert whole.shape == (3000, language.DIMENSIONS) and (whole.sum(axis=1) == [sum(range(len(t.as_py()), max(len(t.as_py()) - 3, 0), -1)) for t in texts]).all()


def test_held_out_labels_are_not_seen(spark):
    df = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "lang", "text")
    wrong = df.withColumn("lang", F.when(language.fold(F.col("doc_id")) == 0, F.lit("xx")).otherwise(F.col("lang")))
    pick = lambda d: sorted(tuple(r) for r in language.identify(d).collect())
    assert pick(df) == pick(wrong) == pick(df.repartition(4))


def test_edges(make):
    rows = [(i, "aa" if i % 2 else "bb", ("aba cada " if i % 2 else "xyx zuzu ") * (1 + i % 5)) for i in range(60)]
    rows += [(100, "aa", None), (101, "aa", ""), (102, None, "12 34 !?"), (103, None, "cada"), (None, "bb", "zuzu"), (1, "aa", "aba"), (104, None, "aba " * 100000)]
    df = make(SCHEMA, rows).withColumn("letter", F.lit("q")).withColumn("score", F.lit("s")).withColumn("rank", F.lit(0))
    got = {r.doc_id: r for r in language.identify(df).collect()}
    assert {d: got[d].lang_pred for d in (100, 101, 102, 103, 104, None)} == {
        100: "und", 101: "und", 102: "und", 103: "aa", 104: "aa", None: "bb"
    }
    assert got[100].score == 0 and got[None].held_out is False
    assert language.identify(make(SCHEMA, [])).collect() == []
    assert [r.lang_pred for r in language.identify(make(SCHEMA, [(1, None, "abc")])).collect()] == ["und"]


def test_far_texts_are_not_accepted(make):
    rows = [(i, "aa", "the cat and the dog are in the house " * 3) for i in range(40)] + [(1000, None, "щука рыба вода")]
    got = {r.doc_id: r.accepted for r in language.identify(make(SCHEMA, rows)).collect()}
    assert got[1000] is False and got[3] is True


def test_sample_is_bounded(make):
    rows = [(i, "aa", f"text {i}") for i in range(300)] + [(i, "bb", f"other {i}") for i in range(300, 320)]
    df = make(SCHEMA, rows)
    model = language.learn(df, np.ones(language.DIMENSIONS), per_language=50)
    assert model["lang"].value_counts().max() <= language.CENTROIDS and set(model["lang"]) == {"aa", "bb"}
