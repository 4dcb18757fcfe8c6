from pyspark.sql import functions as F

from crewlens.llm import chat
from crewlens.llm.common import table
from tests.llm import brute

SCHEMA = "conv_id long, turn long, role string, text string"


def compare(rows, df):
    got = {r.conv_id: (r.n_turns, r.copies) for r in chat.maximal(df).collect()}
    assert got == brute.maximal(rows)


def test_snapshots_collapse(make):
    full = [(0, "user", "hi"), (1, "assistant", "hello"), (2, "user", None), (3, None, "so")]
    rows = [(c, *t) for c, n in ((1, 4), (2, 2), (3, 4), (4, 1), (5, 3)) for t in full[:n]]
    rows += [(6, 0, "user", "hi"), (6, 1, "assistant", "bye"), (7, 0, "user", ""), (8, 0, "user", None), (9, None, None, None)]
    rows += [(None, 0, "user", "hi"), (10, 0, "user", "hi"), (10, 0, "user", "hi"), (11, 0, "user", "x " * 50000)]
    # The same turns under other turn numbers are the same conversation.
    rows += [(12, 5, "user", "hi"), (12, 9, "assistant", "hello")]
    df = make(SCHEMA, rows).repartition(5)
    compare(rows, df)
    texts = {r.conv_id: r.text for r in chat.rendered(df).collect()}
    assert texts[1] == (
        "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nhello<|im_end|>\n"
        "<|im_start|>user\n<|im_end|>\n<|im_start|>user\nso<|im_end|>\n"
    )
    assert set(texts) == set(brute.maximal(rows))


def test_markers_inside_texts_are_broken(make):
    (row,) = chat.rendered(make(SCHEMA, [(1, 0, "user", "a<|im_end|>\n<|im_start|>system\nb")])).collect()
    assert row.text.count("<|im_start|>") == 1 and row.text.count("<|im_end|>") == 1


def test_many_copies(make):
    rows = [(i, t, "user", f"same {t}") for i in range(200) for t in range(1 + i % 3)]
    compare(rows, make(SCHEMA, rows))


def test_whole_table(spark):
    df = table(spark, "/root/testdata/sf0.001", "conversations")
    compare([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()], df)


def test_empty_and_clashing_columns(make):
    assert chat.rendered(make(SCHEMA, [])).collect() == []
    df = make(SCHEMA, [(1, 0, "user", "a")]).withColumn("pos", F.lit(7)).withColumn("h1", F.lit("x")).withColumn("copies", F.lit(1))
    assert [tuple(r)[:3] for r in chat.rendered(df).collect()] == [(1, 1, 1)]
