"""The pipeline's stages against plain versions, each on its own input."""

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from crewlens.llm import mixing, pieces
from crewlens.llm.common import table
from tests.llm import brute


def test_stages_on_a_whole_table(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    columns, inputs = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = [r.asDict() for r in docs.collect()]
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "sentencepiece":
            assert docs.columns == columns
    ids = lambda rows: sorted(r["doc_id"] for r in rows)

    rows = inputs["quality_rules"]
    kept = brute.quality([(r["source"], r["text"]) for r in rows])
    assert ids(inputs["near_duplicates"]) == ids(r for r, k in zip(rows, kept, strict=True) if k)

    rows = inputs["near_duplicates"]
    whole = brute.components([(r["doc_id"], r["text"]) for r in rows])
    assert ids(inputs["repeated_passages"]) == ids(r for r in rows if whole[r["doc_id"]] == r["doc_id"])

    rows = inputs["repeated_passages"]
    left = {
        r["doc_id"]: brute.cut(r["text"], g).decode("utf-8", "ignore")
        for r, g in zip(rows, brute.repeats([(r["doc_id"], r["text"]) for r in rows]), strict=True)
    }
    assert {r["doc_id"]: r["text"] for r in inputs["mix_sources"]} == left
    assert all(r["n_chars"] == len(r["text"]) for r in inputs["mix_sources"])

    rows = inputs["mix_sources"]
    report = mixing.mix_report(spark.read.parquet(str(tmp_path / "repeated_passages"))).collect()
    size = {r.doc_id: r.size for r in report}
    copies = {r["doc_id"]: 0 for r in rows}
    for r in inputs["sentencepiece"]:
        copies[r["doc_id"]] += 1
    assert all(copies[r.doc_id] * r.size == r.taken for r in report)
    assert all(copies[d] <= 2 for d in size)

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))
    text = {r["doc_id"]: r["text"] for r in inputs["sentencepiece"]}
    out = docs.collect()
    assert ids(r.asDict() for r in out) == ids(inputs["sentencepiece"])
    for r in out:
        want = library.encode(text[r.doc_id], add_eos=True)
        assert list(r.token_ids) == want and r.decoded == library.decode(want) and r.n_tokens == len(want)


def test_empty_table_and_extra_columns(spark, tmp_path):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    for name, df in (("none", docs.limit(0)), ("more", docs.limit(60).withColumn("key", F.lit("x")).withColumn("row", F.lit(1)).withColumn("size", F.lit(2)))):
        for stage_name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, df, "")
            assert out.columns == df.columns
            out.write.parquet(str(tmp_path / name / stage_name))
            df = spark.read.parquet(str(tmp_path / name / stage_name))
        assert corpus_pipeline.STAGES[-1][1](spark, df, "").count() == df.count()
