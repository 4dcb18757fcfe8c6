"""A cleaning pipeline over ``documents``: rules, near copies, repeated passages, mix, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; each is written and read again
before the next one runs. All but the last return the columns of the documents; the last one
adds the tokens.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crewlens.llm import jaccard, mixing, pieces, quality, repeats
from crewlens.session import shared_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and whose host is not rejected."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: the smallest doc_id."""
    return jaccard.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings that start earlier elsewhere; n_chars is that of the new text."""
    left = repeats.remove(docs)
    return left.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else left


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, token_ids, decoded and their digests."""
    return pieces.encode(docs, "doc_id", ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mix_sources", mix_sources),
    ("sentencepiece", sentencepiece),
]

#: The encoding of the last stage has no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; all but the last are written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
