"""One query per operator over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crewlens.llm import chat, fingerprints, jaccard, language, mixing, neighbours, ngrams, periods, pieces, quality, repeats, tries, urls
from crewlens.llm.common import table
from crewlens.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]


def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_report(table(spark, folder, "documents"))


def op2_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.search(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.verdicts(table(spark, folder, "documents"), "doc_id").select(
        "doc_id", *quality.MEASURES, "base_failed", "kept"
    )


def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.report(table(spark, folder, "documents"))


def op5_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encode(table(spark, folder, "documents"), "doc_id")


def op6_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    judged = urls.judge(table(spark, folder, "pages"))
    # The scores are sums whose order is not fixed.
    return judged.withColumns({c: F.round(c, 6) for c in ("trust", "distrust")})


def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar(table(spark, folder, "documents"))


def op7_jaccard_links(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.linked(table(spark, folder, "documents"))


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"))


def op9_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return ngrams.scores(table(spark, folder, "documents"))


def op10_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    return chat.rendered(table(spark, folder, "conversations"))


def op11_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.next_likeness(table(spark, folder, "documents"))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return tries.report(table(spark, folder, "conversations"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periods.report(periods.loops_planted(table(spark, folder, "documents")))


QUERIES: dict[str, Query] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_nearest_neighbours": op2_nearest_neighbours,
    "op3_quality_rules": op3_quality_rules,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_url_filters": op6_url_filters,
    "op7_jaccard_join": op7_jaccard_join,
    "op7_jaccard_links": op7_jaccard_links,
    "op8_language_id": op8_language_id,
    "op9_lm_scores": op9_lm_scores,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_fingerprints": op11_fingerprints,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_periodic_runs": op13_periodic_runs,
}

