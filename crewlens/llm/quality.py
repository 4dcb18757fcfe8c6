"""Quality rules judged per document and per host.

Every document is measured on its whole text. A host (the document's source) is judged rule by
rule, by the share of its documents that fail the rule, shrunk towards the corpus by a beta prior.
The prior of a rule is fitted to the hosts' rates by moments: of their spread, what chance alone
gives hosts of their sizes is taken off, so that many small hosts that are all alike get a strong
prior. All documents of a host that any rule rejects go, besides those that fail a rule themselves.

Nulls and edges: a null or empty text has no words and fails. Documents without a source
belong to no host and are judged by their own rules. With one host only, hosts that differ no
more than by chance, or hosts of one document each, the prior is as strong as ``STRONGEST``
documents. Repeated rows count each. A rate of exactly ``HOST_RATE`` does not reject. A text is
measured in one row, which must fit in a task's memory. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crewlens.llm.common import SPACES, WORD, row_key, saved
from crewlens.operators.lookup import join_group_facts

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
REPEAT_PERCENT = 50
SYMBOLS_PER_10_WORDS = 1
DUP_LINE_PERCENT = 30
WORD_LENGTH = (2, 12)
HOST_RATE = 0.5
STRONGEST = 1e6
WEAKEST = 1.0
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def measure(docs: DataFrame) -> DataFrame:
    """Columns of ``docs``, the five measures and n_lines (lines with a word)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    tokens = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    first = docs.select(
        "*",
        F.transform(tokens, lambda w: F.xxhash64(w)).alias("__words"),
        lines.alias("__lines"),
        _without(text, SPACES).cast("long").alias("word_chars"),
        (F.length(text) - _without(text, SYMBOLS)).cast("long").alias("n_symbols"),
    )
    size = F.size("__words")
    pairs = F.zip_with(F.slice("__words", 1, size - 2), F.slice("__words", 2, size - 2), lambda a, b: F.xxhash64(a, b))
    threes = F.zip_with(pairs, F.slice("__words", 3, size - 2), lambda a, b: F.xxhash64(a, b))
    second = first.select("*", F.when(size >= 3, threes).otherwise(F.array().cast("array<bigint>")).alias("__threes"))
    return second.select(
        *docs.columns,
        size.cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        _repeated("__threes").cast("long").alias("n_repeat_words"),
        F.size("__lines").cast("long").alias("n_lines"),
    )


def _repeated(windows: str) -> Column:
    """Words covered by windows that occur twice or more.

    The windows are sorted with their positions, so that repeats are neighbours.
    """
    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    none = F.array().cast("array<int>")
    marked = F.zip_with(
        F.slice(placed, 1, F.size(windows) - 1),
        F.slice(placed, 2, F.size(windows) - 1),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(none),
    )
    starts = F.array_distinct(F.flatten(marked))
    covered = F.array_distinct(F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(F.size(covered))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


#: The rules whose failures are counted for each host.
def rules() -> dict[str, Column]:
    return {
        "base": base_failed(),
        "symbols": 10 * F.col("n_symbols") > SYMBOLS_PER_10_WORDS * F.col("n_words"),
        "dup_lines": 100 * F.col("n_dup_lines") > DUP_LINE_PERCENT * F.col("n_lines"),
        "word_length": ~F.col("word_chars").between(WORD_LENGTH[0] * F.col("n_words"), WORD_LENGTH[1] * F.col("n_words")),
    }


def hosts(judged: DataFrame) -> DataFrame:
    """host, n documents, and per rule its failures, shrunk rate and verdict (``rules``), then the
    largest rate and whether any rule rejects the host; needs (source, failed_rules)."""
    names = list(rules())
    counts = judged.where("source IS NOT NULL").groupBy("source").agg(
        F.count("*").alias("n"), *[F.sum(F.array_contains("failed_rules", r).cast("long")).alias(r) for r in names]
    )
    moments = counts.agg(
        F.sum("n").alias("n"), F.count("*").alias("hosts"),
        *[m for r in names for m in (F.sum(r).alias(r), F.expr(f"sum({r} * {r} / n)").alias(f"{r}_square"))],
    )
    prior = moments.select(F.struct(*[_prior(r).alias(r) for r in names])).scalar()

    def judgement(r: str) -> Column:
        own = F.col(f"prior.{r}")
        rate = (F.col(r) + own["a"]) / (F.col("n") + own["a"] + own["b"])
        return F.struct(F.lit(r).alias("rule"), F.col(r).alias("fails"), rate.alias("rate"), (rate > HOST_RATE).alias("rejected"))

    found = counts.withColumn("prior", prior).select(F.col("source").alias("host"), "n", F.array(*map(judgement, names)).alias("rules"))
    return found.select(
        "*", F.array_max(F.col("rules.rate")).alias("rate"), F.exists("rules", lambda r: r["rejected"]).alias("rejected")
    )


def _prior(rule: str) -> Column:
    """Beta prior (a, b) of a rule, from sums over the hosts.

    The rate of a host of n documents varies by ``m (1 - m) (c + (1 - c) / n)`` about the mean m
    if documents of a host are correlated by c. Averaged over documents, 1 / n is the number of
    hosts over that of documents. The prior counts as many documents as 1 / c - 1.
    """
    n = F.col("n")
    mean = F.col(rule) / n
    noise = F.col("hosts") / n
    spread = (F.col(f"{rule}_square") / n - mean * mean) / (mean * (1 - mean))
    correlation = (spread - noise) / (1 - noise)
    fitted = F.least(F.lit(STRONGEST), F.greatest(F.lit(WEAKEST), 1 / correlation - 1))
    known = (mean > 0) & (mean < 1) & (noise < 1)
    strength = F.when(known, F.when(spread > noise, fitted)).otherwise(F.lit(None))
    strength = F.coalesce(strength, F.lit(STRONGEST))
    return F.struct((mean * strength).alias("a"), ((1 - mean) * strength).alias("b"))


def verdicts(docs: DataFrame, *keys: str) -> DataFrame:
    """The key columns, the measures, base_failed, failed rules, host_rate and kept, per document."""
    measured = measure(docs.select(*keys, "source", "text")).drop("text")
    tests = rules()
    failed = F.array_compact(F.array(*[F.when(t, F.lit(name)) for name, t in tests.items()]))
    judged = saved(
        measured.select("*", base_failed().alias("base_failed"), failed.alias("failed_rules")).withColumn(
            "failed", F.size("failed_rules") > 0
        )
    )
    by_host = hosts(judged).select(F.col("host").alias("source"), F.col("rate").alias("host_rate"), "rejected")
    # Salted, so that a host with a third of all documents is spread.
    return join_group_facts(judged, by_host, "source", "left", keys).select(
        *keys,
        *MEASURES,
        "base_failed",
        "failed_rules",
        "host_rate",
        (~F.col("failed") & ~F.coalesce("rejected", F.lit(False))).alias("kept"),
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents whose verdict is to keep them, with all their columns."""
    keyed = docs.withColumn("__key", row_key("doc_id", "source", "text"))
    good = verdicts(keyed.select("__key", "source", "text"), "__key").where("kept").select("__key")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    held = docs.select(row.alias("row"), row_key("doc_id", "source", "text").alias("__key"))
    return held.join(good.distinct(), "__key", "left_semi").select("row.*")
