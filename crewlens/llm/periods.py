"""Periodic runs: stretches of words that repeat with a fixed lag, found by seed and extend.

A run of period ``q`` is a maximal stretch in which every word equals the one ``q`` words before,
``q`` is its smallest period, and it is at least ``SHORTEST`` words and ``COPIES`` periods long.
On the diagonal of lag ``q`` it therefore shows ``(COPIES - 1) * q`` matching words or more. Lags
are taken by powers of two. For the lags from ``low`` to ``2 * low - 1`` all grams of the smallest
overlap that such a run guarantees are indexed, and neighbouring occurrences of a gram that lie a
lag of the class apart are seeds. Neighbouring ones are enough, so that a word repeated a million
times does not give all pairs: the grams are as long as the longest lag of their class, and such a
gram recurs inside a run at whole periods only. A gram that occurs once in its document is left out
of the longer classes, which are made of longer grams. A seed is extended word by word to both
sides, unless the table of what is covered on its lag says that an earlier one has done it.

Texts are whole and each is judged alone, by one task; it and its words must fit there. Words are
told apart by 64-bit hashes. Nulls and edges: a null or empty text has no words and no runs; rows
without doc_id are documents like others; repeated rows are judged each; equal ratios go to the
smaller start, then the smaller period. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crewlens.llm.common import WORD
from crewlens.llm.texts import combine

SHORTEST = 6
COPIES = 4
#: Bytes of collapsed text per Arrow batch; a longer text makes a batch of its own.
BATCH = 1 << 22

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _grams(words: np.ndarray, size: int, at: np.ndarray) -> np.ndarray:
    """Hashes of the ``size`` words from each place on, doubled from shorter ones."""
    whole, out, done, width = words, None, 0, 1
    while True:
        if size & width:
            part = whole[at + done]
            out = part if out is None else combine(out, part)
            done += width
        width *= 2
        if width > size:
            return out
        half = width // 2
        whole = combine(whole[:-half], whole[half:])


def _matches_right(words: np.ndarray, at: int, lag: int) -> int:
    """First place from ``at`` on whose word differs from the one ``lag`` later."""
    step = 32
    while at + lag < len(words):
        step = min(2 * step, len(words) - lag - at)
        differ = np.flatnonzero(words[at : at + step] != words[at + lag : at + lag + step])
        if len(differ):
            return at + int(differ[0])
        at += step
    return at


def _matches_left(words: np.ndarray, at: int, lag: int) -> int:
    """First place of the stretch before ``at`` whose words equal those ``lag`` later."""
    step = 32
    while at > 0:
        step = min(2 * step, at)
        differ = np.flatnonzero(words[at - step : at] != words[at - step + lag : at + lag])
        if len(differ):
            return at - step + int(differ[-1]) + 1
        at -= step
    return at


def runs_of(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs among word hashes, by start, then period."""
    found, low, at = [], 1, np.arange(len(words))
    while COPIES * low <= len(words) and len(at):
        size = max(SHORTEST - low, (COPIES - 1) * low)
        at = at[at + size <= len(words)]
        hashes = _grams(words, size, at)
        ordered = np.sort(hashes)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        if not len(twice):
            break
        place = np.minimum(np.searchsorted(twice, hashes), len(twice) - 1)
        again = twice[place] == hashes
        at, hashes = at[again], hashes[again]
        order = np.lexsort((at, hashes))
        near, same = at[order], hashes[order]
        lag = np.diff(near)
        seed = (same[1:] == same[:-1]) & (lag >= low) & (lag < 2 * low)
        lag, start = lag[seed], near[:-1][seed]
        order = np.lexsort((start, lag))
        lag, start = lag[order], start[order]
        # Seeds whose window touches the one before lie on a stretch that it covers.
        fresh = np.ones(len(lag), bool)
        fresh[1:] = (lag[1:] != lag[:-1]) | (start[1:] > start[:-1] + size)
        covered: dict[int, int] = {}
        for q, s in zip(lag[fresh].tolist(), start[fresh].tolist(), strict=True):
            if s < covered.get(q, 0):
                continue
            end = _matches_right(words, s, q)
            begin = _matches_left(words, s, q)
            covered[q] = end
            if end - begin + q >= max(SHORTEST, COPIES * q):
                found.append((begin, end - begin + q, q))
        low *= 2
    return sorted(found, key=lambda r: (r[0], r[2]))


def _kept(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay: those that no run holds after its first period."""
    step = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        step[start + period] += 1
        step[start + length] -= 1
    return np.cumsum(step[:-1]) == 0


def collapse(docs: DataFrame, *keys: str) -> DataFrame:
    """The key columns, n_words, runs (start, length, period; words from 0) and collapsed: the
    words left of each text once every run is cut to its first period, joined by blanks."""
    rows = docs.select(*keys, F.coalesce("text", F.lit("")).alias("text"))
    shape = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)
    shape = f"{shape}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"

    def answer(batch: pa.RecordBatch, low: int, sizes: list[int], runs: list[list], texts: list[bytes]) -> pa.RecordBatch:
        flat = [dict(zip(("start", "length", "period"), r, strict=True)) for x in runs for r in x]
        ends = np.cumsum([0, *map(len, runs)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, _RUN))
        columns = [batch.column(i).slice(low, len(sizes)) for i in range(len(keys))]
        plain = pa.array(texts, pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([*columns, pa.array(sizes, pa.int64()), lists, plain], [*keys, "n_words", "runs", "collapsed"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, held, sizes, runs, texts = 0, 0, [], [], []
            for text in batch.column(len(keys)):
                # The white space of bytes.split() is that of the words' pattern.
                words = text.as_buffer().to_pybytes().split()
                hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
                own = runs_of(hashes)
                if own:
                    stay = _kept(len(words), own)
                    left = b" ".join([w for w, k in zip(words, stay.tolist(), strict=True) if k])
                else:
                    left = b" ".join(words)
                sizes.append(len(words))
                runs.append(own)
                texts.append(left)
                held += len(left)
                if held >= BATCH:
                    yield answer(batch, low, sizes, runs, texts)
                    low, held, sizes, runs, texts = low + len(sizes), 0, [], [], []
            if sizes:
                yield answer(batch, low, sizes, runs, texts)

    return rows.mapInArrow(work, shape)


def loops_planted(docs: DataFrame) -> DataFrame:
    """doc_id and text of the documents, one in ten of them (by the checksum of doc_id) with its
    words from some place on replaced by a loop over the first few of them. Without doc_id or
    words a text stays as it is."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    split = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("words"))
    sized = split.withColumn("n", F.size("words")).withColumn("a", F.expr("if(n > 0, g % n, 0)"))
    lag = sized.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    loop = F.expr("flatten(array_repeat(slice(words, cast(a + 1 as int), cast(p as int)), cast((n - a) div p + 1 as int)))")
    # A whole number of loops, and one more for the rest.
    looped = F.array_join(F.concat(F.expr("slice(words, 1, cast(a as int))"), F.slice(loop, F.lit(1), F.expr("cast(n - a as int)"))), " ")
    return lag.select("doc_id", F.when(F.col("n") > 0, looped).otherwise(F.col("text")).alias("text"))


def _best(runs: Column) -> Column:
    """The run with the greatest ratio of length to period.

    The ratios of different runs are different doubles for texts of up to 10^8 words.
    """
    ranked = F.transform(runs, lambda r: F.struct(
        (r["length"].cast("double") / r["period"]).alias("ratio"), (-r["start"]).alias("s"), (-r["period"]).alias("p"), r["length"].alias("length"),
    ))
    return F.array_max(ranked)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, number of runs, the strongest run, and digests of all runs and of the words left."""
    found = collapse(docs, "doc_id").withColumn("best", _best(F.col("runs")))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    period = -F.col("best.p")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"),
        period.alias("period"),
        F.expr("(1000 * best.length) div (-best.p)").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
