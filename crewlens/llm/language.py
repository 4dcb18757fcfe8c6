"""Language identification by nearest centroid.

A text is a TF-IDF vector over hashed byte n-grams. Each language has several centroids, found by
spherical k-means over a bounded sample of its labelled documents; document frequencies come
from all of them. A text gets the language of the centroid with the largest cosine, and is
``accepted`` if it lies within that centroid's radius.

Learning: documents with a language, minus the held-out fold. Per language at most
``PER_LANGUAGE`` sampled documents, ``CENTROIDS`` centroids of ``DIMENSIONS`` numbers each; only
these centroids and the document frequencies pass through the driver.

Nulls and edges: a null text, or one without a letter, is ``und`` with score 0, and so is every
text if nothing could be learned. Rows without doc_id are neither learned from nor held out.
Repeated rows are predicted alike. Equal cosines go to the language that sorts first. Long texts
are read whole. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crewlens.llm.texts import LOWER, chunks, mix

#: Sampled documents per language for the centroids; document frequencies use all documents.
PER_LANGUAGE = 2000
CENTROIDS = 4
ROUNDS = 12
DIMENSIONS = 4096
#: Texts turned into vectors at once.
ROWS = 256
GRAMS = (1, 2, 3)
#: The share of a centroid's own sample that lies inside its radius.
INSIDE = 0.995
UNKNOWN = "und"
_U = np.uint64


def fold(doc_id: Column, folds: int = 5) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def gram_counts(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of hashed n-grams, one row per text; digits and ASCII punctuation count as one sign."""
    rows = len(offsets) - 1
    data = _FOLDED[buf].astype(_U)
    owner = np.repeat(np.arange(rows), np.diff(offsets))
    out = np.zeros(rows * DIMENSIONS)
    for n in GRAMS:
        if len(data) < n:
            continue
        code = np.full(len(data) - n + 1, n, _U)
        for k in range(n):
            code = code * _U(256) + data[k : len(data) - n + 1 + k]
        own = owner[: len(code)] == owner[n - 1 :]
        at = (mix(code[own]) % _U(DIMENSIONS)).astype(np.int64) + owner[: len(code)][own] * DIMENSIONS
        out += np.bincount(at, minlength=len(out))
    return out.reshape(rows, DIMENSIONS)


_FOLDED = LOWER.copy()
for _b in range(0x21, 0x80):
    if not (0x41 <= _b <= 0x5A or 0x61 <= _b <= 0x7A):
        _FOLDED[_b] = 0x2E
_FOLDED[[0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0x20


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF vectors; a row of zeros stays one."""
    v = np.log1p(counts) * idf
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    return np.divide(v, norm, out=v, where=norm > 0)


def counted(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """First row, one past the last row and their gram counts, ``ROWS`` texts at a time at most: a
    text takes a row of ``DIMENSIONS`` numbers, however short it is."""
    for start, stop, buf, offsets in chunks(texts):
        for low in range(start, stop, ROWS):
            high = min(stop, low + ROWS)
            own = offsets[low - start : high - start + 1]
            yield low, high, gram_counts(buf[own[0] : own[-1]], own - own[0])


def vectors(texts: pa.Array, idf: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    for start, stop, counts in counted(texts):
        yield start, stop, weighted(counts, idf)


def cluster(points: np.ndarray, k: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids and, for each, the cosine that ``INSIDE`` of its points reach."""
    centres = [points.mean(axis=0)]
    for _ in range(min(k, len(points)) - 1):
        near = np.max(points @ np.stack(centres).T, axis=1)
        centres.append(points[int(near.argmin())])
    c = np.stack(centres)
    for _ in range(rounds):
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        own = (points @ c.T).argmax(axis=1)
        # An emptied cluster keeps its place.
        c = np.stack([points[own == j].mean(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
    c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    cosine = points @ c.T
    own = cosine.argmax(axis=1)
    radius = [np.quantile(cosine[own == j, j], 1 - INSIDE) if (own == j).any() else 1.0 for j in range(len(c))]
    return c, np.array(radius)


def document_frequencies(labelled: DataFrame) -> np.ndarray:
    """Inverse document frequency of every dimension over all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            for _, _, counts in counted(batch.column(0)):
                seen += (counts > 0).sum(axis=0)
            rows += batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(DIMENSIONS + 1)), pa.array(np.append(seen, rows))], ["dimension", "n"]
        )

    totals = labelled.select("text").mapInArrow(count, "dimension long, n long").groupBy("dimension").agg(F.sum("n").alias("n"))
    found = np.zeros(DIMENSIONS + 1)
    for r in totals.collect():  # one row per dimension
        found[r["dimension"]] = r["n"]
    return np.log((1 + found[-1]) / (1 + found[:-1])) + 0.05


def learn(labelled: DataFrame, idf: np.ndarray, per_language: int = PER_LANGUAGE) -> pd.DataFrame:
    """Centroids of every language: lang, centroid, radius; needs (doc_id, lang, text)."""
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    # One entry per language; as a scalar it reaches the scan, and no text is shuffled for it.
    counts = labelled.groupBy("lang").agg(F.count("*").alias("n"))
    sizes = counts.agg(F.map_from_entries(F.collect_list(F.struct("lang", "n")))).scalar()
    # Half as many again as needed by hash, then the exact number; a small language is taken whole.
    share = F.xxhash64("doc_id") / F.lit(float(1 << 63)) < F.lit(3.0) * per_language / F.element_at("sizes", F.col("lang")) - 1
    drawn = labelled.withColumn("sizes", sizes).where(share).drop("sizes")
    sample = drawn.withColumn("rank", rank).where(F.col("rank") <= per_language)

    def fit(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        texts = pa.array(frame.sort_values("doc_id", kind="stable")["text"].tolist(), pa.large_string())
        points = np.concatenate([v.astype(np.float32) for _, _, v in vectors(texts, idf)])
        c, radius = cluster(points, CENTROIDS, ROUNDS)
        return pd.DataFrame({"lang": key[0], "centroid": [x.tolist() for x in c], "radius": radius.astype(float)})

    return (
        sample.select("lang", "doc_id", "text")
        .groupBy("lang")
        .applyInPandas(fit, "lang string, centroid array<float>, radius double")
        .toPandas()
        .sort_values("lang", kind="stable")
        .reset_index(drop=True)
    )


def predict(rows: DataFrame, keys: list[str], model: pd.DataFrame, idf: np.ndarray) -> DataFrame:
    """Key columns, lang_pred, score, accepted."""
    langs = model["lang"].tolist()
    radius = model["radius"].to_numpy(float)
    centroids = np.array(model["centroid"].tolist(), np.float64).reshape(len(langs), DIMENSIONS).T
    shared = rows.sparkSession.sparkContext.broadcast((langs, radius, centroids, idf))
    chosen = rows.select(*keys, F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letter"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, radius, centroids, idf = shared.value
        for batch in batches:
            letter = batch.column("letter").to_numpy(zero_copy_only=False)
            for start, stop, v in vectors(batch.column("text"), idf):
                ok = letter[start:stop] & bool(langs)
                cosine = v @ centroids if langs else np.zeros((stop - start, 1))
                best = cosine.argmax(axis=1)
                # The last digits depend on how many rows are multiplied at once.
                score = np.where(ok, np.round(np.clip(cosine[np.arange(len(best)), best], 0, 1), 9), 0.0)
                near = ok & (score >= radius[best]) if langs else ok
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(i).slice(start, stop - start) for i in range(len(keys))],
                        pa.array([langs[b] if o else UNKNOWN for b, o in zip(best, ok, strict=True)], pa.string()),
                        pa.array(score),
                        pa.array(near),
                    ],
                    [*keys, "lang_pred", "score", "accepted"],
                )

    shape = ", ".join(f"`{k}` {chosen.schema[k].dataType.simpleString()}" for k in keys)
    return chosen.mapInArrow(run, f"{shape}, lang_pred string, score double, accepted boolean")


def identify(docs: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, lang_pred, score, accepted; learned outside the held-out fold."""
    rows = docs.select("doc_id", "lang", "text", F.coalesce(fold(F.col("doc_id"), folds) == held, F.lit(False)).alias("held_out"))
    labelled = rows.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL AND NOT held_out")
    idf = document_frequencies(labelled)
    model = learn(labelled.select("doc_id", "lang", "text"), idf)
    return predict(rows, ["doc_id", "held_out"], model, idf)
