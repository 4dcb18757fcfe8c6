"""Document fingerprints: quartile digests of hashed byte triplets.

Every place of a text gives a triplet, the bytes ``SPREAD`` apart from it on (with zeros after the
end), which is hashed to one of ``BUCKETS`` buckets. The digest is the text's length in bytes and,
per bucket, the quartile of its count among the counts of all buckets, two bits each. Two digests
differ by the sum of the differences of their quartiles, and by up to ``LENGTH_POINTS`` for unlike
lengths; the difference is cut at a bound, the one that two unrelated digests reach on average, or
less where few buckets are in use. Likeness is one minus the share of the bound.

``next_likeness`` also compares each document with the next one in order of doc_id and with an
edited version of itself, whose last quarter comes from the next one's beginning. Documents are
dealt to ranges of doc_id and stream through their range in order, two texts at a time; the last
document of a range meets the first of the next one afterwards, one pair per range.

Nulls and edges: a null text counts as empty; documents without doc_id come last; equal ids are
ordered by a hash of their text; repeated rows follow one another; the last document's next is
the first, which for a single document is itself. Equal texts have equal digests. Texts are whole,
and one text must fit in a task's memory. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crewlens.llm.common import saved
from crewlens.llm.packing import packed

BUCKETS = 256
SPREAD = 2
#: Multipliers of the three bytes; a bucket is eight middle bits of the sum modulo 2**32.
FACTORS = (2654435761, 2246822519, 3266489917)
SHIFT = 13
LENGTH_POINTS = 32
#: Two independent quartiles differ by 1.25 on average.
BOUND = BUCKETS * 5 // 4
LENGTH_DIGITS = 12
#: Bytes of a text that are counted at once.
STRIDE = 1 << 20
DONE, HEAD, TAIL = 0, 1, 2
RESULT = {
    "doc_id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(),
    "edited_fingerprint": pa.string(), "near_edited": pa.float64(), "near_next": pa.float64(),
}
_SHAPE = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _counts(data: bytes) -> np.ndarray:
    """How many triplets fall into each bucket."""
    out = np.zeros(BUCKETS, np.int64)
    reach = 2 * SPREAD
    padded = np.frombuffer(data + bytes(reach), np.uint8)
    for low in range(0, len(data), STRIDE):
        part = padded[low : low + STRIDE + reach].astype(np.uint32)
        n = len(part) - reach
        mixed = part[:n] * np.uint32(FACTORS[0]) + part[SPREAD : SPREAD + n] * np.uint32(FACTORS[1]) + part[reach:] * np.uint32(FACTORS[2])
        out += np.bincount((mixed >> np.uint32(SHIFT)) & np.uint32(BUCKETS - 1), minlength=BUCKETS)
    return out


def fingerprint(text: str) -> str:
    """Length in bytes, then the quartiles of the buckets, as hexadecimal digits."""
    data = text.encode()
    counts = _counts(data)
    q1, q2, q3 = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, BUCKETS * 3 // 4 - 1]]
    level = ((counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)).reshape(-1, 4)
    return f"{len(data):0{LENGTH_DIGITS}x}" + (level @ np.array([64, 16, 4, 1], np.uint8)).astype(np.uint8).tobytes().hex()


def _levels(prints: list[str]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([int(p[:LENGTH_DIGITS], 16) for p in prints], np.int64)
    codes = np.frombuffer(bytes.fromhex("".join(p[LENGTH_DIGITS:] for p in prints)), np.uint8).reshape(len(prints), -1)
    return lengths, np.stack([codes >> s & 3 for s in (6, 4, 2, 0)], axis=2).reshape(len(prints), -1).astype(np.int64)


def likeness(left: list[str], right: list[str]) -> np.ndarray:
    """Likeness of pairs of fingerprints, 0 to 1; equal ones give 1."""
    if not left:
        return np.zeros(0)
    (n, a), (m, b) = _levels(left), _levels(right)
    longer, shorter = np.maximum(n, m), np.minimum(n, m)
    difference = np.abs(a - b).sum(axis=1) + LENGTH_POINTS * (longer - shorter) // np.maximum(longer, 1)
    bound = np.minimum(BOUND, np.maximum(a, b).sum(axis=1) + LENGTH_POINTS)
    return 1 - np.minimum(difference, bound) / bound


def fingerprints(docs: DataFrame, *keys: str) -> DataFrame:
    """The key columns and the fingerprint of each text."""
    rows = docs.select(*keys, F.coalesce("text", F.lit("")).alias("text"))
    shape = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = pa.array([fingerprint(t.as_py()) for t in batch.column(len(keys))], pa.string())
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(keys))], prints], [*keys, "fingerprint"])

    return rows.mapInArrow(work, f"{shape}, fingerprint string")


def compared(pairs: DataFrame, left: str, right: str, target: str) -> DataFrame:
    """The rows with the likeness of two fingerprint columns; unknown where one is null."""
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (left, right))
            both = [x is not None and y is not None for x, y in zip(a, b, strict=True)]
            found = iter(likeness([x for x, ok in zip(a, both, strict=True) if ok], [y for y, ok in zip(b, both, strict=True) if ok]).tolist())
            near = pa.array([next(found) if ok else None for ok in both], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, near], [*batch.schema.names, target])

    return pairs.mapInArrow(work, f"{shape}, `{target}` double")


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as much of the following one's beginning."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


class _Results:
    """Result rows of documents whose next one is known, compared in one go."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []

    def add(self, doc: int | None, text: str, own: str, following: str, its: str) -> None:
        new = edited(text, following)
        sha = hashlib.sha256(new.encode()).hexdigest()
        self.rows.append((doc, len(text), sha, own, fingerprint(new), its))

    def take(self) -> list[list]:
        """Columns of ``RESULT``; the rows are forgotten."""
        if not self.rows:
            return [[] for _ in RESULT]
        doc, n, sha, own, new, its = map(list, zip(*self.rows, strict=True))
        self.rows = []
        return [doc, n, sha, own, new, likeness(own, new).tolist(), likeness(own, its).tolist()]


def next_likeness(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    text = F.coalesce("text", F.lit(""))
    rows = packed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tid"), text.alias("text")))
    order = [F.col("doc_id").asc_nulls_last(), F.col("tid")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    shape = pa.schema([*RESULT.items(), ("kind", pa.int32()), ("part", pa.int32()), ("text", pa.binary())])

    def single(kind: int, part: int, doc: int | None, own: str, small: bytes) -> pa.RecordBatch:
        cells = {"doc_id": doc, "fingerprint": own, "kind": kind, "part": part, "text": small}
        return pa.RecordBatch.from_pylist([cells], shape)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, press, done = TaskContext.get().partitionId(), None, zstandard.ZstdDecompressor(), _Results()
        for batch in batches:
            for doc, small in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                now = press.decompress(small.as_py()).decode()
                own = fingerprint(now)
                if before is None:
                    yield single(HEAD, part, doc, own, small.as_py())
                else:
                    done.add(*before[:3], now, own)
                before = (doc, now, own, small)
            columns = done.take()
            n = len(columns[0])
            columns += [[DONE] * n, [part] * n, [None] * n]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, shape, strict=True)], schema=shape)
        if before is not None:
            yield single(TAIL, part, before[0], before[2], before[3].as_py())

    found = saved(dealt.mapInArrow(stream, f"{_SHAPE}, kind int, part int, text binary"))
    return found.where(F.col("kind") == DONE).select(*RESULT).unionByName(_across(found))


def _across(found: DataFrame) -> DataFrame:
    """Results of the last documents of all ranges, with the first ones of the ranges after."""
    heads = found.where(F.col("kind") == HEAD).select("part", F.col("text").alias("following"), F.col("fingerprint").alias("its"))
    # One number per range.
    ranges = heads.select("part")
    after = Window.orderBy("part")
    turns = ranges.select("part", F.lead("part").over(after).alias("next_part"), F.first("part").over(after).alias("least"))
    ways = turns.select("part", F.coalesce("next_part", "least").alias("next_part"))
    tails = found.where(F.col("kind") == TAIL).select("doc_id", "fingerprint", "text", "part")
    met = tails.join(ways, "part").join(heads.withColumnRenamed("part", "next_part"), "next_part")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press, done = zstandard.ZstdDecompressor(), _Results()
        for batch in batches:
            for doc, own, small, following, its in zip(*[batch.column(i) for i in range(5)], strict=True):
                texts = [press.decompress(x.as_py()).decode() for x in (small, following)]
                done.add(doc.as_py(), texts[0], own.as_py(), texts[1], its.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(done.take(), RESULT.values(), strict=True)], list(RESULT))

    return met.select("doc_id", "fingerprint", "text", "following", "its").mapInArrow(finish, _SHAPE)
