"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

Every string of ``DEPTH`` bytes that also starts earlier is removed. Its suffixes would be sorted
only through their first ``DEPTH`` bytes; equal groups are exactly the repeated strings. The sort
runs from the most significant digit on, and a suffix that is alone in its group drops out:

* First digit, over the cluster: of the ``DEPTH - ANCHOR + 1`` byte ranges of ``ANCHOR`` bytes in
  a string, the one with the smallest hash is its anchor. Equal strings have equal anchors, so
  strings are grouped by their anchor's hash. Neighbouring strings share an anchor, so one
  record stands for a run of them: about one for 35 bytes of text.
* Second digit: runs whose whole bytes agree are equal string by string; all but the earliest
  are covered.
* Further digits: the earliest runs of groups whose bytes differ send their bytes, and the
  suffixes in them are sorted digit by digit of eight bytes, up to ``DEPTH``.

Records travel as arrays, one row per source batch and target bucket; equal runs of one batch are
reduced to the earliest before they are sent, so a passage in a third of all documents costs a
record per batch. The number of buckets is the session's number of shuffle partitions times
``SPREAD``, so a bucket's size follows the same setting as any other shuffle's.

Earlier means a smaller doc_id, or the same doc_id and an earlier start; a null doc_id comes last.
Rows that repeat a doc_id are judged by their own text; the same start in two of them is not
earlier. A null or empty text has no bytes. Matches never cross documents. Equality is that of
64-bit hashes in the first two digits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crewlens.llm.common import LAST, saved, texts_of
from crewlens.llm.texts import Ranges, chunks, combine
from crewlens.llm.workers import lean, lean_cogroup, lean_group

DEPTH = 100
ANCHOR = 32
DIGIT = 8
SPREAD = 2
_U = np.uint64
#: Bits of a place in a chunk; places are 32-bit numbers in the records as well.
PLACE_BITS = _U(32)
#: A record: a run of strings with one anchor. doc and tid name the text, first and last are the
#: starts of the run's strings, anchor is the place of their anchor.
RECORD = np.dtype(
    [("key", "u8"), ("whole", "u8"), ("doc", "i8"), ("tid", "i8"), ("first", "u4"), ("runs", "u1"), ("back", "u1")]
)
SPAN = np.dtype([("doc", "i8"), ("tid", "i8"), ("start", "u4"), ("end", "u4")])
PARCEL = "bucket int, kind int, data binary"
_parcel = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("data", pa.binary())])
ANCHORS, SPANS, BYTES = 0, 1, 2


def runs(buf: np.ndarray, offsets: np.ndarray, depth: int = DEPTH, anchor: int = ANCHOR) -> np.ndarray:
    """Records of one chunk of texts; ``doc`` holds the text's number in the chunk."""
    if len(buf) < depth:
        return np.zeros(0, RECORD)
    ranges = Ranges(buf)
    hashes = ranges.windows(anchor)
    # The place is part of the value, so that the smallest value tells where it is. It takes as many
    # bits in every chunk: a string must have the same anchor wherever it is met.
    low = (_U(1) << PLACE_BITS) - _U(1)
    best = (hashes & ~low) | np.arange(len(hashes), dtype=_U)
    width, size = depth - anchor + 1, 1
    while size * 2 <= width:
        best = np.minimum(best[:-size], best[size:])
        size *= 2
    if size < width:
        best = np.minimum(best[: len(best) - (width - size)], best[width - size :])
    place = (best & low).astype(np.int64)
    starts = np.arange(len(place))
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(place)]
    inside = starts + depth <= offsets[text + 1]
    starts, place, text = starts[inside], place[inside], text[inside]
    if not len(starts):
        return np.zeros(0, RECORD)
    new = np.ones(len(starts), bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    first, last = starts[at], starts[np.append(at[1:], len(starts)) - 1]
    out = np.zeros(len(at), RECORD)
    out["key"] = hashes[place[at]]
    out["back"] = place[at] - first
    out["runs"] = last - first
    out["whole"] = combine(ranges.hash(first, last + depth), out["back"].astype(_U))
    out["doc"] = text[at]
    out["first"] = first - offsets[text[at]]
    return out


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Where a sorted table of columns starts a new value."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def _spread(values: np.ndarray, head: np.ndarray) -> np.ndarray:
    """The value at the latest head, for each row."""
    return values[np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))]


def earliest(records: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Records sorted by whole, doc, first; which of them repeat an earlier equal run."""
    records = records[np.lexsort((records["first"], records["doc"], records["whole"], records["key"]))]
    head = _heads(records["key"], records["whole"])
    same = (_spread(records["doc"], head) == records["doc"]) & (_spread(records["first"], head) == records["first"])
    return records, ~head & ~same


def spans(records: np.ndarray, depth: int) -> np.ndarray:
    out = np.zeros(len(records), SPAN)
    out["doc"], out["tid"], out["start"] = records["doc"], records["tid"], records["first"]
    out["end"] = records["first"].astype(np.int64) + records["runs"] + depth
    return merged(out)


def merged(found: np.ndarray) -> np.ndarray:
    """Spans sorted by text and start, overlapping and touching ones joined."""
    if not len(found):
        return found
    found = found[np.lexsort((found["start"], found["tid"], found["doc"]))]
    text = np.cumsum(_heads(found["doc"], found["tid"])) - 1
    shift = text.astype(np.int64) << 33
    reach = np.maximum.accumulate(found["end"].astype(np.int64) + shift)
    new = np.ones(len(found), bool)
    new[1:] = (found["start"][1:].astype(np.int64) + shift[1:]) > reach[:-1]
    at = np.flatnonzero(new)
    out = found[at].copy()
    out["end"] = (reach - shift)[np.append(at[1:], len(found)) - 1]
    return out


def radix(order_of: np.ndarray, starts: np.ndarray, words: np.ndarray, depth: int = DEPTH) -> Iterator[np.ndarray]:
    """Groups of equal strings: arrays of rows, for suffixes in first groups ``order_of``.

    ``words`` holds the eight bytes from every place on as a number. One digit is sorted at a
    time, and rows that are alone in their group drop out.
    """
    rows, group = np.arange(len(starts)), order_of
    digits = [*range(0, depth - DIGIT, DIGIT), depth - DIGIT]
    for d in [None, *digits]:
        value = words[starts[rows] + d] if d is not None else np.zeros(len(rows), _U)
        order = np.lexsort((value, group))
        rows, group, value = rows[order], group[order], value[order]
        head = _heads(group, value)
        number = np.cumsum(head) - 1
        many = np.bincount(number, minlength=1)[number] > 1 if len(rows) else np.zeros(0, bool)
        rows, group = rows[many], number[many]
    if len(rows):
        yield from np.split(rows, np.flatnonzero(_heads(group))[1:])


def eight(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on, most significant first; the end is padded."""
    padded = np.concatenate([buf, np.zeros(DIGIT, np.uint8)])
    view = np.lib.stride_tricks.sliding_window_view(padded, DIGIT)[: len(buf)]
    return np.ascontiguousarray(view).view(">u8").ravel().astype(_U)


def repeated_strings(key: np.ndarray, doc: np.ndarray, tid: np.ndarray, first: np.ndarray, count: np.ndarray, back: np.ndarray, buf: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Covered spans among runs given by their bytes: run i has its bytes from ``at[i]`` on."""
    run = np.repeat(np.arange(len(key)), count + 1)
    step = np.arange(len(run)) - np.repeat(np.cumsum(count + 1) - (count + 1), count + 1)
    group = combine(key[run], (back[run] - step).astype(np.int64).astype(_U))
    out = []
    for rows in radix(group, at[run] + step, eight(buf), depth):
        d, s = doc[run[rows]], first[run[rows]] + step[rows]
        best = np.lexsort((s, d))[0]
        late = rows[(d != d[best]) | (s != s[best])]
        part = np.zeros(len(late), SPAN)
        part["doc"], part["tid"] = doc[run[late]], tid[run[late]]
        part["start"] = first[run[late]] + step[late]
        part["end"] = part["start"] + depth
        out.append(part)
    return merged(np.concatenate(out)) if out else np.zeros(0, SPAN)


def _parcels(rows: np.ndarray, by: np.ndarray, buckets: int, kind: int) -> list[tuple[int, int, bytes]]:
    """Rows as one parcel per bucket."""
    if not len(rows):
        return []
    bucket = (by.astype(_U) % _U(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    rows, bucket = rows[order], bucket[order]
    cuts = np.flatnonzero(_heads(bucket))
    return [(int(bucket[a]), kind, rows[a:b].tobytes()) for a, b in zip(cuts, [*cuts[1:], len(rows)], strict=True)]


def _batch(parcels: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*parcels, strict=True) if parcels else ((), (), ()), _parcel.types, strict=True)], schema=_parcel
    )


def _text_hash(rows: np.ndarray) -> np.ndarray:
    return combine(rows["doc"].astype(_U), rows["tid"].astype(_U))


def covered(texts: DataFrame, buckets: int, depth: int = DEPTH, anchor: int = ANCHOR) -> DataFrame:
    """Parcels of covered spans by bucket of the text."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, tid = (batch.column(c).to_numpy() for c in ("doc", "tid"))
            found = []
            for start, _, buf, offsets in chunks(batch.column("text")):
                own = runs(buf, offsets, depth, anchor)
                row = own["doc"] + start
                own["doc"], own["tid"] = doc[row], tid[row]
                found.append(own)
            records, late = earliest(np.concatenate(found) if found else np.zeros(0, RECORD))
            known, sent = spans(records[late], depth), records[~late]
            yield _batch(
                _parcels(sent, sent["key"], buckets, ANCHORS) + _parcels(known, _text_hash(known), buckets, SPANS)
            )

    def compare(parcels: pa.Table) -> pa.Table:
        """Second digit of a bucket of anchors; spans that are known already pass through."""
        bucket, kinds, data = parcels.column("bucket")[0].as_py(), parcels.column("kind").to_numpy(), parcels.column("data")
        out = [(bucket, SPANS, data[i].as_py()) for i in np.flatnonzero(kinds == SPANS)]
        parts = [np.frombuffer(data[i].as_py(), RECORD) for i in np.flatnonzero(kinds == ANCHORS)]
        if parts:
            records = np.concatenate(parts)
            del parts
            records = records[np.argsort(records["key"], kind="stable")]
            head = _heads(records["key"])
            number = np.cumsum(head) - 1
            records = records[np.bincount(number)[number] > 1]
            records, late = earliest(records)
            known, first = spans(records[late], depth), records[~late]
            # The earliest runs of groups that hold different bytes are compared string by string.
            number = np.cumsum(_heads(first["key"])) - 1
            first = first[np.bincount(number, minlength=1)[number] > 1] if len(first) else first
            out += _parcels(known, _text_hash(known), buckets, SPANS) + _parcels(first, _text_hash(first), buckets, ANCHORS)
        return pa.Table.from_batches([_batch(out)])

    def fetch(parcels: pa.Table, texts: pa.Table) -> pa.Table:
        """The bytes of the runs that need them, by bucket of the anchor."""
        parts = [np.frombuffer(x.as_py(), RECORD) for x in parcels.column("data")]
        if not parts or not texts.num_rows:
            return pa.Table.from_batches([_batch([])])
        records = np.concatenate(parts)
        place = {k: i for i, k in enumerate(zip(texts.column("doc").to_pylist(), texts.column("tid").to_pylist(), strict=True))}
        column = texts.column("text").combine_chunks().cast(pa.large_string())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset :]
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
        row = np.array([place[k] for k in zip(records["doc"].tolist(), records["tid"].tolist(), strict=True)], np.int64)
        at = offsets[row] + records["first"]
        size = records["runs"].astype(np.int64) + depth
        out = []
        bucket = (records["key"] % _U(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        for part in np.split(order, np.flatnonzero(_heads(bucket[order]))[1:]) if len(order) else []:
            ends = np.cumsum(size[part])
            where = np.arange(ends[-1]) + np.repeat(at[part] - (ends - size[part]), size[part])
            head = np.array([len(part)], np.int64).tobytes()
            out.append((int(bucket[part[0]]), BYTES, head + records[part].tobytes() + data[where].tobytes()))
        return pa.Table.from_batches([_batch(out)])

    def sort(parcels: pa.Table) -> pa.Table:
        """Further digits of a bucket of anchors, with the runs' bytes."""
        records, bytes_ = [], []
        for x in parcels.column("data"):
            raw = x.as_py()
            n = int(np.frombuffer(raw, np.int64, 1)[0])
            records.append(np.frombuffer(raw, RECORD, n, 8))
            bytes_.append(np.frombuffer(raw, np.uint8, offset=8 + n * RECORD.itemsize))
        r, buf = np.concatenate(records), np.concatenate(bytes_)
        size = r["runs"].astype(np.int64) + depth
        at = np.cumsum(size) - size
        order = np.argsort(r["key"], kind="stable")
        heads = np.flatnonzero(_heads(r["key"][order]))
        out, a = [], 0
        # Some thousands of runs at a time, whole anchor groups each, to bound the sort's memory.
        for b in [*heads[1:], len(order)]:
            if b - a < 4096 and b < len(order):
                continue
            own = order[a:b]
            ends = np.cumsum(size[own])
            where = np.arange(ends[-1]) + np.repeat(at[own] - (ends - size[own]), size[own])
            out.append(
                repeated_strings(
                    r["key"][own], r["doc"][own], r["tid"][own], r["first"][own].astype(np.int64),
                    r["runs"][own].astype(np.int64), r["back"][own].astype(np.int64), buf[where], ends - size[own], depth,
                )
            )
            a = b
        found = np.concatenate(out)
        return pa.Table.from_batches([_batch(_parcels(found, _text_hash(found), buckets, SPANS))])

    sent = texts.mapInArrow(lean(send), PARCEL)
    compared = saved(sent.groupBy("bucket").applyInArrow(lean_group(compare), PARCEL))
    unsure = compared.where(F.col("kind") == ANCHORS)
    fetched = by_text(texts, buckets).groupBy("bucket")
    bytes_ = unsure.groupBy("bucket").cogroup(fetched).applyInArrow(lean_cogroup(fetch), PARCEL)
    sorted_ = bytes_.groupBy("bucket").applyInArrow(lean_group(sort), PARCEL)
    return compared.where(F.col("kind") == SPANS).unionByName(sorted_)


def by_text(texts: DataFrame, buckets: int) -> DataFrame:
    """Texts with the bucket their spans go to."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = combine(batch.column("doc").to_numpy().astype(_U), batch.column("tid").to_numpy().astype(_U))
            yield pa.RecordBatch.from_arrays(
                [pa.array((h % _U(buckets)).astype(np.int32)), *batch.columns], ["bucket", *batch.schema.names]
            )

    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema)
    return texts.mapInArrow(lean(deal), f"bucket int, {shape}")


def bucket_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions")) * SPREAD


def cut(text: bytes, start: np.ndarray, end: np.ndarray) -> bytes:
    """What is left of a text without its spans."""
    keep = np.concatenate([[0], end]).astype(np.int64), np.concatenate([start, [len(text)]]).astype(np.int64)
    return b"".join([text[a:b] for a, b in zip(*(x.tolist() for x in keep), strict=True)])


def _per_text(spans_: pa.Table, texts: pa.Table) -> Iterator[tuple[int, bytes, np.ndarray, np.ndarray]]:
    parts = [np.frombuffer(x.as_py(), SPAN) for x in spans_.column("data")]
    found = merged(np.concatenate(parts)) if parts else np.zeros(0, SPAN)
    head = np.flatnonzero(_heads(found["doc"], found["tid"])) if len(found) else np.zeros(0, np.int64)
    ends = [*head[1:].tolist(), len(found)]
    own = {(int(found["doc"][a]), int(found["tid"][a])): (a, b) for a, b in zip(head.tolist(), ends, strict=False)}
    keys = zip(texts.column("doc").to_pylist(), texts.column("tid").to_pylist(), strict=True)
    for i, (key, text) in enumerate(zip(keys, texts.column("text"), strict=True)):
        a, b = own.get(key, (0, 0))
        yield i, text.as_py().encode(), found["start"][a:b], found["end"][a:b]


def report(docs: DataFrame, depth: int = DEPTH, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, one row per document."""
    buckets = bucket_count(docs.sparkSession)
    texts = texts_of(docs)

    def finish(spans_: pa.Table, texts: pa.Table) -> pa.Table:
        rows = []
        for _, text, start, end in _per_text(spans_, texts):
            left = cut(text, start, end)
            rows.append((len(text), len(text) - len(left), len(start), hashlib.sha256(left).hexdigest()))
        doc = texts.column("doc").to_numpy()
        columns = list(zip(*rows, strict=True)) if rows else [(), (), (), ()]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.table(
            [pa.array(doc, pa.int64(), mask=doc == LAST), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )

    found = covered(texts, buckets, depth, anchor)
    return (
        found.groupBy("bucket")
        .cogroup(by_text(texts, buckets).groupBy("bucket"))
        .applyInArrow(lean_cogroup(finish), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    )


def remove(docs: DataFrame, depth: int = DEPTH, anchor: int = ANCHOR) -> DataFrame:
    """The documents without their repeated strings; characters cut in two by a span go as well."""
    buckets = bucket_count(docs.sparkSession)
    texts = texts_of(docs)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")
    carried = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("tid"), F.coalesce("text", F.lit("")).alias("text"),
        F.col("text").isNull().alias("none"), row,
    )
    out = carried.schema

    def finish(spans_: pa.Table, texts: pa.Table) -> pa.Table:
        left = [cut(text, start, end).decode("utf-8", "ignore") for _, text, start, end in _per_text(spans_, texts)]
        none = texts.column("none").to_numpy()
        return pa.table([pa.array(left, pa.string(), mask=none), texts.column("row")], names=["text", "row"])

    done = (
        covered(texts, buckets, depth, anchor)
        .groupBy("bucket")
        .cogroup(by_text(carried, buckets).groupBy("bucket"))
        .applyInArrow(lean_cogroup(finish), f"text string, row {out['row'].dataType.simpleString()}")
    )
    return done.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
