"""Language-model scores from a word-pair trie in Elias-Fano form.

A token is scored from its count and from the count of the pair it forms with the token before
it: ``p(w | v) = (c(v w) + MU * p(w)) / (c(v) + MU)``, where ``p(w)`` is the add-half estimate.

Neither the counts nor the model ever come together in one place. Documents are dealt to buckets
by a hash. A bucket sends each different word and pair with its count in the training texts to
the shard of the word or of the pair's first word. A shard adds the counts up, packs the pairs
into a trie, looks up every pair that was asked for, and answers each bucket in the order it
asked. The bucket then scores its texts.

The trie's levels are flat arrays in one buffer, which can be written to a file and mapped:
contexts, a monotone sequence of pointers to each context's first pair, and the pairs' second
words, made monotone by adding their context's share of the number space. Both sequences are
Elias-Fano coded. A pair is found by a successor search inside its context's range. Each pair
has its count, quantised on a logarithmic scale, in two bytes: any 64-bit count, to a thousandth of
a power of two. Probabilities are made from it where the texts are scored, since the smoothing
needs the second word's count, which lies in another shard.

A first word with more than ``1 / HOT`` of a shard's share of all words is hot; its pairs are
spread over all shards by their second word. Hot words are found by a count that keeps, in each
batch, those that reach the share there; there can be no more than ``HOT`` per shard.

Nulls and edges: a null or empty text has the end token only. A row without doc_id is scored but
not learned from, nor held out. Rows that repeat a doc_id stand for themselves; repeated rows
count each. Without training texts every count is 0. Words are told apart by 64-bit hashes, the
second words of one context by 48 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crewlens.llm.common import LAST, saved, texts_of
from crewlens.llm.packing import packed, unpacked
from crewlens.llm.texts import LOWER, Ranges, chunks, combine, words

_U = np.uint64
START, END = _U(0x1111111111111111), _U(0x2222222222222222)
MU = 200.0
HOT = 8
STEPS = 1024
SHORT = _U((1 << 48) - 1)
PARCEL = "to int, origin int, kind int, data binary"
_parcel = pa.schema([("to", pa.int32()), ("origin", pa.int32()), ("kind", pa.int32()), ("data", pa.binary())])
ONES, PAIRS, TOTALS = 0, 1, 2


class EliasFano:
    """A sequence that never falls, with about two bits per item plus the bits below its spread."""

    def __init__(self, low_bits: int, size: int, low: np.ndarray, high: np.ndarray) -> None:
        self.low_bits, self.size, self.low, self.high = low_bits, size, low, high
        # Zeros before each word of the upper part: the directory that selects start from.
        ones = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.bitwise_count(high), dtype=np.int64)])
        self.ones = ones
        self.zeros = np.arange(len(ones)) * 64 - ones

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        n = max(1, len(values))
        bits = max(0, (max(1, universe) // n).bit_length() - 1)
        high_value = (values >> _U(bits)).astype(np.int64)
        place = high_value + np.arange(len(values))
        length = (universe >> bits) + len(values) + 2
        high = np.packbits(np.bincount(place, minlength=-(-length // 64) * 64).astype(np.uint8), bitorder="little").view(_U)
        low = cls._pack(values & _U((1 << bits) - 1), bits)
        return cls(bits, len(values), low, high)

    @staticmethod
    def _pack(values: np.ndarray, bits: int) -> np.ndarray:
        out = np.zeros(len(values) * bits // 64 + 2, _U)
        if bits:
            at = np.arange(len(values), dtype=np.int64) * bits
            word, shift = at >> 6, (at & 63).astype(_U)
            np.bitwise_or.at(out, word, values << shift)
            over = shift + _U(bits) > _U(64)
            np.bitwise_or.at(out, word[over] + 1, values[over] >> (_U(64) - shift[over]))
        return out

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), _U)
        at = i * self.low_bits
        word, shift = at >> 6, (at & 63).astype(_U)
        left = (_U(64) - shift) & _U(63)
        above = np.where(shift == 0, _U(0), self.low[word + 1] << left)
        return ((self.low[word] >> shift) | above) & _U((1 << self.low_bits) - 1)

    @staticmethod
    def _select(word: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Place of the k-th set bit (from 0) of each word, halving the range six times."""
        place = np.zeros(len(word), np.int64)
        k = k.copy()
        for width in (32, 16, 8, 4, 2, 1):
            part = (word >> place.astype(_U)) & _U((1 << width) - 1)
            count = np.bitwise_count(part).astype(np.int64)
            go = k >= count
            k -= np.where(go, count, 0)
            place += np.where(go, width, 0)
        return place

    def get(self, i: np.ndarray) -> np.ndarray:
        """The i-th values."""
        word = np.searchsorted(self.ones, i, "right") - 1
        place = word * 64 + self._select(self.high[word], i - self.ones[word])
        return ((place - i).astype(_U) << _U(self.low_bits)) | self._low(i)

    def _rank_of_high(self, high: np.ndarray) -> np.ndarray:
        """How many items have an upper part below ``high``."""
        k = high - 1
        word = np.searchsorted(self.zeros, k, "right") - 1
        word = np.clip(word, 0, len(self.high) - 1)
        place = word * 64 + self._select(~self.high[word], np.maximum(k - self.zeros[word], 0))
        return np.where(high > 0, place - k, 0)

    def successor(self, value: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Index of the first item in [first, end) that is not below ``value``; ``end`` if none is."""
        high = (value >> _U(self.low_bits)).astype(np.int64)
        at = np.clip(self._rank_of_high(high), first, end)
        stop = np.clip(self._rank_of_high(high + 1), first, end)
        low = value & _U((1 << self.low_bits) - 1)
        # Items of one upper part are few and sorted: halve what is left of them.
        while True:
            open_ = np.flatnonzero(at < stop)
            if not len(open_):
                return at
            middle = (at[open_] + stop[open_]) >> 1
            less = self._low(middle) < low[open_]
            at[open_[less]] = middle[less] + 1
            stop[open_[~less]] = middle[~less]


class Trie:
    """Contexts, their pairs' second words and quantised counts, in one flat buffer."""

    def __init__(self, buffer: bytes | np.ndarray) -> None:
        raw = np.frombuffer(buffer, np.uint8) if isinstance(buffer, bytes) else buffer
        head = raw[: 8 * 16].view(np.int64)
        parts, at = [], 128
        for size in head[:7]:
            parts.append(raw[at : at + size])
            at += -(-int(size) // 8) * 8
        contexts, vocabulary, plow, phigh, wlow, whigh, codes = parts
        self.contexts, self.vocabulary, self.codes = contexts.view(_U), vocabulary.view(_U), codes.view(np.uint16)
        pairs = len(self.codes)
        self.pointers = EliasFano(int(head[7]), len(self.contexts) + 1, plow.view(_U), phigh.view(_U))
        self.words = EliasFano(int(head[8]), pairs, wlow.view(_U), whigh.view(_U))

    @classmethod
    def open(cls, path: str) -> Trie:
        """A trie in a file, mapped into memory."""
        return cls(np.memmap(path, np.uint8, "r"))

    @staticmethod
    def pack(context: np.ndarray, word: np.ndarray, count: np.ndarray) -> bytes:
        """The buffer of pairs sorted by context and word, without repeats."""
        contexts, first = np.unique(context, return_index=True)
        vocabulary, local = np.unique(word, return_inverse=True)
        m = max(1, len(vocabulary))
        owner = np.repeat(np.arange(len(contexts)), np.diff(np.append(first, len(context))))
        pointers = EliasFano.of(np.append(first, len(context)).astype(_U), len(context))
        sequence = EliasFano.of(owner.astype(_U) * _U(m) + local.astype(_U), len(contexts) * m)
        arrays = [contexts, vocabulary, pointers.low, pointers.high, sequence.low, sequence.high, quantised(count)]
        head = np.zeros(16, np.int64)
        head[:7] = [a.nbytes for a in arrays]
        head[7:9] = pointers.low_bits, sequence.low_bits
        return b"".join([head.tobytes(), *[a.tobytes() + bytes(-a.nbytes % 8) for a in arrays]])

    def codes_of(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Quantised counts of pairs, 0 for those that are not there."""
        out = np.zeros(len(context), np.uint16)
        if not len(self.codes):
            return out
        c = np.minimum(np.searchsorted(self.contexts, context), len(self.contexts) - 1)
        w = np.minimum(np.searchsorted(self.vocabulary, word), len(self.vocabulary) - 1)
        ok = np.flatnonzero((self.contexts[c] == context) & (self.vocabulary[w] == word))
        c, w = c[ok], w[ok]
        first, end = (self.pointers.get(x).astype(np.int64) for x in (c, c + 1))
        value = c.astype(_U) * _U(len(self.vocabulary)) + w.astype(_U)
        at = self.words.successor(value, first, end)
        there = np.flatnonzero(at < end)
        hit = there[self.words.get(at[there]) == value[there]]
        out[ok[hit]] = self.codes[at[hit]]
        return out


def quantised(count: np.ndarray) -> np.ndarray:
    """Two bytes on a scale of ``STEPS`` to a power of two; 0 only for 0. The largest 64-bit count
    has a code as well."""
    code = 1 + np.rint(STEPS * np.log2(np.maximum(count, 1)))
    return np.where(count > 0, code, 0).astype(np.uint16)


def restored(code: np.ndarray) -> np.ndarray:
    return np.where(code > 0, np.exp2((code.astype(float) - 1) / STEPS), 0.0)


def tokens(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every text's words, lower-cased, each text closed by END; number per text."""
    start, end, before = words(buf, offsets)
    word = Ranges(LOWER[buf]).hash(start, end)
    counts = np.diff(before) + 1
    out = np.empty(len(word) + len(counts), _U)
    stops = np.cumsum(counts) - 1
    inner = np.ones(len(out), bool)
    inner[stops] = False
    out[inner], out[stops] = word, END
    return out, counts


class Bucket:
    """Different words and pairs of a bucket's texts, sorted, and where each token has them."""

    def __init__(self, texts: pa.ChunkedArray) -> None:
        got = [tokens(buf, offsets) for _, _, buf, offsets in chunks(unpacked(texts))]
        none = np.zeros(0, _U)
        flat = np.concatenate([none, *[t for t, _ in got]])
        self.counts = np.concatenate([np.zeros(0, np.int64), *[c for _, c in got]])
        del got
        self.text = np.repeat(np.arange(len(self.counts)), self.counts)
        self.ones, one = np.unique(np.append(flat, START), return_inverse=True)
        start, self.one = one[-1], one[:-1]
        self.before = np.append(start, self.one[:-1]) if len(flat) else self.one
        self.before = np.where(np.append(True, self.text[1:] != self.text[:-1])[: len(flat)], start, self.before)
        codes, self.pair = np.unique((self.before.astype(_U) << _U(32)) | self.one.astype(_U), return_inverse=True)
        self.first, self.second = self.ones[(codes >> _U(32)).astype(np.int64)], self.ones[(codes & _U(0xFFFFFFFF)).astype(np.int64)] & SHORT

    def trained(self, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of the different words and pairs in the training texts."""
        own = train[self.text]
        return np.bincount(self.one[own], minlength=len(self.ones)), np.bincount(self.pair[own], minlength=len(self.first))

    def shards(self, hot: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Shards of the words and of the pairs."""
        away = np.isin(self.first, hot)
        key = self.first + np.where(away, combine(self.second), _U(0))
        return (self.ones % _U(n)).astype(np.int64), (key % _U(n)).astype(np.int64)


def _small(counts: np.ndarray) -> bytes:
    """Counts as bytes; those from 255 on follow in full."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[counts >= 255].astype(np.int64).tobytes()


def _counts(raw: np.ndarray, n: int) -> np.ndarray:
    out = raw[:n].astype(np.int64)
    out[out == 255] = np.frombuffer(raw[n:].tobytes(), np.int64)
    return out


def _write_pairs(first: np.ndarray, second: np.ndarray, counts: np.ndarray) -> bytes:
    """Pairs sorted by first word, which is written once."""
    at = np.flatnonzero(np.append(True, first[1:] != first[:-1]))
    size = np.diff(np.append(at, len(first))).astype(np.uint32)
    six = second.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    return np.array([len(at), len(first)], np.int64).tobytes() + first[at].tobytes() + size.tobytes() + six.tobytes() + _small(counts)


def _read_pairs(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    m, n = np.frombuffer(raw, np.int64, 2)
    first = np.repeat(np.frombuffer(raw, _U, m, 16), np.frombuffer(raw, np.uint32, m, 16 + 8 * m))
    at = 16 + 12 * int(m)
    eight = np.zeros((n, 8), np.uint8)
    eight[:, :6] = np.frombuffer(raw, np.uint8, 6 * n, at).reshape(n, 6)
    return first, eight.view("<u8").ravel(), _counts(np.frombuffer(raw, np.uint8, offset=at + 6 * int(n)), int(n))


def _added(keys: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Different keys, sorted, with the sums of their counts; those that sum to 0 are dropped."""
    order = np.lexsort(keys[::-1])
    keys, counts = [k[order] for k in keys], counts[order]
    if not len(counts):
        return keys, counts
    at = np.flatnonzero(np.append(True, np.logical_or.reduce([k[1:] != k[:-1] for k in keys])))
    sums = np.add.reduceat(counts, at)
    return [k[at][sums > 0] for k in keys], sums[sums > 0]


def _places(owner: np.ndarray, parts: int) -> list[np.ndarray]:
    """Where each part's items stand, in order, from one sort."""
    order = np.argsort(owner, kind="stable")
    return np.split(order, np.searchsorted(owner[order], np.arange(1, parts)))


def _rows(out: list[tuple[int, int, int, bytes]]) -> pa.Table:
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else ((),) * 4, _parcel.types, strict=True)], schema=_parcel)


def hot_words(texts: DataFrame, shards: int) -> np.ndarray:
    """Words that hold at least ``1 / (HOT * shards)`` of all; a bounded list."""
    parts = HOT * shards

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = [tokens(buf, offsets)[0] for _, _, buf, offsets in chunks(batch.column(0))]
            if seen:
                word, times = np.unique(np.concatenate(seen), return_counts=True)
                often = times * parts >= times.sum()
                rows = np.append(word[often], START), np.append(times[often], times.sum())
                yield pa.RecordBatch.from_arrays([pa.array(rows[0].astype(np.int64)), pa.array(rows[1])], ["word", "n"])

    sums = saved(texts.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")))
    all_ = sums.where(F.col("word") == int(START)).agg(F.sum("n")).first()[0] or 0
    found = sums.where((F.col("n") * parts >= all_) & (F.col("word") != int(START))).select("word").toArrow()
    return np.append(found.column(0).to_numpy().astype(_U), START)


def scores(docs: DataFrame, folds: int = 5, held: int = 1, mu: float = MU) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; learned outside the fold."""
    spark = docs.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    mod = F.crc32(F.col("doc").cast("string").cast("binary")) % folds
    known = F.col("doc") != LAST
    texts = texts_of(docs).select(
        "doc",
        (known & (mod == held)).alias("held"),
        (known & (mod != held)).alias("train"),
        F.pmod(F.xxhash64("doc", "tid"), F.lit(shards)).cast("int").alias("bucket"),
        "text",
    )
    hot = hot_words(texts, shards)
    carried = packed(texts)

    def send(batch: pa.Table) -> pa.Table:
        own, origin = Bucket(batch.column("text")), batch.column("bucket")[0].as_py()
        ones, pairs = own.trained(batch.column("train").to_numpy().astype(bool))
        to_one, to_pair = own.shards(hot, shards)
        out = []
        for to, (at, pair) in enumerate(zip(_places(to_one, shards), _places(to_pair, shards), strict=True)):
            if len(at):
                out.append((to, origin, ONES, np.array([len(at)], np.int64).tobytes() + own.ones[at].tobytes() + _small(ones[at])))
            if len(pair):
                out.append((to, origin, PAIRS, _write_pairs(own.first[pair], own.second[pair], pairs[pair])))
        return _rows(out)

    def answer(got: pa.Table) -> pa.Table:
        kinds, origins, data = got.column("kind").to_numpy(), got.column("origin").to_pylist(), got.column("data")
        shard, out = got.column("to")[0].as_py(), []
        asked = []
        for i in np.flatnonzero(kinds == ONES).tolist():
            raw = data[i].as_py()
            n = int(np.frombuffer(raw, np.int64, 1)[0])
            asked.append((origins[i], np.frombuffer(raw, _U, n, 8), _counts(np.frombuffer(raw, np.uint8, offset=8 + 8 * n), n)))
        if asked:
            (word,), total = _added([np.concatenate([w for _, w, _ in asked])], np.concatenate([c for *_, c in asked]))
            out.append((0, shard, TOTALS, np.array([total.sum(), len(word)], np.int64).tobytes()))
            for origin, w, _ in asked:
                at = np.minimum(np.searchsorted(word, w), max(0, len(word) - 1))
                reply = np.where(word[at] == w, total[at], 0) if len(word) else np.zeros(len(w), np.int64)
                out.append((origin, shard, ONES, _small(reply)))
        asked = [(origins[i], *_read_pairs(data[i].as_py())) for i in np.flatnonzero(kinds == PAIRS).tolist()]
        if asked:
            (first, second), total = _added(
                [np.concatenate([a for _, a, _, _ in asked]), np.concatenate([b for _, _, b, _ in asked])],
                np.concatenate([c for *_, c in asked]),
            )
            trie = Trie(Trie.pack(first, second, total))
            for origin, a, b, _ in asked:
                out.append((origin, shard, PAIRS, trie.codes_of(a, b).tobytes()))
        return _rows(out)

    sent = carried.groupBy("bucket").applyInArrow(send, PARCEL)
    replies = saved(sent.groupBy("to").applyInArrow(answer, PARCEL))
    totals = replies.where(F.col("kind") == TOTALS).select("data").toArrow().column(0).to_pylist()
    all_, distinct = np.array([np.frombuffer(t, np.int64) for t in totals]).reshape(-1, 2).sum(axis=0).tolist()

    def finish(answers: pa.Table, batch: pa.Table) -> pa.Table:
        own = Bucket(batch.column("text"))
        to_one, to_pair = own.shards(hot, shards)
        ones, codes = np.zeros(len(own.ones), np.int64), np.zeros(len(own.first), np.uint16)
        one_places, pair_places = _places(to_one, shards), _places(to_pair, shards)
        for origin, kind, data in zip(*(answers.column(c).to_pylist() for c in ("origin", "kind", "data")), strict=True):
            if kind == ONES:
                at = one_places[origin]
                ones[at] = _counts(np.frombuffer(data, np.uint8), len(at))
            else:
                codes[pair_places[origin]] = np.frombuffer(data, np.uint16)
        single = (ones + 0.5) / (all_ + 0.5 * (distinct + 1))
        # START precedes every training text, as END closes each.
        contexts = np.where(own.ones == START, ones[np.searchsorted(own.ones, END)] if END in own.ones else 0, ones)
        c = contexts[own.before]
        p = (restored(codes)[own.pair] + mu * single[own.one]) / (c + mu)
        total = lambda x: np.bincount(own.text, weights=x, minlength=len(own.counts))
        doc = batch.column("doc").to_numpy()
        return pa.table(
            {
                "doc_id": pa.array(doc, pa.int64(), mask=doc == LAST),
                "held_out": batch.column("held"),
                "n_tokens": own.counts,
                "n_known": total((ones > 0)[own.one]).astype(np.int64),
                "train_tokens": np.full(len(doc), all_),
                "base_score": total(np.log10(single)[own.one]),
                "score": total(np.log10(np.minimum(p, 1.0))),
            }
        )

    answers = replies.where(F.col("kind") != TOTALS).select(F.col("to").alias("bucket"), "origin", "kind", "data")
    return answers.groupBy("bucket").cogroup(carried.groupBy("bucket")).applyInArrow(
        finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
