"""SentencePiece encoding and decoding for merge-type vocabularies.

A text is a row of symbols, one per character. An agenda holds every adjacent pair whose join is
a piece, best score first, leftmost first among equals; the top is merged and its new
neighbours are offered, until the agenda is empty. Characters outside the vocabulary become the
pieces of their bytes.

No piece runs over the end of a word or contains a character that is foreign to the vocabulary,
so a text is cut there and every different segment is merged once. Short segments of equal
length are merged together as rows of a matrix, one agenda step for all of them at a time; long
ones have an agenda of their own.

Null and empty texts have the end id only and decode to the empty text. Memory: one chunk of
texts and ``REMEMBERED`` segments per task; between tasks a worker keeps the model only. One document of every Arrow batch is encoded by
the library as well; a difference is an error.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crewlens.llm.workers import lean

MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: Segments up to so many characters are merged in matrices.
SHORT = 48
REMEMBERED = 300_000
CHARACTERS = 1 << 20
NONE = np.iinfo(np.int32).max


class Pieces:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        size = lib.get_piece_size()
        special = [lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) for i in range(size)]
        names = [lib.id_to_piece(i) for i in range(size)]
        self.end = lib.eos_id()
        self.id = {p: i for i, p in enumerate(names) if not special[i]}
        self.score = {p: lib.get_score(i) for p, i in self.id.items()}
        self.byte = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.bytes_of = [p.replace(MARK, " ").encode() if not s else b"" for p, s in zip(names, special, strict=True)]
        for b, i in enumerate(self.byte):
            self.bytes_of[i] = bytes([b])
        inner = [p for p in self.id if MARK in p.lstrip(MARK)]
        if inner:
            raise ValueError(f"pieces that run over a word's end: {inner[:3]}")
        self._tables()
        known = {c for p in self.id for c in p}
        foreign = "" if "\n" in known else "\n"
        self.cut = re.compile(f"[{MARK}]*[^{MARK}{foreign}]+|[{MARK}]+" + (f"|{foreign}" if foreign else ""))
        # Ids and decoded bytes of the segments met so far.
        self.ids: dict[str, str] = {}
        self.raw: dict[str, bytes] = {}

    def _tables(self) -> None:
        """Symbols by character, and for every mergeable pair the rank of the join."""
        self.symbols = sorted({*self.id, *(c for p in self.id for c in p)})
        number = {s: i for i, s in enumerate(self.symbols)}
        coded = [self._coded(s) for s in self.symbols]
        self.symbol_ids, self.symbol_raw = [c[0] for c in coded], [c[1] for c in coded]
        self.of_char = np.full(0x110000, -1, np.int32)
        for s, i in number.items():
            if len(s) == 1:
                self.of_char[ord(s)] = i
        by_score = sorted(self.id, key=lambda p: -self.score[p])
        # Equal scores share a rank; the leftmost of them comes first.
        rank, last, at = {}, None, -1
        for p in by_score:
            if self.score[p] != last:
                last, at = self.score[p], at + 1
            rank[p] = at
        pairs = [
            (number[p[:k]] * len(number) + number[p[k:]], rank[p], number[p])
            for p in self.id
            for k in range(1, len(p))
            if p[:k] in number and p[k:] in number
        ]
        table = np.array(sorted(pairs), np.int64)
        self.pair = table[:, 0].copy()
        self.pair_rank, self.pair_join = table[:, 1].astype(np.int32), table[:, 2].astype(np.int32)

    def _look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the join of each pair (NONE if there is none), and the joined symbol."""
        code = left.astype(np.int64) * len(self.symbols) + right
        at = np.minimum(np.searchsorted(self.pair, code), len(self.pair) - 1)
        hit = (self.pair[at] == code) & (left >= 0) & (right >= 0)
        return np.where(hit, self.pair_rank[at], NONE), self.pair_join[at]

    def agenda(self, segment: str) -> list[str]:
        """Pieces of one segment, by an agenda."""
        symbols: list[str] = list(segment)
        after, before = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
        waiting: list[tuple[float, int, int, str]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b < len(symbols) and (score := self.score.get(joined := symbols[a] + symbols[b])) is not None:
                heapq.heappush(waiting, (-score, a, b, joined))

        for i in range(len(symbols) - 1):
            offer(i, i + 1)
        while waiting:
            _, a, b, joined = heapq.heappop(waiting)
            if not symbols[a] or not symbols[b] or symbols[a] + symbols[b] != joined:
                continue
            symbols[a], symbols[b] = joined, ""
            after[a] = after[b]
            if after[a] < len(symbols):
                before[after[a]] = a
            offer(before[a], a)
            offer(a, after[a])
        return [s for s in symbols if s]

    def together(self, segments: list[str]) -> list[list[str]]:
        """Pieces of segments of one length, merged at the same time."""
        out: list[list[str]] = [[]] * len(segments)
        for who, _, starts in self._merged(segments):
            for r, c in zip(who.tolist(), starts.tolist(), strict=True):
                s = segments[r]
                out[r] = [s[a:b] for a, b in zip(c, [*c[1:], len(s)], strict=True)]
        return out

    def _merged(self, segments: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Segments of one length: each step merges the best pair of every row. Numbers of segments
        that are done, and of each its symbols (-1 for a foreign character) and where they start."""
        n, width = len(segments), len(segments[0])
        points = np.array(segments, dtype=f"<U{width}").view(np.uint32).reshape(n, width)
        row = self.of_char[points]
        starts = np.tile(np.arange(width), (n, 1))
        rank, joins = self._look(row[:, :-1], row[:, 1:])
        rows = np.arange(n)
        while True:
            best = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(rows), int)
            live = rank[np.arange(len(rows)), best] != NONE if rank.shape[1] else np.zeros(len(rows), bool)
            if not live.all():
                yield rows[~live], row[~live], starts[~live]
            if not live.any():
                return
            row, rank, joins, starts, rows, best = (x[live] for x in (row, rank, joins, starts, rows, best))
            i = np.arange(len(rows))
            row[i, best] = joins[i, best]
            # Drop the right symbol and its pair; both neighbouring pairs are looked up again.
            shift = np.arange(row.shape[1] - 1)[None, :]
            row = np.take_along_axis(row, shift + (shift > best[:, None]), 1)
            starts = np.take_along_axis(starts, shift + (shift > best[:, None]), 1)
            gap = shift[:, :-1]
            rank = np.take_along_axis(rank, gap + (gap >= best[:, None]), 1)
            joins = np.take_along_axis(joins, gap + (gap >= best[:, None]), 1)
            if not rank.shape[1]:
                continue
            for near in (best - 1, best):
                ok = np.flatnonzero((near >= 0) & (near < rank.shape[1]))
                at = near[ok]
                rank[ok, at], joins[ok, at] = self._look(row[ok, at], row[ok, at + 1])

    def _coded(self, part: str) -> tuple[str, bytes]:
        """Ids of a piece, or of the bytes of what is none, each followed by a space; decoded bytes."""
        ids = [self.id[part]] if part in self.id else [self.byte[b] for b in part.encode()]
        return "".join([f"{i} " for i in ids]), b"".join([self.bytes_of[i] for i in ids])

    def _remember(self, segment: str, parts: list[str]) -> None:
        coded = [self._coded(p) for p in parts]
        self.ids[segment], self.raw[segment] = "".join([c[0] for c in coded]), b"".join([c[1] for c in coded])

    def forget(self) -> None:
        self.ids.clear()
        self.raw.clear()

    def learn(self, segments: set[str]) -> None:
        """Merge the segments that are new and remember their ids and decoded bytes."""
        if len(self.ids) + len(segments) > REMEMBERED:
            self.forget()
        by_length: dict[int, list[str]] = {}
        for s in segments.difference(self.ids):
            by_length.setdefault(len(s), []).append(s)
        ids_of, raw_of = self.symbol_ids.__getitem__, self.symbol_raw.__getitem__
        for width, group in by_length.items():
            if not 1 < width <= SHORT:
                for s in group:
                    self._remember(s, self.agenda(s))
                continue
            for who, row, starts in self._merged(group):
                foreign = (row < 0).any(axis=1).tolist()
                for i, (r, symbols, odd) in enumerate(zip(who.tolist(), row.tolist(), foreign, strict=True)):
                    s = group[r]
                    if odd:
                        cuts = [*starts[i].tolist(), width]
                        self._remember(s, [s[a:b] for a, b in zip(cuts, cuts[1:], strict=False)])
                    else:
                        self.ids[s], self.raw[s] = "".join(map(ids_of, symbols)), b"".join(map(raw_of, symbols))

    def encoded(self, texts: list[str]) -> Iterator[tuple[str, str]]:
        """Decimal ids joined by spaces, the end id last, and the text decoded from them."""
        cut = [self.cut.findall((MARK + t).replace(" ", MARK)) if t else [] for t in texts]
        self.learn(set().union(*cut))
        ids_of, raw_of = self.ids.__getitem__, self.raw.__getitem__
        for segments in cut:
            decoded = b"".join(map(raw_of, segments)).decode("utf-8", "replace")
            yield "".join(map(ids_of, segments)) + str(self.end), decoded[1:] if decoded[:1] == " " else decoded


@lru_cache(maxsize=2)
def pieces(model: str) -> Pieces:
    import public_tokenizers

    return Pieces(public_tokenizers.path(model))


def encode(docs: DataFrame, *keys: str, model: str = MODEL, ids: bool = False) -> DataFrame:
    """The key columns, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids and decoded.

    ``model`` names a file of the tokenizers' folder.
    """
    rows = docs.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(model)
        try:
            yield from coded(own, batches)
        finally:
            own.forget()

    def coded(own: Pieces, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(keys)
        for batch in batches:
            texts, at = batch.column("text"), 0
            ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
            while at < len(texts):
                # As many rows as make up a chunk of bytes, one at least.
                used = ends[at - 1] if at else 0
                stop = max(at + 1, int(np.searchsorted(ends, used + CHARACTERS)))
                some = texts.slice(at, stop - at).to_pylist()
                out = list(own.encoded(some))
                if at == 0:
                    expected = own.library.encode(some[0], add_eos=True)
                    if out[0] != (" ".join(map(str, expected)), own.library.decode(expected)):
                        raise ValueError(f"ids differ from the library's for a text of {len(some[0])} characters")
                columns = [batch.column(i).slice(at, stop - at) for i in range(width)]
                columns += [
                    pa.array([x.count(" ") + 1 for x, _ in out], pa.int64()),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x, _ in out]),
                    pa.array([hashlib.sha256(d.encode()).hexdigest() for _, d in out]),
                ]
                if ids:
                    columns += [
                        pa.array([np.array(x.split(" "), np.int32) for x, _ in out], pa.list_(pa.int32())),
                        pa.array([d for _, d in out]),
                    ]
                yield pa.RecordBatch.from_arrays(columns, [*(f"k{i}" for i in range(width)), *names])
                at = stop

    names = ["n_tokens", "ids_sha256", "decoded_sha256", *(["token_ids", "decoded"] if ids else [])]
    kinds = ["bigint", "string", "string", "array<int>", "string"]
    shape = ", ".join([f"k{i} {rows.schema[i].dataType.simpleString()}" for i in range(len(keys))] + [f"{a} {b}" for a, b in zip(names, kinds)])
    return rows.mapInArrow(lean(run), shape).toDF(*keys, *names)
