"""Documents whose sets of word shingles are alike, by a grouped prefix join.

All shingles have one order, rare ones first. Two sets with a Jaccard similarity of at least the
threshold share a shingle among the first few of both (their prefixes), and the first one they
share lies so early that enough is left after it. Documents with the same set are one class, and
classes with the same prefix and size one group; only the groups' prefixes are shuffled. A
shingle's list of groups is cut where sizes leap too far, and equal lists of different shingles
are one list.

The lists are then worked off. Two rounds compare every class with one pivot of its lists, which
links nearly all that is alike with few comparisons; classes that are linked already need no
more. The rest is compared pair by pair, once for the first list that two classes share, if size,
position and parity maps allow it and they are not linked yet. Each comparison is exact, on the
whole texts.

That gives the components. All links lie within them, so ``linked`` then compares the classes of
each component with each other, block by block, for the number of links of every document.

The order needs only be the same everywhere. The ``FREQUENT`` most frequent shingles come last,
by their number, so that their table has a proven size of 16 MB. Shingles are counted in every
batch in which they are repeated; the cut is the lowest count that keeps the table in bounds.

Nulls and edges: a null or blank text has no shingles and is linked with nothing; a text with
fewer words than a shingle has one, its whole sequence. A null doc_id comes last and shows as
null. Rows that repeat a doc_id stand for themselves. Shingles are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crewlens.llm.common import LAST, saved, texts_of
from crewlens.llm.graph import components, contracted, partial_components
from crewlens.llm.packing import packed, unpacked
from crewlens.llm.texts import LOWER, Ranges, chunks, combine, mix, words
from crewlens.llm.workers import lean, lean_group

WORDS = 5
PERCENT = 75
FREQUENT = 1 << 20
PIVOT_ROUNDS = 2
#: Bits of a set's parity map: bit i tells whether an odd number of its shingles hash to i. The
#: maps of two sets differ in no more bits than the sets differ in shingles.
BITS = 1024
SPREAD = 2
#: Shingles of a block of classes that are compared with those of another in one place.
BLOCK = 1 << 17
SALTS = 16
_U = np.uint64
TOKEN = np.dtype([("token", "u8"), ("group", "u8"), ("n", "u4"), ("pos", "u4")])
#: Bits of a token that travel, besides those that name its bucket. Two tokens that agree in them
#: only make a longer list.
KEPT = _U(24)
MEMBER = np.dtype([("group", "u8"), ("cid", "u8"), ("n", "u4")])
TOKENS, MEMBERS = 0, 1
PARCEL = "bucket int, kind int, data binary"
_parcel = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("data", pa.binary())])


def shingles(buf: np.ndarray, offsets: np.ndarray, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text of a chunk, and how many each text has."""
    ranges = Ranges(LOWER[buf])
    start, end, before = words(buf, offsets)
    word = ranges.hash(start, end)
    count = np.diff(before)
    full = np.maximum(count - k + 1, 0)
    text = np.repeat(np.arange(len(count)), full)
    at = before[:-1][text] + np.arange(len(text)) - np.repeat(np.cumsum(full) - full, full)
    rolled = combine(*[word[i : len(word) - k + 1 + i] for i in range(k)]) if len(word) >= k else word[:0]
    made = rolled[at]
    short = np.flatnonzero((count > 0) & (count < k))
    for i in short.tolist():
        # The length is part of it, so that it differs from any longer sequence.
        own = combine(_U(count[i]) * np.ones(1, _U), *[word[j : j + 1] for j in range(before[i], before[i + 1])])
        made, text = np.append(made, own), np.append(text, i)
    order = np.lexsort((made, text))
    made, text = made[order], text[order]
    new = np.ones(len(made), bool)
    new[1:] = (made[1:] != made[:-1]) | (text[1:] != text[:-1])
    return made[new], np.bincount(text[new], minlength=len(count))


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of each text's values, modulo 2**64."""
    total = np.concatenate([np.zeros(1, _U), np.cumsum(values, dtype=_U)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def set_id(made: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One hash per set, whatever its order."""
    return combine(_sums(mix(made), counts), _sums(mix(made + _U(0x5851F42D4C957F2D)), counts), counts.astype(_U))


def parity(made: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Parity maps, one row of 64-bit words per text."""
    text = np.repeat(np.arange(len(counts)), counts)
    at = text * BITS + (mix(made) % _U(BITS)).astype(np.int64)
    odd = np.bincount(at, minlength=len(counts) * BITS).astype(np.uint8) & 1
    return np.packbits(odd.reshape(len(counts), BITS), axis=1, bitorder="little").view(np.int64)


def _needed(n: Column | int, m: Column | int, percent: int) -> Column:
    """Least intersection of two similar sets of these sizes."""
    return F.ceil(percent * (n + m) / (100 + percent))


def _planes(values: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, so that they compress."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def _from_planes(raw: np.ndarray, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()


def write_tokens(rows: np.ndarray) -> bytes:
    """Tokens of one bucket: five bytes of each and the group as they are, size and place packed."""
    token = _planes(rows["token"] >> KEPT)[: 5 * len(rows)]
    packed = zstandard.compress(_planes(rows["n"].copy()) + _planes(rows["pos"].copy()), 1)
    return np.array([len(rows)], np.int64).tobytes() + token + rows["group"].tobytes() + packed


def read_tokens(raw: bytes) -> np.ndarray:
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    out = np.zeros(n, TOKEN)
    planes = np.concatenate([np.frombuffer(raw, np.uint8, 5 * n, 8), np.zeros(3 * n, np.uint8)])
    out["token"] = _from_planes(planes, "<u8") if n else 0
    out["group"] = np.frombuffer(raw, _U, n, 8 + 5 * n)
    rest = np.frombuffer(zstandard.decompress(raw[8 + 13 * n :]), np.uint8)
    out["n"], out["pos"] = (_from_planes(rest[a : a + 4 * n], "<u4") if n else 0 for a in (0, 4 * n))
    return out


def census(texts: DataFrame, k: int = WORDS) -> DataFrame:
    """Per document: doc, tid, n, cid (its set), bits (its parity map); besides, shingles repeated in a batch as kind 1."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, seen, maps = [], [], [], []
            for _, _, buf, offsets in chunks(batch.column("text")):
                made, counts = shingles(buf, offsets, k)
                ids.append(set_id(made, counts))
                sizes.append(counts)
                seen.append(made)
                maps.append(parity(made, counts))
            if not ids:
                continue
            token, times = np.unique(np.concatenate(seen), return_counts=True)
            often = times > 1
            rows = len(batch), int(often.sum())
            zeros = np.zeros(rows[1], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat([0, 1], rows).astype(np.int32)),
                    pa.array(np.concatenate([batch.column("doc").to_numpy(), zeros])),
                    pa.array(np.concatenate([batch.column("tid").to_numpy(), zeros])),
                    pa.array(np.concatenate([np.concatenate(sizes), times[often]]).astype(np.int64)),
                    pa.array(np.concatenate([np.concatenate(ids), token[often]]).astype(np.int64)),
                    pa.ListArray.from_arrays(
                        pa.array(np.append(np.arange(rows[0] + 1), np.full(rows[1], rows[0])).astype(np.int32) * (BITS // 64)),
                        pa.array(np.concatenate(maps).ravel()),
                    ),
                ],
                ["kind", "doc", "tid", "n", "cid", "bits"],
            )

    return texts.mapInArrow(lean(count), "kind int, doc long, tid long, n long, cid long, bits array<long>")


def frequent(counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles and the levels of their counts; at most ``FREQUENT`` of them."""
    level = F.floor(4 * F.log2("n")).cast("long").alias("level")
    sums = saved(counted.where("kind = 1").groupBy("cid").agg(F.sum("n").alias("n")).select("cid", level))
    least, room = 1 << 62, FREQUENT
    # One row per level; whole levels only, so that no choice among equals is needed.
    for r in sorted(sums.groupBy("level").agg(F.count("*").alias("n")).collect(), reverse=True):
        if r["n"] > room:
            break
        least, room = r["level"], room - r["n"]
    found = sums.where(F.col("level") >= least).toArrow()
    token = found.column("cid").to_numpy().astype(_U)
    order = np.argsort(token)
    return token[order], found.column("level").to_numpy()[order]


def prefixes(made: np.ndarray, counts: np.ndarray, often: np.ndarray, level: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of all prefixes in order, their places in them, and each text's prefix size."""
    text = np.repeat(np.arange(len(counts)), counts)
    rank = np.zeros(len(made), np.int64)
    if len(often):
        at = np.minimum(np.searchsorted(often, made), len(often) - 1)
        rank = np.where(often[at] == made, level[at] + 1, 0)
    order = np.lexsort((made, rank, text))
    place = np.arange(len(made)) - np.repeat(np.cumsum(counts) - counts, counts)
    size = np.where(counts > 0, counts - -(-percent * counts // 100) + 1, 0)
    kept = place < np.repeat(size, counts)
    return made[order][kept], place[kept], size


def lists(texts: DataFrame, often: tuple[np.ndarray, np.ndarray], buckets: int, k: int, percent: int) -> DataFrame:
    """Lists of groups that share a prefix token (kind 0: lid, group, n, pos), and the groups'
    classes (kind 1: group, cid, n)."""
    shared = texts.sparkSession.sparkContext.broadcast(often)

    def parcels(rows: np.ndarray, by: np.ndarray, kind: int, write: Callable[[np.ndarray], bytes]) -> list[tuple[int, int, bytes]]:
        if not len(rows):
            return []
        bucket = (by % _U(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        rows, bucket = rows[order], bucket[order]
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
        return [(int(bucket[a]), kind, write(rows[a:b])) for a, b in zip(cuts, [*cuts[1:], len(rows)], strict=True)]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, level = shared.value
        for batch in batches:
            found, own = [], []
            for _, _, buf, offsets in chunks(batch.column("text")):
                made, counts = shingles(buf, offsets, k)
                first, place, size = prefixes(made, counts, token, level, percent)
                group = combine(_sums(mix(first), size), counts.astype(_U))
                rows = np.zeros(len(first), TOKEN)
                rows["token"], rows["group"], rows["n"], rows["pos"] = first, np.repeat(group, size), np.repeat(counts, size), place
                found.append(rows)
                members = np.zeros(len(counts), MEMBER)
                members["group"], members["cid"], members["n"] = group, set_id(made, counts), counts
                own.append(members[counts > 0])
            if not found:
                continue
            rows, members = np.concatenate(found), np.unique(np.concatenate(own))
            order = np.lexsort((rows["group"], rows["token"]))
            rows = rows[order]
            rows = rows[np.append(True, (rows["token"][1:] != rows["token"][:-1]) | (rows["group"][1:] != rows["group"][:-1]))[: len(rows)]]
            out = parcels(rows, rows["token"], TOKENS, write_tokens) + parcels(members, members["group"], MEMBERS, np.ndarray.tobytes)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else ((), (), ()), _parcel.types, strict=True)], schema=_parcel)

    def compare(got: pa.Table) -> pa.Table:
        kinds, data = got.column("kind").to_numpy(), got.column("data")
        rows = np.concatenate([np.zeros(0, TOKEN), *[read_tokens(data[i].as_py()) for i in np.flatnonzero(kinds == TOKENS)]])
        members = np.unique(np.concatenate([np.zeros(0, MEMBER), *[np.frombuffer(data[i].as_py(), MEMBER) for i in np.flatnonzero(kinds == MEMBERS)]]))
        # Tokens of one group only are dropped first; they are most.
        rows = rows[np.lexsort((rows["group"], rows["n"], rows["token"]))]
        keep = np.append(True, (rows["token"][1:] != rows["token"][:-1]) | (rows["group"][1:] != rows["group"][:-1]))[: len(rows)]
        rows = rows[keep]
        far = 100 * rows["n"][:-1].astype(np.int64) < percent * rows["n"][1:].astype(np.int64)
        new = np.append(True, (rows["token"][1:] != rows["token"][:-1]) | far)[: len(rows)]
        number = np.cumsum(new) - 1
        many = np.bincount(number, minlength=1)[number] > 1 if len(rows) else np.zeros(0, bool)
        rows, number = rows[many], number[many]
        if len(rows):
            cuts = np.flatnonzero(np.diff(number, prepend=-1))
            lid = np.repeat(np.add.reduceat(mix(rows["group"].copy()), cuts), np.diff(np.append(cuts, len(rows))))
            # Equal lists are one; a member's place is the earliest of them.
            order = np.lexsort((rows["pos"], rows["group"], lid))
            rows, lid = rows[order], lid[order]
            keep = np.append(True, (lid[1:] != lid[:-1]) | (rows["group"][1:] != rows["group"][:-1]))
            rows, lid = rows[keep], lid[keep]
        else:
            lid = np.zeros(0, _U)
        return pa.table(
            {
                "kind": np.repeat([0, 1], [len(rows), len(members)]).astype(np.int32),
                "lid": np.concatenate([lid, members["group"]]).astype(np.int64),
                "item": np.concatenate([rows["group"], members["cid"]]).astype(np.int64),
                "n": np.concatenate([rows["n"], members["n"]]).astype(np.int64),
                "pos": np.concatenate([rows["pos"], np.zeros(len(members), np.uint32)]).astype(np.int64),
            }
        )

    return texts.mapInArrow(lean(send), PARCEL).groupBy("bucket").applyInArrow(lean_group(compare), "kind int, lid long, item long, n long, pos long")


def members(listed: DataFrame) -> DataFrame:
    """Lists with the groups expanded to their classes: lid, cid, n, pos.

    The classes of one group are a list of their own, ahead of all others.
    """
    of_group = listed.where("kind = 1").select(F.col("lid").alias("item"), F.col("item").alias("cid"), "n").distinct()
    shared = listed.where("kind = 0").groupBy("lid", "item").agg(F.min("pos").alias("pos"))
    across = shared.join(of_group, "item").select("lid", "cid", "n", "pos")
    several = of_group.groupBy("item").agg(F.count("*").alias("classes")).where("classes > 1").select("item")
    within = of_group.join(several, "item").select(F.xxhash64("item").alias("lid"), "cid", "n", F.lit(-1).cast("long").alias("pos"))
    return across.unionByName(within).groupBy("lid", "cid", "n").agg(F.min("pos").alias("pos"))


def _possible(a: str, b: str, percent: int) -> Column:
    """Whether size and position let two members of a list be similar."""
    col = lambda side, name: F.col(f"{side}.{name}")
    need = _needed(col(a, "n"), col(b, "n"), percent)
    return (
        (F.least(col(a, "n"), col(b, "n")) * 100 >= F.greatest(col(a, "n"), col(b, "n")) * percent)
        & (col(a, "n") - F.greatest(col(a, "pos"), F.lit(0)) >= need)
        & (col(b, "n") - F.greatest(col(b, "pos"), F.lit(0)) >= need)
    )


def _near(a: str, b: str, percent: int) -> Column:
    """Whether the parity maps of two classes let them be similar."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    apart = F.aggregate(
        F.zip_with(f"{a}.bits", f"{b}.bits", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda all_, x: all_ + x
    )
    return apart <= n + m - 2 * _needed(n, m, percent)


def verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """a, b, linked: exact comparison of the classes' texts (cid, packed)."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets: dict[int, np.ndarray] = {}

            def of(side: str, i: int, batch: pa.RecordBatch = batch, sets: dict[int, np.ndarray] = sets) -> np.ndarray:
                cid = batch.column(side)[i].as_py()
                if cid not in sets:
                    text = unpacked(batch.column(f"text_{side}").slice(i, 1))
                    sets[cid] = next(shingles(buf, offsets, k)[0] for _, _, buf, offsets in chunks(text))
                return sets[cid]

            linked = []
            for i in range(len(batch)):
                x, y = of("a", i), of("b", i)
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    left = texts.select(F.col("cid").alias("a"), F.col("packed").alias("text_a"))
    right = texts.select(F.col("cid").alias("b"), F.col("packed").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(lean(check), "a long, b long, linked boolean")


def _labelled(lists_: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Lists with their members' components, without the lists that lie in one."""
    if roots is None:
        return lists_.withColumn("label", F.col("cid"))
    named = lists_.join(roots.select(F.col("node").alias("cid"), "root"), "cid", "left").select(
        *lists_.columns, F.coalesce("root", "cid").alias("label")
    )
    open_ = named.groupBy("lid").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    return named.join(open_.select("lid"), "lid", "left_semi")


def _ordered(pairs: DataFrame) -> DataFrame:
    x, y = F.col("x.cid"), F.col("y.cid")
    return pairs.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


def _count(batches: Iterator[pa.RecordBatch], k: int, percent: int) -> Iterator[pa.RecordBatch]:
    """cid, links of the classes of one meeting after another; rows (key, side, cid, docs, packed) by key."""

    def compared(held: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
        got = pa.Table.from_batches(held)
        cid, docs, side = (got.column(c).to_numpy() for c in ("cid", "docs", "side"))
        links_ = np.zeros(len(cid), np.int64)
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        if len(cid) < 2 or not len(left) or not len(right):
            return cid, links_
        found = [shingles(buf, offsets, k) for _, _, buf, offsets in chunks(unpacked(got.column("packed")))]
        count = np.concatenate([c for _, c in found])
        token = np.unique(np.concatenate([m for m, _ in found]), return_inverse=True)[1]
        start = np.cumsum(count) - count
        theirs = token[np.repeat(side != 0, count)]
        first, many, weight = np.cumsum(count[right]) - count[right], count[right], docs[right]
        mark = np.zeros(int(token.max()) + 1, np.int32)
        for x in left.tolist():
            own = token[start[x] : start[x] + count[x]]
            mark[own] = 1
            both = np.add.reduceat(mark[theirs], first)
            mark[own] = 0
            linked_ = (100 * both >= percent * (count[x] + many - both)) & (right != x)
            links_[x] += weight[linked_].sum()
            if side[x] == 0:
                links_[right[linked_]] += docs[x]
        return cid, links_

    held: list[pa.RecordBatch] = []
    last = None

    def batch_of(out: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["cid", "links"])

    for batch in batches:
        key, out = batch.column("key").to_numpy(), []
        for a, b in zip([0, *(cuts := np.flatnonzero(np.diff(key)) + 1)], [*cuts, len(key)], strict=True):
            if held and a < b and key[a] != last:
                out.append(compared(held))
                held.clear()
            if a < b:
                held.append(batch.slice(a, b - a))
                last = key[a]
        if out:
            yield batch_of(out)
    if held:
        yield batch_of([compared(held)])


def link_counts(roots: DataFrame, sizes: DataFrame, class_texts: DataFrame, k: int, percent: int) -> DataFrame:
    """cid, links: the documents of other classes that a class is linked to; sizes hold (cid, n, docs).

    A large component is cut by size, so that a class is linked only within its level and the
    next ones, and each level into blocks of about ``BLOCK`` shingles. Every two blocks that may
    be linked meet in one place, and all their pairs are compared there. Rows that travel grow
    with the classes times the blocks of a component, comparisons with the square of its classes.
    """
    # A little wider than the threshold, so that rounding does not part two levels.
    level = F.floor(F.log("n") / math.log(100.1 / percent)).cast("int").alias("level")
    of = saved(roots.withColumnRenamed("node", "cid").join(sizes, "cid").select("root", "cid", "n", "docs", level))
    room = of.groupBy("root", "level").agg(F.sum("n").alias("n"))
    entries = F.collect_list(F.struct("level", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    large = room.groupBy("root").agg(F.sum("n").alias("all"), F.map_from_entries(entries).alias("blocks")).where(F.col("all") > BLOCK)
    salted = large.select("root", "blocks", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    named = of.withColumn("salt", F.pmod(F.xxhash64("cid"), F.lit(SALTS)).cast("int")).join(salted, ["root", "salt"], "left")
    placed = named.selectExpr(
        "root",
        "cid",
        "docs",
        "IF(blocks IS NULL, 0, level) AS level",
        "COALESCE(try_element_at(blocks, level), 1) AS own",
        "try_element_at(blocks, level - 1) AS lower",
        "try_element_at(blocks, level + 1) AS upper",
    ).selectExpr("*", "CAST(PMOD(xxhash64(cid, 1), own) AS INT) AS block")
    pairs = F.expr("""flatten(array_compact(array(
        transform(sequence(0, own - 1), o -> struct(level AS p, least(block, o) AS i, level AS q, greatest(block, o) AS j)),
        transform(sequence(0, lower - 1), o -> struct(level - 1 AS p, o AS i, level AS q, block AS j)),
        transform(sequence(0, upper - 1), o -> struct(level AS p, block AS i, level + 1 AS q, o AS j)))))""")
    met = placed.select("root", "cid", "docs", "level", "block", F.explode(pairs).alias("m")).selectExpr(
        "xxhash64(root, m.p, m.i, m.q, m.j) AS key",
        "CASE WHEN m.p = m.q AND m.i = m.j THEN 2 WHEN level = m.p AND block = m.i THEN 0 ELSE 1 END AS side",
        "cid",
        "docs",
    )
    sent = met.join(class_texts.select("cid", "packed"), "cid").select("key", "side", "cid", "docs", "packed")
    counts = sent.repartition("key").sortWithinPartitions("key").mapInArrow(lean(lambda batches: _count(batches, k, percent)), "cid long, links long")
    return counts.groupBy("cid").agg(F.sum("links").alias("links"))


def links(
    texts: DataFrame, counted: DataFrame, buckets: int, k: int = WORDS, percent: int = PERCENT, sizes: DataFrame | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """node, root over the classes that are linked; and their number of links, if ``sizes`` are given."""
    listed = saved(lists(texts, frequent(counted), buckets, k, percent))
    open_ = saved(members(listed))
    wanted = open_.select("cid").distinct()
    one = counted.where("kind = 0").join(wanted, "cid", "left_semi").groupBy("cid").agg(F.min(F.struct("doc", "tid")).alias("d"))
    carried = packed(texts).join(one.select("cid", "d.doc", "d.tid"), ["doc", "tid"])
    chosen = carried.groupBy("cid").agg(F.any_value("text").alias("packed"))
    # Each round reads the texts by class: bucketed by it, they are shuffled only once.
    name = f"jaccard_texts_{uuid.uuid4().hex}"
    spark = texts.sparkSession
    try:
        chosen.write.bucketBy(buckets // SPREAD, "cid").sortBy("cid").saveAsTable(name)
        maps = counted.where("kind = 0").join(wanted, "cid", "left_semi").groupBy("cid").agg(F.any_value("bits").alias("bits"))
        roots = _linked(open_, spark.table(name), maps, k, percent)
        return roots, sizes if sizes is None else saved(link_counts(roots, sizes, spark.table(name), k, percent))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _linked(open_: DataFrame, class_texts: DataFrame, maps: DataFrame, k: int, percent: int) -> DataFrame:
    """node, root: the lists worked off in rounds; maps hold (cid, bits)."""
    known: DataFrame | None = None
    roots: DataFrame | None = None
    for turn in range(PIVOT_ROUNDS + 1):
        now = _labelled(open_, roots)
        if turn < PIVOT_ROUNDS:
            pivot = now.groupBy("lid").agg(F.min(F.struct(F.xxhash64("cid", F.lit(turn)), "cid", "n", "pos", "label")).alias("p"))
            pivot = pivot.select("lid", "p.cid", "p.n", "p.pos", "p.label")
            pairs = now.alias("x").join(
                pivot.alias("y"),
                (F.col("x.lid") == F.col("y.lid")) & (F.col("x.label") != F.col("y.label")) & _possible("x", "y", percent),
            )
        else:
            # Each pair once: at the first list that both are in, by the order of the smaller id.
            now = saved(now)
            own = now.groupBy("cid").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "lid"))), lambda s: s["lid"]).alias("lids"))
            full = now.join(own, "cid").join(maps, "cid")
            pairs = full.alias("x").join(
                full.alias("y"),
                (F.col("x.lid") == F.col("y.lid"))
                & (F.col("x.cid") < F.col("y.cid"))
                & (F.col("x.label") != F.col("y.label"))
                & _possible("x", "y", percent)
                & _near("x", "y", percent)
                & (F.get(F.array_intersect("x.lids", "y.lids"), F.lit(0)) == F.col("x.lid")),
            )
        fresh = _ordered(pairs)
        if known is not None:
            fresh = fresh.join(known, ["a", "b"], "left_anti")
        done = saved(verified(fresh, class_texts, k, percent))
        known = done if known is None else known.unionByName(done)
        found = contracted(known.where("linked").select("a", "b"))
        # Between the rounds it is enough to know most of what hangs together.
        roots = partial_components(found) if turn < PIVOT_ROUNDS else components(found)
    return roots


def _components(docs: DataFrame, k: int, percent: int, count: bool = False) -> DataFrame:
    """doc, tid, n, the class at the root of the component, and its smallest doc, per document; if
    asked for, n_links too."""
    texts = texts_of(docs)
    counted = saved(census(texts, k))
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) * SPREAD
    rows = counted.where("kind = 0").select("doc", "tid", "n", "cid")
    classes = rows.where("n > 0").groupBy("cid").agg(F.min("doc").alias("least"), F.max("n").alias("n"), F.count("*").alias("docs"))
    roots, per = links(texts, counted, buckets, k, percent, classes.select("cid", "n", "docs") if count else None)
    rooted = classes.join(roots.withColumnRenamed("node", "cid"), "cid", "left").select("cid", "least", "docs", F.coalesce("root", "cid").alias("root"))
    whole = rooted.groupBy("root").agg(F.min("least").alias("component"))
    own = rooted.join(whole, "root")
    if per is not None:
        own = own.join(per, "cid", "left").withColumn("n_links", F.coalesce("links", F.lit(0)) + F.col("docs") - 1)
    added = ["n_links"] if count else []
    named = saved(own.select(F.col("cid").alias("c"), "root", "component", *added))
    return rows.join(named, (F.col("cid") == F.col("c")) & (F.col("n") > 0), "left").select(
        "doc", "tid", "n", "root", F.coalesce("component", "doc").alias("component"), *[F.coalesce(c, F.lit(0)).alias(c) for c in added]
    )


def _shown(found: DataFrame, *more: str) -> DataFrame:
    plain = lambda c: F.when(F.col(c) != LAST, F.col(c))
    return found.select(plain("doc").alias("doc_id"), F.col("n").alias("n_shingles"), plain("component").alias("component_id"), *more)


def similar(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, one row per document."""
    return _shown(_components(docs, k, percent))


def linked(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and n_links, one row per document.

    n_links counts all other documents that are similar enough, copies included.
    """
    return _shown(_components(docs, k, percent, count=True), "n_links")


def keep_one(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents without those linked to another of smaller doc_id; the columns stay.

    Groups go by their class, as several may have the same smallest doc_id, or only null ones.
    """
    found = _components(docs, k, percent)
    first = found.where("n > 0").groupBy("root").agg(F.min(F.struct("doc", "tid")).alias("d")).select("d.doc", "d.tid")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    text = F.coalesce("text", F.lit(""))
    held = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64(text).alias("tid"), text.rlike(r"[^\x20\x09-\x0D]").alias("worded"), row)
    chosen = held.where("worded").join(first, ["doc", "tid"], "left_semi").dropDuplicates(["doc", "tid"])
    return chosen.select("row.*").unionByName(held.where("NOT worded").select("row.*"))
