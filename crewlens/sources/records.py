"""CSV records with line breaks inside cells, read by many tasks per file.

A line break belongs to a cell if the number of quotes before it is odd. Spark reads the file as
lines, dealt to ranges of bytes (blocks). One pass counts the quotes of every block; a running
sum over the blocks of a file, one row each, tells whether a block starts inside a cell. In a
second pass every block streams its lines in file order and joins those of each record, without a
shuffle. Only records that reach over the end of a block are put together afterwards, from two
pieces per block at most, which a third pass that makes nothing else looks up.

A task streams as many blocks as make up ``SPLIT_BYTES``, one after another, so that small blocks
do not cost a task and a Python worker's start each; inputs too small for that are dealt to
``TASKS_PER_CORE`` tasks per core.

The state of the blocks reaches the lines by a broadcast up to ``MOST_BLOCKS`` blocks, and beyond
by a join, for which the lines are shuffled by block and sorted.

Quotes are taken to stand around cells and, doubled, inside them; a file with an odd number of
quotes is an error. A single cell, and so a record, must fit in a task's memory.
"""

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crewlens.operators.lookup import leaf_bytes

SPLIT_BYTES = 128 << 20
#: A block's state is some 200 bytes.
MOST_BLOCKS = 100_000
TASKS_PER_CORE = 3
BLOCK = ["file", "block"]
FILE, START, SEQ, RECORD = "_file", "_start", "_seq", "_record"
WHOLE, LEAD, TAIL = 0, 1, 2


def _steady(spark: SparkSession, split_bytes: int) -> SparkSession:
    """A session whose splits depend on nothing but the files.

    Spark also sizes splits by the number of cores there are when a scan starts, so that two scans
    of one file could be cut differently if executors come or go in between.
    """
    out = spark.newSession()
    out.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    out.conf.set("spark.sql.files.openCostInBytes", str(split_bytes))
    out.conf.set("spark.sql.files.minPartitionNum", "1")
    return out


def lines(spark: SparkSession, files: str | Sequence[str], encoding: str = "UTF-8", split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """file, block (its first byte), seq (ascending inside a block), line without its end."""
    steady = _steady(spark, split_bytes)
    read = steady.read.option("lineSep", "\n").text(list(files) if not isinstance(files, str) else files)
    value = F.col("value") if encoding.upper() in ("UTF-8", "UTF8") else F.decode(F.col("value").cast("binary"), encoding)
    rows = read.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        value.alias("line"),
    )
    # Known to the caller's session by a view that lives as long as the plan is taken from it.
    name = f"lines_{id(rows):x}"
    rows.createOrReplaceGlobalTempView(name)
    try:
        return spark.table(f"global_temp.{name}")
    finally:
        spark.catalog.dropGlobalTempView(name)


def _odd(c: Column) -> Column:
    return c.bitwiseAND(F.lit(1))


def _quotes(line: str) -> Column:
    return (F.length(line) - F.length(F.replace(F.col(line), F.lit('"'), F.lit("")))).cast("long")


def _blank(line: str) -> Column:
    return F.col(line).isin("", "\r")


def blocks(rows: DataFrame) -> DataFrame:
    """Per block: does it start inside a cell, and which line is the file's first with any text."""
    own = rows.groupBy(*BLOCK).agg(
        _odd(F.sum(_quotes("line"))).alias("odd"),
        F.min(F.when(~_blank("line"), F.struct("block", "seq"))).alias("first"),
    )
    # One row per block.
    of_file = Window.partitionBy("file")
    ahead = of_file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    message = F.concat(F.lit("odd number of quotes in "), "file")
    whole = F.when(_odd(F.sum("odd").over(of_file)) == 0, F.lit(0)).otherwise(F.raise_error(message).cast("int"))
    inside = _odd(F.coalesce(F.sum("odd").over(ahead), F.lit(0))) + whole
    return own.select(*BLOCK, inside.alias("inside"), "odd", F.min("first").over(of_file).alias("first"))


class _Joiner:
    """Lines of one task in file order, joined to records.

    ``WHOLE`` records, the ``LEAD`` of a block that starts inside a record, and the ``TAIL``
    that a block ends in; ``parts`` leaves the whole ones out.
    """

    shape = pa.schema([("file", pa.string()), ("block", pa.int64()), ("seq", pa.int64()), ("kind", pa.int32()), ("record", pa.string()), ("is_header", pa.bool_())])

    def __init__(self, parts: bool) -> None:
        self.parts = parts
        self.place: tuple[str, int] | None = None
        self.first: tuple[int, int] | None = None
        self.state = 0
        self.held: list[str] = []
        self.seq, self.kind = 0, WHOLE

    def batches(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = batch.column("block").to_numpy()
            if not len(block):
                continue
            file = batch.column("file")
            new = np.append(True, block[1:] != block[:-1])
            new[1:] |= pc.not_equal(file[1:], file[:-1]).to_numpy(zero_copy_only=False)
            edges = [*np.flatnonzero(new).tolist(), len(block)]
            for low, high in zip(edges, edges[1:]):
                place = (file[low].as_py(), int(block[low]))
                if place != self.place:
                    yield from self.close()
                    self.enter(place, batch, low)
                yield from self.lines(batch.column("line").slice(low, high - low), batch.column("seq").to_numpy()[low:high])
        yield from self.close()

    def enter(self, place: tuple[str, int], batch: pa.RecordBatch, row: int) -> None:
        inside = batch.column("inside")[row].as_py()
        if inside is None:
            raise ValueError(f"{place[0]} changed between two scans")
        first = batch.column("first")[row].as_py()
        self.place, self.state = place, inside
        self.first = (first["block"], first["seq"]) if first else None
        self.held, self.kind = [], LEAD if inside else WHOLE
        self.seq = batch.column("seq")[row].as_py()

    def close(self) -> Iterator[pa.RecordBatch]:
        """What a block ends in: the record that is still open."""
        if self.held:
            yield self.rows([self.seq], [self.kind if self.kind == LEAD else TAIL], ["\n".join(self.held)])
            self.held = []

    def rows(self, seq: Sequence[int] | np.ndarray, kind: Sequence[int], record: list[str] | pa.Array) -> pa.RecordBatch:
        file, block = self.place
        n = len(seq)
        header = np.asarray(seq) == self.first[1] if self.first and self.first[0] == block else np.zeros(n, bool)
        return pa.RecordBatch.from_arrays([
            pa.array([file]).take(pa.array(np.zeros(n, np.int64))), pa.array(np.full(n, block)), pa.array(np.asarray(seq, np.int64)),
            pa.array(np.asarray(kind, np.int32)), pa.array(record, pa.string()), pa.array(header),
        ], schema=self.shape)

    def lines(self, line: pa.Array, seq: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Lines of the current block; a last record that is still open is held back."""
        odd = pc.count_substring(line, '"').to_numpy() & 1
        toggles = np.cumsum(odd)
        after = (toggles + self.state) & 1
        before = after ^ odd
        blank = np.isin(pc.binary_length(line).to_numpy(), (0, 1)) & pc.is_in(line, pa.array(["", "\r"])).to_numpy(zero_copy_only=False)
        begun = (before == 0) & ~blank
        self.state = int(after[-1])
        if not self.held and self.kind != LEAD and not odd.any():
            if not self.parts:
                yield self.rows(seq[begun], np.full(int(begun.sum()), WHOLE), line.filter(pa.array(begun)))
            return
        kept = np.flatnonzero(begun | (before == 1))
        starts = np.flatnonzero(begun[kept])
        # Lines ahead of the first start go on with what is held, or with the block's lead.
        ahead = kept[: starts[0]] if len(starts) else kept
        self.held += line.take(pa.array(ahead)).to_pylist()
        if self.held and (len(starts) or not self.state):
            if self.kind == LEAD or not self.parts:
                yield self.rows([self.seq], [self.kind], ["\n".join(self.held)])
            self.held, self.kind = [], WHOLE
        if len(starts):
            ends = np.append(starts, len(kept))
            if self.state:
                # The last record is open.
                last, ends = kept[starts[-1] :], starts
                self.held, self.seq, self.kind = line.take(pa.array(last)).to_pylist(), int(seq[last[0]]), WHOLE
            if not self.parts and len(ends) > 1:
                lines = line.take(pa.array(kept[ends[0] : ends[-1]]))
                made = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends - ends[0], pa.int32()), lines), "\n")
                yield self.rows(seq[kept[ends[:-1]]], np.full(len(made), WHOLE), made)


def _joined(rows: DataFrame, parts: bool) -> DataFrame:
    shape = "file string, block long, seq long, kind int, record string, is_header boolean"
    return rows.mapInArrow(lambda batches: _Joiner(parts).batches(batches), shape)


def _in_tasks(rows: DataFrame) -> DataFrame:
    """Lines of several blocks per task, if blocks are small; each block stays whole and in order.

    ``seq`` is made ahead of this, by the split, and does not depend on the number of tasks.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.coalesce(max(leaf_bytes(rows) // SPLIT_BYTES, cores * TASKS_PER_CORE))


def records(rows: DataFrame, split_bytes: int = SPLIT_BYTES, most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """file, block and seq of the first line, record, is_header: all records that are not blank.

    ``rows`` are ``lines`` in splits of ``split_bytes``.
    """
    size, rows = leaf_bytes(rows), _in_tasks(rows)
    state = blocks(rows)
    if size // split_bytes <= most_blocks:
        # Scan order is kept by a broadcast.
        met = rows.join(F.broadcast(state), BLOCK, "left")
    else:
        met = rows.join(state, BLOCK, "left").repartition(*BLOCK).sortWithinPartitions(*BLOCK, "seq")
    met = met.select("file", "block", "seq", "line", "inside", "first")
    whole = _joined(met, False).where(F.col("kind") == WHOLE)
    pieces = _joined(met, True)
    # Two pieces per block at most: a record's first one, then one of each block that it reaches.
    order = Window.partitionBy("file").orderBy("block", "kind")
    chained = pieces.withColumn("_chain", F.sum((F.col("kind") == TAIL).cast("long")).over(order))
    piece = F.struct("block", "seq", "record")
    stitched = chained.groupBy("file", "_chain").agg(
        F.min(F.struct("block", "seq")).alias("at"),
        F.array_join(F.transform(F.array_sort(F.collect_list(piece)), lambda x: x["record"]), "\n").alias("record"),
        F.bool_or("is_header").alias("is_header"),
    ).select("file", F.col("at.block").alias("block"), F.col("at.seq").alias("seq"), "record", "is_header")
    every = whole.select(*BLOCK, "seq", "record", "is_header").unionByName(stitched)
    bare = F.when(F.endswith("record", F.lit("\r")), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    return every.withColumn("record", bare)


def read_records(
    spark: SparkSession,
    files: str | Sequence[str],
    schema: T.StructType,
    sep: str = ",",
    encoding: str = "UTF-8",
    split_bytes: int = SPLIT_BYTES,
    most_blocks: int = MOST_BLOCKS,
) -> DataFrame:
    """Columns of ``schema``, and ``_file``, ``_start`` and ``_seq`` that give the file order.

    A record that does not have the schema's number of cells is an error.
    """
    found = records(lines(spark, files, encoding, split_bytes), split_bytes, most_blocks).where(~F.col("is_header"))
    how = {"sep": sep, "escape": '"', "mode": "FAILFAST", "multiLine": "true"}
    plain = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(schema.fields)])
    cells = found.select("file", "block", "seq", F.from_csv("record", plain.simpleString()[7:-1].replace(":", " "), how).alias(RECORD))
    named = [F.col(f"{RECORD}.c{i}").alias(f.name) for i, f in enumerate(schema.fields)]
    return cells.select(*named, F.col("file").alias(FILE), F.col("block").alias(START), F.col("seq").alias(SEQ))
