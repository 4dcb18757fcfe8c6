"""Texts compressed one by one, for shuffles that carry whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from crewlens.llm.workers import lean

LEVEL = 3


def packed(df: DataFrame, column: str = "text") -> DataFrame:
    """The rows with a text column compressed; the column must hold no nulls."""
    shape = ", ".join(f"`{f.name}` {'binary' if f.name == column else f.dataType.simpleString()}" for f in df.schema)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            at = batch.schema.get_field_index(column)
            small = pa.array([press.compress(t.as_py().encode()) for t in batch.column(at)], pa.binary())
            columns = [small if i == at else batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return df.mapInArrow(lean(pack), shape)


def unpacked(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    """The texts of a compressed column."""
    press = zstandard.ZstdDecompressor()
    return pa.array([press.decompress(x.as_py()).decode() for x in column], pa.large_string())
