"""Scans. One file or folder per sheet, CSV or parquet, always lazy after the header."""

from collections.abc import Collection, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crewlens import vocabulary as V
from crewlens.functions.parsing import col
from crewlens.operators.columns import clean_columns, clean_header
from crewlens.sources import records
from crewlens.sources.headers import Layout, all_columns, layouts

ROW = V.ROW


def blank_to_null(df: DataFrame, tokens: Sequence[str] = V.MISSING_TOKENS) -> DataFrame:
    """Texts that mean 'no value' become NULL in all text columns."""
    def cell(f: T.StructField) -> Column:
        c = col(f.name)
        return F.when(~c.isin(*tokens), c).alias(f.name) if isinstance(f.dataType, T.StringType) else c

    return df.select(*[cell(f) for f in df.schema.fields])


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None = None,
    sep: str = ",",
    encoding: str = "UTF-8",
) -> DataFrame:
    """CSV with header, columns by position. Without a schema the types are inferred, which costs
    a pass.

    A row that does not have the header's number of cells is an error, so that a line break
    inside a cell cannot split it unseen; ``records`` reads such cells.
    """
    reader = spark.read.options(header=True, sep=sep, escape='"', encoding=encoding, mode="FAILFAST")
    where = path if isinstance(path, str) else list(path)
    return reader.schema(schema).csv(where) if schema else reader.option("inferSchema", True).csv(where)


def _file_order(part: Column, start: Column, seq: Column) -> Column:
    """Ordinal that ascends in file order: (``part``: file and block, ``seq``: position inside)."""
    return F.struct(F.concat_ws("#", part, F.lpad(start.cast("string"), 20, "0")).alias("part"), seq.alias("seq"))


def _read_layout(
    spark: SparkSession, files: str | Sequence[str], schema: T.StructType, ordinal: bool, sep: str, encoding: str,
    multi_line: bool, split_bytes: int,
) -> DataFrame:
    """The rows of files that share a header, with a ``_row`` ordinal if asked for."""
    names = [col(f.name) for f in schema.fields]
    if multi_line:
        raw = records.read_records(spark, files, schema, sep, encoding, split_bytes)
        made = _file_order(F.col(records.FILE), F.col(records.START), F.col(records.SEQ))
    else:
        raw = read_csv(spark, files, schema, sep, encoding)
        made = _file_order(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    if ROW in schema.fieldNames():
        return raw.select(*names).withColumn(ROW, col(ROW).try_cast("long"))
    return raw.select(*names, made.alias(ROW)) if ordinal else raw.select(*names)


def text_schema(names: Iterable[str]) -> T.StructType:
    """Text columns of the given names."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def reconciled(
    spark: SparkSession,
    path: str,
    found: Sequence[Layout],
    expected: Sequence[str] | None = None,
    unknown: str = "keep",
    ordinal: bool = False,
    sep: str = ",",
    encoding: str = "UTF-8",
    multi_line: bool = False,
    split_bytes: int = records.SPLIT_BYTES,
) -> DataFrame:
    """Files of any header as one table of text columns, matched by name.

    Every layout is one scan with its own schema. A column that a file lacks is NULL there.
    Columns beyond ``expected`` are kept, dropped (``unknown="drop"``) or an error that names
    them and a file (``"error"``); an expected column that no file has is an error too.
    """
    names = all_columns(found)
    if expected is not None:
        absent = [n for n in expected if n not in names]
        if absent:
            raise ValueError(f"no file under {path} has the columns {absent}")
        extra = {n: layout.files[0] for layout in reversed(found) for n in layout.names if n not in expected}
        if extra and unknown == "error":
            raise ValueError(f"unknown columns in {path}: " + ", ".join(f"{n!r} in {f}" for n, f in extra.items()))
        names = list(expected) if unknown == "drop" else [*expected, *[n for n in names if n in extra]]
    parts = [
        _read_layout(spark, path if len(found) == 1 else layout.files, text_schema(layout.names), ordinal, sep, encoding, multi_line, split_bytes)
        for layout in found
    ]
    # Ordinals of the sheets themselves and made ones do not mix.
    if ordinal and 0 < sum(ROW in layout.names for layout in found) < len(found):
        raise ValueError(f"only some files under {path} have a {ROW} column")
    table = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return table.select(*[col(n) for n in dict.fromkeys([*names, *([ROW] if ordinal else [])])])


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    ordinal: bool = False,
    fmt: str | None = None,
    sep: str = ",",
    clean: bool = True,
    encoding: str = "UTF-8",
    multi_line: bool = False,
    expected: Sequence[str] | None = None,
    unknown: str = "keep",
    split_bytes: int = records.SPLIT_BYTES,
) -> DataFrame:
    """A sheet as a table: cleaned headers, 'no value' texts as NULL, optional row ordinal.

    ``fmt`` is 'csv' or 'parquet', by default taken from the path. CSV cells stay text, and the
    files of a folder are matched by their headers (``reconciled``) unless a schema states the
    columns by position. ``multi_line`` reads cells with line breaks, by many tasks per file.
    Parquet files are matched by name as well. A ``_row`` column of the source is the ordinal;
    otherwise it is made of the file position and ascends in file order however Spark groups the
    blocks into tasks.
    """
    kind = fmt or ("csv" if path.rstrip("/").endswith(".csv") else "parquet")
    if kind == "csv":
        if schema:
            table = _read_layout(spark, path, schema, ordinal, sep, encoding, multi_line, split_bytes)
            table = clean_columns(table) if clean else table
        else:
            found = layouts(spark, path, sep, encoding, clean_header if clean else str)
            if not found:
                raise ValueError(f"no header in {path}")
            table = reconciled(spark, path, found, expected, unknown, ordinal, sep, encoding, multi_line, split_bytes)
        return blank_to_null(table)
    if kind != "parquet":
        raise ValueError(f"unknown format {kind!r}")
    raw = (spark.read.schema(schema) if schema else spark.read.option("mergeSchema", True)).parquet(path)
    names = list(raw.columns)
    if ordinal and ROW not in names:
        at = F.struct(F.col("_metadata.file_path").alias("part"), F.col("_metadata.row_index").alias("seq"))
        raw = raw.select(*[col(n) for n in names], at.alias(ROW))
    return clean_columns(raw) if clean else raw


# The sheets by name: does the plan need row order, and are the headers cleaned?
SHEETS: Mapping[str, tuple[bool, bool]] = {
    "workforce": (True, True),
    "performance_2023": (True, True),
    "performance_2024": (True, True),
    "performance_working": (True, False),
    "absenteeism": (False, True),
    "training_records": (False, True),
    "training_quick": (False, True),
    "training_cold": (False, True),
    "finance_pl": (False, True),
    "finance_fte": (True, True),
}


def load_sources(
    spark: SparkSession,
    root: str,
    fmt: str = "csv",
    sep: str = ",",
    names: Iterable[str] = tuple(SHEETS),
    views: bool = False,
    encoding: str = "UTF-8",
    multi_line: Collection[str] = (),
) -> dict[str, DataFrame]:
    """The named sheets under ``root`` (``<root>/<sheet>.<fmt>``) as a catalog of lazy tables.

    ``views`` also registers them as temporary views under the same names. ``multi_line`` names
    the CSV sheets with line breaks inside cells.
    """
    tables = {}
    for name in names:
        ordered, clean = SHEETS[name]
        tables[name] = read_table(spark, f"{root}/{name}.{fmt}", ordinal=ordered, fmt=fmt, sep=sep, clean=clean,
                                  encoding=encoding, multi_line=name in multi_line)
    if views:
        for name, table in tables.items():
            table.createOrReplaceTempView(name)
    return tables
